"""Windows of words, overlaps between neighbours, duplicates and retrieval over chunks.

Null and blank texts give no window and no row unless a docstring says otherwise; repeated rows are separate chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.predicates import normalized
from ..functions.text import with_once, words
from .adjacency import with_neighbour
from .searching import search, spaced_tokens, spaced_words


def word_windows(rows: DataFrame, id_col: str, text_col: str = "text", size: int = 400, overlap: int = 50) -> DataFrame:
    """(id, chunk, n_words, text): windows of ``size`` words, each beginning ``size - overlap`` after the one before.

    A window that its predecessor holds wholly is left out, as is a last one of at most twice the overlap.
    """
    step = max(1, size - max(overlap, 0))
    w = with_once(rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("w")), "w", words(F.col("w"))).where(F.size("w") > 0).withColumn("n", F.size("w"))
    starts = w.select("id", "w", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(step))).alias("s"))
    length = F.least(F.lit(size), F.col("n") - F.col("s"))
    contained = (F.col("s") > 0) & (F.col("n") - F.col("s") <= overlap)
    tiny_last = (F.col("s") > 0) & (F.col("s") + step >= F.col("n")) & (length <= 2 * overlap)
    # After a contained window is left out, the one before it is the last; it is full or longer than the overlap already.
    kept = starts.where(~contained & ~tiny_last)
    cut = kept.select(F.col("id").alias(id_col), (F.col("s") / step).cast("int").alias("chunk"), length.alias("n_words"), F.slice("w", F.col("s") + 1, length).alias("text"))
    return with_once(cut, "text", F.array_join("text", " "))


def overlap_window(prev: Column, curr: Column, limit: int) -> Column:
    """Length of the longest run of words that ends ``prev`` and begins ``curr``, up to ``limit``; arrays of words."""
    most = F.least(F.size(prev), F.size(curr), F.lit(limit))
    hits = F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda n: (n <= most) & (F.slice(prev, F.size(prev) - n + 1, n) == F.slice(curr, F.lit(1), n)))
    return F.when(most >= 1, F.coalesce(F.array_max(hits), F.lit(0))).otherwise(0)


def boundary_overlaps(rows: DataFrame, group: list[str], order: list[str], least: int = 5, most: int = 20) -> DataFrame:
    """Rows whose last words, five to twenty, are the first of the next row, case ignored; adds ``overlap_words``. Each text is
    cut into words once, and only its first and last words meet those of its neighbours."""
    edges = with_once(rows, "__w", words(F.lower("text"))).withColumns(
        {"__tail": F.slice("__w", F.greatest(F.size("__w") - most + 1, F.lit(1)), F.lit(most)), "__head": F.slice("__w", F.lit(1), F.lit(most))}
    )
    pairs = with_neighbour(edges.drop("__w"), group, order, {"head": F.col("__head")}, "__next").where("__next.head is not null")
    found = with_once(pairs, "overlap_words", overlap_window(F.col("__tail"), F.col("__next.head"), most))
    return found.where(F.col("overlap_words") >= least).drop("__tail", "__head", "__next")


def fingerprint(text: Column) -> Column:
    """Lower case, plain quotes, single spaces: what exact duplicates share."""
    return normalized(F.translate(text, "“”‘’", "\"\"''"))


def exact_duplicates(rows: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(fp, copies, first_id, second_id): fingerprints of several rows. Only hashes are shuffled, with partial aggregation."""
    keyed = rows.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("t")).where("t <> ''").select("id", F.md5("t").alias("fp"))
    first = keyed.groupBy("fp").agg(F.count("*").alias("copies"), F.min("id").alias("first_id")).where("copies > 1")
    second = keyed.join(first, "fp").where("id > first_id").groupBy("fp").agg(F.min("id").alias("second_id"))
    return first.join(second, "fp")


def _shingle_hashes(rows: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, h, pos): the hash and first place, in words from 1, of each different run of ``size`` words of the fingerprint."""
    w = with_once(rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "w", F.filter(F.split(fingerprint(F.col("text")), " "), lambda x: x != ""))
    w = w.where(F.size("w") >= size).select("id", "w", F.sequence(F.lit(1), F.size("w") - size + 1).alias("at"))
    runs = F.array_sort(F.transform("at", lambda i: F.struct(F.xxhash64(F.slice("w", i, size)).alias("h"), i.alias("pos"))))
    once = with_once(w, "runs", runs).select("id", F.explode(F.filter("runs", lambda x, i: (i == 0) | (x["h"] != F.get("runs", i - 1)["h"]))).alias("r"))
    return once.select("id", "r.h", "r.pos")


def shared_shingles(rows: DataFrame, id_col: str, text_col: str = "text", size: int = 5) -> DataFrame:
    """(id, shingles, shared, first_shared, least_holder): how many of a row's runs of words another row has too, the first of
    them in the text, and the least row that has one of them.

    One row for each input row with a run, not a row for each pair: counting holders of a run needs no pairs, so a run that
    a third of all rows hold costs no more than any other. Hashes are shuffled; one run a row is read from its text again.
    """
    at = _shingle_hashes(rows, id_col, text_col, size)
    holders = at.groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    several = F.col("n") > 1
    per = at.join(holders, "h").groupBy("id").agg(
        F.count("*").alias("shingles"), F.count_if(several).alias("shared"), F.min(F.when(several, F.col("pos"))).alias("pos"), F.min(F.when(several, F.col("least"))).alias("least_holder")
    )
    texts = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).groupBy("id").agg(F.first("text").alias("text"))
    w = F.filter(F.split(fingerprint(F.col("text")), " "), lambda x: x != "")
    first = F.when(F.col("pos").isNotNull(), F.array_join(F.slice(w, F.col("pos"), F.lit(size)), " "))
    return per.join(texts, "id").select(F.col("id").alias(id_col), "shingles", "shared", first.alias("first_shared"), "least_holder")


def shingle_links(rows: DataFrame, id_col: str, text_col: str = "text", size: int = 5) -> DataFrame:
    """(id, first_id, runs): for each run of words that rows share, every other row is linked to the least that has it; ``runs`` are
    those of a link. Rows share a run if one is linked to the other, or both to a third, so no link is lost, without a row for
    each pair."""
    at = _shingle_hashes(rows, id_col, text_col, size)
    first = at.groupBy("h").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id").select("h", "first_id")
    return at.join(first, "h").where("id > first_id").groupBy(F.col("id").alias(id_col), "first_id").agg(F.count("*").alias("runs"))


def repeated_sentences(rows: DataFrame, id_col: str, text_col: str = "text", least_words: int = 10) -> DataFrame:
    """(sentence, times, first_id): sentences of ten words or more that occur more than once, by their normalised text."""
    marked = F.regexp_replace(F.col(text_col), r"([.!?])\s+", "$1\n")
    parts = rows.select(F.col(id_col).alias("id"), F.explode(F.split(marked, "\n")).alias("s")).select("id", normalized(F.col("s")).alias("sentence"))
    parts = parts.where(F.size(words(F.col("sentence"))) >= least_words)
    return parts.groupBy("sentence").agg(F.count("*").alias("times"), F.min("id").alias("first_id")).where("times > 1")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def term_weights(rows: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, term, tf): share of each term among a row's tokens."""
    t = rows.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("t")).where(F.size("t") > 0)
    exploded = t.select("id", F.size("t").alias("total"), F.explode("t").alias("term"))
    return exploded.groupBy("id", "term", "total").agg(F.count("*").alias("c")).select("id", "term", (F.col("c") / F.col("total")).alias("tf"))


def document_frequencies(weights: DataFrame) -> DataFrame:
    """(term, df) of term weights."""
    return weights.groupBy("term").agg(F.count("*").alias("df"))


def boundary_queries(rows: DataFrame, group: list[str], order: list[str], id_col: str) -> DataFrame:
    """(id, next_id, query): the last five and first five tokens at each boundary of neighbours with ten tokens each."""
    t = with_once(rows.select(F.col(id_col).alias("__id"), *group, *(c for c in order if c != id_col), *([id_col] if id_col in order else []), "text"), "t", tokens(F.col("text"))).drop("text")
    edges = t.select(*(c for c in t.columns if c != "t"), F.size("t").alias("__n"), F.slice("t", F.greatest(F.size("t") - 4, F.lit(1)), F.lit(5)).alias("__tail"), F.slice("t", F.lit(1), F.lit(5)).alias("__head"))
    edges = edges.withColumn("__tail", F.when(F.col("__n") >= 10, F.col("__tail")))
    both = with_neighbour(edges, group, order, {"id": F.col("__id"), "n": F.col("__n"), "head": F.col("__head")}, "u").where("__n >= 10 and u.n >= 10")
    return both.select(F.col("__id").alias("id"), F.col("u.id").alias("next_id"), F.concat("__tail", "u.head").alias("query"))


def retrieve(queries: DataFrame, rows: DataFrame, id_col: str, k: int = 3) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` best rows for each (query_id, query) by the sum of tf * idf.

    ``queries`` is a stated set that is small against the rows. Every block of rows gives its best for each query (``searching``), so
    neither weights of terms nor pairs of a query and a row are shuffled.
    """
    n = rows.count()  # of files, the footers only are read
    texts = rows.select(F.col(id_col).alias("id"), spaced_tokens(F.col("text")).alias("s")).where("s <> ''")
    asked = queries.select(F.lit(0).alias("overlap"), F.col("query_id").alias("q"), "query")
    found = search(texts, n, asked, k, n_units=n)[1].select(F.col("q").alias("query_id"), "id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def recall_by_overlap(rows: DataFrame, id_col: str, overlaps: tuple[int, ...], asked: Column, size: int = 400, k: int = 3) -> DataFrame:
    """(overlap, chunks, queries, recall): for each overlap, how often one of the two windows at a boundary is among the ``k`` best for the
    last five and first five tokens there. ``asked`` picks the rows whose boundaries are asked; they are asked of all windows.

    All overlaps are one plan. Texts are shuffled once, and cut into windows where they are searched (``searching``): a row of one window
    has the same one for every overlap. Equal scores are in the order of the row and window.
    """
    sources = rows.select(F.col(id_col).alias("row"), "text").where(asked)
    parts = [word_windows(sources, "row", size=size, overlap=o).select(F.lit(o).alias("overlap"), "row", "chunk", tokens(F.col("text")).alias("t")) for o in overlaps]
    windows = parts[0]
    for part in parts[1:]:
        windows = windows.unionByName(part)
    near = Window.partitionBy("overlap", "row").orderBy("chunk")  # a row's windows
    beside = windows.withColumns({"u": F.lead("t").over(near), "next": F.lead("chunk").over(near)})
    ask = beside.where((F.size("t") >= 10) & (F.size("u") >= 10)).select("overlap", F.struct("row", "chunk").alias("q"), "next", F.concat(F.slice("t", F.size("t") - 4, F.lit(5)), F.slice("u", F.lit(1), F.lit(5))).alias("query"))
    texts = rows.select(F.col(id_col).alias("id"), spaced_words(F.col("text")).alias("s")).where("s <> ''")
    sizes, scored = search(texts, rows.count(), ask.drop("next"), k, size, overlaps)
    best = Window.partitionBy("overlap", "q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "chunk")
    top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    hit = (F.col("id") == F.col("q.row")) & ((F.col("chunk") == F.col("q.chunk")) | (F.col("chunk") == F.col("next")))
    per = top.join(ask.select("overlap", "q", "next"), ["overlap", "q"]).groupBy("overlap", "q").agg(F.max(hit.cast("int")).alias("hit"))
    recall = per.groupBy("overlap").agg(F.count("*").alias("queries"), F.round(F.avg("hit"), 6).alias("recall"))
    return sizes.join(recall, "overlap", "left").select("overlap", F.col("units").alias("chunks"), F.coalesce("queries", F.lit(0)).alias("queries"), "recall")
