"""Statistics and scores over tables of chunks. Aggregations only; null texts count where a docstring says so."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import metrics as M
from ..functions import predicates as P
from ..functions.text import n_words, strip, with_once, words
from .adjacency import with_neighbour
from .blocks import lines_as_blocks


def size_statistics(rows: DataFrame) -> DataFrame:
    """One row: count, mean, median, least, most and deviation of words and characters; empty and null texts don't count."""
    sizes = rows.where("text <> ''").select(n_words(F.col("text")).cast("bigint").alias("w"), F.length("text").cast("bigint").alias("c"))
    cols = [F.count("*").alias("chunks")]
    for x, name in (("w", "words"), ("c", "chars")):
        cols += [F.round(F.avg(x), 6).alias(f"mean_{name}"), F.median(x).alias(f"median_{name}"), F.min(x).alias(f"min_{name}"), F.max(x).alias(f"max_{name}"), F.round(F.stddev_samp(x), 6).alias(f"sd_{name}")]
    return sizes.agg(*cols)


def short_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, chunks) by words: up to 9, 12, 15, and more. Null counts as no word."""
    w = F.greatest(F.coalesce(n_words(F.col("text")), F.lit(0)), F.lit(0))
    bucket = F.when(w <= 9, "very_short").when(w <= 12, "short").when(w <= 15, "minimal").otherwise("normal")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("chunks"))


def validation(rows: DataFrame) -> DataFrame:
    """One row: chunks, those that are blank, begin with a small letter, or have more than 8,000 characters."""
    t = strip(F.col("text"))
    return rows.agg(F.count("*").alias("chunks"), F.count_if(t == "").alias("empty_text"), F.count_if(P.starts_lower(t)).alias("mid_sentence"), F.count_if(F.length("text") > 8000).alias("overlong"))


def flow(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """By group: transitions between neighbours, and those that break a sentence, a word or a short chunk's continuation. What is
    asked of a text is taken from it first; only that meets the next row."""
    text = rows.select(*group, *order, strip(F.col("text")).alias("a"))
    w = with_once(text, "w", words(F.col("a")))
    last, first = F.try_element_at("w", F.lit(-1)), F.try_element_at("w", F.lit(1))
    edges = w.select(
        *group, *order, (F.col("a") != "").alias("filled"), F.size("w").alias("n"), P.ends_with_any(F.col("a")).alias("closed"), P.ends_with_any(F.col("a"), (".", "!", "?")).alias("stopped"),
        (F.length(last) < 4).alias("short_last"), P.starts_lower(F.col("a")).alias("small"), ((F.length(first) < 8) & P.starts_lower(first)).alias("small_first"),
    )
    pairs = with_neighbour(edges, group, order, {c: F.col(c) for c in ("filled", "n", "small", "small_first")}, "b").where("filled and b.filled")
    return pairs.groupBy(*group).agg(
        F.count("*").alias("transitions"),
        F.count_if(~F.col("closed") & F.col("b.small")).alias("abrupt"),
        F.count_if(F.col("short_last") & F.col("b.small_first")).alias("word_splits"),
        F.count_if((F.col("n") <= 5) & (F.col("b.n") <= 10) & ~F.col("stopped")).alias("continuations"),
    )


def report(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """By group: size, flow and dialogue scores and their sum weighted 0.3, 0.4 and 0.3."""
    size = rows.groupBy(*group).agg(F.count("*").alias("chunks"), F.avg((n_words(F.col("text")) > 15).cast("double")).alias("size_score"), F.avg((~(P.unbalanced_quotes(F.col("text")))).cast("double")).alias("dialogue_score"))
    f = flow(rows, group, order).select(*group, F.greatest(F.lit(0.0), 1 - (F.col("abrupt") + F.col("word_splits") + F.col("continuations")) / F.col("transitions")).alias("flow_score"))
    both = size.join(f, group, "left").withColumn("flow_score", F.coalesce("flow_score", F.lit(1.0)))
    return both.withColumn("score", F.round(0.3 * F.col("size_score") + 0.4 * F.col("flow_score") + 0.3 * F.col("dialogue_score"), 6))


SAID = r"(?i)\b(said|asked|replied|answered|whispered|shouted)\b"
QUOTED = r'["“][^"“”]+["”]'


def dialogue_counts(rows: DataFrame) -> DataFrame:
    """One row: chunks with quoted speech, with a verb of saying, and with both."""
    quoted, said = F.col("text").rlike(QUOTED), F.col("text").rlike(SAID)
    return rows.agg(F.count_if(quoted).alias("quoted"), F.count_if(said).alias("attributed"), F.count_if(quoted & said).alias("dialogue"))


def gluing(rows: DataFrame) -> DataFrame:
    """One row: places where words, sentences or digits are joined, and the chunks affected."""
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p)))
    return rows.agg(
        n("[a-z][A-Z]").alias("case_joins"), n("[.!?][A-Za-z]").alias("sentence_joins"), n("[a-z][0-9]").alias("digit_joins"), F.count_if(F.col("text").rlike("[a-z][A-Z]|[.!?][A-Za-z]|[a-z][0-9]")).alias("affected")
    )


def contamination(docs: DataFrame) -> DataFrame:
    """(doc_id, repeated, lone_numbers, lines): lines that recur more than twice in a document, and lines of a number only."""
    lines = lines_as_blocks(docs).select("doc_id", strip(F.col("text")).alias("line"))
    per = lines.groupBy("doc_id", "line").agg(F.count("*").alias("n"))
    return per.groupBy("doc_id").agg(
        F.sum(F.when((F.col("n") > 2) & (F.length("line") < 100), F.col("n")).otherwise(0)).alias("repeated"),
        F.sum(F.when(F.col("line").rlike(r"^\d+$"), F.col("n")).otherwise(0)).alias("lone_numbers"),
        F.sum("n").alias("lines"),
    )


def text_quality(docs: DataFrame, id_col: str) -> DataFrame:
    """(id, sentence, word, whitespace, ligature, contamination, overall): scores from 0 to 1, weighted .30 .25 .20 .15 .10."""
    t = F.col("text")
    scores = docs.select(
        F.col(id_col).alias("doc_id"), M.sentence_integrity(t).alias("sentence"), M.word_joining(t).alias("word"), M.whitespace_quality(t).alias("whitespace"), M.ligature_quality(t).alias("ligature")
    )
    dirt = contamination(docs.select(F.col(id_col).alias("doc_id"), "text"))
    clean = dirt.select("doc_id", (1 - F.least(F.lit(1.0), (F.col("repeated") + F.when(F.col("lone_numbers") > 3, F.col("lone_numbers")).otherwise(0)) / F.col("lines"))).alias("contamination"))
    both = scores.join(clean, "doc_id", "left").withColumn("contamination", F.coalesce("contamination", F.lit(1.0)))
    overall = 0.30 * F.col("sentence") + 0.25 * F.col("word") + 0.20 * F.col("whitespace") + 0.15 * F.col("ligature") + 0.10 * F.col("contamination")
    return both.withColumn("overall", F.round(overall, 6)).withColumnRenamed("doc_id", id_col)


# Words that announce parts of a book; fixed values.
PART_WORDS = "part i|part ii|part iii|chapter|section|figure|table|appendix|bibliography"


def documents_to_clean(blocks: DataFrame) -> DataFrame:
    """(doc_id, blocks, troubled, clean): whether the blocks of a document show signs that a second cleaning would help: a block with
    signs of bad extraction, many short blocks, quotes, words that announce parts, or pages that mostly break sentences."""
    text = F.coalesce("text", F.lit(""))
    t = strip(text)
    quotes = F.length(text) - F.length(F.translate(text, "\"'", ""))
    troubled = (text != "") & (
        text.rlike("[a-z][A-Z]") | (P.starts_lower(t) & ~P.ends_with_any(t)) | text.rlike(r"\s{3,}") | (quotes % 2 != 0)
        | ((F.length(t) < 20) & ~P.ends_with_any(t, (".", "!", "?"))) | text.rlike("[a-z][.!?][A-Z]")
    )
    order = Window.partitionBy("doc_id").orderBy("page", "seq", "text")
    rows = blocks.withColumns({"__n": F.lead(strip(text)).over(order), "__p": F.lead(F.struct("page")).over(order)})
    turns = F.col("__p").isNotNull() & ~F.col("__p.page").eqNullSafe(F.col("page"))
    broken = turns & (t != "") & ~P.ends_with_any(t, (".", "!", "?")) & P.starts_lower(F.col("__n"))
    per = rows.groupBy("doc_id").agg(
        F.count("*").alias("blocks"), F.count_if(troubled).alias("troubled"), F.sum(F.length(text) + 1).alias("chars"), F.bool_or((quotes > 0) | F.lower(text).rlike(PART_WORDS)).alias("signs"),
        F.count_if(turns).alias("turns"), F.count_if(F.coalesce(broken, F.lit(False))).alias("broken"),
    )
    clean = (F.col("troubled") > 0) | ((F.col("blocks") > 10) & (F.col("chars") / F.col("blocks") < 100)) | F.col("signs") | ((F.col("turns") > 0) & (F.col("broken") / F.col("turns") > 0.3))
    return per.select("doc_id", "blocks", "troubled", clean.alias("clean"))


def better_blocks(original: DataFrame, other: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, seq, text, replaced): blocks with signs of bad extraction take the text of the most similar block of another extractor of
    the same document, if half of their words are shared and that text has fewer signs. Rows of one document meet."""
    faults = lambda c: F.size(P.extraction_issues(F.col(c)))
    own = original.where("text is not null").select("doc_id", "seq", "text", faults("text").alias("f"))
    bag = lambda c: F.array_distinct(words(F.lower(F.col(c))))
    theirs = other.where("text is not null").select("doc_id", F.col("text").alias("o"), bag("text").alias("ob"), faults("text").alias("of"))
    pairs = own.where("f > 0").withColumn("b", bag("text")).join(theirs, "doc_id").where("of < f")
    shared = F.size(F.array_intersect("b", "ob"))
    likeness = F.round(shared / F.greatest(F.size("b") + F.size("ob") - shared, F.lit(1)), 6)
    best = pairs.withColumn("s", likeness).where(F.col("s") >= least).groupBy("doc_id", "seq", "text").agg(F.min(F.struct((-F.col("s")).alias("s"), "o")).alias("m"))
    out = own.join(best, ["doc_id", "seq", "text"], "left")
    return out.select("doc_id", "seq", F.coalesce("m.o", "text").alias("text"), F.col("m").isNotNull().alias("replaced"))
