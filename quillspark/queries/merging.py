"""Queries of merging, splitting and further analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import predicates as P
from ..functions.text import BULLETS, n_words, words
from ..operators import blocks as K
from ..operators import merging as G
from ._base import LINES_SQL, TRIMMED, query, s_bullet, s_number, s_strip, s_words, table

_BOOK = "regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1)"
_ORDER = f"PARTITION BY {_BOOK} ORDER BY chunk_seq, row_id"
_PAIRS = f"SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY seq) AS prev FROM ({LINES_SQL})"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return K.lines_as_blocks(_docs(spark, folder))


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "epub").withColumn("book", F.regexp_extract("chunk_id", r"^(.+)_p\d+_c\d+$", 1))


def _line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).withColumn("prev", F.lag("text").over(Window.partitionBy("doc_id").orderBy("seq"))).where("prev is not null")


_VERBS = ", ".join(f"'{v}'" for v in G.DIALOGUE_VERBS)
_NO_END = "right(a, 1) NOT IN ('.', '!', '?')"


@query(rf"""SELECT row_id, CASE WHEN n <= 6 AND len(list_filter(w, lambda x: lower(x) IN ({_VERBS}))) > 0 THEN 'short_dialogue_attribution' WHEN n <= 6 AND {_NO_END} AND NOT regexp_matches(b, '^\p{{Lu}}') THEN 'incomplete_sentence'
  WHEN n <= 4 THEN 'very_short_fragment' WHEN n <= 9 AND m <= 12 AND {_NO_END} THEN 'related_short_chunks' WHEN m <= 9 THEN 'next_chunk_very_short' END AS reason
  FROM (SELECT row_id, {s_strip('text')} AS a, {s_words('text')} AS w, len({s_words('text')}) AS n, {s_strip('nxt')} AS b, len({s_words('nxt')}) AS m FROM (SELECT row_id, text, lead(text) OVER ({_ORDER}) AS nxt FROM epub)) WHERE a <> '' AND m > 0""")
def merge_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return G.merge_reasons(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"]).select("row_id", "reason")


_QA, _LEFT = "regexp_matches(prev, '(?i)[QA]\\d+:')", f"ltrim(text, '{TRIMMED}')"


@query(rf"""SELECT doc_id, seq, CASE WHEN {_QA} AND regexp_matches({_LEFT}, '(?i)^[QA]\d+:') THEN 0.95::DOUBLE WHEN regexp_matches({_LEFT}, '(?i)^[QA]\d+:') THEN 0.7::DOUBLE
  WHEN {_QA} AND regexp_matches({_LEFT}, '^\p{{Lu}}') AND length({_LEFT}) > 20 THEN 0.6::DOUBLE WHEN {_QA} THEN 0.4::DOUBLE ELSE 0.1::DOUBLE END AS confidence FROM ({_PAIRS}) WHERE prev IS NOT NULL""")
def question_answers(spark: SparkSession, folder: str) -> DataFrame:
    return _line_pairs(spark, folder).select("doc_id", "seq", G.question_confidence(F.col("prev"), F.col("text")).alias("confidence"))


_ITEM = lambda x: f"({s_bullet(f"ltrim({x}, '{TRIMMED}')")} OR {s_number(f"ltrim({x}, '{TRIMMED}')")})"
_BODY = rf"ltrim(regexp_replace({s_strip('prev')}, '^(?:[{BULLETS}]|-\s|\d+[.)])', ''), '{TRIMMED}')"
_N = lambda ch: f"(length(body) - length(replace(body, '{ch}', '')))"
_CARRY = ", ".join(f"'{w}'" for w in G.CARRY_ON)


@query(rf"""SELECT doc_id, seq, CASE WHEN item AND NOT new_item THEN round(least(1.0::DOUBLE, CASE WHEN n <= 5 OR (n <= 7 AND right(body, 1) NOT IN ('.', '!', '?')) OR right(body, 1) IN (',', ';', ':')
    OR {_N('(')} > {_N(')')} OR {_N('[')} > {_N(']')} OR {_N('{')} > {_N('}')} OR {_N('"')} % 2 <> 0 THEN 0.8::DOUBLE ELSE 0.3::DOUBLE END
  + CASE WHEN regexp_matches(t, '^\p{{Ll}}') THEN 0.15::DOUBLE WHEN regexp_matches(t, '^\p{{Lu}}') AND lower({s_words('t')}[1]) IN ({_CARRY}) THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END), 6) ELSE 0.0::DOUBLE END AS confidence
  FROM (SELECT doc_id, seq, {s_strip('text')} AS t, {_ITEM('prev')} AS item, {_ITEM('text')} AS new_item, {_BODY} AS body, len({s_words(_BODY)}) AS n FROM ({_PAIRS}) WHERE prev IS NOT NULL)""")
def list_continuations(spark: SparkSession, folder: str) -> DataFrame:
    return _line_pairs(spark, folder).select("doc_id", "seq", G.list_continuation_confidence(F.col("prev"), F.col("text")).alias("confidence"))


@query(None)
def overlap_restored(spark: SparkSession, folder: str) -> DataFrame:
    return G.with_overlap_restored(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"]).select("row_id", "restored")


@query(rf"""WITH RECURSIVE l AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS i FROM ({LINES_SQL})),
  f AS (SELECT doc_id, i, text AS held, 0 AS part, len(regexp_split_to_array(text, '\s+')) >= 15 OR length(text) > 2000 AS ready FROM l WHERE i = 1 UNION ALL
    SELECT l.doc_id, l.i, CASE WHEN f.ready THEN l.text ELSE f.held || chr(10) || l.text END, CASE WHEN f.ready THEN f.part + 1 ELSE f.part END,
      len(regexp_split_to_array(CASE WHEN f.ready THEN l.text ELSE f.held || chr(10) || l.text END, '\s+')) >= 15 OR length(CASE WHEN f.ready THEN l.text ELSE f.held || chr(10) || l.text END) > 2000 FROM f JOIN l ON l.doc_id = f.doc_id AND l.i = f.i + 1),
  p AS (SELECT *, max(CASE WHEN ready THEN part END) OVER (PARTITION BY doc_id) AS last_ready FROM f)
  SELECT doc_id, least(part, coalesce(last_ready, part))::INTEGER AS part, count(*)::INTEGER AS lines FROM p GROUP BY doc_id, least(part, coalesce(last_ready, part))""")
def hold_and_merge(spark: SparkSession, folder: str) -> DataFrame:
    return G.hold_short(_lines(spark, folder)).select("doc_id", "part", "lines")


@query(None)
def inline_headings(spark: SparkSession, folder: str) -> DataFrame:
    return G.split_inline_heading(table(spark, folder, "blocks"))


@query("""WITH l AS (SELECT doc_id, page, max(bbox.y1) AS y FROM blocks WHERE bbox IS NOT NULL GROUP BY ALL), b AS (SELECT doc_id, round(y / 5) * 5 AS footer_y, count(*) AS n FROM l WHERE y IS NOT NULL GROUP BY ALL)
  SELECT doc_id, footer_y, (sum(n) OVER (PARTITION BY doc_id))::BIGINT AS pages, round(n / sum(n) OVER (PARTITION BY doc_id), 6) AS confidence FROM b QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, footer_y) = 1""")
def zone_margins(spark: SparkSession, folder: str) -> DataFrame:
    return G.zone_margins(table(spark, folder, "blocks"))


@query(r"""WITH p AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+-[ \t]*\n[ \t]*[a-z]+')) AS m FROM documents), q AS (SELECT regexp_extract(m, '^([a-z]+)', 1) AS head, regexp_extract(m, '([a-z]+)$', 1) AS tail, count(*) AS breaks FROM p GROUP BY ALL),
  s AS (SELECT word, count(*) AS seen FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+(?:-[a-z]+)*')) AS word FROM documents) GROUP BY word)
  SELECT head, tail, breaks, coalesce(j.seen, 0) AS joined_seen, coalesce(h.seen, 0) AS hyphenated_seen, coalesce(h.seen, 0) > coalesce(j.seen, 0) AS keep FROM q LEFT JOIN s j ON j.word = head || tail LEFT JOIN s h ON h.word = head || '-' || tail""")
def hyphen_choices(spark: SparkSession, folder: str) -> DataFrame:
    return G.hyphen_choices(_docs(spark, folder))


@query(f"""WITH w AS (SELECT doc_id, {s_words('text')} AS w FROM documents), h AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 49], ' ')) AS window_hash FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50))
  SELECT window_hash, count(*) AS rows FROM h GROUP BY window_hash HAVING count(*) > 1""")
def dup_windows(spark: SparkSession, folder: str) -> DataFrame:
    return G.shared_windows(_docs(spark, folder), "doc_id")


def _label(text: str) -> str:
    return "question | asked" if text.rstrip().endswith("?") else "statement | said"


@query("""SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'unclassified' WHEN rtrim(text) LIKE '%?' THEN 'question' ELSE 'statement' END AS utterance_type FROM documents""")
def enrich_labels(spark: SparkSession, folder: str) -> DataFrame:
    return G.enrich(_docs(spark, folder), "doc_id", _label).select("doc_id", "utterance_type")


@query(r"SELECT doc_id, regexp_replace(text, '\n\n([A-Z][A-Za-z ]{0,60}?)\s+(\d{1,3})(\n|$)', chr(10) || chr(10), 'g') AS value, len(regexp_extract_all(text, '\n\n[A-Z][A-Za-z ]{0,60}?\s+\d{1,3}(?:\n|$)'))::BIGINT AS removed FROM documents")
def clean_inline_footers(spark: SparkSession, folder: str) -> DataFrame:
    pattern = r"\n\n[A-Z][A-Za-z ]{0,60}?\s+\d{1,3}(?:\n|$)"
    return _docs(spark, folder).select("doc_id", F.regexp_replace("text", pattern, "\n\n").alias("value"), F.regexp_count("text", F.lit(pattern)).cast("bigint").alias("removed"))


@query(r"SELECT word, count(*) AS times FROM (SELECT unnest(regexp_extract_all(text, '[a-z]+[A-Z][a-z]+')) AS word FROM documents) GROUP BY word")
def glued_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = _docs(spark, folder).select(F.explode(F.regexp_extract_all("text", F.lit(r"([a-z]+[A-Z][a-z]+)"), F.lit(1))).alias("word"))
    return found.groupBy("word").agg(F.count("*").alias("times"))


@query(r"""SELECT row_id, (i - 1)::INTEGER AS pos, q AS quoted FROM (SELECT row_id, unnest(l) AS q, generate_subscripts(l, 1) AS i FROM (SELECT row_id, regexp_extract_all(text, '“([^“”]+)”', 1) AS l FROM epub))""")
def dialogue_segments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "epub").select("row_id", F.posexplode(F.regexp_extract_all("text", F.lit("“([^“”]+)”"), F.lit(1))).alias("pos", "quoted"))


@query("""SELECT row_id, (s // 8000)::INTEGER AS part, substring(text, (s + 1)::INTEGER, 8000) AS segment FROM (SELECT row_id, text, unnest(range(0, length(text), 8000)) AS s FROM epub)""")
def soft_segments(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "epub").where("length(text) > 0").select("row_id", "text", F.explode(F.expr("sequence(0, length(text) - 1, 8000)")).alias("s"))
    return e.select("row_id", (F.col("s") / 8000).cast("int").alias("part"), F.substring("text", F.col("s") + 1, F.lit(8000)).alias("segment"))


@query(f"""SELECT o AS overlap, count(*) AS chunks, round(avg(least(400, n - s)), 6) AS mean_words FROM (SELECT len({s_words('text')}) AS n FROM documents), (VALUES (0), (25), (50), (75), (100)) v(o), unnest(range(0, n, 400 - o)) t(s)
  WHERE NOT (s > 0 AND n - s <= o) AND NOT (s > 0 AND s + 400 - o >= n AND least(400, n - s) <= 2 * o) GROUP BY o""")
def overlap_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Windows at several overlaps, from the lengths of the documents: the texts are read once."""
    sizes = _docs(spark, folder).select(n_words(F.col("text")).alias("n")).where("n > 0")
    each = sizes.select("n", F.explode(F.array(*(F.lit(o) for o in (0, 25, 50, 75, 100)))).alias("overlap"))
    each = each.select("n", "overlap", F.explode(F.expr("sequence(0, n - 1, 400 - overlap)")).alias("s")).withColumn("w", F.expr("least(400, n - s)"))
    kept = each.where("not (s > 0 and n - s <= overlap) and not (s > 0 and s + 400 - overlap >= n and w <= 2 * overlap)")
    return kept.groupBy("overlap").agg(F.count("*").alias("chunks"), F.round(F.avg("w"), 6).alias("mean_words"))


@query("""SELECT event_type, count(*) AS events, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, min(value) AS least, max(value) AS most, count(*) FILTER (value IS NULL) AS failures FROM events GROUP BY event_type""")
def run_statistics(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("value")
    return table(spark, folder, "events").groupBy("event_type").agg(
        F.count("*").alias("events"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_samp(v), 6).alias("sd"), F.min(v).alias("least"), F.max(v).alias("most"), F.count_if(v.isNull()).alias("failures")
    )


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    from ..streaming.ingest import event_counts

    counted = event_counts(table(spark, folder, "events"))
    return counted.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("value", 4).alias("value"))


@query("""WITH k AS (SELECT source, md5(text) AS h FROM documents), g AS (SELECT source, h, count(*) AS n FROM k GROUP BY ALL) SELECT source, sum(n)::BIGINT AS documents, sum(n - 1)::BIGINT AS duplicates, max(n)::BIGINT AS largest FROM g GROUP BY source""")
def dup_totals(spark: SparkSession, folder: str) -> DataFrame:
    per = _docs(spark, folder).select("source", F.md5("text").alias("h")).groupBy("source", "h").agg(F.count("*").alias("n"))
    return per.groupBy("source").agg(F.sum("n").alias("documents"), F.sum(F.col("n") - 1).alias("duplicates"), F.max("n").alias("largest"))


@query(r"""SELECT count(*) FILTER (m AND u) AS both, count(*) FILTER (m AND NOT u) AS only_numbered, count(*) FILTER (u AND NOT m) AS only_upper FROM (SELECT regexp_matches(text, '^\d+(?:\.\d+)* ') AS m, upper(text) = text AND lower(text) <> text AS u FROM """ + f"({LINES_SQL}))")
def heading_agreement(spark: SparkSession, folder: str) -> DataFrame:
    m, u = F.col("text").rlike(r"^\d+(?:\.\d+)* "), P.is_upper(F.col("text"))
    return _lines(spark, folder).agg(F.count_if(m & u).alias("both"), F.count_if(m & ~u).alias("only_numbered"), F.count_if(u & ~m).alias("only_upper"))


@query(f"""SELECT doc_id, chunk::INTEGER AS chunk, array_to_string(w[s + 1 : s + 200], ' ') AS text FROM (SELECT doc_id, w, s, s // 180 AS chunk FROM (SELECT doc_id, {s_words('text')} AS w FROM documents), unnest(range(0, len(w), 180)) t(s))""")
def plain_windows(spark: SparkSession, folder: str) -> DataFrame:
    w = _docs(spark, folder).select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = w.select("doc_id", "w", F.posexplode(F.expr("sequence(0, size(w) - 1, 180)")).alias("chunk", "s"))
    return starts.select("doc_id", "chunk", F.array_join(F.slice("w", F.col("s") + 1, F.lit(200)), " ").alias("text"))


