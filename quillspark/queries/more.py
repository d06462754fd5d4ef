"""Queries of comparisons, repairs of lines and further checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import text as T
from ..operators import blocks as K
from ..operators import chunks as C
from ..operators.adjacency import with_neighbour
from ._base import LINES_SQL, query, s_normalized, s_strip, s_words, table

_BOOK = "regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1)"
_ORDER = f"PARTITION BY {_BOOK} ORDER BY chunk_seq, row_id"
_FP = s_normalized("translate(text, '“”‘’', '\"\"''''')")


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "epub").withColumn("book", F.regexp_extract("chunk_id", r"^(.+)_p\d+_c\d+$", 1))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return K.lines_as_blocks(_docs(spark, folder))


@query(f"SELECT row_id, contains(prev, text) AND text <> '' AS contained FROM (SELECT row_id, text, lag(text) OVER ({_ORDER}) AS prev FROM epub) WHERE prev IS NOT NULL")
def dup_contained(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that the chunk before them holds wholly."""
    rows = with_neighbour(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"], {"text": F.col("text")}, "prev", ahead=False).where("prev.text is not null")
    return rows.select("row_id", (F.contains("prev.text", F.col("text")) & (F.col("text") != "")).alias("contained"))


@query(f"SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE {_FP} <> '' GROUP BY {_FP}")
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first document of each normalised text; only hashes meet."""
    keyed = _docs(spark, folder).select("doc_id", C.fingerprint(F.col("text")).alias("t")).where("t <> ''").select("doc_id", F.md5("t").alias("h"), F.length("t").alias("n"))
    return keyed.groupBy("h", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "copies")


@query(None)
def clean_effect(spark: SparkSession, folder: str) -> DataFrame:
    """By collection: characters and quality before and after cleaning."""
    docs = T.with_once(_docs(spark, folder).select("source", "text"), "clean", T.clean_text(F.col("text")))
    score = lambda c: F.round(F.avg(M.whitespace_quality(F.col(c))), 6)
    return docs.groupBy("source").agg(F.sum(F.length("text")).alias("chars_before"), F.sum(F.length("clean")).alias("chars_after"), score("text").alias("quality_before"), score("clean").alias("quality_after"))


@query(f"""SELECT doc_id, page, seq, text FROM blocks WHERE coalesce((bbox.y0 < 0.15::DOUBLE * 792 OR bbox.y1 > 0.85::DOUBLE * 792) AND len({s_words('text')}) <= 6 AND regexp_matches({s_strip('text')}, '^(?:[0-9]+|[ivxlcdmIVXLCDM]+|[^A-Za-z]*[0-9]+[^A-Za-z]*)$'), false)""")
def margin_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Short numbers in the top or bottom 15 percent of a page."""
    box, t = F.col("bbox"), T.strip(F.col("text"))
    margin = (box["y0"] < 0.15 * 792) | (box["y1"] > 0.85 * 792)
    number = t.rlike(r"^(?:[0-9]+|[ivxlcdmIVXLCDM]+|[^A-Za-z]*[0-9]+[^A-Za-z]*)$")
    return table(spark, folder, "blocks").where(F.coalesce(margin & (T.n_words(F.col("text")) <= 6) & number, F.lit(False))).select("doc_id", "page", "seq", "text")


@query(rf"""SELECT doc_id, len(string_split_regex(text, '[.!?]+'))::BIGINT AS parts, len(regexp_extract_all(text, '[.!?]+'))::BIGINT AS terminators, len(regexp_extract_all(text, '[.!?]\s+\p{{Lu}}'))::BIGINT AS starts FROM documents""")
def sentence_statistics(spark: SparkSession, folder: str) -> DataFrame:
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("bigint")
    return _docs(spark, folder).select("doc_id", F.size(F.split("text", r"[.!?]+")).cast("bigint").alias("parts"), n(r"[.!?]+").alias("terminators"), n(r"[.!?]\s+\p{Lu}").alias("starts"))


@query(None)  # DuckDB counts edits of bytes
def source_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    """How alike the start of a block and the start of its document are, by edits."""
    first = _docs(spark, folder).where("text is not null").select("doc_id", F.left("text", F.lit(50)).alias("first"))
    both = table(spark, folder, "blocks").where("text is not null").select("doc_id", "seq", "text").join(first, "doc_id")
    a, b = F.left(F.lower("text"), F.lit(50)), F.left(F.lower("first"), F.lit(50))
    return both.select("doc_id", "seq", "text", F.round(1 - F.levenshtein(a, b) / F.greatest(F.length(F.left("text", F.lit(50))), F.length(F.left("first", F.lit(50))), F.lit(1)), 6).alias("ratio"))


@query(r"""SELECT kind, pattern, decision, max(coalesce(confidence, 0)) AS confidence, count(*) AS times, max(learned_at) AS learned_at FROM decisions GROUP BY kind, pattern, decision""")
def decisions_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The store of learned patterns, each decision once."""
    d = table(spark, folder, "decisions")
    return d.groupBy("kind", "pattern", "decision").agg(F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.count("*").alias("times"), F.max("learned_at").alias("learned_at"))


@query(rf"""SELECT doc_id, seq, text, regexp_matches(text, '[a-z0-9]\s+(?:For|See|As|In|This|Other)\b[^.]*$') AS has_note, regexp_replace(text, '^[0-9]{{1,3}}\s+([A-Z])', '[note] \1') AS value FROM ({LINES_SQL})""")
def footnote_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a note run on to them, and lines that begin with a note number."""
    t = F.col("text")
    return _lines(spark, folder).select("doc_id", "seq", "text", t.rlike(r"[a-z0-9]\s+(?:For|See|As|In|This|Other)\b[^.]*$").alias("has_note"), F.regexp_replace(t, r"^[0-9]{1,3}\s+([A-Z])", "[note] $1").alias("value"))


@query(f"""SELECT doc_id, array_to_string(list_distinct(list_filter(list_transform(string_split(text, '|'), lambda c: {s_strip('c')}), lambda c: c <> '' AND NOT regexp_matches(c, '^:?-+:?$'))), ' ') = '' AS empty_table, len(string_split(text, '|'))::BIGINT AS cells FROM documents""")
def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of lines of a Markdown table."""
    cells = F.filter(F.transform(F.split("text", r"\|"), T.strip), lambda c: (c != "") & ~c.rlike("^:?-+:?$"))
    return _docs(spark, folder).select("doc_id", (F.size(cells) == 0).alias("empty_table"), F.size(F.split("text", r"\|")).cast("bigint").alias("cells"))


