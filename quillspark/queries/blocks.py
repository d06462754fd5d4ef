"""Queries of the block operators, on the tables blocks, pages, books, tags and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import BULLETS
from ..operators import blocks as K
from ..operators import rules as R
from ..sources import html as H
from ..sources.tables import adapter
from ._base import LINES_SQL, query, s_bullet, s_ended, s_heading, s_heading_level, s_number, s_rstrip, s_strip, s_words, table


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "blocks")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return K.lines_as_blocks(table(spark, folder, "documents"))


@query("SELECT book_id, source, CASE WHEN lower(source) LIKE '%.epub' THEN 'epub' ELSE 'pdf' END AS adapter FROM books")
def src_adapter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "books").select("book_id", "source", adapter(F.col("source")).alias("adapter"))


@query(r"""WITH r AS (SELECT row_id, TRY_CAST(regexp_extract(metadata.page_range, '^(\d{1,9})(?:-\d{1,9})?$', 1) AS INTEGER) AS lo,
  TRY_CAST(nullif(regexp_extract(metadata.page_range, '^\d{1,9}-(\d{1,9})$', 1), '') AS INTEGER) AS hi FROM epub)
  SELECT row_id, unnest(range(least(lo, coalesce(hi, lo)), greatest(lo, coalesce(hi, lo)) + 1))::INTEGER AS page FROM r WHERE lo IS NOT NULL""")
def src_block_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "epub").select("row_id", F.explode(K.pages_covered(F.col("metadata.page_range"))).alias("page"))


@query("""WITH p AS (SELECT doc_id, page, count(*) AS n FROM blocks WHERE page IS NOT NULL GROUP BY ALL),
  e AS (SELECT doc_id, unnest(range(1, max(page) + 1))::INTEGER AS page FROM p GROUP BY doc_id HAVING max(page) >= 1)
  SELECT e.doc_id, e.page, coalesce(n, 0) AS n_blocks FROM e LEFT JOIN p USING (doc_id, page)""")
def src_all_pages(spark: SparkSession, folder: str) -> DataFrame:
    return K.all_pages(_blocks(spark, folder))


@query("SELECT doc_id, page, string_agg(text, chr(10) ORDER BY seq NULLS FIRST, text) AS text FROM blocks WHERE text IS NOT NULL GROUP BY doc_id, page")
def src_page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return K.page_texts(_blocks(spark, folder))


@query(f"""SELECT doc_id, seq, text, 'blocks' AS origin FROM blocks UNION ALL
  SELECT doc_id, seq, text, 'lines' AS origin FROM ({LINES_SQL}) l WHERE doc_id NOT IN (SELECT doc_id FROM blocks WHERE doc_id IS NOT NULL)""")
def src_gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    primary = _blocks(spark, folder).select("doc_id", "seq", "text", F.lit("blocks").alias("origin"))
    return K.fill_gaps(primary, _lines(spark, folder).withColumn("origin", F.lit("lines")), ["doc_id"])


@query("""WITH s AS (SELECT doc_id, page, round(bbox.y1 - bbox.y0, 1) AS size FROM blocks WHERE bbox IS NOT NULL), c AS (SELECT doc_id, page, size, count(*) AS n FROM s WHERE size IS NOT NULL GROUP BY ALL)
  SELECT doc_id, page, size AS font_size FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, page ORDER BY n DESC, size) = 1""")
def src_font_size(spark: SparkSession, folder: str) -> DataFrame:
    return K.modal_height(_blocks(spark, folder))


@query("SELECT DISTINCT lower(trim(category)) AS category, lower(trim(tag)) AS tag FROM tags WHERE tag IS NOT NULL")
def src_tags(spark: SparkSession, folder: str) -> DataFrame:
    return R.tag_vocabulary(table(spark, folder, "tags"))


@query(None)
def src_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return H.html_blocks(table(spark, folder, "pages"), "page_id", "html")


@query(H.HTML_SQL)
def src_html_blocks_sql(spark: SparkSession, folder: str) -> DataFrame:
    return H.html_blocks_by_pattern(table(spark, folder, "pages"), "page_id", "html")


@query("""SELECT page_id, regexp_extract(url, '^book:([^/]*)/(.*)$', 1) AS source, regexp_extract(url, '^book:([^/]*)/(.*)$', 2) AS location,
  CASE WHEN length(t) > 80 THEN left(t, 77) || '...' ELSE t END AS preview FROM (SELECT page_id, url, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS t FROM pages WHERE url IS NOT NULL)""")
def src_spines(spark: SparkSession, folder: str) -> DataFrame:
    return H.spine_previews(table(spark, folder, "pages"))


@query("SELECT doc_id, (page_no - 1)::INTEGER AS page, text FROM (SELECT doc_id, unnest(string_split(text, chr(12))) AS text, generate_subscripts(string_split(text, chr(12)), 1) AS page_no FROM documents)")
def src_form_feed_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\f")).alias("page", "text"))


@query("SELECT doc_id, page, seq, text FROM blocks WHERE page NOT IN (1, 3, 4, 5)")
def filter_pages(spark: SparkSession, folder: str) -> DataFrame:
    from ..sources.tables import page_ranges

    return _blocks(spark, folder).where(~F.col("page").isin(*sorted(page_ranges("1,3-5")))).select("doc_id", "page", "seq", "text")


@query("SELECT doc_id, page, seq, text FROM blocks WHERE coalesce(bbox.y0 < 72 OR bbox.y1 > 792 - 72, false) = false")
def filter_zones(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).where(~K.in_margin(F.col("bbox"), 792, 72, 72)).select("doc_id", "page", "seq", "text")


@query("SELECT doc_id, page, seq, text FROM blocks WHERE contains(lower(text), 'the')")
def filter_trace(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).where(F.contains(F.lower("text"), F.lit("the"))).select("doc_id", "page", "seq", "text")


_SORTED = "row_number() OVER (PARTITION BY doc_id, page ORDER BY seq NULLS FIRST, text NULLS FIRST)"
_LAST = s_strip(f"regexp_extract({s_rstrip('prev')}, '([^\\n]*)$', 1)")
_KIND = rf"""CASE WHEN {s_bullet('text')} OR (coalesce(prev, '') <> '' AND coalesce(regexp_matches({_LAST}, '[{BULLETS}]$') AND regexp_matches(text, '^\p{{Ll}}'), false)) THEN 'bullet'
  WHEN {s_number('text')} OR (coalesce(prev, '') <> '' AND {s_number('prev')} AND NOT {s_number('text')} AND text IS NOT NULL AND right({s_rstrip('prev')}, 1) NOT IN ('.', '!', '?')) THEN 'numbered' END"""


@query(f"""SELECT doc_id, page, seq, text, {_KIND} AS found_kind FROM (SELECT *, lag(text) OVER (PARTITION BY doc_id, page ORDER BY seq NULLS FIRST, text NULLS FIRST) AS prev FROM blocks)""")
def list_detect(spark: SparkSession, folder: str) -> DataFrame:
    return K.with_lists(_blocks(spark, folder)).select("doc_id", "page", "seq", "text", "found_kind")


@query(f"""SELECT found_kind, count(*) AS blocks FROM (SELECT {_KIND} AS found_kind FROM (SELECT *, lag(text) OVER (PARTITION BY doc_id, page ORDER BY seq NULLS FIRST, text NULLS FIRST) AS prev FROM blocks)) GROUP BY 1""")
def list_kind_counts(spark: SparkSession, folder: str) -> DataFrame:
    return K.with_lists(_blocks(spark, folder)).groupBy("found_kind").agg(F.count("*").alias("blocks"))


_STYLED = """coalesce(list_sum([greatest(x."end" - x.start, 0) for x in inline_styles if x.style IN ('bold', 'underline', 'caps', 'small_caps')]), CASE WHEN inline_styles IS NOT NULL THEN 0 END)::DOUBLE / length(text) >= 0.6"""


@query(f"""SELECT doc_id, page, seq, text, a OR b AS is_heading, CASE WHEN a OR b THEN level END AS heading_level, CASE WHEN a THEN 'fallback' WHEN b THEN 'inline_styles' END AS heading_source FROM (
  SELECT *, {s_heading(s_strip('text'))} AS a, coalesce({_STYLED} AND len({s_words('text')}) <= 12 AND length(text) > 0, false) AS b, {s_heading_level(s_strip('text'))} AS level FROM blocks)""")
def heading_detect(spark: SparkSession, folder: str) -> DataFrame:
    return K.with_headings(_blocks(spark, folder)).select("doc_id", "page", "seq", "text", "is_heading", "heading_level", "heading_source")


@query(f"""WITH h AS (SELECT doc_id, seq, text, {s_heading_level(s_strip('text'))} AS level FROM ({LINES_SQL}) WHERE {s_heading(s_strip('text'))})
  SELECT a.doc_id, a.seq, a.text, a.level, (SELECT max(b.seq) FROM h b WHERE b.doc_id = a.doc_id AND b.seq < a.seq AND b.level < a.level) AS parent_seq FROM h a""")
def heading_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).where(P.is_heading(F.col("text"))).withColumn("level", P.heading_level(F.col("text")))
    return K.heading_tree(lines)


_NUMERIC = r"regexp_matches(text, '^\d+(?:\.\d+)* ')"


@query(f"""SELECT doc_id, seq, string_agg(text, chr(10) ORDER BY s) AS text FROM (SELECT doc_id, max(seq) OVER (PARTITION BY doc_id, g) AS seq, seq AS s, text FROM (
  SELECT *, sum((NOT {_NUMERIC})::INT) OVER (PARTITION BY doc_id ORDER BY seq DESC) AS g FROM ({LINES_SQL})) WHERE g > 0) GROUP BY doc_id, seq""")
def attach_headings(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered lines stand for headings here, so that SQL can say the same."""
    return K.attach_headings(_lines(spark, folder).withColumn("is_heading", F.col("text").rlike(r"^\d+(?:\.\d+)* ")))


_TAIL = "max((length(coalesce(text, '')) > 40)::INT) OVER (PARTITION BY doc_id, page ORDER BY seq DESC NULLS LAST, text DESC NULLS LAST ROWS UNBOUNDED PRECEDING) = 0"


@query(f"""WITH a AS (SELECT doc_id, page, seq, text, {_TAIL} AS in_tail, {_SORTED} AS rn FROM blocks),
  b AS (SELECT *, sum(in_tail::INT) OVER (PARTITION BY doc_id, page) AS nt, count(*) OVER (PARTITION BY doc_id, page) AS n FROM a)
  SELECT doc_id, page, min(seq) AS seq, string_agg(coalesce(text, ''), ' ' ORDER BY seq NULLS FIRST, text NULLS FIRST) AS text FROM b GROUP BY doc_id, page, CASE WHEN in_tail AND nt BETWEEN 2 AND 3 AND nt < n THEN -1 ELSE rn END""")
def merge_footers(spark: SparkSession, folder: str) -> DataFrame:
    return K.merge_short_tails(_blocks(spark, folder))


_BODY = rf"{s_strip('text')} <> '' AND NOT regexp_matches({s_strip('text')}, '^\d+$') AND NOT regexp_matches({s_strip('text')}, '^(?:\.\s*){{3,}}$')"


@query(rf"""WITH p AS (SELECT doc_id, page, sum(CASE WHEN {_BODY} THEN 1 ELSE 0 END) AS n, max(CASE WHEN {_BODY} THEN {s_strip('text')} END) AS only_text FROM blocks GROUP BY doc_id, page),
  l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY page DESC NULLS LAST) <= 3),
  e AS (SELECT doc_id, max(page) AS end_page FROM l WHERE n = 1 AND regexp_matches(only_text, '{K.DOC_END}') GROUP BY doc_id)
  SELECT doc_id, page, seq, text FROM blocks LEFT JOIN e USING (doc_id) WHERE end_page IS NULL OR page <= end_page""")
def detect_doc_end(spark: SparkSession, folder: str) -> DataFrame:
    return K.cut_after_end(_blocks(spark, folder)).select("doc_id", "page", "seq", "text")


_RUN = f"SELECT *, coalesce(sum(prev) OVER (PARTITION BY doc_id ORDER BY seq), 0) AS run FROM (SELECT *, lag(ended) OVER (PARTITION BY doc_id ORDER BY seq) AS prev FROM (SELECT *, ({s_ended('text')})::INT AS ended FROM ({LINES_SQL})))"


@query(f"""SELECT doc_id, min(seq) AS seq, string_agg(text, ' ' ORDER BY seq) AS text FROM (SELECT *, max(ended) OVER (PARTITION BY doc_id, run) AS closes FROM ({_RUN})) GROUP BY doc_id, run, CASE WHEN closes = 1 THEN -1 ELSE seq END""")
def coalesce_sentence_runs(spark: SparkSession, folder: str) -> DataFrame:
    return K.coalesce_sentences(_lines(spark, folder))


@query(f"""SELECT doc_id, min(seq) AS seq, string_agg(text, chr(10) ORDER BY seq) AS text FROM (SELECT *, sum(1 - ({s_bullet('text')} OR {s_number('text')})::INT) OVER (PARTITION BY doc_id ORDER BY seq) AS run FROM ({LINES_SQL})) GROUP BY doc_id, run""")
def standalone_lists(spark: SparkSession, folder: str) -> DataFrame:
    return K.merge_standalone_lists(_lines(spark, folder))


@query(rf"""WITH RECURSIVE l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS i, len({s_words('text')}) AS w, greatest(len({s_words('text')}), ceil(length(text) / 4.7::DOUBLE)::BIGINT) AS n FROM ({LINES_SQL})),
  f AS (SELECT doc_id, i, w, n, n AS size, 0 AS chunk FROM l WHERE i = 1 UNION ALL
    SELECT l.doc_id, l.i, l.w, l.n, CASE WHEN f.size + l.n > 400 THEN l.n ELSE f.size + l.n END, CASE WHEN f.size + l.n > 400 THEN f.chunk + 1 ELSE f.chunk END FROM f JOIN l ON l.doc_id = f.doc_id AND l.i = f.i + 1)
  SELECT doc_id, chunk::INTEGER AS chunk_seq, count(*)::INTEGER AS n_lines, sum(w)::INTEGER AS n_words FROM f GROUP BY doc_id, chunk""")
def budget_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return K.budget_fold(_lines(spark, folder))


@query(None)
def strip_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    kept = _blocks(spark, folder).where(~P.is_page_artifact(F.col("text"), F.col("page")))
    return kept.select("doc_id", "page", "seq", "text")


@query("""SELECT CASE WHEN inline_styles IS NULL THEN 'none' WHEN len(inline_styles) = 0 THEN 'empty' ELSE 'styled' END AS kind, count(*) AS blocks FROM blocks GROUP BY 1""")
def style_kinds(spark: SparkSession, folder: str) -> DataFrame:
    s = F.col("inline_styles")
    return _blocks(spark, folder).groupBy(F.when(s.isNull(), "none").when(F.size(s) == 0, "empty").otherwise("styled").alias("kind")).agg(F.count("*").alias("blocks"))


@query("""SELECT s.style AS style, count(*) AS spans, sum(s."end" - s.start)::BIGINT AS chars, round(avg(s.confidence), 6) AS confidence FROM (SELECT unnest(inline_styles) AS s FROM blocks) GROUP BY 1""")
def style_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return R.style_histogram(_blocks(spark, folder))


@query("""SELECT doc_id, page, seq, text, len(list_filter(inline_styles, lambda s: least(s."end", length(text)) > greatest(s.start, 0))) AS spans FROM blocks""")
def style_spans_clamped(spark: SparkSession, folder: str) -> DataFrame:
    clamped = R.clamp_spans(F.col("inline_styles"), F.length("text"))
    return _blocks(spark, folder).select("doc_id", "page", "seq", "text", F.when(F.col("inline_styles").isNotNull(), F.size(clamped)).cast("bigint").alias("spans"))


@query(rf"""WITH d AS (SELECT lower({s_strip('pattern')}) AS key, decision, max(coalesce(confidence, 0)) AS confidence FROM decisions GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY key ORDER BY max(coalesce(confidence, 0)) DESC, decision) = 1)
  SELECT doc_id, seq, text, decision, confidence FROM ({LINES_SQL}) l JOIN d ON lower({s_strip('l.text')}) = d.key""")
def decisions_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return R.remembered(_lines(spark, folder), table(spark, folder, "decisions")).select("doc_id", "seq", "text", "decision", "confidence")


@query(None)
def classify_footers(spark: SparkSession, folder: str) -> DataFrame:
    return R.classify_footers(_blocks(spark, folder), table(spark, folder, "decisions")).select("doc_id", "page", "seq", "is_footer", "reason")


@query(rf"""SELECT doc_id, seq, CASE WHEN {s_bullet('text')} AND regexp_matches(prev, '(?:^|\n)[ \t]*(?:[{BULLETS}]|-\s)') THEN 'merge' WHEN {s_number('text')} AND regexp_matches(prev, '^\d+[.)]') THEN 'merge'
  WHEN {s_ended('prev')} THEN 'split' WHEN regexp_matches(text, '^\p{{Ll}}') THEN 'merge' ELSE 'split' END AS verdict
  FROM (SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY seq) AS prev FROM ({LINES_SQL})) WHERE prev IS NOT NULL""")
def merge_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return R.merge_verdicts(_lines(spark, folder))


@query(f"""SELECT doc_id, seq, coalesce(sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
  (coalesce(sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(text))::BIGINT AS "end" FROM ({LINES_SQL})""")
def char_map(spark: SparkSession, folder: str) -> DataFrame:
    return R.char_map(_lines(spark, folder))


@query("""SELECT doc_id, count(DISTINCT page) AS pages, count(*) AS blocks, count(text) AS texts, sum(length(text))::BIGINT AS chars FROM blocks GROUP BY doc_id""")
def block_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).groupBy("doc_id").agg(F.countDistinct("page").alias("pages"), F.count("*").alias("blocks"), F.count("text").alias("texts"), F.sum(F.length("text")).alias("chars"))


@query("""(SELECT doc_id, text, 'removed' AS side FROM blocks WHERE text IS NOT NULL EXCEPT ALL SELECT doc_id, trim(text), 'removed' FROM blocks WHERE text IS NOT NULL)
  UNION ALL (SELECT doc_id, trim(text), 'added' AS side FROM blocks WHERE text IS NOT NULL EXCEPT ALL SELECT doc_id, text, 'added' FROM blocks WHERE text IS NOT NULL)""")
def parity_diff(spark: SparkSession, folder: str) -> DataFrame:
    old = _blocks(spark, folder).where("text is not null").select("doc_id", "text")
    return R.row_diff(old, old.select("doc_id", F.trim("text").alias("text")))


