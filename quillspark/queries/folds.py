"""Queries of the folds over documents, of output rows and of recall by overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..operators import blocks as K
from ..operators import chunks as C
from ..operators import emitting as E
from ..operators import folding as D
from ..operators import quality as Q
from ..operators import relational as J
from ..operators.quality import PART_WORDS
from ..sources.tables import register_sql
from ._base import LINES_SQL, TRIMMED, query, s_bullet, s_heading, s_number, s_rstrip, s_strip, s_words, table


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return K.lines_as_blocks(_docs(spark, folder))


def _paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, chunk, text): the paragraphs of the documents, a line each where there are no blank lines."""
    return _lines(spark, folder).withColumnRenamed("seq", "chunk")


_ITEM = f"({s_bullet(f"ltrim(text, '{TRIMMED}')")} OR {s_number(f"ltrim(text, '{TRIMMED}')")})"
_NUMBERS = r"regexp_extract_all(text || ' ', '(?:^|\n)[ \t]*(\d+)[.)]\s', 1)"


@query(rf"""WITH RECURSIVE l AS (SELECT *, {s_heading(s_strip('text'))} AS h FROM ({LINES_SQL})), g AS (SELECT *, sum((NOT h)::INT) OVER (PARTITION BY doc_id ORDER BY seq DESC) AS g FROM l),
  r0 AS (SELECT doc_id, max(seq) AS seq, string_agg(text, chr(10) ORDER BY seq) AS text, bool_or(h) AS heading FROM g GROUP BY doc_id, g),
  r AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS i, heading, greatest(len({s_words('text')}), ceil(length(text) / 4.7::DOUBLE)::BIGINT) AS n, length(text) AS chars, {_ITEM} AS item,
    TRY_CAST({_NUMBERS}[1] AS BIGINT) AS first, TRY_CAST({_NUMBERS}[-1] AS BIGINT) AS last, coalesce({s_rstrip('text')} LIKE '%:', false) AS colon FROM r0),
  p AS (SELECT *, lag(item) OVER w AS p_item, lag(last) OVER w AS p_last, lag(colon) OVER w AS p_colon FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  b AS (SELECT *, coalesce(first = p_last + 1, false) AS nxt FROM p),
  f AS (SELECT doc_id, i, n AS size, chars AS total, 0 AS chunk FROM b WHERE i = 1 UNION ALL
    SELECT b.doc_id, b.i, CASE WHEN j THEN f.size + b.n ELSE b.n END, CASE WHEN j THEN f.total + 2 + b.chars ELSE b.chars END, CASE WHEN j THEN f.chunk ELSE f.chunk + 1 END
    FROM f JOIN b ON b.doc_id = f.doc_id AND b.i = f.i + 1, LATERAL (SELECT NOT b.heading AND NOT (b.item AND NOT b.p_item AND NOT b.p_colon AND NOT b.nxt) AND (f.size + b.n <= 400 OR (b.nxt AND f.total + 2 + b.chars <= 8000)) AS j) x)
  SELECT doc_id, chunk::INTEGER AS chunk_seq, count(*)::INTEGER AS n_records, max(total)::INTEGER AS chars FROM f GROUP BY doc_id, chunk""")
def semantic_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, with their headings, packed by the size, headings and lists."""
    rows = D.records(_lines(spark, folder).withColumn("is_heading", P.is_heading(F.col("text"))))
    return D.semantic_chunks(rows).select("doc_id", "chunk_seq", "n_records", F.length("text").alias("chars"))


@query(rf"""WITH RECURSIVE r AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq, text) AS i, text, {s_heading(s_strip('text'))} AS h FROM ({LINES_SQL})),
  f AS (SELECT doc_id, i, h, text AS t, 0 AS run FROM r WHERE i = 1 UNION ALL SELECT r.doc_id, r.i, r.h, CASE WHEN j THEN both_texts ELSE r.text END, CASE WHEN j THEN f.run ELSE f.run + 1 END
    FROM f JOIN r ON r.doc_id = f.doc_id AND r.i = f.i + 1, LATERAL (SELECT {s_rstrip('f.t')} || chr(10) || chr(10) || ltrim(r.text, '{TRIMMED}') AS both_texts) y,
    LATERAL (SELECT NOT f.h AND NOT r.h AND NOT {s_rstrip('r.text')} LIKE '%:' AND (length(both_texts) <= 650 OR (length(f.t) < 450 AND length(both_texts) <= 1100)) AS j) x)
  SELECT doc_id, run::INTEGER AS run, count(*)::INTEGER AS rows, arg_max(t, i) AS text FROM f GROUP BY doc_id, run""")
def coalesced_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return D.coalesce_bodies(_lines(spark, folder).withColumn("heading", P.is_heading(F.col("text"))), ["doc_id"], ["seq"])


@query(None)
def page_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return D.merge_page_blocks(table(spark, folder, "blocks"))


@query(None)
def continuation_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return D.merge_continuations(table(spark, folder, "blocks"))


@query(None)
def carried_headings(spark: SparkSession, folder: str) -> DataFrame:
    return D.carry_headings(_paragraphs(spark, folder))


@query(rf"""SELECT doc_id, run::INTEGER AS run, count(*)::INTEGER AS rows, string_agg(text, chr(10) ORDER BY seq) AS text FROM (SELECT *, sum((NOT b OR seq = first)::INT) OVER (PARTITION BY doc_id ORDER BY seq) - 1 AS run
  FROM (SELECT *, regexp_matches(text, '^\s*(?:[{T.BULLETS}]|-\s)') AS b, min(seq) OVER (PARTITION BY doc_id) AS first FROM ({LINES_SQL}))) GROUP BY doc_id, run""")
def bullet_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return D.bullet_chunks(_paragraphs(spark, folder))


@query(None)
def coalesced_texts(spark: SparkSession, folder: str) -> DataFrame:
    return E.over_documents(_paragraphs(spark, folder), "doc_id", "chunk", E.coalesce)


@query(None)
def held_texts(spark: SparkSession, folder: str) -> DataFrame:
    return E.over_documents(_paragraphs(spark, folder), "doc_id", "chunk", E.hold_and_merge)


@query(None)
def fused_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return E.over_documents(_paragraphs(spark, folder), "doc_id", "chunk", E.fuse_sentences)


@query(None)
def repaired_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return E.over_documents(_paragraphs(spark, folder), "doc_id", "chunk", E.repair_quotes)


@query("SELECT row_id, length(text) > 8000 AS divided FROM epub WHERE trim(text, ' \t\n\r') <> ''")
def output_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = E.rows_for_output(table(spark, folder, "epub").select("row_id", "text"), "row_id")
    return rows.groupBy("row_id").agg(F.bool_or(F.col("chunk_part").isNotNull()).alias("divided"))


_FOOTER = r"\n\n[A-Z][A-Za-z ]{0,60} \d{1,3}(?:\n| )"


@query(f"SELECT row_id, (i - 1)::INTEGER AS pos, {s_strip('m')} AS footer FROM (SELECT row_id, unnest(l) AS m, generate_subscripts(l, 1) AS i FROM (SELECT row_id, regexp_extract_all(text, '{_FOOTER}') AS l FROM epub WHERE lower(regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1)) NOT LIKE '%.epub'))")
def footer_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Titles with a page number between paragraphs; books with flowing text have no such footers and are passed over."""
    rows = table(spark, folder, "epub").where(~F.lower(F.regexp_extract("chunk_id", r"^(.+)_p\d+_c\d+$", 1)).endswith(".epub"))
    return rows.select("row_id", F.posexplode(F.regexp_extract_all("text", F.lit(f"({_FOOTER})"), F.lit(1))).alias("pos", "m")).select("row_id", "pos", T.strip(F.col("m")).alias("footer"))


@query(None)
def superscript_notes(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "blocks").where("text is not null")
    return T.with_once(b.select("doc_id", "page", "seq", "text", "inline_styles"), "n", T.strip_superscripts(F.col("text"), F.coalesce("inline_styles", F.from_json(F.lit("[]"), b.schema["inline_styles"].dataType)))).select(
        "doc_id", "page", "seq", F.col("n.text").alias("text"), F.array_join("n.notes", ",").alias("notes")
    )


_STEPS = ("raw", "spaces", "case", "sorted_words")
_STEP_SQL = {"raw": "text", "spaces": s_strip(r"regexp_replace(text, '\s+', ' ', 'g')"), "case": f"lower({s_strip(r"regexp_replace(text, '\s+', ' ', 'g')")})", "sorted_words": f"array_to_string(list_sort({s_words('lower(text)')}), ' ')"}


@query("SELECT step, (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM (SELECT CASE step WHEN 'raw' THEN " + _STEP_SQL["raw"] + " WHEN 'spaces' THEN " + _STEP_SQL["spaces"] + " WHEN 'case' THEN " + _STEP_SQL["case"] + " ELSE " + _STEP_SQL["sorted_words"]
    + " END AS v FROM documents WHERE text IS NOT NULL) GROUP BY v)) AS duplicates FROM (VALUES ('raw'), ('spaces'), ('case'), ('sorted_words')) s(step)")
def dup_by_step(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicates in the output of each of some steps, to see which of them makes texts equal. Hashes only meet."""
    t = F.col("text")
    spaces = T.strip(F.regexp_replace(t, r"\s+", " "))
    forms = {"raw": t, "spaces": spaces, "case": F.lower(spaces), "sorted_words": F.array_join(F.array_sort(T.words(F.lower(t))), " ")}
    each = _docs(spark, folder).where(t.isNotNull()).select(F.explode(F.array(*(F.struct(F.lit(s).alias("step"), F.md5(forms[s]).alias("h")) for s in _STEPS))).alias("x"))
    per = each.groupBy("x.step", "x.h").agg(F.count("*").alias("n"))
    return per.groupBy("step").agg(F.sum(F.col("n") - 1).alias("duplicates"))


_TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_OVERLAPS = (0, 25, 50, 75, 100, 125, 150)


@query(rf"""WITH d AS (SELECT doc_id, {s_words('text')} AS w FROM documents), o AS (SELECT unnest([0, 25, 50, 75, 100, 125, 150]) AS overlap),
  s AS (SELECT overlap, doc_id, w, len(w) AS n, unnest(range(0, len(w), 400 - overlap)) AS s FROM d, o WHERE len(w) > 0),
  c AS (SELECT overlap, doc_id, s // (400 - overlap) AS chunk, array_to_string(w[s + 1 : s + 400], ' ') AS text FROM s WHERE NOT (s > 0 AND n - s <= overlap) AND NOT (s > 0 AND s + 400 - overlap >= n AND least(400, n - s) <= 2 * overlap)),
  t AS (SELECT overlap, doc_id, chunk, {_TOK} AS t FROM c), b AS (SELECT *, lead(t) OVER x AS u, lead(chunk) OVER x AS nxt FROM t WINDOW x AS (PARTITION BY overlap, doc_id ORDER BY chunk)),
  q AS (SELECT overlap, doc_id, chunk, nxt, list_concat(t[len(t) - 4 :], u[: 5]) AS query FROM b WHERE doc_id % 100 = 0 AND len(t) >= 10 AND len(u) >= 10),
  e AS (SELECT overlap, doc_id, chunk, len(t) AS total, unnest(t) AS term FROM t), tf AS (SELECT overlap, doc_id, chunk, term, count(*)::DOUBLE / total AS tf FROM e GROUP BY overlap, doc_id, chunk, term, total),
  z AS (SELECT overlap, count(*) AS chunks FROM t GROUP BY overlap), idf AS (SELECT overlap, term, ln((any_value(chunks) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf JOIN z USING (overlap) GROUP BY overlap, term),
  qt AS (SELECT overlap, doc_id, chunk, term, count(*) AS times FROM (SELECT overlap, doc_id, chunk, unnest(query) AS term FROM q) GROUP BY ALL),
  r AS (SELECT qt.overlap, qt.doc_id AS qd, qt.chunk AS qc, tf.doc_id AS wd, tf.chunk AS wc, round(sum(times * tf * idf), 9) AS score FROM qt JOIN idf USING (overlap, term) JOIN tf ON tf.overlap = qt.overlap AND tf.term = qt.term GROUP BY ALL),
  k AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY overlap, qd, qc ORDER BY score DESC, wd, wc) <= 3),
  p AS (SELECT k.overlap, qd, qc, max((wd = qd AND (wc = qc OR wc = nxt))::INT) AS hit FROM k JOIN q ON q.overlap = k.overlap AND q.doc_id = qd AND q.chunk = qc GROUP BY ALL),
  a AS (SELECT overlap, count(*) AS queries, round(avg(hit::DOUBLE), 6) AS recall FROM p GROUP BY overlap)
  SELECT overlap::INTEGER AS overlap, chunks, coalesce(queries, 0) AS queries, recall FROM z LEFT JOIN a USING (overlap)""")
def recall_by_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Recall at three for overlaps of windows of 400 words; the boundaries of documents with an id divisible by 100 are asked of all."""
    return C.recall_by_overlap(_docs(spark, folder).select("doc_id", "text"), "doc_id", _OVERLAPS, F.col("row") % 100 == 0)


_T = s_strip("t")
_MARKS = """(length(t) - length(translate(t, '"' || chr(39), '')))"""


@query(rf"""WITH b AS (SELECT doc_id, page, seq, coalesce(text, '') AS t, text FROM blocks), n AS (SELECT *, lead({_T}) OVER w AS nt, lead(page) OVER w AS np, lead(1) OVER w AS more FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY page NULLS FIRST, seq NULLS FIRST, text NULLS FIRST)),
  f AS (SELECT doc_id, t, t <> '' AND (regexp_matches(t, '[a-z][A-Z]') OR (regexp_matches({_T}, '^\p{{Ll}}') AND right({_T}, 1) NOT IN ('.', '!', '?', ';', ':')) OR regexp_matches(t, '\s{{3,}}') OR {_MARKS} % 2 <> 0
    OR (length({_T}) < 20 AND right({_T}, 1) NOT IN ('.', '!', '?')) OR regexp_matches(t, '[a-z][.!?][A-Z]')) AS trouble, {_MARKS} > 0 OR regexp_matches(lower(t), '{PART_WORDS}') AS sign,
    more IS NOT NULL AND np IS DISTINCT FROM page AS turn, more IS NOT NULL AND np IS DISTINCT FROM page AND {_T} <> '' AND right({_T}, 1) NOT IN ('.', '!', '?') AND coalesce(regexp_matches(nt, '^\p{{Ll}}'), false) AS broken FROM n),
  p AS (SELECT doc_id, count(*) AS blocks, count(*) FILTER (trouble) AS troubled, sum(length(t) + 1) AS chars, bool_or(sign) AS signs, count(*) FILTER (turn) AS turns, count(*) FILTER (broken) AS broken FROM f GROUP BY doc_id)
  SELECT doc_id, blocks, troubled, troubled > 0 OR (blocks > 10 AND chars / blocks < 100) OR signs OR (turns > 0 AND broken / turns > 0.3) AS clean FROM p""")
def documents_to_clean(spark: SparkSession, folder: str) -> DataFrame:
    return Q.documents_to_clean(table(spark, folder, "blocks"))


@query(None)
def better_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return Q.better_blocks(table(spark, folder, "blocks").select("doc_id", "seq", "text").distinct(), _lines(spark, folder))


@query("""WITH o AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type <> 'purchase' GROUP BY ALL)
  SELECT o.event_id, v.value AS value_asof FROM o ASOF LEFT JOIN v ON o.user_id = v.user_id AND o.ts >= v.ts""")
def events_asof(spark: SparkSession, folder: str) -> DataFrame:
    """For each purchase, the value of the user's latest other event."""
    e = table(spark, folder, "events")
    left, right = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type <> 'purchase'").select("user_id", "ts", "value")
    return J.asof_join(left, right, ["user_id"], "ts", ["value"]).select("event_id", "value_asof")


@query("""WITH s AS (SELECT doc_id, seq, s.start AS a, s."end" AS z FROM (SELECT doc_id, page, seq, unnest(inline_styles) AS s FROM blocks)), p AS (SELECT row_id, metadata.page AS page FROM epub WHERE metadata.page IS NOT NULL)
  SELECT row_id, count(*) AS spans FROM p JOIN s ON p.page >= s.a AND p.page < s.z GROUP BY row_id""")
def pages_in_spans(spark: SparkSession, folder: str) -> DataFrame:
    """An interval join: the style spans that hold a number, for the page numbers of chunks, counted on each side before they meet."""
    spans = table(spark, folder, "blocks").select(F.explode("inline_styles").alias("s")).groupBy(F.col("s.start").alias("a"), F.col("s.end").alias("z")).agg(F.count("*").alias("n"))
    pages = table(spark, folder, "epub").select("row_id", F.col("metadata.page").alias("page")).where("page is not null")
    per = J.interval_join(pages.select("page").distinct(), spans, "page", "a", "z", 16).groupBy("page").agg(F.sum("n").alias("spans"))
    return pages.join(per, "page").select("row_id", "spans")


@query("SELECT book, count(*) AS chunks, sum(words)::BIGINT AS words FROM (SELECT regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1) AS book, len(" + s_words("text") + ") AS words FROM epub) GROUP BY book")
def sql_surface(spark: SparkSession, folder: str) -> DataFrame:
    """The same through SQL, on views and a registered function."""
    register_sql(spark, folder, ("epub",))
    return spark.sql("SELECT book, count(*) AS chunks, sum(n) AS words FROM (SELECT regexp_extract(chunk_id, r'^(.+)_p\\d+_c\\d+$', 1) AS book, quill_words(text) AS n FROM epub) GROUP BY book")
