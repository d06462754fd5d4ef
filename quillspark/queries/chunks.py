"""Queries of windows, neighbours, duplicates, retrieval, quality and metadata, on the tables documents and epub."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import words
from ..operators import chunks as C
from ..operators import provenance as V
from ..operators import quality as Q
from ..operators import rules as R
from ..operators.adjacency import with_neighbour
from ._base import LINES_SQL, query, s_ended, s_normalized, s_strip, s_words, table


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _epub(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "epub")


def _windows_sql(size: int, overlap: int) -> str:
    step = max(1, size - overlap)
    return f"""SELECT doc_id, (s // {step})::INTEGER AS chunk, least({size}, n - s)::INTEGER AS n_words, array_to_string(w[s + 1 : s + {size}], ' ') AS text FROM (
      SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w), {step})) AS s FROM (SELECT doc_id, {s_words('text')} AS w FROM documents) WHERE len(w) > 0)
      WHERE NOT (s > 0 AND n - s <= {overlap}) AND NOT (s > 0 AND s + {step} >= n AND least({size}, n - s) <= {2 * overlap})"""


@query(_windows_sql(400, 50))
def chunk_windows(spark: SparkSession, folder: str) -> DataFrame:
    return C.word_windows(_docs(spark, folder), "doc_id")


@query(_windows_sql(400, 100))
def chunk_windows_rag(spark: SparkSession, folder: str) -> DataFrame:
    return C.word_windows(_docs(spark, folder), "doc_id", overlap=100)


_FP = s_normalized("translate(text, '“”‘’', '\"\"''''')")


@query(f"""WITH k AS (SELECT doc_id, md5({_FP}) AS fp FROM documents WHERE {_FP} <> '')
  SELECT fp, count(*) AS copies, min(doc_id) AS first_id, list_sort(list(doc_id))[2] AS second_id FROM k GROUP BY fp HAVING count(*) > 1""")
def dup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return C.exact_duplicates(_docs(spark, folder), "doc_id")


_GRAMS = f"""w AS (SELECT doc_id, list_filter(string_split({_FP}, ' '), lambda x: x <> '') AS w FROM documents),
  g AS (SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS gram, min(i) AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5) GROUP BY ALL),
  h AS (SELECT gram, count(*) AS n, min(doc_id) AS least FROM g GROUP BY gram)"""


@query(f"""WITH {_GRAMS} SELECT doc_id, count(*) AS shingles, count(*) FILTER (n > 1) AS shared, arg_min(CASE WHEN n > 1 THEN gram END, CASE WHEN n > 1 THEN pos END) AS first_shared,
  min(CASE WHEN n > 1 THEN least END) AS least_holder FROM g JOIN h USING (gram) GROUP BY doc_id""")
def dup_shingles(spark: SparkSession, folder: str) -> DataFrame:
    return C.shared_shingles(_docs(spark, folder), "doc_id")


@query(f"WITH {_GRAMS} SELECT doc_id, least AS first_id, count(*) AS runs FROM g JOIN h USING (gram) WHERE doc_id > least GROUP BY ALL")
def dup_shingle_links(spark: SparkSession, folder: str) -> DataFrame:
    return C.shingle_links(_docs(spark, folder), "doc_id")


@query(rf"""WITH s AS (SELECT doc_id, {s_normalized('s')} AS sentence FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10))) AS s FROM documents))
  SELECT sentence, count(*) AS times, min(doc_id) AS first_id FROM s WHERE len({s_words('sentence')}) >= 10 GROUP BY sentence HAVING count(*) > 1""")
def dup_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return C.repeated_sentences(_docs(spark, folder), "doc_id")


_BOOK = "regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1)"
_ORDER = f"PARTITION BY {_BOOK} ORDER BY chunk_seq, row_id"


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return _epub(spark, folder).withColumn("book", F.regexp_extract("chunk_id", r"^(.+)_p\d+_c\d+$", 1))


@query(f"""WITH n AS (SELECT row_id, {s_words('lower(text)')} AS a, lead({s_words('lower(text)')}) OVER ({_ORDER}) AS b FROM epub),
  c AS (SELECT row_id, a, b, unnest(range(5, 21)) AS k FROM n WHERE b IS NOT NULL)
  SELECT row_id, max(k)::INTEGER AS overlap_words FROM c WHERE k <= len(a) AND k <= len(b) AND a[len(a) - k + 1 :] = b[: k] GROUP BY row_id""")
def boundary_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return C.boundary_overlaps(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"]).select("row_id", "overlap_words")


_TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query(f"""WITH t AS (SELECT row_id, {_TOK} AS t FROM epub), e AS (SELECT row_id, len(t) AS total, unnest(t) AS term FROM t)
  SELECT row_id AS id, term, round(count(*)::DOUBLE / total, 9) AS tf FROM e GROUP BY row_id, term, total""")
def tfidf_tf(spark: SparkSession, folder: str) -> DataFrame:
    return C.term_weights(_epub(spark, folder), "row_id").withColumn("tf", F.round("tf", 9))


@query(f"""WITH e AS (SELECT DISTINCT row_id, unnest({_TOK}) AS term FROM epub)
  SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM epub) + 1)::DOUBLE / (count(*) + 1)) + 1, 6) AS idf FROM e GROUP BY term""")
def tfidf_idf(spark: SparkSession, folder: str) -> DataFrame:
    epub = _epub(spark, folder)
    df = C.document_frequencies(C.term_weights(epub, "row_id"))
    n = epub.agg(F.count("*").alias("n"))
    return df.crossJoin(F.broadcast(n)).select("term", "df", F.round(F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1, 6).alias("idf"))


@query(f"""SELECT row_id, next_id, array_to_string(list_concat(t[len(t) - 4 :], u[: 5]), ' ') AS query FROM (SELECT row_id, {_TOK} AS t, lead(row_id) OVER ({_ORDER}) AS next_id, lead({_TOK}) OVER ({_ORDER}) AS u FROM epub) WHERE len(t) >= 10 AND len(u) >= 10""")
def boundary_queries(spark: SparkSession, folder: str) -> DataFrame:
    q = C.boundary_queries(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"], "row_id")
    return q.select(F.col("id").alias("row_id"), "next_id", F.array_join("query", " ").alias("query"))


def _retrieved(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Top three of all rows for the boundary queries of rows whose id is divisible by 100: the stated query set."""
    epub = _chunks(spark, folder)
    queries = C.boundary_queries(epub, ["book"], ["chunk_seq", "row_id"], "row_id").where("id % 100 = 0").withColumnRenamed("id", "query_id")
    return queries, C.retrieve(queries.select("query_id", "query"), epub, "row_id")


_RETRIEVE = f"""q AS (SELECT row_id AS query_id, next_id, list_concat(t[len(t) - 4 :], u[: 5]) AS query FROM (SELECT row_id, {_TOK} AS t, lead(row_id) OVER ({_ORDER}) AS next_id, lead({_TOK}) OVER ({_ORDER}) AS u FROM epub) WHERE len(t) >= 10 AND len(u) >= 10 AND row_id % 100 = 0),
  e AS (SELECT row_id, len(t) AS total, unnest(t) AS term FROM (SELECT row_id, {_TOK} AS t FROM epub)), tf AS (SELECT row_id, term, count(*)::DOUBLE / total AS tf FROM e GROUP BY row_id, term, total),
  idf AS (SELECT term, ln(((SELECT count(*) FROM epub) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY term),
  qt AS (SELECT query_id, term, count(*) AS times FROM (SELECT query_id, unnest(query) AS term FROM q) GROUP BY ALL),
  r AS (SELECT query_id, row_id AS id, round(sum(times * tf * idf), 9) AS score FROM qt JOIN idf USING (term) JOIN tf USING (term) GROUP BY ALL),
  k AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM r QUALIFY rank <= 3)"""


@query(f"WITH {_RETRIEVE} SELECT query_id, id, round(score, 6) AS score, rank FROM k")
def retrieval_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _retrieved(spark, folder)[1].withColumn("score", F.round("score", 6))


@query(f"WITH {_RETRIEVE} SELECT count(*) AS queries, round(avg(hit::DOUBLE), 6) AS recall_at_3 FROM (SELECT query_id, max((id = query_id OR id = next_id)::INT) AS hit FROM q JOIN k USING (query_id) GROUP BY query_id)")
def retrieval_recall(spark: SparkSession, folder: str) -> DataFrame:
    queries, top = _retrieved(spark, folder)
    hits = top.join(queries.select("query_id", "next_id"), "query_id").groupBy("query_id").agg(F.max(((F.col("id") == F.col("query_id")) | (F.col("id") == F.col("next_id"))).cast("int")).alias("hit"))
    return hits.agg(F.count("*").alias("queries"), F.round(F.avg("hit"), 6).alias("recall_at_3"))


@query(f"""SELECT count(*) AS chunks, round(avg(w), 6) AS mean_words, median(w) AS median_words, min(w) AS min_words, max(w) AS max_words, round(stddev_samp(w), 6) AS sd_words, round(avg(c), 6) AS mean_chars, median(c) AS median_chars,
  min(c)::BIGINT AS min_chars, max(c)::BIGINT AS max_chars, round(stddev_samp(c), 6) AS sd_chars FROM (SELECT len({s_words('text')})::BIGINT AS w, length(text) AS c FROM epub WHERE text <> '')""")
def stats_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return Q.size_statistics(_epub(spark, folder))


@query(f"""SELECT CASE WHEN w <= 9 THEN 'very_short' WHEN w <= 12 THEN 'short' WHEN w <= 15 THEN 'minimal' ELSE 'normal' END AS bucket, count(*) AS chunks FROM (SELECT coalesce(len({s_words('text')}), 0) AS w FROM epub) GROUP BY 1""")
def stats_short_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return Q.short_buckets(_epub(spark, folder))


@query(rf"""SELECT count(*) AS chunks, count(*) FILTER ({s_strip('text')} = '') AS empty_text, count(*) FILTER (regexp_matches({s_strip('text')}, '^\p{{Ll}}')) AS mid_sentence, count(*) FILTER (length(text) > 8000) AS overlong FROM epub""")
def validate_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return Q.validation(_epub(spark, folder))


_FLOW = rf"""SELECT book, a, b, {s_words('a')} AS wa, {s_words('b')} AS wb FROM (SELECT {_BOOK} AS book, {s_strip('text')} AS a, lead({s_strip('text')}) OVER ({_ORDER}) AS b FROM epub) WHERE b IS NOT NULL AND a <> '' AND b <> ''"""


@query(rf"""SELECT book, count(*) AS transitions, count(*) FILTER (right(a, 1) NOT IN ('.', '!', '?', ':', ';') AND regexp_matches(b, '^\p{{Ll}}')) AS abrupt,
  count(*) FILTER (length(wa[-1]) < 4 AND length(wb[1]) < 8 AND regexp_matches(wb[1], '^\p{{Ll}}')) AS word_splits, count(*) FILTER (len(wa) <= 5 AND len(wb) <= 10 AND right(a, 1) NOT IN ('.', '!', '?')) AS continuations
  FROM ({_FLOW}) GROUP BY book""")
def stats_flow(spark: SparkSession, folder: str) -> DataFrame:
    return Q.flow(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"])


@query(None)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return Q.report(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"])


@query(r"""SELECT count(*) FILTER (regexp_matches(text, '["“][^"“”]+["”]')) AS quoted, count(*) FILTER (regexp_matches(text, '(?i)\b(said|asked|replied|answered|whispered|shouted)\b')) AS attributed,
  count(*) FILTER (regexp_matches(text, '["“][^"“”]+["”]') AND regexp_matches(text, '(?i)\b(said|asked|replied|answered|whispered|shouted)\b')) AS dialogue FROM epub""")
def stats_dialogue(spark: SparkSession, folder: str) -> DataFrame:
    return Q.dialogue_counts(_epub(spark, folder))


@query(r"""SELECT sum(len(regexp_extract_all(text, '[a-z][A-Z]')))::BIGINT AS case_joins, sum(len(regexp_extract_all(text, '[.!?][A-Za-z]')))::BIGINT AS sentence_joins, sum(len(regexp_extract_all(text, '[a-z][0-9]')))::BIGINT AS digit_joins,
  count(*) FILTER (regexp_matches(text, '[a-z][A-Z]|[.!?][A-Za-z]|[a-z][0-9]')) AS affected FROM epub""")
def stats_gluing(spark: SparkSession, folder: str) -> DataFrame:
    return Q.gluing(_epub(spark, folder))


@query(rf"""WITH l AS (SELECT doc_id, {s_strip('text')} AS line FROM ({LINES_SQL})), r AS (SELECT doc_id, line, count(*) AS n FROM l GROUP BY ALL)
  SELECT doc_id, sum(CASE WHEN n > 2 AND length(line) < 100 THEN n ELSE 0 END)::BIGINT AS repeated, sum(CASE WHEN regexp_matches(line, '^\d+$') THEN n ELSE 0 END)::BIGINT AS lone_numbers, sum(n)::BIGINT AS lines FROM r GROUP BY doc_id""")
def stats_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return Q.contamination(_docs(spark, folder))


@query(None)
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return Q.text_quality(_docs(spark, folder), "doc_id")


@query(f"SELECT lang, source, count(*) AS documents, sum(n_chars)::BIGINT AS chars, grouping(lang, source)::BIGINT AS level FROM documents GROUP BY ROLLUP (lang, source)")
def corpus_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).rollup("lang", "source").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("level"))


@query("SELECT row_id, format('{}_p{}_c{}', regexp_extract(chunk_id, '^(.+)_p\\d+_c\\d+$', 1), greatest(metadata.page - 2, 0), chunk_seq) AS compat_id FROM epub WHERE metadata.page IS NOT NULL AND chunk_seq IS NOT NULL")
def meta_chunk_id(spark: SparkSession, folder: str) -> DataFrame:
    e = _chunks(spark, folder).where("metadata.page is not null and chunk_seq is not null")
    return e.select("row_id", F.format_string("%s_p%d_c%d", "book", F.greatest(F.col("metadata.page") - 2, F.lit(0)), "chunk_seq").alias("compat_id"))


@query(f"""WITH v AS (SELECT DISTINCT lower(trim(tag)) AS tag FROM tags WHERE tag IS NOT NULL), t AS (SELECT DISTINCT row_id, lower(trim(unnest(metadata.tags))) AS tag FROM epub)
  SELECT row_id, CASE WHEN count(v.tag) > 0 THEN string_agg(v.tag, ',' ORDER BY v.tag) ELSE string_agg(t.tag, ',' ORDER BY t.tag) END AS tags FROM t LEFT JOIN v ON t.tag = v.tag WHERE t.tag <> '' GROUP BY row_id""")
def meta_tags(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = R.tag_vocabulary(table(spark, folder, "tags"))
    valid = R.valid_tags(_epub(spark, folder), "row_id", F.col("metadata.tags"), vocabulary)
    return valid.select("row_id", F.array_join("tags", ",").alias("tags"))


@query("""SELECT row_id, array_to_string(list_filter([CASE WHEN metadata.chunk_id IS NULL THEN 'chunk_id' END, CASE WHEN metadata.language IS NULL THEN 'language' END, CASE WHEN metadata.location IS NULL THEN 'location' END,
  CASE WHEN metadata.page IS NULL THEN 'page' END, CASE WHEN metadata.readability IS NULL THEN 'readability' END, CASE WHEN metadata.source IS NULL THEN 'source' END, CASE WHEN metadata.tags IS NULL THEN 'tags' END], lambda x: x IS NOT NULL), ',') AS missing FROM epub""")
def meta_gaps(spark: SparkSession, folder: str) -> DataFrame:
    keys = ("chunk_id", "language", "location", "page", "readability", "source", "tags")
    missing = F.array_compact(F.array(*(F.when(F.col(f"metadata.{k}").isNull(), F.lit(k)) for k in keys)))
    return _epub(spark, folder).select("row_id", F.array_join(missing, ",").alias("missing"))


@query(None)
def meta_struct(spark: SparkSession, folder: str) -> DataFrame:
    return V.with_metadata(_chunks(spark, folder)).select("row_id", F.to_json("meta").alias("meta"))


@query(f"""WITH b AS (SELECT doc_id, seq, text, {s_normalized('text')} AS t FROM blocks WHERE {s_normalized('text')} <> ''), d AS (SELECT doc_id, {s_normalized('text')} AS t FROM documents)
  SELECT b.doc_id, b.seq, contains(d.t, left(b.t, 50)) AS found FROM b JOIN d USING (doc_id)""")
def source_match(spark: SparkSession, folder: str) -> DataFrame:
    return V.match_blocks(table(spark, folder, "blocks"), _docs(spark, folder)).select("doc_id", "seq", "found")


@query(f"""SELECT row_id, text, CASE WHEN lower(regexp_extract(ltrim(text), '^([\\p{{L}}\\p{{N}}_'']+)', 1)) IN ({', '.join(repr(w) for w in P.CONTINUATION_LEADS)}) AND prev IS NOT NULL AND NOT {s_ended('prev')} THEN true ELSE false END AS needs_context
  FROM (SELECT row_id, text, lag(text) OVER ({_ORDER}) AS prev FROM epub)""")
def continuation_context(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_neighbour(_chunks(spark, folder), ["book"], ["chunk_seq", "row_id"], {"filled": F.col("text").isNotNull(), "ended": P.has_sentence_ending(F.col("text"))}, "prev", ahead=False)
    need = P.starts_with_continuation(F.col("text")) & F.coalesce(F.col("prev.filled") & ~F.col("prev.ended"), F.lit(False))
    return rows.select("row_id", "text", need.alias("needs_context"))


@query(f"""SELECT doc_id, array_to_string(list_reverse(list_reverse({s_words('text')})[: 5]), ' ') AS tail, array_to_string({s_words('text')}[: 5], ' ') AS head FROM documents""")
def overlap_edges(spark: SparkSession, folder: str) -> DataFrame:
    w = words(F.col("text"))
    return _docs(spark, folder).select(
        "doc_id", F.array_join(F.slice(w, F.greatest(F.size(w) - 4, F.lit(1)), F.lit(5)), " ").alias("tail"), F.array_join(F.slice(w, F.lit(1), F.lit(5)), " ").alias("head")
    )


@query(r"""SELECT doc_id, string_split(trim(regexp_replace(replace(text, chr(10), ' [[BR]] '), '\s+', ' ', 'g')), ' ')[1] AS first, len(list_filter(regexp_split_to_array(replace(text, chr(10), ' [[BR]] '), '\s+'), lambda x: x <> '')) AS tokens FROM documents""")
def tokens_with_breaks(spark: SparkSession, folder: str) -> DataFrame:
    t = F.filter(F.split(F.replace("text", F.lit("\n"), F.lit(" [[BR]] ")), r"\s+"), lambda x: x != "")
    return _docs(spark, folder).select("doc_id", F.get(t, F.lit(0)).alias("first"), F.size(t).cast("bigint").alias("tokens"))


@query("SELECT metadata.block_type AS block_type, metadata.list_kind AS list_kind, count(*) AS chunks, count(DISTINCT metadata.source_file) AS files FROM epub GROUP BY 1, 2")
def stats_block_types(spark: SparkSession, folder: str) -> DataFrame:
    return _epub(spark, folder).groupBy(F.col("metadata.block_type").alias("block_type"), F.col("metadata.list_kind").alias("list_kind")).agg(F.count("*").alias("chunks"), F.countDistinct("metadata.source_file").alias("files"))


@query("""SELECT bool_or(metadata.page IS NULL) AS metadata_gaps, bool_or(contains(text, '_')) AS underscores, bool_or(regexp_matches(text, '\\[\\d+\\]')) AS footnotes, bool_or(length(text) > 8000) AS overlong FROM epub""")
def run_warnings(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    return _epub(spark, folder).agg(
        F.bool_or(F.col("metadata.page").isNull()).alias("metadata_gaps"), F.bool_or(F.contains(t, F.lit("_"))).alias("underscores"),
        F.bool_or(t.rlike(r"\[\d+\]")).alias("footnotes"), F.bool_or(F.length(t) > 8000).alias("overlong"),
    )


@query("SELECT row_id, text, NULL AS metadata FROM epub")
def jsonl_text_only(spark: SparkSession, folder: str) -> DataFrame:
    return _epub(spark, folder).select("row_id", "text", F.lit(None).cast("string").alias("metadata"))


@query(None)
def pipeline_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The shipped pipeline over all documents: clean, drop artefacts, detect, split, describe."""
    from ..plans import pipeline

    return pipeline.run(pipeline.default_spec(), _docs(spark, folder)).select("doc_id", "chunk", "text", F.to_json("meta").alias("meta"))


