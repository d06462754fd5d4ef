"""Queries of the training-data problems: (spark, folder) -> DataFrame, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import confusables, leakage, packing, sentences, spans, splitting, truncation


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentences(_table(spark, folder, "epub"))


def p1_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Units and their characters by declared language."""
    units = sentences.sentences(_table(spark, folder, "epub"))
    langs = _table(spark, folder, "epub").select("row_id", F.coalesce(F.lower("metadata.language"), F.lit("un")).alias("language"))
    n = F.col("sent_end") - F.col("sent_start")
    per = units.groupBy("row_id").agg(F.count("*").alias("units"), F.sum(n).alias("chars"))
    return per.join(langs, "row_id").groupBy("language").agg(F.sum("units").alias("units"), F.sum("chars").alias("chars"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated(_table(spark, folder, "epub")).where("is_cut").select("row_id")


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncation_shares(truncation.truncated(_table(spark, folder, "epub")))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = spans.shared_pairs(_table(spark, folder, "epub"))
    return pairs.select(F.col("a").alias("chunk_id_a"), F.col("b").alias("chunk_id_b"))


def p3_shares(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_share(_table(spark, folder, "epub"))


def p3_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """The same by runs of three whole sentences, of any length and however their white space is written."""
    return spans.sentence_share(_table(spark, folder, "epub"))


def p3_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The texts without the sentences of repeated runs."""
    return spans.without_repeats(_table(spark, folder, "epub"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that were split, from their pieces."""
    return splitting.pieces(_table(spark, folder, "epub")).where("piece = 0").select("row_id")


def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.pieces(_table(spark, folder, "epub"))


def p4_cover(spark: SparkSession, folder: str) -> DataFrame:
    """For every row that was split: its text put together from the pieces again, and what of the rules its pieces break."""
    p = splitting.pieces(_table(spark, folder, "epub"))
    new = F.when(F.col("done").isNull(), F.col("piece_text")).otherwise(F.substring("piece_text", F.col("done") - F.col("piece_start") + 1, F.length("piece_text")))
    overlap = F.col("done") - F.col("piece_start")
    p = p.withColumn("done", F.lag("piece_end").over(Window.partitionBy("row_id").orderBy("piece"))).withColumn("new", new)
    in_order = F.array_sort(F.collect_list(F.struct("piece", "new")))
    return p.groupBy("row_id").agg(
        F.md5(F.array_join(F.transform(in_order, lambda x: x["new"]), "")).alias("text_md5"),
        F.max("piece_end").alias("chars"),
        F.count_if(F.length("piece_text") > 8000).alias("too_long"),
        F.count_if(~overlap.between(200, 264)).alias("odd_overlaps"),
        F.count_if(F.col("piece_end") <= F.coalesce("done", F.lit(0))).alias("without_new_text"),
    )


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that were divided, from the packing."""
    packed = packing.pack(_table(spark, folder, "documents"), "doc_id", packing.byt5_tokens(F.col("text")))
    return packed.where("part = 1").select("doc_id")


def p5_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), "doc_id", packing.byt5_tokens(F.col("text")))


def p5_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full containers of several permitted capacities get, each shrunk to its contents."""
    packed = packing.pack(_table(spark, folder, "documents"), "doc_id", packing.byt5_tokens(F.col("text")), (512, 1024, 2048, 4096))
    return packing.fill(packed)


def p5_held(spark: SparkSession, folder: str) -> DataFrame:
    """For every document, the tokens and parts that the containers hold of it, and whether one of these holds too much."""
    packed = p5_containers(spark, folder)
    per = packed.groupBy("container").agg(F.sum("part_size").alias("held"))
    return packed.join(per, "container").groupBy("doc_id").agg(
        F.sum("part_size").alias("tokens"), F.count("*").alias("parts"), F.max((F.col("held") > F.col("capacity")).cast("int")).alias("overfull")
    )


def p5_containers_needed(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the containers are at most one in a hundred, and one, above the least that could hold all tokens."""
    packed = p5_containers(spark, folder)
    total = packed.agg(F.sum("part_size").alias("tokens"), F.countDistinct("container").alias("n"))
    least = F.ceil(F.col("tokens") / 4096)
    return total.select("tokens", least.alias("least"), (F.col("n").between(least, F.ceil(least * 1.01) + 1)).alias("near_least"))


def p5_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", packing.byt5_tokens(F.col("text")).cast("bigint").alias("tokens"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """For every evaluation item, the number of documents it leaked into."""
    found = p6_found(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"))
    items = _table(spark, folder, "benchmark").select("item_id", "suite")
    return items.join(found, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).alias("documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = confusables.same_look_pairs(_table(spark, folder, "documents"))
    return pairs.select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p7_forms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return confusables.same_look(docs).select("doc_id", "form", (F.col("form") != F.col("text")).alias("changed"))


def p7_exploded(spark: SparkSession, folder: str) -> DataFrame:
    """The form of every document by exploded code points, to compare with ``p7_forms``."""
    return confusables.exploded_form(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_lengths, p2_found, p2_shares, p3_found, p3_shares, p3_sentences, p3_kept, p4_found, p4_pieces,
        p4_cover, p5_found, p5_containers, p5_fill, p5_held, p5_containers_needed, p5_sizes, p6_found, p6_items, p7_found, p7_forms, p7_exploded,
    )
}
ORACLE_SQL: dict[str, str] = {
    "p4_found": "SELECT row_id FROM epub WHERE length(text) > 8000",
    "p4_cover": "SELECT row_id, md5(text) AS text_md5, length(text)::INTEGER AS chars, 0::BIGINT AS too_long, 0::BIGINT AS odd_overlaps, 0::BIGINT AS without_new_text FROM epub WHERE length(text) > 8000",
    "p5_held": "SELECT doc_id, (strlen(text) + 1)::BIGINT AS tokens, ceil((strlen(text) + 1) / 4096)::BIGINT AS parts, 0::INTEGER AS overfull FROM documents WHERE text IS NOT NULL",
    "p5_containers_needed": "SELECT sum(strlen(text) + 1)::BIGINT AS tokens, ceil(sum(strlen(text) + 1) / 4096)::BIGINT AS least, true AS near_least FROM documents",
    "p5_found": "SELECT doc_id FROM documents WHERE strlen(text) + 1 > 4096",
    "p5_sizes": "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS tokens FROM documents",
}
