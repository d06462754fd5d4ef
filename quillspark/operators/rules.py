"""Vocabularies, remembered decisions, merge rules, style spans and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import predicates as P
from ..functions.text import strip


def tag_vocabulary(tags: DataFrame) -> DataFrame:
    """(category, tag) in lower case, each once; rows without a tag go."""
    return tags.where("tag is not null").select(F.lower(F.trim("category")).alias("category"), F.lower(F.trim("tag")).alias("tag")).distinct()


def valid_tags(rows: DataFrame, id_col: str, tags_col: Column, vocabulary: DataFrame) -> DataFrame:
    """(id, tags): the tags of the vocabulary, sorted; where none is left, those the row has. A join on the tag."""
    each = rows.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.transform(tags_col, lambda t: F.lower(F.trim(t))))).alias("tag")).where("tag <> ''")
    known = vocabulary.select("tag").distinct().withColumn("known", F.lit(True))
    per = each.join(known, "tag", "left").groupBy("id").agg(
        F.array_sort(F.collect_set(F.when(F.col("known"), F.col("tag")))).alias("good"), F.array_sort(F.collect_set("tag")).alias("every")
    )
    return per.select(F.col("id").alias(id_col), F.when(F.size("good") > 0, F.col("good")).otherwise(F.col("every")).alias("tags"))


def style_histogram(blocks: DataFrame) -> DataFrame:
    """(style, spans, chars, confidence) over all inline styles."""
    s = blocks.select(F.explode("inline_styles").alias("s"))
    return s.groupBy(F.col("s.style").alias("style")).agg(F.count("*").alias("spans"), F.sum(F.col("s.end") - F.col("s.start")).alias("chars"), F.round(F.avg("s.confidence"), 6).alias("confidence"))


def clamp_spans(spans: Column, length: Column) -> Column:
    """Spans cut to the text and put in order; empty ones go."""
    cut = F.transform(spans, lambda s: s.withField("start", F.greatest(s["start"], F.lit(0))).withField("end", F.least(s["end"], length)))
    keyed = F.transform(F.filter(cut, lambda s: s["end"] > s["start"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["style"].alias("style"), s["confidence"].alias("confidence")))
    return F.array_sort(keyed)


def remembered(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows whose trimmed text, case ignored, has a decision: the most confident one, the first by name of equals."""
    keyed = decisions.groupBy(F.lower(strip(F.col("pattern"))).alias("key"), "decision").agg(F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
    best = keyed.groupBy("key").agg(F.min(F.struct((-F.col("confidence")).alias("c"), F.col("decision"))).alias("b")).select("key", F.col("b.decision").alias("decision"), (-F.col("b.c")).alias("confidence"))
    return rows.withColumn("key", F.lower(strip(F.col("text")))).join(best, "key").drop("key")


def classify_footers(blocks: DataFrame, decisions: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Adds ``is_footer`` and ``reason``: what was decided before, else the look of the block."""
    notes = decisions.groupBy(F.lower(strip(F.col("pattern"))).alias("key")).agg(
        F.max(F.struct(F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.col("decision"))).alias("d")
    )
    joined = blocks.withColumn("key", F.lower(strip(F.col("text")))).join(notes, "key", "left")
    sure = F.col("d.confidence") >= threshold
    footer = F.col("d.decision").isin("footer", "merge", "remove", "always")
    look = P.is_page_artifact(F.col("text"), F.col("page"))
    reason = F.when(F.col("d").isNotNull() & sure, "decided").when(P.standalone_footer(F.col("text")).isNotNull(), "title_and_number").when(look, "pattern").otherwise("none")
    return joined.withColumn("reason", reason).withColumn("is_footer", F.when(F.col("reason") == "decided", footer).otherwise(F.col("reason") != "none")).drop("key", "d")


def merge_verdicts(rows: DataFrame) -> DataFrame:
    """(doc_id, seq, verdict): whether a line goes with the one before it: lists, then ended sentences, then a small letter."""
    prev, curr = F.col("prev"), F.col("text")
    pairs = rows.withColumn("prev", F.lag("text").over(Window.partitionBy("doc_id").orderBy("seq"))).where("prev is not null")
    verdict = (
        F.when(P.starts_with_bullet(curr) & P.contains_bullet(prev), "merge")
        .when(P.starts_with_number(curr) & P.starts_with_number(prev), "merge")
        .when(P.has_sentence_ending(prev), "split")
        .when(P.starts_lower(curr), "merge")
        .otherwise("split")
    )
    return pairs.select("doc_id", "seq", verdict.alias("verdict"))


def char_map(rows: DataFrame, gap: int = 2) -> DataFrame:
    """(doc_id, seq, start, end): where each line lies in the text of all lines with ``gap`` characters between them."""
    before = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + gap).over(before), F.lit(0))
    return rows.select("doc_id", "seq", start.cast("bigint").alias("start"), (start + F.length("text")).cast("bigint").alias("end"))


def row_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that one of two tables has more often than the other, with ``side`` removed or added."""
    return old.exceptAll(new).withColumn("side", F.lit("removed")).unionByName(new.exceptAll(old).withColumn("side", F.lit("added")))
