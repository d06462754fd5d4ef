"""Where chunks come from, and the metadata they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import predicates as P
from ..functions.text import let


def match_blocks(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, seq, text, found): whether the first 50 characters of a block, normalised, occur in its document."""
    keyed = blocks.select("doc_id", "seq", "text", P.normalized(F.col("text")).alias("t")).where("t <> ''")
    whole = docs.select("doc_id", P.normalized(F.col("text")).alias("whole"))
    return keyed.join(whole, "doc_id").withColumn("found", F.contains("whole", F.left("t", F.lit(50)))).drop("whole", "t")


def with_metadata(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``meta``: readability, kind of block and list, utterance and importance, all read from the text."""
    t = F.col(text_col)
    listed = P.contains_bullet(t) | P.starts_with_number(t)
    meta = F.struct(
        F.when(listed, "list_item").otherwise("paragraph").alias("block_type"),
        F.when(P.contains_bullet(t), "bullet").when(P.starts_with_number(t), "numbered").alias("list_kind"),
        let(M.flesch_kincaid(t), lambda g: F.struct(g.alias("flesch_kincaid_grade"), M.difficulty(g).alias("difficulty"))).alias("readability"),
        F.when(t.rlike(r"\?\s*$"), "question").otherwise("statement").alias("utterance_type"),
        F.lit("medium").alias("importance"),
        F.left(F.md5(t), F.lit(8)).alias("text_hash"),
    )
    return chunks.withColumn("meta", meta)
