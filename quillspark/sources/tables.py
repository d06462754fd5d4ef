"""Choice of a reader, page ranges, JSON lines in and out, snapshots."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def adapter(path: Column) -> Column:
    """``epub`` for that suffix, ``pdf`` for every other path; null for null counts as pdf."""
    return F.when(F.lower(path).endswith(".epub"), "epub").otherwise("pdf")


def page_ranges(spec: str | None) -> set[int]:
    """The pages of ``1,3,5-10``, from 1; an empty spec has none. Raises ValueError for 0, words and reversed ranges."""
    pages: set[int] = set()
    for part in (p.strip() for p in (spec or "").split(",")):
        if not part:
            continue
        low, _, high = (x.strip() for x in part.partition("-"))
        a, b = int(low), int(high or low)
        if a < 1 or b < a:
            raise ValueError(f"invalid page range: {part}")
        pages |= set(range(a, b + 1))
    return pages


def read_jsonl(spark: SparkSession, path: str, schema: str = "text STRING, metadata STRING") -> DataFrame:
    """JSON lines; lines that can't be read are kept whole in ``_bad`` and null elsewhere."""
    return spark.read.json(path, schema=f"{schema}, _bad STRING", mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")


def jsonl_rows(chunks: DataFrame, with_metadata: bool = True) -> DataFrame:
    """(text) or (text, metadata) with empty metadata null."""
    if not with_metadata or "metadata" not in chunks.columns:
        return chunks.select("text")
    return chunks.select("text", "metadata")


def write_jsonl(chunks: DataFrame, path: str, with_metadata: bool = True, order: list[str] | None = None) -> None:
    """One JSON object a line, in many files; with ``order``, files and lines follow it (a range partitioning, no single task)."""
    rows = chunks.orderBy(*order) if order else chunks
    jsonl_rows(rows, with_metadata).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def snapshot(df: DataFrame, run_dir: str, step: str) -> DataFrame:
    """Writes the output of a step and reads it again, which also cuts its lineage."""
    path = os.path.join(run_dir, step)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register_sql(spark: SparkSession, folder: str, names: tuple[str, ...]) -> None:
    """Tables of a folder as temporary views, and functions of the engine for SQL: ``quill_words`` (words of a text), ``quill_clean_spaces``.
    They are SQL functions, so Catalyst puts their bodies in place."""
    from ..functions.text import WIDE_SPACES

    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    plain = f"translate(t, '{WIDE_SPACES}', '{' ' * len(WIDE_SPACES)}')"
    spark.sql(rf"CREATE OR REPLACE TEMPORARY FUNCTION quill_words(t STRING) RETURNS INT RETURN size(filter(split({plain}, r'\s+'), w -> w <> ''))")
    spark.sql(rf"CREATE OR REPLACE TEMPORARY FUNCTION quill_clean_spaces(t STRING) RETURNS STRING RETURN trim(regexp_replace({plain}, r'\s+', ' '))")
