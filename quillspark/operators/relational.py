"""Joins by time and by range that a plain equality can't express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, values: list[str]) -> DataFrame:
    """``left`` with ``values`` of the latest row of ``right`` with the same ``by`` whose ``at`` is not later; null where there is none.

    Both sides go through one shuffle and one running window, so there is no row for each pair. Null times meet nothing; of rows of
    ``right`` at one time the greatest values count.
    """
    kept = right.where(F.col(at).isNotNull()).groupBy(*by, at).agg(F.max(F.struct(*values)).alias("__v"))
    names = left.columns
    both = left.withColumns({"__v": F.lit(None).cast(kept.schema["__v"].dataType), "__left": F.lit(1), "__row": F.struct(*names)}).select(*by, at, "__v", "__left", "__row")
    other = kept.withColumns({"__left": F.lit(0), "__row": F.lit(None).cast(both.schema["__row"].dataType)}).select(*by, at, "__v", "__left", "__row")
    upto = Window.partitionBy(*by).orderBy(F.col(at).asc_nulls_first(), "__left").rowsBetween(Window.unboundedPreceding, 0)
    met = both.unionByName(other).withColumn("__last", F.last("__v", ignorenulls=True).over(upto)).where("__left = 1")
    return met.select("__row.*", *(F.when(F.col(f"__row.{at}").isNotNull(), F.col(f"__last.{v}")).alias(f"{v}_asof") for v in values))


def interval_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, width: int, by: list[str] | None = None) -> DataFrame:
    """Rows of ``points`` with each row of ``ranges`` whose ``start <= at < end``. Both are put into stretches of ``width``; a range stands in
    each stretch it touches, so the join is one of equality. ``width`` should be about as long as a range."""
    keys = [*(by or []), "__stretch"]
    p = points.withColumn("__stretch", F.floor(F.col(at) / width))
    touched = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))
    r = ranges.where(F.col(end) > F.col(start)).withColumn("__stretch", F.explode(touched))
    return p.join(r, keys).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("__stretch")
