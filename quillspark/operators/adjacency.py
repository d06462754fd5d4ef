"""Values of the neighbouring row of a group, however many rows one group has.

A window by group alone would put a whole group, which may be a third of all rows, into one task. Here a group is cut into
stretches of ``width`` consecutive numbers of its first order column, a window runs inside each stretch, and what crosses a
border comes from a table of one row for each stretch, aggregated before it is shuffled. Only the values asked for are moved.

Rows without a number come first in their group. Rows equal in every order column are in no defined order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_neighbour(rows: DataFrame, group: list[str], order: list[str], values: dict[str, Column], name: str, ahead: bool = True, width: int = 1000) -> DataFrame:
    """Adds ``name``, a struct of ``values`` of the following row of the group (or of the one before), null where there is none.

    ``order[0]`` is a number; ``values`` must have types that can be ordered.
    """
    stretch = F.coalesce(F.floor(F.col(order[0]) / width), F.lit(-(1 << 40))).cast("bigint")
    base = rows.withColumns({"__stretch": stretch, "__own": F.struct(*(c.alias(n) for n, c in values.items()))})
    key = [*group, "__stretch"]
    within = Window.partitionBy(*key).orderBy(*order)
    edge = F.struct(*(F.col(c) for c in order), F.col("__own").alias("__own"))
    edges = base.groupBy(*key).agg((F.min if ahead else F.max)(edge).alias("__edge"))
    across = Window.partitionBy(*group).orderBy("__stretch" if ahead else F.desc("__stretch"))
    borders = edges.select(*(F.col(c).alias(f"__g{i}") for i, c in enumerate(key)), F.lead("__edge.__own").over(across).alias("__beyond"))
    beside = F.lead if ahead else F.lag
    inner = base.withColumn("__near", beside("__own").over(within))
    same = [inner[c].eqNullSafe(borders[f"__g{i}"]) for i, c in enumerate(key)]
    met = inner.join(borders, same, "left")
    return met.select(*(c for c in rows.columns if c != name), F.coalesce("__near", "__beyond").alias(name))
