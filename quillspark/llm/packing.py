"""Filling fixed-capacity containers with items (problem 5).

Method: variable-capacity best fit. Items go, largest first, into the container with the least room that still takes them;
where none does, the permitted capacity of least cost for each token it can expect to hold is opened; at the end each
container shrinks to the smallest permitted capacity that holds its contents. What a container can expect to hold is the
item and as much of its room as the smaller items still to come can fill beside the rooms that are open already, so the
capacities are chosen jointly with the sizes that are left. Items beyond the largest capacity are divided: full parts fill
containers of their own, the rest is an item.

Items are spread by a hash over blocks of a bounded number of items, each packed in one task, so that no task grows with
the data and no key can be hot. What a block loses is its last container or so: under a thousandth of its containers.

Defined results: null ids and null sizes have no container, an item of size 0 or less has none either; repeated ids are
separate items.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def byt5_tokens(text: Column) -> Column:
    """Tokens of the public byte-level ByT5 tokenizer: one for each UTF-8 byte and an end token; null for null."""
    return F.octet_length(text) + 1


def attention_cost(capacity: int) -> float:
    """The default cost of a container: one for each place, filled or not, and for attention a part that grows with the square
    of the length, as much again at 4,096."""
    return capacity * (1 + capacity / 4096)


def _fit(order: np.ndarray, sizes: np.ndarray, capacities: tuple[int, ...], cost: Callable[[int], float], opens: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit in a given order, largest first; ``opens`` is the capacity opened where an item fits it, 0 the one of least cost."""
    falling = sizes[order]
    rest = np.r_[np.cumsum(falling[::-1])[::-1], 0]
    # No item from the k-th on is larger than the k-th, so those that fit a room are the later ones from some place on.
    first_at_most = np.searchsorted(-falling, -np.arange(capacities[-1] + 1), "left")
    at = np.empty(len(sizes), np.int64)
    content: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = open_room = 0
    for k, i in enumerate(order):
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            box = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            open_room -= room
        else:
            room, best = 0, 0.0
            for c in capacities if not opens else capacities[-1:] if opens < size else (opens,):
                if c >= size:
                    to_come = int(rest[max(k + 1, int(first_at_most[c - size]))]) - open_room
                    each = cost(c) / (size + min(c - size, max(0, to_come)))
                    if not room or each <= best:
                        room, best = c, each
            box = len(content)
            content.append(0)
        at[i] = box
        content[box] += size
        room -= size
        if room:
            by_room.setdefault(room, []).append(box)
            rooms |= 1 << room
            open_room += room
    steps = np.asarray(capacities)
    return at, steps[np.searchsorted(steps, np.asarray(content, np.int64))] if content else np.empty(0, np.int64)


def best_fit(sizes: np.ndarray, capacities: tuple[int, ...], cost: Callable[[int], float] = attention_cost) -> tuple[np.ndarray, np.ndarray]:
    """(container of each item, capacity of each container). Sizes must lie between 1 and the largest capacity.

    Rooms are held as one bit for each amount of room left, and the least sufficient one is found by the lowest set bit.
    The joint choice and, as a bound on it, each capacity by itself are packed; the packing of least cost is taken.
    """
    capacities = tuple(sorted(capacities))
    order = np.argsort(-sizes, kind="stable")
    ways = [_fit(order, sizes, capacities, cost, opens) for opens in ((0, *capacities) if len(capacities) > 1 else (0,))]
    total = lambda way: sum(cost(int(c)) * int(n) for c, n in zip(*np.unique(way[1], return_counts=True)))
    return min(ways, key=lambda way: (total(way), len(way[1])))


def pack(
    df: DataFrame, id_col: str, size: Column, capacities: tuple[int, ...] = (4096,), block_items: int = 50_000, cost: Callable[[int], float] = attention_cost
) -> DataFrame:
    """(id, part, part_size, container, capacity): where each item, or each part of an oversized one, goes.

    ``container`` is unique over all blocks. Containers are the same on every run over the same items.
    """
    most = max(capacities)
    kind = df.schema[id_col].dataType.simpleString()
    items = df.select(F.col(id_col).alias("id"), size.cast("bigint").alias("size")).where("id is not null and size > 0")
    parts = items.select("id", F.posexplode(F.expr(f"transform(sequence(0L, (size - 1) div {most}L), i -> least(size - i * {most}L, {most}L))")).alias("part", "part_size"))
    full = parts.where(F.col("part_size") == most)
    rest = parts.where(F.col("part_size") < most)
    blocks = max(1, -(-df.count() // block_items))  # rows of ``df``: of files, the footers only are read
    spread = rest.withColumn("block", F.pmod(F.xxhash64("id", "part"), F.lit(blocks)).cast("int"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part_size", "id", "part"], ascending=[False, True, True], kind="stable")
        at, caps = best_fit(pdf["part_size"].to_numpy(), capacities, cost)
        return pd.DataFrame({"id": pdf["id"], "part": pdf["part"], "part_size": pdf["part_size"], "container": [f"{key[0]}-{x}" for x in at], "capacity": caps[at].astype(np.int32)})

    packed = spread.groupBy("block").applyInPandas(run, f"id {kind}, part int, part_size bigint, container string, capacity int")
    alone = full.select("id", "part", "part_size", F.concat(F.lit("full-"), F.col("id").cast("string"), F.lit("-"), F.col("part").cast("string")).alias("container"), F.lit(most).alias("capacity"))
    return packed.unionByName(alone).withColumnRenamed("id", id_col)


def fill(packed: DataFrame) -> DataFrame:
    """(capacity, containers, tokens, room, fill): how full the containers are."""
    per = packed.groupBy("container", "capacity").agg(F.sum("part_size").alias("held"))
    return per.groupBy("capacity").agg(
        F.count("*").alias("containers"), F.sum("held").alias("tokens"), F.sum(F.col("capacity") - F.col("held")).alias("room"), (F.sum("held") / F.sum("capacity")).alias("fill")
    )
