"""Search by the sum of tf * idf over all rows, or over all windows of rows, exact and without a row for each pair that meets.

Texts go once to blocks by the hash of their id, and every block gets all queries: those are a stated set, small against the rows.
In its block a query adds up its terms' shares in one array, and only its best rows leave. Work grows with the queries times the
rows that hold one of their terms; what is written to disk grows with the texts, and with the queries times the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_spaces, with_once

_INNER = "\x01"  # between the tokens of a word


def spaced_tokens(text: Column) -> Column:
    """The tokens of a text with a space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def spaced_words(text: Column) -> Column:
    """The words of a text with a space between them; of each word its tokens, with U+0001 for what lies between them."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(plain_spaces(text), r"\s+", " "))), r"[^\p{L}\p{N}_ ]+", _INNER)


def _split(strings: pa.Array, mark: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all strings, and where those of each begin."""
    lists = pc.split_pattern(strings, pattern=mark)
    return lists.flatten(), lists.offsets.to_numpy()


def window_starts(n: np.ndarray, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, start) of each window of rows of ``n`` words, and the step: the windows of ``chunks.word_windows``."""
    step = max(1, size - max(overlap, 0))
    many = -(-n // step)
    row = np.repeat(np.arange(len(n)), many)
    start = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * step
    left = n[row] - start
    kept = (start == 0) | ~((left <= overlap) | ((left <= step) & (np.minimum(size, left) <= 2 * overlap)))
    return row[kept], start[kept], step


class _Units:
    """Rows or windows, in the order of their ids, with the share of each wanted term among their tokens."""

    def __init__(self, owner: np.ndarray, row: np.ndarray, chunk: np.ndarray, start: np.ndarray, stop: np.ndarray, code: np.ndarray, terms: int) -> None:
        self.row, self.chunk, self.n, total = row, chunk, len(row), stop - start
        token = np.arange(total.sum()) + np.repeat(start - (np.cumsum(total) - total), total)
        term, unit = code[token], np.repeat(np.arange(self.n, dtype=np.int32), total)
        del token
        known = term >= 0
        key, times = np.unique(term[known] * np.int64(self.n) + unit[known], return_counts=True)
        term, self.unit = key // max(1, self.n), key % max(1, self.n)
        self.share, self.at = times / total[self.unit], np.searchsorted(term, np.arange(terms + 1))
        self.df, self.one = np.diff(self.at), None
        keys, first, one = np.unique(owner[row] * (int(chunk.max(initial=0)) + 1) + chunk, return_index=True, return_inverse=True)
        if len(keys) < self.n:  # an id of several rows is one unit; rows of equal length count once for df, as one group has them
            seen = np.unique(np.stack([term, one[self.unit], total[self.unit]]), axis=1)[0]
            self.df, self.one, self.row, self.chunk = np.bincount(seen, minlength=terms), one, row[first], chunk[first]

    def best(self, codes: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` units of the largest sums, to nine digits, and the sums; equal ones in the order of units."""
        sums = np.zeros(self.n)
        for c, w in zip(codes, weights):
            a, z = self.at[c], self.at[c + 1]
            sums[self.unit[a:z]] += w * self.share[a:z]
        if self.one is not None:
            sums = np.bincount(self.one, sums)
        taken = []
        for _ in range(min(k, len(sums))):
            i = int(sums.argmax())
            taken.append((i, sums[i]))
            sums[i] = 0
        for i, x in taken:
            sums[i] = x
        least = taken[-1][1] if len(taken) == k else 0
        found = np.flatnonzero((sums > 0) & (sums >= least - 2e-9))  # those that may be equal once rounded
        score = np.floor(sums[found] * 1e9 + 0.5) / 1e9
        order = np.lexsort((found, -score))[:k]
        return found[order], score[order]


def _units(rows: pa.Table, vocabulary: pa.Array, size: int | None, overlaps: tuple[int, ...]) -> Iterator[tuple[int | None, _Units]]:
    """Of a block sorted by id: what is the same for every overlap (whole rows, and rows of one window), as None, then each overlap's windows."""
    pieces, at = _split(rows["s"].combine_chunks(), " ")
    inside = np.arange(len(pieces) + 1)
    if size is not None:
        pieces, inside = _split(pieces, _INNER)
    real = pc.not_equal(pieces, "").to_numpy(zero_copy_only=False)
    code = pc.fill_null(pc.index_in(pieces, value_set=vocabulary), -1).to_numpy()[real]
    to = np.concatenate([[0], np.cumsum(real)])[inside]  # tokens before each word
    owner = rows["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    n = np.diff(at).astype(np.int64)
    one = np.arange(len(n)) if size is None else np.flatnonzero(n <= size)
    yield None, _Units(owner, one, np.zeros(len(one), np.int64), to[at[one]], to[at[one + 1]], code, len(vocabulary))
    more = np.flatnonzero(n > size) if size is not None else []
    for overlap in overlaps if len(more) else ():
        i, start, step = window_starts(n[more], size, overlap)
        row = more[i]
        yield overlap, _Units(owner, row, start // step, to[at[row] + start], to[at[row] + np.minimum(start + size, n[row])], code, len(vocabulary))


def search(texts: DataFrame, n_rows: int, asked: DataFrame, k: int, size: int | None = None, overlaps: tuple[int, ...] = (0,), n_units: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((overlap, units), (overlap, q, id, chunk, score)): how many units there are, and the best ``k`` for each query in each block, of
    which the best of all are to be taken.

    ``texts`` has (id, s), s by ``spaced_tokens`` for whole rows or ``spaced_words`` for windows of ``size`` words; ``n_rows`` says about
    how many. ``asked`` has (overlap, q, query), a query being an array of tokens. idf is by ``n_units`` where given, else by the units counted.
    """
    kind, q_kind = (d.schema[c].dataType.simpleString() for d, c in ((texts, "id"), (asked, "q")))
    blocks = max(1, min(-(-n_rows // 4_096), max(64, -(-n_rows // 32_768))))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    keyed = texts.select("id", "s", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    terms = asked.select("overlap", "q", F.explode("query").alias("term")).groupBy("overlap", "q", "term").agg(F.count("*").alias("times"))

    def count(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        vocabulary = wanted["term"].combine_chunks()
        if rows.num_rows:
            for overlap, units in _units(rows.sort_by("id"), vocabulary, size, overlaps):
                there = np.flatnonzero(units.df)
                at = -1 if overlap is None else overlap
                out.append((np.full(len(there) + 1, at, np.int32), pa.concat_arrays([vocabulary.take(pa.array(there)), pa.nulls(1, vocabulary.type)]), np.append(units.df[there], units.n).astype(np.int64)))
        names = ["overlap", "term", "n"]
        kinds = pa.schema([("overlap", pa.int32()), ("term", vocabulary.type), ("n", pa.int64())])
        return pa.concat_tables([kinds.empty_table(), *(pa.table([pa.array(a), t, pa.array(n)], names=names) for a, t, n in out)])

    def find(rows: pa.Table, queries: pa.Table) -> pa.Table:
        lists = queries["terms"].combine_chunks()
        flat = lists.flatten()
        names, weight = flat.field("term").dictionary_encode(), flat.field("w").to_numpy()
        code, bounds = names.indices.to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
        overlap_of = queries["overlap"].to_numpy()
        rows = rows.sort_by("id") if rows.num_rows else rows
        q, row, chunk, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        for overlap, units in _units(rows, names.dictionary, size, overlaps) if rows.num_rows and queries.num_rows else ():
            for i in range(len(overlap_of)) if overlap is None else np.flatnonzero(overlap_of == overlap):
                part = slice(bounds[i], bounds[i + 1])
                at, sums = units.best(code[part], weight[part], k)
                q.append(np.full(len(at), i))
                row.append(units.row[at])
                chunk.append(units.chunk[at])
                score.append(sums)
        of = pa.array(np.concatenate(q))
        found = [queries["overlap"].take(of), queries["q"].take(of), rows["id"].take(pa.array(np.concatenate(row))), pa.array(np.concatenate(chunk).astype(np.int32)), pa.array(np.concatenate(score))]
        return pa.table(found, names=["overlap", "q", "id", "chunk", "score"])

    wanted = terms.select("term").distinct().select("term", every)
    counted = keyed.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(count, "overlap int, term string, n bigint")
    # The generator keeps the filters on terms above the counting, which then runs once for both.
    summed = with_once(counted.groupBy("overlap", "term").agg(F.sum("n").alias("n")), "term", F.col("term"))
    spread = F.explode(F.when(F.col("overlap") == -1, F.array(*map(F.lit, overlaps))).otherwise(F.array("overlap"))).alias("overlap")
    summed = summed.select("term", "n", spread).groupBy("overlap", "term").agg(F.sum("n").alias("n"))
    summed = with_once(summed, "term", F.col("term"))
    units = summed.where("term is null").select("overlap", F.col("n").alias("units"))
    df = summed.where("term is not null")
    df = df.join(F.broadcast(units), "overlap") if n_units is None else df.withColumn("units", F.lit(n_units))  # a row for each overlap
    idf = df.select("overlap", "term", (F.ln((F.col("units") + 1) / (F.col("n") + 1)) + 1).alias("idf"))
    weighted = terms.join(idf, ["overlap", "term"]).groupBy("overlap", "q").agg(F.array_sort(F.collect_list(F.struct("term", (F.col("times") * F.col("idf")).alias("w")))).alias("terms"))
    found = keyed.groupBy("block").cogroup(weighted.select("overlap", "q", "terms", every).groupBy("block")).applyInArrow(find, f"overlap int, q {q_kind}, id {kind}, chunk int, score double")
    return units, found
