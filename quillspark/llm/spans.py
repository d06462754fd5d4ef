"""Long exact spans shared between records (problem 3).

* ``shared_pairs``, by the method named: spans slide over the sentences of each text, each being the shortest run of whole
  sentences from one on that has ``least`` characters. Spans are hashed, the hashes meet in one global shuffle, and around
  each meeting the characters are compared exactly. A sentence of ``min_chars`` or more can hold a whole passage between its
  ends, so it is cut further: the spans inside it are the windows that winnowing selects. What is not found is a passage of
  ``min_chars`` whose whole sentences, less those at its two ends that it only touches, have under ``least`` characters.
* ``sentence_share`` / ``without_repeats``: runs of a given number of sentences; a sentence covered by a run that another
  record holds too is shared, and those covered by a run that isn't its first occurrence are removed.
* ``shared_share``: how much of each record lies in runs of ``min_chars`` characters that others hold, from winnowed windows
  alone: of every ``min_chars - gram + 1`` consecutive windows one is chosen by its hash, so all texts choose the same one in
  every common run, whatever surrounds it.

Defined results: null keys or texts and texts below ``min_chars`` have no pair and share 0. Rows of one key never form a pair. Rows
with the same key and text count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_once
from .lineage import cut
from .sentences import BLANKS, placed, sentence_pieces, sentence_spans

_MULTIPLIER, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    return x ^ (x >> np.uint64(29))


def window_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` (a power of two) consecutive codes, by doubling: log2(gram) steps over the array."""
    h, width, factor = _mixed(codes.astype(np.uint64) * _MULTIPLIER + np.uint64(1)), 1, np.full(1, _MULTIPLIER)
    while width < gram:
        h = h[:-width] * factor + h[width:]
        factor, width = factor * factor, width * 2
    return _mixed(h)


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive codes, from the two windows of a power of two that cover it."""
    half = 1 << (length.bit_length() - 1)
    h = window_hashes(codes, half)
    return h if half == length else _mixed(h[: half - length] * _MULTIPLIER + h[length - half :])


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every ``n`` consecutive values."""
    width = 1
    while width * 2 <= n:
        h, width = np.minimum(h[:-width], h[width:]), width * 2
    return np.minimum(h[: len(h) - (n - width)], h[n - width :]) if width < n else h


def winnowed(codes: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows of ``gram`` codes that winnowing selects: one in every ``span`` codes at least."""
    if len(codes) < span:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = window_hashes(codes, gram)
    n = span - gram + 1
    least = _least(h, n)
    # least[i] is the minimum of h[i : i + n]; every position that has it is chosen, so ties are chosen alike in both texts
    chosen = np.zeros(len(h), bool)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.r_[starts[1:], len(least)]
    for s, e in zip(starts, ends):  # one step per change of the minimum, about one in n / 2 positions
        block = h[s : e + n - 1]
        chosen[s + np.flatnonzero(block == least[s])] = True
    at = np.flatnonzero(chosen)
    if len(at) > 4:
        # A text that repeats itself within a window (rulers, blank runs) has one hash at equal steps; windows that overlap
        # and are equal make the stretch periodic, so its first two and last two positions find what all of them would.
        step = np.diff(at)
        same = (h[at][1:] == h[at][:-1]) & (step < gram)
        inner = np.zeros(len(at), bool)
        inner[1:-1] = same[:-1] & same[1:] & (step[:-1] == step[1:])
        deep = inner.copy()
        deep[1:-1] &= inner[:-2] & inner[2:]
        at = at[~deep]
    return at, h[at]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _common_run(a: str, at_a: int, b: str, at_b: int) -> int:
    """Length of the run that two strings share around two positions."""
    left = 0
    most = min(at_a, at_b)
    while left < most and a[at_a - left - 1] == b[at_b - left - 1]:
        left += 1
    right, most = 0, min(len(a) - at_a, len(b) - at_b)
    while right < most and a[at_a + right] == b[at_b + right]:
        right += 1
    return left + right


def _common_runs(a: pd.Series, at_a: pd.Series, b: pd.Series, at_b: pd.Series) -> pd.Series:
    return pd.Series([_common_run(*row) for row in zip(a, at_a, b, at_b)], dtype="int32")


def _span_hash(spans: Column, pieces: Column, i: Column, least: int) -> Column:
    """A hash of the shortest run of whole sentences from the ``i``-th on that has ``least`` characters; null if there is none.
    The next two sentences mostly suffice; no run needs more than ``least`` of them, since each has a character. The run is put
    together from its pieces: cutting it from the text would read the text from its start for each sentence."""
    start = F.get(spans, i)["sent_start"]
    bare = lambda k: F.rtrim(F.get(pieces, k), F.lit(BLANKS))
    reaches = lambda k: F.get(spans, i + k)["sent_end"] - start >= least
    out = F.when(reaches(0), F.xxhash64(bare(i)))
    for k in (1, 2):
        out = out.when(reaches(k), F.xxhash64(F.concat(*(F.get(pieces, i + j) for j in range(k)), bare(i + k))))
    short = F.size(F.filter(F.slice(spans, i + 1, F.lit(least)), lambda u: u["sent_end"] - start < least))
    later = F.when(i + short < F.size(spans), F.xxhash64(F.concat(F.array_join(F.slice(pieces, i + 1, short), ""), bare(i + short))))
    return out.when(i + 3 < F.size(spans), later)


def _class_spans(rows: DataFrame, least: int, min_chars: int) -> DataFrame:
    """(cls, part, keys, long) of each different text of (cls, part, text): the places and hashes of its spans, and the places
    and texts of its sentences of ``min_chars``. Copies of a text are put together before they are shuffled."""
    base = with_once(with_once(rows, "p", sentence_pieces(F.col("text"))).drop("text"), "s", placed(F.col("p")))
    base = with_once(base.withColumn("u", F.col("p")), "u", F.filter(F.transform("p", lambda p: F.ltrim(p, F.lit(BLANKS))), lambda p: p != "")).drop("p")
    every = F.transform("s", lambda u, i: F.struct(u["sent_start"].alias("pos"), _span_hash(F.col("s"), F.col("u"), i, least).alias("hash")))
    keys = F.filter(every, lambda k: k["hash"].isNotNull())
    placed_long = F.filter(F.transform("s", lambda u, i: F.struct(u.alias("at"), i.alias("i"))), lambda x: x["at"]["sent_end"] - x["at"]["sent_start"] >= min_chars)
    long = F.transform(placed_long, lambda x: F.struct(x["at"]["sent_start"].alias("pos"), F.rtrim(F.get("u", x["i"]), F.lit(BLANKS)).alias("text")))
    found = base.select("cls", "part", F.struct(keys.alias("keys"), long.alias("long")).alias("f"))
    return found.groupBy("cls", "part").agg(F.first("f").alias("f")).select("cls", "part", "f.keys", "f.long")


def _windows_within(rows: DataFrame, gram: int, span: int) -> DataFrame:
    """(cls, tag, hash) of the selected windows of stretches of text (cls, part, pos, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [winnowed(_codes(text), gram, span) for text in batch["text"]]
            n = [len(p) for p, _ in found]
            if sum(n):
                tags = [(np.int64(part) << np.int64(32)) | (at.astype(np.int64) + pos) for part, pos, (at, _) in zip(batch["part"], batch["pos"], found)]
                yield pd.DataFrame({"cls": batch["cls"].repeat(n), "tag": np.concatenate(tags), "hash": np.concatenate([h for _, h in found]).view(np.int64)})

    return rows.mapInPandas(run, "cls bigint, tag bigint, hash bigint")


def shared_pairs(df: DataFrame, key_col: str = "chunk_id", text_col: str = "text", min_chars: int = 200, gram: int = 64, least: int = 80) -> DataFrame:
    """(a, b), a < b: the pairs of different keys that have a row each with an identical run of ``min_chars`` characters.

    Identical texts are one class, known by 96 bits of hashes of the text: spans are joined and compared for classes, and
    only the pairs of classes are expanded to keys at the end. Texts aren't shuffled for the spans; the self-join on their
    hash is an ordinary sort-merge join of three numbers a row, made from one exchange, whose hot hashes adaptive
    execution splits. Only texts of classes that met are fetched for the comparison.
    """
    if not gram <= least <= min_chars:
        raise ValueError("a span must have at least the characters of a window and at most those of a passage")
    rows = df.where(F.col(key_col).isNotNull() & (F.length(text_col) >= min_chars)).select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    hashed = rows.select("key", F.xxhash64("text").alias("cls"), F.hash("text").alias("part"), "text")
    spans = _class_spans(hashed.select("cls", "part", "text"), least, min_chars)
    tag = F.shiftleft(F.col("part").cast("bigint"), 32).bitwiseOR(F.col("k.pos").cast("bigint"))
    prints = spans.select("cls", "part", F.explode("keys").alias("k")).select("cls", tag.alias("tag"), "k.hash")
    prints = prints.union(_windows_within(spans.select("cls", "part", F.inline("long")), gram, min_chars))
    name = lambda cls, part: F.concat(F.hex(cls), F.lit("-"), F.hex(part.cast("bigint")))
    at = lambda tag: F.col(tag).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    part = lambda tag: F.shiftright(F.col(tag), 32).cast("int")
    # Meetings of one diagonal that start less than gram apart lie in one run, so one in each stretch of gram finds them all.
    meetings = cut(
        prints.alias("x")
        .join(prints.alias("y"), "hash")
        .where(F.struct("x.cls", part("x.tag")) < F.struct("y.cls", part("y.tag")))
        .select(F.col("x.cls").alias("ca"), part("x.tag").alias("da"), at("x.tag").alias("pa"), F.col("y.cls").alias("cb"), part("y.tag").alias("db"), at("y.tag").alias("pb"))
        .groupBy("ca", "da", "cb", "db", (F.col("pa") - F.col("pb")).alias("diagonal"), F.floor(F.col("pa") / gram).alias("stretch"))
        .agg(F.min("pa").alias("pa"))
        .select(name(F.col("ca"), F.col("da")).alias("a"), name(F.col("cb"), F.col("db")).alias("b"), "pa", (F.col("pa") - F.col("diagonal")).cast("int").alias("pb"))
    )
    named = hashed.select(name(F.col("cls"), F.col("part")).alias("cls"), "key", "text")
    need = meetings.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    texts = named.select("cls", "text").join(need, "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text"))
    reach = min_chars - gram
    near = lambda text, p: F.substring(text, F.greatest(p - reach, F.lit(0)) + 1, F.lit(2 * reach + gram) - F.greatest(reach - p, F.lit(0)))
    with_a = meetings.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "pa", "pb", near(F.col("ta"), F.col("pa")).alias("wa"))
    with_b = with_a.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "pa", "pb", "wa", near(F.col("tb"), F.col("pb")).alias("wb"))
    run = F.pandas_udf(_common_runs, "int")("wa", F.least("pa", F.lit(reach)), "wb", F.least("pb", F.lit(reach)))
    pairs = with_b.where(run >= min_chars).select("a", "b").distinct()
    members = cut(named.select("cls", "key").distinct())
    across = pairs.join(members.select(F.col("cls").alias("a"), F.col("key").alias("ka")), "a").join(members.select(F.col("cls").alias("b"), F.col("key").alias("kb")), "b")
    across = across.where("ka <> kb").select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
    # Keys of one class share its whole text; classes of one member have no such pair.
    several = members.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls")
    kin = members.join(several, "cls", "left_semi")
    inside = kin.alias("x").join(kin.alias("y"), "cls").where("x.key < y.key").select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
    return across.union(inside).distinct()


def _window_keys(rows: DataFrame, gram: int, span: int) -> DataFrame:
    """(id, key, hash): the different selected windows of each text (id, key, text)."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(winnowed(_codes(text), gram, span)[1]) for text in batch["text"]]
            n = [len(h) for h in found]
            if sum(n):
                yield pd.DataFrame({"id": batch["id"].repeat(n), "key": batch["key"].repeat(n), "hash": np.concatenate(found).view(np.int64)})

    return rows.mapInPandas(run, f"id {kind}, key bigint, hash bigint")


def _candidate_runs(rows: DataFrame, gram: int, span: int) -> DataFrame:
    """(id, key, pos, hash): the runs of ``span`` characters of each text (id, key, text, marks) whose selected window, the
    one of least hash, is among ``marks``. Two equal runs select the same window, so no run that is shared is left out."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, hashes = [], []
            for text, marks in zip(batch["text"], batch["marks"]):
                codes = _codes(text)
                p = np.flatnonzero(np.isin(_least(window_hashes(codes, gram), span - gram + 1), np.asarray(marks, np.int64).view(np.uint64)))
                at.append(p)
                hashes.append(run_hashes(codes, span)[p])
            n = [len(p) for p in at]
            if sum(n):
                yield pd.DataFrame({"id": batch["id"].repeat(n), "key": batch["key"].repeat(n), "pos": np.concatenate(at).astype(np.int32), "hash": np.concatenate(hashes).view(np.int64)})

    return rows.mapInPandas(run, f"id {kind}, key bigint, pos int, hash bigint")


def _held_elsewhere(rows: DataFrame) -> DataFrame:
    """The rows (id, key, hash, ...) whose hash several keys have, with ``first_id``, the smallest id that has it. The rows
    are shuffled once, for the count of keys and for the join with it."""
    placed = rows.repartition("hash")
    about = placed.groupBy("hash").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.min("id").alias("first_id")).where("low <> high")
    return placed.join(about.select("hash", "first_id"), "hash")


def _covered_by(positions: Column, width: int) -> Column:
    """Characters covered by runs of ``width`` characters that start at ``positions``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, p: F.struct((p + width).alias("end"), (acc["n"] + p + width - F.greatest(acc["end"], p)).alias("n"))
    return F.aggregate(F.array_sort(positions), zero, step, lambda acc: acc["n"])


def shared_share(df: DataFrame, id_col: str = "row_id", key_col: str = "chunk_id", text_col: str = "text", min_chars: int = 200, gram: int = 64) -> DataFrame:
    """(id, n_chars, shared_chars, shared_share, repeated_chars): how much of each record lies in runs of ``min_chars``
    characters that records of another key hold too, and how much in runs whose first occurrence is elsewhere (smallest id).

    These are the runs of ``shared_pairs``, but no pairs are made: a run is counted by its hash, so a passage that many
    records hold costs what any other does. Only runs around a window that several keys have are hashed.
    """
    rows = df.where(F.col(key_col).isNotNull() & (F.length(text_col) >= min_chars)).select(F.col(id_col).alias("id"), F.xxhash64(F.col(key_col)).alias("key"), F.col(text_col).alias("text"))
    marks = _held_elsewhere(_window_keys(rows, gram, min_chars)).groupBy("id").agg(F.collect_set("hash").alias("marks"))
    hit = _held_elsewhere(_candidate_runs(rows.join(marks, "id"), gram, min_chars))
    per = hit.groupBy("id").agg(
        _covered_by(F.collect_set("pos"), min_chars).alias("shared_chars"), _covered_by(F.collect_set(F.when(F.col("id") != F.col("first_id"), F.col("pos"))), min_chars).alias("repeated_chars")
    )
    keys = df.select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), F.length(text_col).alias("n_chars"))
    return _shares(keys.join(per, "id", "left"), id_col, key_col)


def _shares(out: DataFrame, id_col: str, key_col: str) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select(
        F.col("id").alias(id_col), F.col("key").alias(key_col), zero("n_chars"), zero("shared_chars"),
        F.coalesce(F.col("shared_chars") / F.col("n_chars"), F.lit(0.0)).alias("shared_share"), zero("repeated_chars"),
    )


def sentence_runs(df: DataFrame, id_col: str, key_col: str, text_col: str, run: int = 3) -> DataFrame:
    """(id, key, start, stop, hash): every run of ``run`` consecutive sentences. A sentence is hashed once, with its white space
    unified, and a run by the hashes of its sentences."""
    base = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    base = with_once(base, "s", sentence_spans(F.col("text"))).where(F.size("s") >= run)
    whole = lambda u: F.xxhash64(F.regexp_replace(F.substring(F.col("text"), u["sent_start"] + 1, u["sent_end"] - u["sent_start"]), r"\s+", " "))
    hashed = with_once(base.withColumn("h", F.col("s")), "h", F.transform("h", whole)).drop("text")
    runs = hashed.select("id", "key", "s", "h", F.explode(F.sequence(F.lit(1), F.size("s") - run + 1)).alias("first"))
    last = F.col("first") + run - 1
    return runs.select(
        "id", "key", F.element_at("s", F.col("first"))["sent_start"].alias("start"), F.element_at("s", last)["sent_end"].alias("stop"), F.xxhash64(F.slice("h", F.col("first"), F.lit(run))).alias("hash")
    )


def _covered(runs: DataFrame) -> Column:
    """Characters covered by the runs of one record, from their (start, stop) in order."""
    ordered = F.array_sort(F.collect_set(F.struct("start", "stop")))
    zero = F.struct(F.lit(0).cast("int").alias("end"), F.lit(0).cast("int").alias("n"))
    return F.aggregate(
        ordered,
        zero,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["stop"]).cast("int").alias("end"),
            (acc["n"] + F.greatest(x["stop"] - F.greatest(acc["end"], x["start"]), F.lit(0))).cast("int").alias("n"),
        ),
        lambda acc: acc["n"],
    )


def _sentence_hits(df: DataFrame, id_col: str, key_col: str, text_col: str, run: int) -> DataFrame:
    """The runs of sentences that several keys hold, with ``first_id``, the smallest id that has it."""
    known = cut(sentence_runs(df, id_col, key_col, text_col, run))  # narrow, and read twice
    about = known.groupBy("hash").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.min("id").alias("first_id")).where("low <> high")
    return cut(known.join(about.select("hash", "first_id"), "hash"))


def sentence_share(df: DataFrame, id_col: str = "row_id", key_col: str = "chunk_id", text_col: str = "text", run: int = 3) -> DataFrame:
    """(id, n_chars, shared_chars, shared_share, repeated_chars): how much of each record lies in runs of sentences that
    records of another key hold too, and how much in runs whose first occurrence is elsewhere (smallest id)."""
    hit = _sentence_hits(df, id_col, key_col, text_col, run)
    keys = df.select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), F.length(text_col).alias("n_chars"))
    per = hit.groupBy("id").agg(_covered(hit).alias("shared_chars"))
    again = hit.where("id <> first_id")
    rep = again.groupBy("id").agg(_covered(again).alias("repeated_chars"))
    return _shares(keys.join(per, "id", "left").join(rep, "id", "left"), id_col, key_col)


def without_repeats(df: DataFrame, id_col: str = "row_id", key_col: str = "chunk_id", text_col: str = "text", run: int = 3) -> DataFrame:
    """(id, text, dropped): every text less the sentences of runs whose first occurrence is elsewhere, and their number.

    Other texts stay as they are. Between two sentences that remain stands the first line break that stood anywhere
    between them, else the first space.
    """
    again = _sentence_hits(df, id_col, key_col, text_col, run).where("id <> first_id")
    gone = again.groupBy("id").agg(F.collect_set(F.struct("start", "stop")).alias("gone"))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(gone, "id", "left")
    rows = with_once(rows, "s", F.when(F.col("gone").isNotNull(), sentence_spans(F.col("text"))))
    text, empty = F.col("text"), F.lit("")
    zero = F.struct(F.lit(0).alias("end"), empty.alias("sep"), empty.alias("out"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["end"] + 1, x["sent_start"] - acc["end"])
        sep = F.when((acc["sep"] == "") | (F.contains(gap, F.lit("\n")) & ~F.contains(acc["sep"], F.lit("\n"))), gap).otherwise(acc["sep"])
        inside = F.exists("gone", lambda g: (g["start"] <= x["sent_start"]) & (g["stop"] >= x["sent_end"]))
        whole = F.concat(acc["out"], F.when(acc["out"] == "", empty).otherwise(sep), F.substring(text, x["sent_start"] + 1, x["sent_end"] - x["sent_start"]))
        return F.struct(
            x["sent_end"].alias("end"), F.when(inside, sep).otherwise(empty).alias("sep"), F.when(inside, acc["out"]).otherwise(whole).alias("out"), (acc["n"] + inside.cast("int")).alias("n")
        )

    left = with_once(rows, "left", F.when(F.col("gone").isNotNull(), F.aggregate("s", zero, step)))
    return left.select(F.col("id").alias(id_col), F.when(F.col("gone").isNull(), text).otherwise(F.col("left.out")).alias(text_col), F.coalesce("left.n", F.lit(0)).alias("dropped"))
