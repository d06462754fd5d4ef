"""Evaluation texts leaking into a corpus (problem 6).

Texts are compared by their letters and digits, in the same-look form, without case. Method: a prefix-filtered set join.
Each window of ``min_chars`` letters of an item is the set of its shingles; exact containment needs all of them, so one,
the rarest in the corpus, is the necessary prefix of the window, and a window with a shingle that the corpus lacks is
dropped unjoined. Documents join on the prefix shingles only; positions bound where the window must lie, and the window is
compared with the document character by character.

The shingles of a document are tested where the document is, against a table of bits of the items' shingles, which has one
fixed size however many items there are. Only stretches of marked shingles long enough for a window leave the task. With more
items more bits are set and a little more passes; the join and the comparison behind it are the same.

Defined results: null ids, null texts and texts with fewer than ``min_chars`` letters have no pair; repeated rows give one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import with_once
from .confusables import same_look
from .lineage import cut
from .spans import _codes, window_hashes

GRAM = 32
#: The table of bits has 2 ** BITS of them, 16 MB: at a hundred million shingles half of them are set, and a stretch of 49 that
#: are set by chance is still out of the question.
BITS = 27
# Lower-case letters whose capitals have the shape of a Latin capital, and that letter; fixed values. n and v are one
# letter here, since the Greek letter that looks like v is the small form of the one that looks like N.
SMALL_OF_SAME_SHAPE = ("квнмтαβεζηικμνρτυχςn", "kbhmtabezhikmvptyxσv")


def _letters(form: Column) -> Column:
    low = F.lower(form)
    # Of the mapping, ASCII texts need the last pair only, and a replacement is faster than a look-up for each character.
    ascii_only = F.octet_length(form) == F.length(form)
    other = F.translate(F.replace(low, F.lit("ß"), F.lit("ss")), *SMALL_OF_SAME_SHAPE)
    return F.when(ascii_only, F.regexp_replace(F.replace(low, F.lit("n"), F.lit("v")), "[^a-z0-9]+", "")).otherwise(F.regexp_replace(other, r"[^\p{L}\p{N}]+", ""))


def comparable(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, letters): what the comparison sees of each text."""
    base = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_once(same_look(base).select("id", "form"), "letters", _letters(F.col("form"))).drop("form")


def _shingles(df: DataFrame, min_chars: int) -> DataFrame:
    """(id, pos, hash): all shingles of each text."""
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["id"], batch["letters"]):
                h = window_hashes(_codes(text), GRAM).view(np.int64)
                yield pd.DataFrame({"id": key, "pos": np.arange(len(h), dtype=np.int32), "hash": h})

    return df.where(F.length("letters") >= min_chars).mapInPandas(run, f"id {kind}, pos int, hash bigint")


def _bit_table(shingles: DataFrame) -> np.ndarray:
    """The items' shingles as bits, by the first BITS of their hashes; words are put together before they go to the driver, at
    most 2 ** (BITS - 6) of them."""
    bit = F.shiftrightunsigned("hash", 64 - BITS)
    word = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words = shingles.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(word).alias("bits")).toPandas()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def _probed(df: DataFrame, table: np.ndarray, min_chars: int) -> DataFrame:
    """(id, pos, hash): the shingles of each text that are marked in the table, in stretches long enough for a window."""
    kind = df.schema["id"].dataType.simpleString()
    least = min_chars - GRAM + 1
    sent = df.sparkSession.sparkContext.broadcast(table.view(np.uint8))
    to_bit, low = np.uint64(64 - BITS), np.uint64(7)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = sent.value
        for batch in batches:
            ids, at, hashes = [], [], []
            for key, text in zip(batch["id"], batch["letters"]):
                h = window_hashes(_codes(text), GRAM)
                bit = h >> to_bit
                maybe = np.flatnonzero((marks[bit >> np.uint64(3)] >> (bit & low).astype(np.uint8)) & np.uint8(1))
                if len(maybe) < least:
                    continue
                stretch = np.cumsum(np.r_[True, np.diff(maybe) != 1]) - 1
                maybe = maybe[np.bincount(stretch)[stretch] >= least]
                ids.extend([key] * len(maybe))
                at.append(maybe)
                hashes.append(h[maybe].view(np.int64))
            if ids:
                yield pd.DataFrame({"id": ids, "pos": np.concatenate(at).astype(np.int32), "hash": np.concatenate(hashes)})

    return df.where(F.length("letters") >= min_chars).mapInPandas(run, f"id {kind}, pos int, hash bigint")


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", min_chars: int = 80) -> DataFrame:
    """(doc_id, item_id): the documents and items that share a run of ``min_chars`` letters and digits."""
    corpus, tests = comparable(docs, doc_id, text_col), cut(comparable(items, item_id, text_col))
    shingles = cut(_shingles(tests, min_chars))
    hits = cut(_probed(corpus, _bit_table(shingles), min_chars))
    rarity = hits.groupBy("hash").agg(F.count("*").alias("df"))
    ranked = shingles.join(rarity, "hash", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    ahead = Window.partitionBy("id").orderBy("pos").rowsBetween(0, min_chars - GRAM)
    windows = ranked.select("id", "pos", F.min(F.struct("df", "hash", "pos")).over(ahead).alias("rare"), F.count("*").over(ahead).alias("n"))
    windows = windows.where((F.col("n") == min_chars - GRAM + 1) & (F.col("rare.df") > 0))
    prefix = windows.select(F.col("id").alias("item"), F.col("pos").alias("start"), F.col("rare.hash").alias("hash"), (F.col("rare.pos") - F.col("pos")).alias("offset"))
    meet = cut(hits.select(F.col("id").alias("doc"), F.col("pos").alias("at"), "hash").join(prefix, "hash"))
    # Cut, for else the filters of the form are pushed below this join and run over the whole corpus again.
    met_docs = cut(docs.select(doc_id, text_col).join(meet.select(F.col("doc").alias(doc_id)).distinct(), doc_id, "left_semi"))
    texts = comparable(met_docs, doc_id, text_col).select(F.col("id").alias("doc"), F.col("letters").alias("dl"))
    probes = tests.select(F.col("id").alias("item"), F.col("letters").alias("il"))
    return _exact_windows(meet, texts, probes, min_chars).select(F.col("doc").alias(doc_id), F.col("item").alias(item_id))


def _exact_windows(meet: DataFrame, texts: DataFrame, probes: DataFrame, min_chars: int) -> DataFrame:
    """(doc, item) of the meetings whose window, which must begin at ``at - offset`` in the document, is there in full."""
    both = meet.where(F.col("at") >= F.col("offset")).join(probes, "item").select("doc", "item", (F.col("at") - F.col("offset")).alias("at"), F.substring("il", F.col("start") + 1, F.lit(min_chars)).alias("w"))
    side = both.distinct().join(texts, "doc")
    return side.where(F.substring("dl", F.col("at") + 1, F.lit(min_chars)) == F.col("w")).select("doc", "item").distinct()
