"""Splitting oversized items at natural boundaries (problem 4).

Method: a hierarchy of separators - section, paragraph, list item, sentence, word, character. Pieces are packed greedily:
each ends at the last boundary within the limit of the highest level that still leaves it a fair part of new text, and
the next begins with the last ``overlap`` characters, moved to the word at which they start.

Only oversized rows reach Python; boundaries of sentences come from the sentence operator, as a column.

Defined results: null, empty and fitting texts have no piece here. Blank stretches belong to pieces like any text, so the
pieces of a row always cover all of it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sentences import sentence_spans

_PARAGRAPH = re.compile(r"\n[ \t]*\n\s*")
_SECTION = re.compile(r"\n[ \t]*\n\s*(?=#{1,6} |(?:Chapter|Part|Section|Kapitel|Capítulo|Chapitre|Глава|Κεφάλαιο) |\d+(?:\.\d+)+ |第.{1,6}[章节節部])")
_ITEM = re.compile(r"\n(?=[ \t]*(?:[•‣◦▪●○*\-]|\d{1,3}[.)])[ \t])")
_WORD = re.compile(r"\s+")


def split_points(text: str, sentence_ends: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text. A level counts if the piece gets at least a quarter of the limit of new text."""
    ends = lambda pattern: [m.end() for m in pattern.finditer(text)]
    levels = [ends(_SECTION), ends(_PARAGRAPH), ends(_ITEM), [int(x) for x in sentence_ends]]
    words = [m.end() for m in _WORD.finditer(text)]
    levels.append(words)
    n, out, start, done = len(text), [], 0, 0
    while True:
        if n - start <= limit:
            out.append((start, n))
            return out
        stop, least = start + limit, done + limit // 4
        end = 0
        for level in levels:
            k = bisect_right(level, stop) - 1
            if k >= 0 and level[k] >= least:
                end = level[k]
                break
        end = end or stop
        out.append((start, end))
        done = end
        back = max(end - overlap, start + 1)
        k = bisect_right(words, back) - 1  # the word at which the stretch starts
        word = words[k] if k >= 0 else 0
        start = word if back - word <= 64 and word > start else back


def pieces(df: DataFrame, id_col: str = "row_id", text_col: str = "text", limit: int = 8000, overlap: int = 200) -> DataFrame:
    """(id, piece, piece_start, piece_end, piece_text) of every row with more than ``limit`` characters."""
    if not 0 <= overlap < limit // 4:
        raise ValueError("the overlap must be below a quarter of the limit")
    kind = df.schema[id_col].dataType.simpleString()
    large = df.where(F.length(text_col) > limit).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    large = large.withColumn("ends", F.transform(sentence_spans(F.col("text")), lambda s: s["sent_end"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text, ends in zip(batch["id"], batch["text"], batch["ends"]):
                cut = split_points(text, np.asarray(ends), limit, overlap)
                yield pd.DataFrame({"id": key, "piece": range(len(cut)), "piece_start": [a for a, _ in cut], "piece_end": [b for _, b in cut], "piece_text": [text[a:b] for a, b in cut]})

    made = large.mapInPandas(run, f"id {kind}, piece int, piece_start int, piece_end int, piece_text string")
    return made.withColumnRenamed("id", id_col)
