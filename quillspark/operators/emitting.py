"""Rows for output: pieces within a size, overlaps trimmed, fragments put to what they belong to.

Here the text that was built decides about the next one, so these are folds over the ordered texts of one document, in Python, one
document to a row through Arrow; texts of different documents never meet. Null and blank texts give no row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ITEM = re.compile(r"\s*(?:[*•◦▪‣·●◉○‧]|- |\d+[.)])")
_ENDED = re.compile(r"[.!?][\"')\]}]*\s*$")
_STARTS_WHOLE = re.compile(r"[\"'(]*[A-Z0-9]")
_CAPTION = re.compile(r"(?:figure|fig\.|table|tbl\.|image|img\.|diagram)\s+[\w.-]*\d[\w.-]*$", re.IGNORECASE)


def ends_sentence(text: str) -> bool:
    return bool(_ENDED.search(text))


def starts_mid_sentence(text: str) -> bool:
    return bool(text.strip()) and not _STARTS_WHOLE.match(text.strip())


def coherent(text: str, least: int = 40) -> bool:
    return len(text.strip()) >= least and not starts_mid_sentence(text) and ends_sentence(text)


def shared_edge(before: str, after: str) -> int:
    """Length of the longest end of ``before`` that begins ``after``, in linear time: the border of one string behind the other."""
    tail = before[-len(after) :] if after else ""
    joined = [*after, None, *tail]
    border = [0] * len(joined)
    k = 0
    for i in range(1, len(joined)):
        while k and joined[i] != joined[k]:
            k = border[k - 1]
        k += joined[i] == joined[k]
        border[i] = k
    return border[-1] if tail else 0


def trim_overlap(before: str, after: str) -> str:
    """``after`` without what ``before`` ends with, or without its first paragraph if that stands in ``before``; empty if all of it does.
    Labels of captions, parts of words and a name that goes on in small letters stay, as does an overlap of nine tenths."""
    a, b = before.lower(), after.lower()
    if b and b in a:
        return ""
    n = shared_edge(a, b)
    if 0 < n < 0.9 * len(after):
        head, rest = after[:n].strip(), after[n:]
        joined_word = n < len(before) and before[-n - 1].isalnum()
        words, follower = re.findall(r"\w+", head), rest.lstrip()[:1]
        name = len(words) == 1 and words[0].istitle() and (follower.islower() or follower.isdigit())
        return after if joined_word or name or _CAPTION.match(head) else rest.lstrip()
    first = b.split("\n\n", 1)[0]
    return after[len(first) :].lstrip() if first and first in a else after


def cut_point(text: str, limit: int) -> int:
    """Where a text above ``limit`` is cut: behind a sentence, at a blank line or at a space, each if it leaves enough, else at the limit."""
    room = limit - 100
    if room <= 0:
        return limit
    ends = [p + 1 for p in (text.rfind(mark + gap, 0, room) for mark in ".!?" for gap in " \n") if p > 0.7 * room]
    paragraph, word = text.rfind("\n\n", 0, room), text.rfind(" ", 0, room)
    return max(ends) if ends else paragraph if paragraph > 0.7 * room else word if word > 0.8 * room else room


def list_blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the lists of a text, each with the line that leads to it."""
    out, at, open_from, before = [], 0, None, 0
    for line in text.splitlines(keepends=True):
        if _ITEM.match(line):
            open_from = before if open_from is None else open_from
        elif line.strip():
            if open_from is not None:
                out.append((open_from, at))
            open_from, before = None, at
        at += len(line)
    return out + ([(open_from, at)] if open_from is not None else [])


def split_to_limit(text: str, limit: int) -> list[str]:
    """Pieces of at most ``limit`` characters. A list isn't cut, even above the limit: the cut goes before the line that leads to it,
    unless that leaves a piece of under 100 characters, else behind it. Pieces of one text share nothing, so nothing is trimmed from
    them, however much it repeats itself."""
    pieces, rest = [], text.strip()
    while len(rest) > limit:
        at = cut_point(rest, limit)
        for start, end in list_blocks(rest):
            if start < at < end:
                at = start if len(rest[:start].strip()) >= 100 else end
        piece, rest = rest[:at].strip(), rest[at:].strip()
        pieces.append(piece)
    return [p for p in [*pieces, rest] if p]


def give_back_fragments(pieces: list[str], limit: int) -> list[str]:
    """A piece that starts inside a sentence gives its sentences to the piece before, as long as that stays within the limit; what is
    left of it, or all of it if not even one fits, stays a piece."""
    out: list[str] = []
    for piece in pieces:
        while out and piece and starts_mid_sentence(piece):
            end = re.search(r"[.!?][\"')\]}]*(?=\s|$)", piece)
            taken = piece[: end.end()] if end else piece
            if len(out[-1]) + 1 + len(taken) > limit:
                break
            out[-1], piece = f"{out[-1].rstrip()} {taken.strip()}", piece[len(taken) :].lstrip()
        if piece:
            out.append(piece)
    return out


def coalesce(texts: list[str], min_words: int = 50) -> list[str]:
    """Texts less their overlap with the one before, and joined to it where either is short or incoherent. Lists keep their lines."""
    out: list[str] = []
    for text in (t.strip() for t in texts):
        if out and text:
            text = trim_overlap(out[-1], text)
        if not text:
            continue
        n = lambda t: len(re.findall(r"\w+", t))
        if out and (n(out[-1]) < min_words or not coherent(out[-1]) or starts_mid_sentence(text) or (n(text) < min_words and not coherent(text))):
            sep = "\n" if _ITEM.match(text) else " " if starts_mid_sentence(text) else "\n\n"
            out[-1] = f"{out[-1].rstrip()}{sep}{text}"
        else:
            out.append(text)
    return out


def hold_and_merge(texts: list[str], least: int = 30, most: int = 8000, critical: int = 5) -> list[str]:
    """Texts below ``least`` words are held and put before the next one that leaves room, those below ``critical`` in any case; a coherent
    one of half as many words isn't held. What is held at the end goes behind the last."""
    out: list[str] = []
    held = ""
    n = lambda t: len(t.split())
    for text in texts:
        if held and (len(held) + 2 + len(text) <= most or n(held) < critical):
            text, held = f"{held}\n\n{text}", ""
        elif held:
            out.append(held)
            held = ""
        orphan = bool(re.fullmatch(r"\s*(?:[*•◦▪‣·●◉○‧]|-)\s*\S*", text))
        keep = coherent(text) and n(text) >= max(15, least // 2)
        if (n(text) < least or orphan) and not keep and len(text) < most / 2:
            held = text
        else:
            out.append(text)
    if held:
        if out and (len(out[-1]) + 2 + len(held) <= most or n(held) < critical):
            out[-1] = f"{out[-1]}\n\n{held}"
        else:
            out.append(held)
    return out


def fuse_sentences(chunks: list[str], soft: int = 400, hard: int = 480, most_chars: int = 8000) -> list[str]:
    """A chunk that goes on with the sentence of the one before is joined to it, less the words they share: within ``soft`` words freely,
    up to ``hard`` to complete the sentence. Where it doesn't fit, its first sentence alone goes back, if that fits."""
    out: list[str] = []
    for chunk in (c.strip() for c in chunks):
        if not chunk:
            continue
        if out and not ends_sentence(out[-1]):
            words, before = chunk.split(), out[-1].split()
            same = next((k for k in range(min(len(words), len(before), 50), 0, -1) if before[-k:] == words[:k]), 0)
            rest = words[same:]
            goes_on = bool(rest) and (rest[0][:1].islower() or rest[0][:1] in ",.;:)]\"'")
            if not rest:
                continue
            if goes_on:
                n, chars = len(before) + len(rest), len(out[-1]) + 1 + len(" ".join(rest))
                tail = chunk if not same else " ".join(rest)
                if chars <= most_chars and (n <= soft or (n <= hard and ends_sentence(tail))):
                    out[-1] = f"{out[-1]} {tail}"
                    continue
                end = re.search(r"[.!?][\"')\]}]*(?=\s|$)", tail)
                first = tail[: end.end()] if end else ""
                if first and len(out[-1]) + 1 + len(first) <= most_chars and len(before) + len(first.split()) <= hard:
                    out[-1], chunk = f"{out[-1]} {first}", tail[len(first) :].strip()
                    if not chunk:
                        continue
        out.append(chunk)
    return out


def repair_quotes(chunks: list[str]) -> list[str]:
    """A chunk that ends in an opening quote takes the next one in, and so does one with an open quotation the one that closes it first."""
    out: list[str] = []
    for chunk in chunks:
        opens = bool(out) and re.search(r"(?:^|\s)[\"“]\s*$", out[-1]) and re.match(r"\s*[\w“\"']", chunk)
        closes = bool(out) and out[-1].count('"') % 2 == 1 and re.match(r'\s*[^"]{0,20}"', chunk)
        if opens or closes:
            out[-1] = f"{out[-1].rstrip()} {chunk.lstrip()}"
        else:
            out.append(chunk)
    return [re.sub(r'^[\s,.:;]+', "", c) for c in out]


def over_documents(chunks: DataFrame, group: str, order: str, fold: Callable[[list[str]], list[str]]) -> DataFrame:
    """(group, piece, text): a fold over the ordered texts of each group. The arrays are made with partial aggregation, and a group is one
    row of an Arrow batch."""
    kind = chunks.schema[group].dataType.simpleString()
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"])
    per = chunks.where("text is not null").groupBy(group).agg(texts.alias("texts")).select(F.col(group).alias("g"), "texts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [[t for t in fold(list(texts)) if t.strip()] for texts in batch["texts"]]
            n = [len(d) for d in done]
            if sum(n):
                yield pd.DataFrame({"g": batch["g"].repeat(n), "piece": [k for d in done for k in range(len(d))], "text": [t for d in done for t in d]})

    return per.mapInPandas(run, f"g {kind}, piece int, text string").withColumnRenamed("g", group)


def rows_for_output(chunks: DataFrame, id_col: str, limit: int = 8000, overhead: int = 0) -> DataFrame:
    """(id, chunk_part, text): each text in pieces that fit ``limit`` with ``overhead`` characters of metadata, ``chunk_part`` null where one
    piece is all. Sentences begun in a piece before are given back to it."""
    room = max(limit - overhead, 200)

    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: give_back_fragments(split_to_limit(t, room), room), na_action="ignore")

    # One pass: every row meets the function, but a row that fits sends a null there and keeps its text.
    large = F.length("text") > room
    rows = chunks.where("text is not null").select(F.col(id_col).alias("id"), "text").withColumn("cut", F.pandas_udf(cut, "array<string>")(F.when(large, F.col("text"))))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("chunk_part"), F.trim("text", F.lit(" \t\n\r")).alias("text")))
    parts = F.transform("cut", lambda t, i: F.struct(i.cast("int").alias("chunk_part"), t.alias("text")))
    return rows.select(F.col("id").alias(id_col), F.explode(F.when(large, parts).otherwise(whole)).alias("p")).select(id_col, "p.chunk_part", "p.text").where("text <> ''")
