"""Scores of texts as Columns: quality from 0 to 1, readability, and cutting to a size. Null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, words


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _score(issues: Column, of: Column) -> Column:
    """1 less the share of issues, from 0 to 1; 0 where there is nothing to judge."""
    return F.when(of == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), 1.0 - F.least(issues / of, F.lit(1.0))), 6))


def usable(text: Column) -> Column:
    return F.when(strip(text) != "", 1.0).otherwise(0.0)


def sentence_integrity(text: Column) -> Column:
    """1 less the faults of sentences (fewer than three words, a small first letter, a hyphen at the end) by sentence."""
    parts = F.filter(F.transform(F.split(text, r"[.!?]+"), strip), lambda s: s != "")
    fault = lambda s: (F.size(words(s)) < 3).cast("int") + s.rlike(r"^\p{Ll}").cast("int") + s.endswith("-").cast("int")
    total = F.aggregate(F.transform(parts, fault), F.lit(0), lambda a, b: a + b)
    return _score(total.cast("double"), F.size(parts))


def whitespace_quality(text: Column) -> Column:
    """Faults of white space in a thousand characters, taken from 1."""
    trailing = F.size(F.filter(F.split(text, "\n"), lambda line: F.right(line, F.lit(1)).isin(" ", "\t")))
    mixed = (F.contains(text, F.lit("\t")) & F.contains(text, F.lit("  "))).cast("int")
    issues = _count(text, r"\n{3,}") + _count(text, "[.!?][a-zA-Z]") + _count(text, " {3,}") + trailing + mixed
    return _score(1000.0 * issues, F.length(text))


def ligature_quality(text: Column) -> Column:
    """Ligatures left in a thousand characters, taken from 1; the common ones count twice."""
    return _score(1000.0 * (_count(text, r"[\x{FB00}-\x{FB4F}]") + _count(text, "[ﬀﬁﬂﬃﬄﬅﬆ﬈ﬗﬞ]")), F.length(text))


#: Signs of joined or broken words, case ignored; fixed values.
JOINING = (r"\b[a-z]+[A-Z][a-z]+\b", r"\b\w{1,2}\s+\w{1,2}\s+\w{1,2}\b", r"\b[a-z]+-\s*\n\s*[a-z]+\b", r"\b\w+\s+\w+(?=\w)", r"\b[a-z]+[0-9]+[a-z]+\b")


def word_joining(text: Column) -> Column:
    """Signs of joined or broken words by word, taken from 1. Case is ignored in the signs too, as in the scores to match, so most
    words count as joined and ordinary prose scores 0."""
    hits = F.lit(0)
    for pattern in JOINING:
        hits = hits + _count(text, "(?iU)" + pattern)
    return _score(hits.cast("double"), F.size(words(text)))


def flesch_kincaid(text: Column) -> Column:
    """The Flesch-Kincaid grade, a syllable being a run of vowels and a word having one at least."""
    n, sentences = _count(text, "[A-Za-z]+"), F.greatest(_count(text, "[.!?]+"), F.lit(1))
    syllables = F.greatest(_count(text, "(?i)[aeiouy]+"), n)
    return F.when(n == 0, 0.0).otherwise(F.round(0.39 * n / sentences + 11.8 * syllables / n - 15.59, 3))


def difficulty(grade: Column) -> Column:
    return F.when(grade <= 6, "elementary").when(grade <= 8, "middle_school").when(grade <= 12, "high_school").when(grade <= 16, "college_level").otherwise("graduate_level")


def truncate_chunk(text: Column, limit: int = 8000) -> Column:
    """At most ``limit`` less 100 characters of a text above the limit: cut behind the last sentence, else before the last blank line,
    if that keeps more than 70 % of them, else at the last space if that keeps more than 80 %, else right there."""
    room = limit - 100
    head = F.left(text, F.lit(room))
    place = lambda sep: F.when(F.contains(head, F.lit(sep)), F.length(head) - F.length(F.substring_index(head, sep, -1)) - len(sep)).otherwise(-1)
    sentence = F.greatest(*(place(mark + gap) for mark in ".!?" for gap in " \n"))
    paragraph, word = place("\n\n"), place(" ")
    end = F.when(sentence > 0.7 * room, sentence + 1).when(paragraph > 0.7 * room, paragraph).when(word > 0.8 * room, word).otherwise(room)
    return F.when(F.length(text) <= limit, text).otherwise(strip(F.left(text, end.cast("int"))))


def split_short(text: Column) -> Column:
    """ARRAY<STRING>: two halves, parted at the paragraph, line or space nearest before the middle, else after it."""
    mid = F.floor(F.length(text) / 2).cast("int")
    head = F.left(text, mid)
    out = F.array(strip(text))
    for sep in (" ", "\n", "\n\n"):
        before = F.length(head) - F.length(F.substring_index(head, sep, -1)) - len(sep)
        after = F.instr(F.substring(text, mid + 1, F.length(text)), sep) - 1
        at = F.when(F.contains(head, F.lit(sep)), before).when(after >= 0, mid + after)
        rest = strip(F.substring(text, at + 1 + len(sep), F.length(text)))
        out = F.when(at.isNotNull(), F.array_compact(F.array(strip(F.left(text, at)), F.when(rest != "", rest)))).otherwise(out)
    return out
