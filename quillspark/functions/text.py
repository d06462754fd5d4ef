"""Cleaning of text as Column expressions. Null stays null everywhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spaces outside ASCII, which patterns don't count as white space; fixed values.
WIDE_SPACES = "\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Separators taken for an ordinary space, and characters without width; fixed values.
NBSP_LIKE = "\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
ZERO_WIDTH = "\u200b\u200c\u200d\u2060\ufeff"
# Curly quotes and the plain ones; fixed values.
CURLY_QUOTES = ("“”„‟«»‘’‚‛", "\"\"\"\"\"\"''''")
# Windows-1252 bytes read as Latin-1; fixed values.
CP1252_QUOTES = ("\x91\x92\x93\x94", "''\"\"")
BULLETS = "*•◦▪‣·●◉○‧"
SUPERSCRIPTS = ("⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789")
# Private-use characters that stand for breaks to keep.
PARAGRAPH, ITEM = "\ue001", "\ue002"
LIST_START = rf"(?:[{BULLETS}]|-\s|\d+[.)])"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it: a chain of such steps stays linear."""
    return F.element_at(F.transform(F.array(value), f), 1)


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row: filters and later columns can't be moved below it.

    Catalyst pushes a filter on a computed column below the projection, and so computes it again; it doesn't push one
    through a generator, which here makes one row of each.
    """
    return df.select(*(c for c in df.columns if c != name), F.explode(F.array(column)).alias(name))


def plain_spaces(text: Column) -> Column:
    """Every kind of white space outside ASCII as a space; same length."""
    return F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))


def words(text: Column) -> Column:
    """The pieces between white space, none of them empty."""
    return F.filter(F.split(plain_spaces(text), r"\s+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def strip(text: Column) -> Column:
    """The text without white space at its ends. No pattern: linear in long blank runs."""
    return F.trim(text, F.lit(" \t\n\r\f" + WIDE_SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\r\f" + WIDE_SPACES))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(" \t\n\r\f" + WIDE_SPACES))


def normalize_nbsp(text: Column) -> Column:
    """Separators like the no-break space become spaces, zero-width characters go, runs of spaces become one."""
    plain = F.translate(text, NBSP_LIKE + ZERO_WIDTH, " " * len(NBSP_LIKE))
    return F.regexp_replace(plain, " {2,}", " ")


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n|\r|\u2028|\u2029", "\n")


def remove_control_characters(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{202C}\x{202D}]", "")


def consolidate_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"[ \t\r\f\x0B]+", " "))


def normalize_quotes(text: Column) -> Column:
    """Curly and misread quotes become plain; a space is set before a quote between a letter and a word; doubled ones are one."""
    plain = F.translate(F.translate(text, *CP1252_QUOTES), *CURLY_QUOTES)
    spaced = F.regexp_replace(plain, r'([A-Za-z])"(?=\w)', '$1 "')
    return F.regexp_replace(F.regexp_replace(spaced, r'"{2,}', '"'), r"'{2,}", "'")


def drop_stray_circumflex(text: Column) -> Column:
    """An accented A that only guards white space becomes a space."""
    return F.regexp_replace(text, r"(^|\s)Â(?=\s)", "$1 ")


def expand_ligatures(text: Column) -> Column:
    """Latin ligatures as their letters."""
    out = text
    for ligature, letters in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return out


def remove_soft_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("\u00ad"), F.lit(""))


def join_hyphenated(text: Column) -> Column:
    """Words divided by a hyphen at a line break, the rest in lower case, are joined."""
    return F.regexp_replace(text, r"([A-Za-z]+)[-\x{2010}\x{2011}][ \t]*\n[ \t]*([a-z]+)", "$1$2")


def collapse_colon_list_breaks(text: Column) -> Column:
    return F.regexp_replace(text, rf":\n{{2,}}([ \t]*(?:[{BULLETS}]|- |\d))", ":\n$1")


def collapse_artifact_breaks(text: Column) -> Column:
    """A line break right behind a full stop or underscore, before a letter, becomes a space."""
    return F.regexp_replace(text, r"([._])\n([\p{L}_])", "$1 $2")


def drop_piped_lines(text: Column) -> Column:
    """Lines with a vertical bar go."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~F.contains(line, F.lit("|"))), "\n")


def replace_pipes(text: Column) -> Column:
    return F.translate(text, "|", ":")


def collapse_single_newlines(text: Column) -> Column:
    """Line breaks inside a paragraph become spaces; paragraph breaks and breaks before list items stay."""
    kept = F.regexp_replace(text, r"\n{2,}", PARAGRAPH)
    kept = F.regexp_replace(kept, rf"\n([ \t]*{LIST_START})", ITEM + "$1")
    return F.replace(F.translate(F.replace(kept, F.lit("\n"), F.lit(" ")), ITEM, "\n"), F.lit(PARAGRAPH), F.lit("\n\n"))


def normalize_inline_footnotes(text: Column) -> Column:
    """``end.12`` becomes ``end[12].``; superscript digits count as digits there."""
    return F.regexp_replace(F.translate(text, *SUPERSCRIPTS), r"(^|[^0-9])\.([0-9]+)(\s|$)", "$1[$2].$3")


def restore_leading_capital(text: Column) -> Column:
    """The first letter of a leading word in lower case is capitalised, behind a list marker too."""

    def capitalised(t: Column) -> Column:
        at = F.length(F.regexp_extract(t, rf"^(\s*(?:(?:[{BULLETS}]|- |\d+[.)])\s*)?)", 1))
        rest = F.substring(t, at + 1, F.length(t))
        word = F.regexp_extract(rest, r"^[^\p{L}]*([A-Za-z]+(?:['’\-][A-Za-z]+)*)", 1)
        gap = F.length(F.regexp_extract(rest, r"^([^\p{L}]*)", 1))
        cap = F.concat(F.left(t, at + gap), F.upper(F.substring(rest, gap + 1, F.lit(1))), F.substring(rest, gap + 2, F.length(t)))
        return F.when((word != "") & (word == F.lower(word)), cap).otherwise(t)

    return let(text, capitalised)


def split_glued_words(text: Column) -> Column:
    """A space where a small letter meets a capital one."""
    return F.regexp_replace(text, r"([a-z])([A-Z])", "$1 $2")


def strip_dot_leaders(text: Column) -> Column:
    """Lines end before their first dot leader; lines that are empty then go."""
    cut = F.transform(F.split(text, "\n"), lambda line: F.when(line.rlike(r"\.\s*\."), rstrip(F.regexp_replace(line, r"\.\s*\..*$", ""))).otherwise(line))
    return F.array_join(F.filter(cut, lambda line: line != ""), "\n")


def remove_underscore_emphasis(text: Column) -> Column:
    """``_word_`` and ``__word__`` become the word; phrases of several words keep their marks."""
    return F.regexp_replace(text, r"(^|[^\p{L}\p{N}_])_{1,2}([A-Za-z0-9]+(?:['’\-][A-Za-z0-9]+)*)_{1,2}(?=[^\p{L}\p{N}_]|$)", "$1$2")


def json_issues(text: Column) -> Column:
    """ARRAY<STRING>: what makes a text awkward as a JSON value."""
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    trimmed = strip(text)
    checks = (
        F.when(text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{202C}\x{202D}]"), F.lit("control_characters")),
        F.when(quotes % 2 != 0, F.lit("unbalanced_quotes")),
        F.when(F.left(trimmed, F.lit(1)).isin('"', ","), F.lit("bad_start")),
        F.when(F.right(trimmed, F.lit(1)).isin('"', ","), F.lit("bad_end")),
    )
    return F.array_compact(F.array(*checks))


def json_safe(text: Column) -> Column:
    """Control characters and a leading ``", `` go, an odd quote at an edge goes, and the ends are trimmed."""
    end = 1 << 30
    odd = lambda t: (F.length(t) - F.length(F.replace(t, F.lit('"'), F.lit("")))) % 2 != 0
    steps = (
        lambda t: F.when(t.startswith('", '), F.substring(t, 4, end)).otherwise(t),
        lambda t: F.when(t.rlike(r'^"[a-z]'), F.substring(t, 2, end)).otherwise(t),
        lambda t: F.when(odd(t) & t.endswith('"'), F.left(t, F.length(t) - 1)).when(odd(t) & t.startswith('"'), F.substring(t, 2, end)).otherwise(t),
    )
    out = remove_control_characters(text)
    for step in steps:
        out = let(out, step)
    return strip(out)


MARKER = rf"(?:[{BULLETS}]|- |\d+[.)])"


def merge_number_suffixes(text: Column) -> Column:
    """A line that begins with a number and full stop goes up behind the line before it, unless that is blank, numbered itself, ended,
    or leads to the number (a colon, the word chapter)."""
    def placed(lines: Column, line: Column, i: Column) -> Column:
        before = strip(F.get(lines, i - 1))
        open_line = (before != "") & ~before.rlike(r"^\d+[.)]") & ~F.right(before, F.lit(1)).isin(":", ".", "!", "?") & ~before.rlike(r"(?i)(?:^|\s)chapter$")
        up = (i > 0) & line.rlike(r"^\d+\.") & F.coalesce(open_line, F.lit(False))
        return F.concat(F.when(i == 0, "").when(up, " ").otherwise("\n"), line)

    return let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(lines, lambda line, i: placed(lines, line, i)), ""))


def drop_number_markers(text: Column) -> Column:
    """Markers of numbered items that stand where none can be: behind a broken word, alone in a line, before capitals, between single
    letters, or at the end of the text; and blank lines before a marker."""
    for pattern, to in (
        (r"-\n\d+[.)]\s*", "-"),
        (r"\n\d+[.)]\n", "\n"),
        (r"\n\d+[.)]\s+(?=[A-Z]{2,}\b)", "\n"),
        (r"(?<=\b[a-z])\s+\d+[.)]\s+(?=[a-z])", " "),
        (r"(?i)\b(?!(?:chapter|section|part|figure|table|appendix)\s)([a-z]+)\s+\d+[.)]['\"’]?(\s*)$", "$1$2"),
        (r"\n{2,}(\d+[.)])", "\n$1"),
    ):
        text = F.regexp_replace(text, pattern, to)
    return text


def fixpoint(text: Column, step: Callable[[Column], Column], rounds: int = 3) -> Column:
    """``step`` applied some times over; once nothing changes, the rest changes nothing."""
    for _ in range(rounds):
        text = step(text)
    return text


def remove_stray_bullets(text: Column) -> Column:
    """Bullets that mark no item: alone in a line, before a small letter in a line that goes on, or inside a line; the markers of lines that
    are an address; and blank lines before items."""
    names = r"[A-Z0-9][\w.'-]*(?:\s+[A-Za-z0-9][\w.'-]*)*"

    def step(t: Column) -> Column:
        for pattern, to in (
            (rf"\n[{BULLETS}]\s*(?=\n|$)", "\n"),
            (rf"(?<![\n:{BULLETS}-])\n(?:[{BULLETS}]|- )\s*(?<=\s)(?=[a-z0-9])", " "),
            (rf"(?<=\S)[ \t](?:[{BULLETS}]|- )\s*(?<=\s)(?=[a-z0-9])", " "),
            (rf"(?im)^([ \t]*)[{BULLETS}]\s*(?=(?:(?:directed|addressed|ship|shipped|sent|consigned) to\s+)?{names},\s*{names},\s*[A-Z][A-Za-z.'-]+$)", "$1"),
            (rf"\n+(?=[ \t]*(?:[{BULLETS}]|- ))", "\n"),
        ):
            t = F.regexp_replace(t, pattern, to)
        return t

    return fixpoint(text, step)


def break_numbered_lists(text: Column) -> Column:
    """Numbered items stand in lines of their own: a break behind a colon and between items of one line, unless a capitalised word
    comes before the number; and a blank line behind an item that ends a sentence."""
    for pattern, to in (
        (r":\s*(?!\n)(\d{1,3}[.)])", ":\n$1"),
        (r"(\d{1,3}[.)][^\n]*?)(?<!(?:^|\s)\p{Lu}\p{Ll}{0,30})[ \t]+(?=\d{1,3}[.)]\s)", "$1\n"),
        (r"(\d{1,3}[.)][^\n]*[.!?…])\n+(?=[^\n])", "$1\n\n"),
    ):
        text = F.regexp_replace(text, pattern, to)
    return text


def join_wrapped_items(text: Column) -> Column:
    """A line behind a list item, without a marker of its own, joins the item."""
    marked = lambda line: line.rlike(rf"^\s*{MARKER}")

    def placed(lines: Column, line: Column, i: Column) -> Column:
        up = (i > 0) & F.coalesce(marked(F.get(lines, i - 1)), F.lit(False)) & (strip(line) != "") & ~marked(line)
        return F.concat(F.when(i == 0, "").when(up, " ").otherwise("\n"), F.when(up, lstrip(line)).otherwise(line))

    return let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(lines, lambda line, i: placed(lines, line, i)), ""))


def merge_paragraphs(text: Column, is_heading: Callable[[Column], Column]) -> Column:
    """Paragraphs that were parted without need become one: a line with a dash goes to what it is said of, a paragraph behind a note
    mark, behind an open quotation, and behind one that is short or has no end. Headings and list items stay."""
    quotes = lambda t, q: F.length(t) - F.length(F.replace(t, F.lit(q), F.lit("")))
    paragraphs = F.filter(F.split(text, r"\n{2,}"), lambda p: strip(p) != "")
    about = F.transform(
        paragraphs,
        lambda p: F.struct(
            p.alias("t"), F.when(F.length(p) <= 120, is_heading(p)).otherwise(False).alias("heading"), strip(F.substring_index(rstrip(p), "\n", -1)).rlike(rf"^{MARKER}").alias("last_item"), lstrip(p).rlike(rf"^{MARKER}").alias("item"),
            lstrip(p).startswith("—").alias("dash"), rstrip(p).rlike(r"\[\d+\][.!?]?$").alias("note"), rstrip(p).rlike(r"[.?!]$").alias("ended"),
            quotes(p, '"').alias("double"), quotes(p, "'").alias("single"), F.length(p).alias("n"),
        ),
    )
    odd = lambda x: (x["double"] % 2 != 0) | (x["single"] % 2 != 0)
    numbers = "starts array<int>, i int, heading boolean, last_item boolean, note boolean, ended boolean, double int, single int, n int"
    zero = F.from_json(F.lit('{"starts": [], "i": 0, "heading": false, "last_item": false, "note": false, "ended": false, "double": 0, "single": 0, "n": 0}'), numbers)

    def step(acc: Column, x: Column) -> Column:
        plain = ~acc["heading"] & ~x["heading"]
        closes = odd(acc) & ((acc["double"] + x["double"]) % 2 == 0) & ((acc["single"] + x["single"]) % 2 == 0)
        joined = (acc["i"] > 0) & (x["dash"] | (acc["note"] & ~x["item"]) | (~acc["last_item"] & plain & (closes | (acc["n"] < 60) | ~acc["ended"])))
        both = lambda name: F.when(joined, acc[name] + x[name]).otherwise(x[name])
        return F.struct(
            F.when(joined, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["i"]))).alias("starts"), (acc["i"] + 1).alias("i"),
            F.when(joined, False).otherwise(x["heading"]).alias("heading"), x["last_item"].alias("last_item"), x["note"].alias("note"), x["ended"].alias("ended"),
            both("double").alias("double"), both("single").alias("single"), F.when(joined, acc["n"] + x["n"] + 1).otherwise(x["n"]).alias("n"),
        )

    def assembled(xs: Column) -> Column:
        starts = F.aggregate(xs, zero, step, lambda acc: acc["starts"])
        return F.array_join(F.transform(xs, lambda x, i: F.concat(F.when(i == 0, "").when(F.array_contains(starts, i), "\n\n").otherwise(" "), F.when(F.array_contains(starts, i), rstrip(x["t"])).otherwise(strip(x["t"])))), "")

    return let(about, assembled)


def strip_superscripts(text: Column, styles: Column) -> Column:
    """STRUCT<text, notes>: superscript spans with nothing but closing marks behind them become notes and leave the text."""
    tail = lambda s: strip(F.substring(text, s["end"] + 1, F.length(text)))
    at_end = F.filter(styles, lambda s: (s["style"] == "superscript") & (s["start"] >= 0) & (s["end"] > s["start"]) & (s["end"] <= F.length(text)) & (F.translate(tail(s), ".,;:!?)]\"'", "") == ""))
    spans = F.array_sort(F.transform(at_end, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    notes = F.filter(F.transform(spans, lambda s: strip(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), lambda n: n != "")
    first = F.get(spans, F.lit(0))
    cut = F.when(F.size(spans) > 0, F.concat(F.left(text, first["start"]), F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text)))).otherwise(text)
    return F.struct(cut.alias("text"), F.coalesce(notes, F.array().cast("array<string>")).alias("notes"))


def clean_paragraph(text: Column) -> Column:
    """The steps for one paragraph, in order."""
    for step in (
        remove_underscore_emphasis, join_hyphenated, remove_soft_hyphens, drop_piped_lines, replace_pipes, collapse_artifact_breaks, remove_stray_bullets,
        remove_control_characters, expand_ligatures, normalize_quotes, normalize_inline_footnotes, consolidate_whitespace,
    ):
        text = step(text)
    return text


def clean_text(text: Column) -> Column:
    """The whole cleaner: steps for the text, then paragraphs merged, then each by itself, then what JSON needs."""
    from .predicates import probable_heading

    for step in (
        drop_stray_circumflex, normalize_nbsp, normalize_newlines, join_hyphenated, remove_soft_hyphens, normalize_quotes, remove_control_characters,
        collapse_colon_list_breaks, drop_number_markers, break_numbered_lists, merge_number_suffixes, join_wrapped_items, collapse_single_newlines,
    ):
        text = step(text)
    text = let(text, lambda t: merge_paragraphs(t, probable_heading))
    paragraphs = F.transform(F.split(text, r"\n{2,}"), clean_paragraph)
    return json_safe(F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n"))
