"""Visually identical text with different characters (problem 7).

One consistent form: canonical, width, presentation and same-look compatibility forms are decomposed, invisible
characters go, kinds of space and hyphen become one, letters of another script with the same shape become the Latin
letter, marks are ordered by class and composed. Raised, circled, squared, fractional and styled characters, dashes, case,
accents and line breaks are kept.

The mapping tables are made by rule from the Unicode database. They are applied inside each row: one-to-one and
one-to-none mappings by ``translate``, and only texts with combining marks, conjoining Hangul or a character that becomes
several get their form from an Arrow function that orders and composes. Exploding texts to rows of code points, joining
the mappings and gathering the rows again gives the same form at several times the cost (figures in the README), since
every character becomes a row of a shuffle.

Defined results: null stays null, empty stays empty. Identical texts, and copies of them, are one class.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lineage import cut

# Letters of other scripts with the shape of a Latin letter; fixed values.
SAME_SHAPE = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ѕ": "s", "х": "x", "у": "y", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "Ӏ": "I",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    "Ա": "U", "Տ": "S", "Օ": "O", "օ": "o", "ո": "n", "ս": "u", "ց": "g", "հ": "h",
}
ELLIPSIS = "…"
# Hyphens, and the hyphen-minus they become; dashes and the minus sign look different and stay. Fixed values.
HYPHENS = "‐‑⁃﹣－"
# Compatibility mappings tagged <compat> whose look differs from what they map to; fixed values.
OTHER_LOOK = {*range(0x2100, 0x214F), *range(0x2474, 0x24B6), *range(0x3200, 0x3400), *range(0x02D8, 0x02DE), 0x00A8, 0x00AF, 0x00B4, 0x00B8, 0x017F, 0x0149, 0x2017, 0x203E, 0x2E9F, 0x2EF3}
SAME_LOOK_TAGS = {"", "<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<compat>"}


@cache
def code_point_map() -> dict[str, str]:
    """What each character becomes, by itself and before marks are ordered and composed; characters that stay aren't in it."""

    def decomposed(ch: str) -> str:
        if ch in SAME_SHAPE:
            return SAME_SHAPE[ch]
        tag, _, rest = d.partition(" ") if (d := unicodedata.decomposition(ch)).startswith("<") else ("", "", d)
        if not rest or tag not in SAME_LOOK_TAGS or ord(ch) in OTHER_LOOK:
            return ch
        return "".join(decomposed(chr(int(x, 16))) for x in rest.split())

    out: dict[str, str] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000 or 0xAC00 <= cp < 0xD7A4:
            continue
        ch = chr(cp)
        category = unicodedata.category(ch)
        if category in ("Cn", "Co"):
            continue
        if category == "Cf" and not 0x0600 <= cp <= 0x0605 or 0xFE00 <= cp <= 0xFE0F or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
            new = ""
        elif category == "Zs":
            new = " "
        elif ch in HYPHENS:
            new = "-"
        else:
            new = unicodedata.normalize("NFC", decomposed(ch))
        if new != ch:
            out[ch] = new
    return out


def _composer(table: dict[int, str]) -> Callable[[pd.Series], pd.Series]:
    """The whole form of texts that need marks ordered or a character expanded: composed, mapped, composed again.

    Composed before, so that a mark isn't parted from a letter with a precomposed form of another look; after, since a
    mapped letter may compose with the mark that follows it.
    """

    def composed(texts: pd.Series) -> pd.Series:
        nfc = unicodedata.normalize
        return texts.map(lambda t: nfc("NFC", nfc("NFC", t).translate(table)), na_action="ignore")

    return composed


def same_look(df: DataFrame, text_col: str = "text", out_col: str = "form") -> DataFrame:
    """``df`` with the consistent form of a text column added.

    ASCII texts are their own form and are known by their length in bytes. The rest goes through ``translate`` in the
    JVM, in which characters that become several stand as one of plane 16, so that a single range tells the texts that
    hold any. Those, and texts with marks or conjoining Hangul, get their form from the Arrow function instead.
    """
    table = code_point_map()
    several = [k for k, v in table.items() if len(v) > 1 and k != ELLIPSIS]
    ones = {k: v for k, v in table.items() if len(v) == 1} | {k: chr(0x100000 + i) for i, k in enumerate(several)}
    source, target = "".join([*ones, *(k for k, v in table.items() if not v)]), "".join(ones.values())
    text = F.col(text_col)
    ascii_only = F.octet_length(text) == F.length(text)
    mapped = F.translate(F.replace(text, F.lit(ELLIPSIS), F.lit("...")), source, target)
    once = df.withColumn("__form", F.when(ascii_only, text).otherwise(mapped))
    marks = F.col("__form").rlike(r"[\p{M}\x{1100}-\x{11ff}\x{100000}-\x{10ffff}]")
    once = once.withColumn("__python", F.when(ascii_only, False).otherwise(F.coalesce(marks, F.lit(False))))
    # One pass: every row meets the function, but a row that doesn't need it sends a null there and keeps its own form.
    composed = F.pandas_udf(_composer({ord(k): v for k, v in table.items()}), "string")(F.when(F.col("__python"), text))
    once = once.withColumn("__composed", composed)
    return once.withColumn(out_col, F.when(F.col("__python"), F.col("__composed")).otherwise(F.col("__form"))).drop("__form", "__python", "__composed")


@cache
def code_point_rules() -> list[tuple[str, list[tuple[str, int, str, str]]]]:
    """For each character with a part in the form, the characters it is decomposed into. Each of these has its combining class and,
    if it composes with one before it, the characters it composes with and what they become, in the same order."""
    table, nfd = code_point_map(), lambda t: unicodedata.normalize("NFD", t)
    composed: dict[str, list[tuple[str, str]]] = {}
    chars = set(table)
    for cp in range(0xA0, sys.maxunicode + 1):
        ch = chr(cp)
        if 0xD800 <= cp < 0xE000 or unicodedata.category(ch) in ("Cn", "Co"):
            continue
        full = nfd(ch)
        if full != ch:
            chars.add(ch)
            for at in range(1, len(full)):
                first = unicodedata.normalize("NFC", full[:at])
                if len(first) == 1 and at == len(full) - 1 and unicodedata.normalize("NFC", first + full[-1]) == ch:
                    composed.setdefault(full[-1], []).append((first, ch))
        elif unicodedata.combining(ch):
            chars.add(ch)
    part = lambda c: (c, unicodedata.combining(c), "".join(b for b, _ in composed.get(c, [])), "".join(x for _, x in composed.get(c, [])))
    chars.update(composed)
    return [(ch, [part(c) for c in nfd(table.get(ch, ch))]) for ch in sorted(chars)]


def exploded_form(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, form): the form of ``same_look`` by the method named, row by row: texts beyond ASCII are exploded to positioned code
    points, these are broadcast-joined with the table of decompositions and look-alikes, marks are ordered by class, composed
    with their letters, and the strings are put together again. Repeated rows give one; null ids and texts none.

    The table has one size, that of Unicode. Every code point is a row of two shuffles, so this serves to check ``same_look``,
    which gives the same form (figures in the README).
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ascii_only = F.octet_length("text") == F.length("text")
    kind = "ch string, parts array<struct<c:string,ccc:int,before:string,becomes:string>>"
    table = F.broadcast(df.sparkSession.createDataFrame(code_point_rules(), kind))
    points = rows.where(~ascii_only).select("id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "")).alias("pos", "ch"))
    alone = F.array(F.struct(F.col("ch").alias("c"), F.lit(0).alias("ccc"), F.lit("").alias("before"), F.lit("").alias("becomes")))
    parts = points.join(table, "ch", "left").select("id", "t", "pos", F.posexplode(F.coalesce("parts", alone)).alias("k", "p")).distinct()
    starts = ((F.col("p.ccc") == 0) & (F.col("p.before") == "")).cast("int")
    placed = parts.withColumn("g", F.sum(starts).over(Window.partitionBy("id", "t").orderBy("pos", "k")))
    # Canonical order within each stretch between letters that nothing before them can take in.
    stretch = Window.partitionBy("id", "t", "g").orderBy("pos", "k")
    placed = placed.withColumn("h", F.sum((F.col("p.ccc") == 0).cast("int")).over(stretch))
    ordered = F.array_sort(F.collect_list(F.struct("h", "p.ccc", "pos", "k", "p.c", "p.before", "p.becomes")))
    zero = F.struct(F.lit("").alias("done"), F.lit("").alias("letter"), F.lit("").alias("marks"), F.lit(-1).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        at = F.when(acc["letter"] != "", F.instr(x["before"], acc["letter"])).otherwise(0)
        # A mark is blocked by one of the same class, or a letter by any mark, that stands between and stayed.
        free = F.when(acc["last"] == -1, True).otherwise((x["ccc"] != 0) & (acc["last"] < x["ccc"]))
        joins = (at > 0) & free
        new = (x["ccc"] == 0) & ~joins
        return F.struct(
            F.when(new, F.concat(acc["done"], acc["letter"], acc["marks"])).otherwise(acc["done"]).alias("done"),
            F.when(joins, F.substring(x["becomes"], at, F.lit(1))).when(new, x["c"]).otherwise(acc["letter"]).alias("letter"),
            F.when(joins, acc["marks"]).when(new, "").otherwise(F.concat(acc["marks"], x["c"])).alias("marks"),
            F.when(joins, acc["last"]).when(new, F.lit(-1)).otherwise(x["ccc"]).alias("last"),
        )

    whole = F.aggregate(ordered, zero, step, lambda acc: F.concat(acc["done"], acc["letter"], acc["marks"]))
    strings = placed.groupBy("id", "t", "g").agg(whole.alias("s")).groupBy("id", "t").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("g", "s"))), lambda x: x["s"]), "").alias("form"))
    back = rows.where(~ascii_only).select("id", F.xxhash64("text").alias("t")).distinct().join(strings, ["id", "t"], "left").select("id", F.coalesce("form", F.lit("")).alias("form"))
    return rows.where(ascii_only).distinct().select("id", F.col("text").alias("form")).union(back).withColumnRenamed("id", id_col)


def same_look_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b), a < b: the pairs of rows whose texts differ but have one consistent form.

    Rows meet on two hashes of the form, in one shuffle of ids and hashes without texts. Copies of a text are one class:
    forms with a single text are left out before any pair is made, pairs are made of classes, and only then of their rows.
    """
    forms = same_look(df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    digest = lambda c: F.struct(F.xxhash64(c).alias("x"), F.hash(c).alias("h"), F.length(c).alias("n"))
    keys = cut(forms.select("id", digest("form").alias("form"), digest("text").alias("cls")))  # read four times
    classes = keys.groupBy("form", "cls").agg(F.count("*").alias("n"))
    mixed = classes.groupBy("form").agg(F.count("*").alias("k")).where("k > 1").select("form")
    rows = keys.join(mixed, "form", "left_semi")
    kinds = rows.select("form", "cls").distinct()
    pairs = kinds.alias("x").join(kinds.alias("y"), "form").where("x.cls < y.cls").select("form", F.col("x.cls").alias("ca"), F.col("y.cls").alias("cb"))
    left = rows.select("form", F.col("cls").alias("ca"), F.col("id").alias("ia"))
    right = rows.select("form", F.col("cls").alias("cb"), F.col("id").alias("ib"))
    found = pairs.join(left, ["form", "ca"]).join(right, ["form", "cb"])
    return found.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"))


def same_look_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, texts): the smallest id with the same form, and how many different texts the form has."""
    forms = same_look(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    keys = forms.select("id", F.xxhash64("form").alias("f"), F.length("form").alias("n"), F.xxhash64("text").alias("t"))
    per = keys.groupBy("f", "n").agg(F.min("id").alias("class_id"), F.approx_count_distinct("t").alias("texts"))
    return keys.join(per, ["f", "n"]).select(F.col("id").alias(id_col), "class_id", "texts")
