"""Merging of the ordered rows of a document where a decision looks at what was gathered: folds inside the row of a document.

A fold only finds where a new run begins, from numbers and flags taken from each row beforehand; the texts of a run are joined
afterwards, so no text is copied while the fold goes on. Rows of one document meet in one task, rows of the corpus never.
Null texts are left out; equal places are ordered by their text; repeated rows are separate rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import predicates as P
from ..functions.text import BULLETS, let, lstrip, n_words, rstrip, strip, with_once, words
from .merging import CARRY_ON, is_list_item, item_looks_incomplete

Joins = Callable[[Column, Column], Column]
Carry = dict[str, tuple[Column, Callable[[Column, Column, Column], Column]]]


def fold_runs(rows: DataFrame, group: list[str], order: list[str], fields: dict[str, Column], joins: Joins, carry: Carry) -> DataFrame:
    """(group, run, parts): the rows of a group in runs; ``parts`` has order, fields and text of each row of a run.

    ``joins(state, row)`` says whether a row goes on with the run; ``carry`` has for each name of the state its value before the
    first row and ``(state, row, joined) -> value``.
    """
    named = [c.alias(f"__{n}") for n, c in fields.items()]
    narrow = rows.where(F.col("text").isNotNull()).select(*group, *order, "text", *named)
    part = F.struct(*order, *(F.col(f"__{n}").alias(n) for n in fields), "text")
    per = narrow.groupBy(*group).agg(F.array_sort(F.collect_list(part)).alias("__x"))
    return runs_in_rows(per, group, joins, carry).drop("before")


def runs_in_rows(per: DataFrame, group: list[str], joins: Joins, carry: Carry) -> DataFrame:
    """(group, run, parts, before): the runs of the array ``__x`` of each row; ``before`` is the run before it, null for the first."""
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"), *(first.alias(n) for n, (first, _) in carry.items()))

    def step(acc: Column, x: Column) -> Column:
        joined = (acc["i"] > 0) & F.coalesce(joins(acc, x), F.lit(False))
        starts = F.when(joined, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["i"])))
        return F.struct(starts.alias("starts"), (acc["i"] + 1).alias("i"), *(f(acc, x, joined).alias(n) for n, (_, f) in carry.items()))

    found = per.withColumn("__s", F.aggregate("__x", zero, step, lambda acc: acc["starts"]))
    ends = found.select(*group, "__x", "__s", F.posexplode("__s").alias("run", "__at"))
    size = F.coalesce(F.get("__s", F.col("run") + 1), F.size("__x")) - F.col("__at")
    last = F.get("__s", F.col("run") - 1)
    before = F.when(F.col("run") > 0, F.slice("__x", last + 1, F.col("__at") - last))
    return ends.select(*group, "run", F.slice("__x", F.col("__at") + 1, size).alias("parts"), before.alias("before"))


def joined_text(sep: str = " ") -> Column:
    return F.array_join(F.transform("parts", lambda p: p["text"]), sep)


def records(lines: DataFrame) -> DataFrame:
    """(doc_id, seq, text, heading): lines with the run of headings before them; headings at the end are a record by themselves.
    ``lines`` has doc_id, seq, text, is_heading."""
    back = Window.partitionBy("doc_id").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    grouped = lines.withColumn("g", F.sum((~F.col("is_heading")).cast("int")).over(back))
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return grouped.groupBy("doc_id", "g").agg(F.max("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"), F.bool_or("is_heading").alias("heading")).drop("g")


def semantic_chunks(rows: DataFrame, limit: int = 400, most_chars: int = 8000) -> DataFrame:
    """(doc_id, chunk_seq, n_records, text): records packed into chunks of at most ``limit`` words, formed by headings and lists.

    The size of a record is the larger of its words and its characters over 4.7. A heading begins a chunk; so does the first
    item of a list, unless the record before ends in a colon or with the number before. The next number of a list may go
    beyond the words, up to ``most_chars``. A record above the limit is a chunk by itself.
    """
    t = F.col("text")
    fields = {
        "n": F.greatest(n_words(t), F.ceil(F.length(t) / 4.7).cast("int")),
        "chars": F.length(t),
        "heading": F.col("heading"),
        "item": is_list_item(t),
        "number": P.first_list_number(F.concat(t, F.lit(" "))),
        "last": P.last_list_number(F.concat(t, F.lit(" "))),
        "colon": F.coalesce(rstrip(t).endswith(":"), F.lit(False)),
    }

    def joins(acc: Column, x: Column) -> Column:
        next_number = F.coalesce(x["number"] == acc["last"] + 1, F.lit(False))
        list_begins = x["item"] & ~acc["item"] & ~acc["colon"] & ~next_number
        fits = (acc["n"] + x["n"] <= limit) | (next_number & (acc["chars"] + 2 + x["chars"] <= most_chars))
        return ~x["heading"] & ~list_begins & fits

    gathered = lambda name, gap=0: lambda acc, x, joined: F.when(joined, acc[name] + gap + x[name]).otherwise(x[name])
    latest = lambda name: lambda acc, x, joined: x[name]
    carry = {
        "n": (F.lit(0), gathered("n")),
        "chars": (F.lit(0), gathered("chars", 2)),
        "item": (F.lit(False), latest("item")),
        "last": (F.lit(None).cast("bigint"), latest("last")),
        "colon": (F.lit(False), latest("colon")),
    }
    runs = fold_runs(rows, ["doc_id"], ["seq"], fields, joins, carry)
    return runs.select("doc_id", F.col("run").alias("chunk_seq"), F.size("parts").alias("n_records"), joined_text("\n\n").alias("text"))


def chunks_of_texts(df: DataFrame, limit: int, overlap: int, is_heading: Callable[[Column], Column], most_chars: int = 8000) -> DataFrame:
    """(doc_id, chunk, text) of documents (doc_id, text): the rule of ``semantic_chunks`` over the lines of a text, inside its row, so that
    nothing is shuffled and streams can use it.

    Headings stay with what follows. Lines above the limit are cut into stretches of it. A chunk begins with the last ``overlap``
    words of the one before, unless a heading begins it.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("text"), is_heading(line).alias("heading"))), lambda line: strip(line["text"]) != "")

    def cut(line: Column) -> Column:
        stretch = lambda w: F.transform(F.sequence(F.lit(1), F.size(w), F.lit(limit)), lambda at: F.struct(F.array_join(F.slice(w, at, F.lit(limit)), " ").alias("text"), line["heading"].alias("heading")))
        return let(words(line["text"]), lambda w: F.when(F.size(w) > limit, stretch(w)).otherwise(F.array(line)))

    def fields(line: Column, i: Column) -> Column:
        t = line["text"]
        return F.struct(
            i.alias("seq"), F.greatest(n_words(t), F.ceil(F.length(t) / 4.7).cast("int")).alias("n"), F.length(t).alias("chars"), F.coalesce(line["heading"], F.lit(False)).alias("heading"), is_list_item(t).alias("item"),
            P.first_list_number(F.concat(t, F.lit(" "))).alias("number"), F.coalesce(rstrip(t).endswith(":"), F.lit(False)).alias("colon"), t.alias("text"),
        )

    def joins(acc: Column, x: Column) -> Column:
        next_number = F.coalesce(x["number"] == acc["number"] + 1, F.lit(False))
        list_begins = x["item"] & ~acc["item"] & ~acc["colon"] & ~next_number
        fits = (acc["n"] + x["n"] <= limit) | (next_number & (acc["chars"] + 2 + x["chars"] <= most_chars))
        return acc["heads"] | (~x["heading"] & ~list_begins & fits)

    gathered = lambda name, gap=0: lambda acc, x, joined: F.when(joined, acc[name] + gap + x[name]).otherwise(x[name])
    latest = lambda name: lambda acc, x, joined: x[name]
    carry = {
        "n": (F.lit(0), gathered("n")), "chars": (F.lit(0), gathered("chars", 2)), "item": (F.lit(False), latest("item")), "number": (F.lit(None).cast("bigint"), latest("number")),
        "colon": (F.lit(False), latest("colon")), "heads": (F.lit(False), lambda acc, x, joined: x["heading"] & (acc["heads"] | ~joined)),
    }
    rows = with_once(df, "__l", F.flatten(F.transform(lines, cut)))
    per = with_once(rows.select("doc_id", "__l"), "__x", F.transform("__l", fields)).drop("__l")
    runs = runs_in_rows(per, ["doc_id"], joins, carry)
    sep = lambda i: F.when(i == 0, "").when(F.get("parts", i - 1)["heading"], "\n").otherwise("\n\n")
    text = F.array_join(F.transform("parts", lambda p, i: F.concat(sep(i), p["text"])), "")
    if overlap > 0:
        last = let(words(F.array_join(F.transform("before", lambda p: p["text"]), " ")), lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - overlap + 1, F.lit(1)), F.lit(overlap)), " "))
        text = F.concat_ws(" ", F.when(F.col("before").isNotNull() & ~F.get("parts", F.lit(0))["heading"], last), text)
    return runs.select("doc_id", F.col("run").alias("chunk"), text.alias("text"))


def coalesce_bodies(rows: DataFrame, group: list[str], order: list[str], most: int = 650, anchor: int = 450) -> DataFrame:
    """(group, run, rows, text): blocks joined by blank lines while they stay within ``most`` characters, or within ``most`` and
    ``anchor`` behind a block below ``anchor``. Headings stay by themselves, and a block that ends in a colon begins a new one.
    ``rows`` has ``heading``."""
    t = F.col("text")
    fields = {"n": F.length(t), "head": F.length(rstrip(t)), "tail": F.length(lstrip(t)), "lead": F.length(t) - F.length(lstrip(t)), "heading": F.col("heading"), "colon": rstrip(t).endswith(":")}

    def joins(acc: Column, x: Column) -> Column:
        both = F.when(acc["n"] == 0, x["n"]).when(x["n"] == 0, acc["n"]).otherwise(acc["head"] + 2 + x["tail"])
        return ~acc["heading"] & ~x["heading"] & ~x["colon"] & ((both <= most) | ((acc["n"] < anchor) & (both <= most + anchor)))

    trailing = lambda x: x["n"] - x["head"]
    both = lambda acc, x: F.when(acc["n"] == 0, x["n"]).when(x["n"] == 0, acc["n"]).otherwise(acc["head"] + 2 + x["tail"])
    carry = {
        "n": (F.lit(0), lambda acc, x, joined: F.when(joined, both(acc, x)).otherwise(x["n"])),
        "head": (F.lit(0), lambda acc, x, joined: F.when(joined, F.when(x["n"] == 0, acc["head"]).otherwise(F.greatest(both(acc, x) - trailing(x), F.lit(0)))).otherwise(x["head"])),
        "heading": (F.lit(False), lambda acc, x, joined: x["heading"]),
    }
    runs = fold_runs(rows, group, order, fields, joins, carry)
    filled = F.filter("parts", lambda p: p["text"] != "")
    n = F.size(filled)
    clean = F.transform(filled, lambda p, i: F.when((i > 0) & (i < n - 1), strip(p["text"])).when(i > 0, lstrip(p["text"])).when(n > 1, rstrip(p["text"])).otherwise(p["text"]))
    return runs.select(*group, "run", F.size("parts").alias("rows"), F.array_join(clean, "\n\n").alias("text"))


def merge_page_blocks(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, run, rows, text): neighbours on a page that are one paragraph.

    In this order: a caption goes to what is before it, once; headings and list items stay; so does what follows a colon and
    begins like a list, a capital or a number; a line that most likely goes on with a list item joins it, and so does one that
    begins with a word that carries on, or with a small letter or closing mark behind an open sentence.
    """
    t = strip(F.col("text"))
    fields = {
        "heading": (P.is_heading(F.col("text")) & ~is_list_item(F.col("text"))) | F.coalesce(F.col("type") == "heading", F.lit(False)),
        "item": is_list_item(F.col("text")),
        "caption": P.is_caption(F.col("text")),
        "colon": t.endswith(":"),
        "ended": P.has_sentence_ending(t),
        "open_item": is_list_item(F.col("text")) & item_looks_incomplete(F.col("text")),
        "lower": P.starts_lower(t),
        "like_start": t.rlike(r"^[\p{Lu}\d]"),
        "carries": P.starts_with_continuation(t),
        "carry_on": F.lower(F.regexp_extract(t, r"^(\p{L}+)", 1)).isin(*CARRY_ON),
        "close": F.substring(t, 1, 1).isin(",", ".", ";", ":", ")", "]", '"', "'"),
    }

    def joins(acc: Column, x: Column) -> Column:
        item_goes_on = acc["open_item"] & ~x["item"]  # 0.8 or more against 0.7
        prose = x["carries"] | (~acc["ended"] & (x["lower"] | x["close"]))
        return F.when(x["caption"], ~acc["caption"]).when(acc["heading"] | x["heading"] | x["item"], False).when(acc["colon"] & x["like_start"], False).otherwise(item_goes_on | prose)

    latest = lambda name: lambda acc, x, joined: x[name]
    carry = {name: (F.lit(False), latest(name)) for name in ("heading", "caption", "colon", "ended", "open_item")}
    runs = fold_runs(blocks, ["doc_id", "page"], ["seq"], fields, joins, carry)
    sep = lambda p: F.when(p["caption"], "\n\n").otherwise(" ")
    text = F.array_join(F.transform("parts", lambda p, i: F.when(i > 0, F.concat(sep(p), strip(p["text"]))).otherwise(strip(p["text"]))), "")
    return runs.select("doc_id", "page", "run", F.size("parts").alias("rows"), text.alias("text"))


def continuation_reason(prev: Column, curr: Column, same_page: Column, indent: Column, gap: Column) -> Column:
    """Why a block goes on with the one before it, or null. ``indent`` and ``gap`` are the points it stands further right and
    further down; null where boxes are missing."""
    a, b = strip(prev), strip(curr)
    last = P.last_line(prev)
    heading = P.is_heading(curr)
    hyphen = a.rlike(r"[\p{L}][-\x{2010}\x{2011}]$") & (P.starts_lower(b) | (b.rlike(r"^\p{Lu}\p{Ll}") & F.regexp_extract(a, r"(\p{L}+)[-\x{2010}\x{2011}]$", 1).rlike(r"^\p{Ll}+$")))
    open_quote = (F.length(a) - F.length(F.replace(a, F.lit('"'), F.lit("")))) % 2 != 0
    body = ~P.has_sentence_ending(a) & ~a.endswith(":")
    return (
        F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), None)
        .when(b.startswith("—"), "attribution")
        .when(P.is_bullet_continuation(a, b), "bullet_continuation")
        .when(P.is_bullet_fragment(a, b), "bullet_fragment")
        .when(P.starts_with_bullet(last) & (n_words(b) <= 3) & ~P.starts_with_bullet(b), "bullet_short_fragment")
        .when(P.is_bullet_pair(a, b), "bullet_list")
        .when(P.is_numbered_pair(a, b), "numbered_list")
        .when(P.is_numbered_continuation(a, b) & ~heading, "numbered_continuation")
        .when(P.starts_with_number(a) & F.coalesce(indent > 8, F.lit(False)) & ~P.starts_with_number(b), "numbered_indent")
        .when(a.rlike(r"(?:^|\n)\d+\.$"), "lone_number")
        .when(open_quote & ~heading, "quote")
        .when(F.coalesce((indent > 10) & (gap < 8), F.lit(False)) & ~heading, "indented")
        .when(hyphen, "hyphenated")
        .when(body & P.starts_lower(b), F.when(same_page, "sentence").otherwise("sentence_across_pages"))
    )


def merge_continuations(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, seq, rows, reasons, text): blocks of a document merged while each goes on with the one before it, over at
    most two pages. Broken words are joined, lists keep their lines, the rest is joined by a space."""
    order = Window.partitionBy("doc_id").orderBy("page", "seq", "text")
    lag = lambda c: F.lag(c).over(order)
    known = blocks.where(strip(F.col("text")) != "").select("doc_id", "page", "seq", "text", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))
    pairs = known.withColumns({"p": lag("text"), "pp": lag("page"), "indent": F.col("x0") - lag("x0"), "gap": F.col("y0") - lag("y1")})
    reason = continuation_reason(F.col("p"), F.col("text"), F.col("pp").eqNullSafe(F.col("page")), F.when(F.col("pp") == F.col("page"), F.col("indent")), F.when(F.col("pp") == F.col("page"), F.col("gap")))
    near = F.coalesce(F.col("page") - F.col("pp") <= 1, F.lit(False))
    rows = pairs.withColumn("reason", F.when(near, reason))
    carry = {"from_page": (F.lit(None).cast("int"), lambda acc, x, joined: F.when(joined, acc["from_page"]).otherwise(x["page"]))}
    runs = fold_runs(rows.select("doc_id", "page", "seq", "text", "reason"), ["doc_id"], ["page", "seq"], {"reason": F.col("reason")}, lambda acc, x: x["reason"].isNotNull() & (x["page"] - acc["from_page"] <= 1), carry)
    broken = lambda i: F.coalesce(F.get("parts", i + 1)["reason"] == "hyphenated", F.lit(False))
    own = lambda p, i: F.when(broken(i), F.regexp_replace(strip(p["text"]), r"[-\x{2010}\x{2011}]$", "")).otherwise(strip(p["text"]))
    sep = lambda p: F.when(p["reason"] == "hyphenated", "").when(p["reason"].isin("bullet_list", "numbered_list"), "\n").otherwise(" ")
    text = F.array_join(F.transform("parts", lambda p, i: F.when(i > 0, F.concat(sep(p), own(p, i))).otherwise(own(p, i))), "")
    reasons = F.array_join(F.transform(F.filter("parts", lambda p, i: i > 0), lambda p: p["reason"]), ",")
    return runs.select("doc_id", F.get("parts", F.lit(0))["page"].alias("page"), F.get("parts", F.lit(0))["seq"].alias("seq"), F.size("parts").alias("rows"), reasons.alias("reasons"), text.alias("text"))


def carry_headings(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk, text): a heading in the last line of a chunk, or behind the last bar of that line, goes to the head of the next
    chunk; one at the end of the document is a chunk of its own. ``chunks`` has doc_id, chunk, text; blank ones go."""
    lines = F.split(rstrip(F.col("text")), "\n")
    last = strip(F.element_at(lines, -1))
    behind = strip(F.substring_index(last, "|", -1))
    split = F.contains(last, F.lit("|")) & P.probable_heading(behind)
    heading = F.when(split, behind).when(P.probable_heading(last), last)
    before = F.slice(lines, F.lit(1), F.size(lines) - 1)
    kept = F.when(split, F.concat(before, F.array(rstrip(F.left(last, F.length(last) - F.length(F.substring_index(last, "|", -1)) - 1))))).when(heading.isNotNull(), before).otherwise(lines)
    order = Window.partitionBy("doc_id").orderBy("chunk")
    cut = chunks.where(strip(F.col("text")) != "").select("doc_id", "chunk", heading.alias("head"), lstrip(rstrip(F.array_join(kept, "\n"))).alias("body"))
    led = cut.withColumns({"lead": F.lag("head").over(order), "final": F.lead("chunk").over(order).isNull()})
    own = F.struct("chunk", F.concat_ws("\n", "lead", F.nullif("body", F.lit(""))).alias("text"))
    end = F.when(F.col("final") & F.col("head").isNotNull(), F.struct((F.col("chunk") + 1).alias("chunk"), F.col("head").alias("text")))
    return led.select("doc_id", F.explode(F.array_compact(F.array(own, end))).alias("c")).select("doc_id", "c.chunk", "c.text").where("text <> ''")


def bullet_chunks(chunks: DataFrame) -> DataFrame:
    """(doc_id, run, rows, text): chunks of which every line is a list item join the one before them."""
    lines = F.filter(F.split("text", "\n"), lambda x: strip(x) != "")
    bullets = (F.size(lines) > 0) & F.forall(lines, lambda x: x.rlike(rf"^\s*(?:[{BULLETS}]|-\s)"))
    runs = fold_runs(chunks, ["doc_id"], ["chunk"], {"bullets": bullets}, lambda acc, x: x["bullets"], {})
    return runs.select("doc_id", "run", F.size("parts").alias("rows"), joined_text("\n").alias("text"))
