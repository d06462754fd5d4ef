"""Merging and splitting of neighbours: folds over the ordered rows of a document, and the pair rules they use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import BULLETS, let, lstrip, n_words, strip, with_once, words
from .adjacency import with_neighbour
from .chunks import overlap_window

# Verbs of saying; fixed values.
DIALOGUE_VERBS = (
    "said replied asked answered continued added noted observed remarked stated declared exclaimed whispered shouted muttered explained insisted argued suggested wondered thought concluded"
).split()
# Words that carry on a list item though they begin with a capital; fixed values.
CARRY_ON = "and or but which that because since although however therefore thus also as if when where for to with without".split()


def merge_reason(curr: Column, next_words: Column, next_upper: Column) -> Column:
    """Why a chunk should take in the next one, of which only the number of words and whether it begins with a capital are asked.

    Tried in order: a short phrase of saying, a short unended sentence, a fragment, a short chunk before a short one, and any
    chunk before a very short one."""
    w, text = words(curr), strip(curr)
    n, ended = F.size(w), P.ends_with_any(text, (".", "!", "?"))
    return (
        F.when((n <= 6) & F.exists(w, lambda x: F.lower(x).isin(*DIALOGUE_VERBS)), "short_dialogue_attribution")
        .when((n <= 6) & ~ended & ~next_upper, "incomplete_sentence")
        .when(n <= 4, "very_short_fragment")
        .when((n <= 9) & (next_words <= 12) & ~ended, "related_short_chunks")
        .when(next_words <= 9, "next_chunk_very_short")
    )


def merge_reasons(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``reason`` to rows with a next row of the group; neither may be blank."""
    text = strip(F.col("text"))
    values = {"n": n_words(F.col("text")), "upper": text.rlike(r"^\p{Lu}")}
    pairs = with_neighbour(rows, group, order, values, "__next").where((text != "") & (F.col("__next.n") > 0))
    return pairs.withColumn("reason", merge_reason(F.col("text"), F.col("__next.n"), F.col("__next.upper"))).drop("__next")


def question_confidence(prev: Column, curr: Column) -> Column:
    """How surely a line goes on with the questions and answers (``Q1:``, ``A1:``) of the line before it."""
    text = lstrip(curr)
    before, here = F.coalesce(prev.rlike(r"(?i)[QA]\d+:"), F.lit(False)), F.coalesce(text.rlike(r"(?i)^[QA]\d+:"), F.lit(False))
    answer = F.coalesce(text.rlike(r"^\p{Lu}") & (F.length(text) > 20), F.lit(False))
    return F.when(before & here, 0.95).when(here, 0.7).when(before & answer, 0.6).when(before, 0.4).otherwise(0.1)


def is_list_item(text: Column) -> Column:
    return P.starts_with_bullet(lstrip(text)) | P.starts_with_number(lstrip(text))


def item_looks_incomplete(text: Column) -> Column:
    """Whether a list item seems to go on: a comma or colon at its end, few words, no end, or something left open."""
    body = lstrip(F.regexp_replace(strip(text), rf"^(?:[{BULLETS}]|-\s|\d+[.)])", ""))

    def judged(b: Column) -> Column:
        n = n_words(b)
        count = lambda ch: F.length(b) - F.length(F.replace(b, F.lit(ch), F.lit("")))
        left_open = (count("(") > count(")")) | (count("[") > count("]")) | (count("{") > count("}")) | (count('"') % 2 != 0)
        return (n <= 5) | ((n <= 7) & ~P.ends_with_any(b, (".", "!", "?"))) | P.ends_with_any(b, (",", ";", ":")) | left_open

    return F.coalesce(let(body, judged), F.lit(True))


def list_continuation_confidence(prev: Column, curr: Column) -> Column:
    """How surely a line continues the list item before it; 0 where that is none or the line is an item itself."""
    text = strip(curr)
    base = F.when(item_looks_incomplete(prev), 0.8).otherwise(0.3)
    bonus = F.when(P.starts_lower(text), 0.15).when(text.rlike(r"^\p{Lu}") & F.lower(F.get(words(text), F.lit(0))).isin(*CARRY_ON), 0.1).otherwise(0.0)
    possible = (F.coalesce(prev, F.lit("")) != "") & (text != "") & is_list_item(prev) & ~is_list_item(curr)
    return F.when(F.coalesce(possible, F.lit(False)), F.round(F.least(F.lit(1.0), base + bonus), 6)).otherwise(0.0)


def with_overlap_restored(rows: DataFrame, group: list[str], order: list[str], overlap: int = 5) -> DataFrame:
    """Adds ``restored``: the text behind those of the last ``overlap`` words of the row before that it doesn't begin with."""
    w = with_once(rows, "__w", words(F.col("text")))
    edges = w.withColumns({"__tail": F.slice("__w", F.greatest(F.size("__w") - overlap + 1, F.lit(1)), F.lit(overlap)), "__head": F.slice("__w", F.lit(1), F.lit(overlap))}).drop("__w")
    out = with_neighbour(edges, group, order, {"tail": F.col("__tail")}, "__prev", ahead=False)
    tail = F.col("__prev.tail")
    shared = overlap_window(tail, F.col("__head"), overlap)
    lead = F.array_join(F.slice(tail, F.lit(1), F.greatest(F.size(tail) - shared, F.lit(0))), " ")
    return out.withColumn("restored", F.when(F.size(tail) > 0, F.trim(F.concat_ws(" ", lead, "text"))).otherwise(F.col("text"))).drop("__tail", "__head", "__prev")


def hold_short(rows: DataFrame, min_words: int = 15, max_chars: int = 2000) -> DataFrame:
    """(doc_id, part, lines, text): rows below ``min_words`` are held and put before the next while that stays small; what is
    held at the end goes behind the last. A fold over the rows of a document, in the JVM."""
    ordered = rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda r: r["text"]).alias("lines"))
    box = "struct<lines:int,text:string>"
    empty = F.struct(F.array().cast(f"array<{box}>").alias("done"), F.lit(0).alias("n"), F.lit("").alias("held"))
    join = lambda a, b: F.when(a == "", b).otherwise(F.concat_ws("\n", a, b))

    def step(acc: Column, line: Column) -> Column:
        both = join(acc["held"], line)
        ready = (F.size(F.split(both, r"\s+")) >= min_words) | (F.length(both) > max_chars)
        made = F.struct((acc["n"] + 1).alias("lines"), both.alias("text"))
        return F.struct(
            F.when(ready, F.concat(acc["done"], F.array(made))).otherwise(acc["done"]).alias("done"), F.when(ready, 0).otherwise(acc["n"] + 1).alias("n"), F.when(ready, "").otherwise(both).alias("held")
        )

    def finish(acc: Column) -> Column:
        last = F.element_at(acc["done"], -1)
        tail = F.when(
            F.size(acc["done"]) > 0,
            F.concat(F.slice(acc["done"], F.lit(1), F.size(acc["done"]) - 1), F.array(F.struct((last["lines"] + acc["n"]).alias("lines"), F.concat_ws("\n", last["text"], acc["held"]).alias("text")))),
        ).otherwise(F.array(F.struct(acc["n"].alias("lines"), acc["held"].alias("text"))))
        return F.when(acc["n"] > 0, tail).otherwise(acc["done"])

    return ordered.select("doc_id", F.posexplode(F.aggregate("lines", empty, step, finish)).alias("part", "b")).select("doc_id", "part", "b.lines", "b.text")


def split_inline_heading(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, seq, part, text): a bold or italic span at the start of a block, ended by its text's end or a colon,
    becomes a heading of its own; other blocks stay whole."""
    lead = F.filter("inline_styles", lambda s: (s["start"] == 0) & s["style"].isin("bold", "italic") & (s["end"] > 0) & (s["end"] < F.length("text")))
    cut = F.try_element_at(lead, F.lit(1))["end"]
    whole = F.array(F.struct(F.lit("body").alias("part"), F.col("text").alias("text")))
    two = F.array(F.struct(F.lit("heading").alias("part"), strip(F.left("text", cut)).alias("text")), F.struct(F.lit("body").alias("part"), strip(F.substring("text", cut + 1, F.length("text"))).alias("text")))
    return blocks.select("doc_id", "page", "seq", F.explode(F.when(cut.isNotNull(), two).otherwise(whole)).alias("p")).select("doc_id", "page", "seq", "p.part", "p.text")


def zone_margins(blocks: DataFrame) -> DataFrame:
    """(doc_id, footer_y, pages, confidence): the commonest height, to five points, of the lowest block of a document's pages."""
    lowest = blocks.where("bbox is not null").groupBy("doc_id", "page").agg(F.max("bbox.y1").alias("y")).where("y is not null")
    bins = lowest.groupBy("doc_id", (F.round(F.col("y") / 5) * 5).alias("footer_y")).agg(F.count("*").alias("n"))
    total = bins.groupBy("doc_id").agg(F.sum("n").alias("pages"), F.min(F.struct((-F.col("n")).alias("m"), F.col("footer_y"))).alias("b"))
    return total.select("doc_id", F.col("b.footer_y").alias("footer_y"), "pages", F.round(-F.col("b.m") / F.col("pages"), 6).alias("confidence"))


def hyphen_choices(docs: DataFrame) -> DataFrame:
    """(head, tail, breaks, joined_seen, hyphenated_seen, keep): how words divided at line breaks should be joined, judged by how
    often the joined and the hyphenated form occur elsewhere in the corpus. Pre-aggregated counts are joined, not texts."""
    text = F.lower("text")
    pairs = docs.select(F.explode(F.regexp_extract_all(text, F.lit(r"([a-z]+-[ \t]*\n[ \t]*[a-z]+)"), F.lit(1))).alias("m"))
    parts = pairs.select(F.regexp_extract("m", r"^([a-z]+)", 1).alias("head"), F.regexp_extract("m", r"([a-z]+)$", 1).alias("tail")).groupBy("head", "tail").agg(F.count("*").alias("breaks"))
    seen = docs.select(F.explode(F.regexp_extract_all(text, F.lit(r"([a-z]+(?:-[a-z]+)*)"), F.lit(1))).alias("word")).groupBy("word").agg(F.count("*").alias("seen"))
    both = parts.withColumn("j", F.concat("head", "tail")).withColumn("h", F.concat_ws("-", "head", "tail"))
    out = both.join(seen.select(F.col("word").alias("j"), F.col("seen").alias("joined_seen")), "j", "left").join(seen.select(F.col("word").alias("h"), F.col("seen").alias("hyphenated_seen")), "h", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select("head", "tail", "breaks", zero("joined_seen").alias("joined_seen"), zero("hyphenated_seen").alias("hyphenated_seen"), (zero("hyphenated_seen") > zero("joined_seen")).alias("keep"))


def shared_windows(rows: DataFrame, id_col: str, size: int = 50) -> DataFrame:
    """(window_hash, rows): runs of ``size`` words that several rows hold; hashes only are shuffled."""
    w = rows.select(F.col(id_col).alias("id"), words(F.col("text")).alias("w")).where(F.size("w") >= size)
    runs = w.select("id", "w", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("i"))
    hashed = runs.select("id", F.md5(F.array_join(F.slice("w", F.col("i"), F.lit(size)), " ")).alias("window_hash"))
    return hashed.distinct().groupBy("window_hash").agg(F.count("*").alias("rows")).where("rows > 1")


def enrich(chunks: DataFrame, id_col: str, complete: Callable[[str], str], text_col: str = "text") -> DataFrame:
    """(id, utterance_type, tags): the answer of an outside function to each text, ``label | tag, tag``; failures are ``error``.

    The function is sent to the tasks; batches go through Arrow, and order within a batch is kept.
    """
    kind = chunks.schema[id_col].dataType.simpleString()

    def answer(text: str | None) -> tuple[str, list[str]]:
        try:
            label, _, tags = (complete(text) if text else "unclassified").partition("|")
            return label.strip() or "unclassified", sorted({t.strip().lower() for t in tags.split(",") if t.strip()})
        except Exception:
            return "error", []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [answer(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "utterance_type": [g[0] for g in got], "tags": [g[1] for g in got]})

    rows = chunks.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, utterance_type string, tags array<string>").withColumnRenamed("id", id_col)
