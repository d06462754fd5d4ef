"""Operators on blocks (doc_id, page, seq, text, ...): order within a document is (page, seq).

Windows are partitioned by document or page, so a task holds one document's blocks at most. Repeated rows are separate
blocks; null text counts as empty where a length is taken and is never a heading, list item or artefact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import predicates as P
from ..functions.text import strip, words


def lines_as_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, seq, text): the lines of each document that aren't blank, numbered from 0 with the blank ones counted."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("seq", "text"))
    return lines.where(strip(F.col("text")) != "")


def pages_covered(page_range: Column) -> Column:
    """ARRAY<INT> of the pages of ``a`` or ``a-b``, in either order; null if it can't be read."""
    lo = F.try_to_number(F.regexp_extract(page_range, r"^(\d{1,9})(?:-\d{1,9})?$", 1), F.lit("999999999")).cast("int")
    hi = F.coalesce(F.try_to_number(F.regexp_extract(page_range, r"^\d{1,9}-(\d{1,9})$", 1), F.lit("999999999")).cast("int"), lo)
    return F.when(lo.isNotNull(), F.sequence(F.least(lo, hi), F.greatest(lo, hi)))


def all_pages(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, n_blocks): every page from 1 to the document's last, those without blocks too."""
    per = blocks.where("page is not null").groupBy("doc_id", "page").agg(F.count("*").alias("n_blocks"))
    last = per.groupBy("doc_id").agg(F.max("page").alias("last"))
    every = last.where("last >= 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("page"))
    return every.join(per, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))


def page_texts(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, text): the blocks of each page in order, one to a line. Equal places are ordered by their text."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return blocks.where("text is not null").groupBy("doc_id", "page").agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("text"))


def fill_gaps(primary: DataFrame, secondary: DataFrame, on: list[str]) -> DataFrame:
    """``primary`` and, of ``secondary``, the rows of keys that ``primary`` lacks."""
    return primary.unionByName(secondary.join(primary.select(*on).distinct(), on, "left_anti"))


def modal_height(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, font_size): the commonest height of a page's blocks to a tenth, the smallest of equals."""
    sizes = blocks.where("bbox is not null").select("doc_id", "page", F.round(F.col("bbox.y1") - F.col("bbox.y0"), 1).alias("size")).where("size is not null")
    counts = sizes.groupBy("doc_id", "page", "size").agg(F.count("*").alias("n"))
    return counts.groupBy("doc_id", "page").agg(F.min(F.struct(-F.col("n"), F.col("size"))).alias("m")).select("doc_id", "page", F.col("m.size").alias("font_size"))


def in_margin(bbox: Column, height: float, header: float, footer: float) -> Column:
    """Above the header margin or below the footer margin; a block without a box is in neither."""
    return F.coalesce((bbox["y0"] < header) | (bbox["y1"] > height - footer), F.lit(False))


def with_lists(blocks: DataFrame) -> DataFrame:
    """Adds ``found_kind``: bullet, numbered or null, by the block and the one before it on its page."""
    order = Window.partitionBy("doc_id", "page").orderBy("seq", "text")
    return blocks.withColumn("found_kind", P.list_kind(F.lag("text").over(order), F.col("text")))


def with_headings(blocks: DataFrame) -> DataFrame:
    """Adds ``is_heading``, ``heading_level`` and ``heading_source``: by text, or by style where most of it is styled."""
    text, styles = F.col("text"), F.col("inline_styles")
    strong = F.filter(styles, lambda s: s["style"].isin("bold", "underline", "caps", "small_caps"))
    styled = F.aggregate(strong, F.lit(0), lambda acc, s: acc + F.greatest(s["end"] - s["start"], F.lit(0))) / F.length(text)
    by_style = F.coalesce((styled >= 0.6) & (F.size(words(text)) <= 12), F.lit(False))
    by_text = P.is_heading(text)
    return blocks.withColumns(
        {
            "is_heading": by_text | by_style,
            "heading_level": F.when(by_text | by_style, P.heading_level(text)),
            "heading_source": F.when(by_text, "fallback").when(by_style, "inline_styles"),
        }
    )


def heading_tree(headings: DataFrame) -> DataFrame:
    """(doc_id, seq, text, level, parent_seq) of rows (doc_id, seq, text, level).

    The parent is the nearest earlier heading of a smaller level, found by one running window for each level, so there is
    no join of headings with headings.
    """
    before = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    nearest = [F.last(F.when(F.col("level") == k, F.col("seq")), ignorenulls=True).over(before) for k in range(1, 6)]
    out = headings
    for k, column in enumerate(nearest, 1):
        out = out.withColumn(f"__at{k}", column)
    parent = F.greatest(F.lit(None).cast("int"), *(F.when(F.col("level") > k, F.col(f"__at{k}")) for k in range(1, 6)))
    return out.select("doc_id", "seq", "text", "level", parent.alias("parent_seq"))


def attach_headings(blocks: DataFrame) -> DataFrame:
    """(doc_id, seq, text): each run of headings is set before the next other block; a run at the end goes.

    ``blocks`` has doc_id, seq, text, is_heading. The group of a row is the number of other blocks from it to the end.
    """
    back = Window.partitionBy("doc_id").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    grouped = blocks.withColumn("g", F.sum((~F.col("is_heading")).cast("int")).over(back)).where("g > 0")
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return grouped.groupBy("doc_id", "g").agg(F.max("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")).select("doc_id", "seq", "text")


def merge_short_tails(blocks: DataFrame, max_chars: int = 40, max_blocks: int = 3) -> DataFrame:
    """(doc_id, page, seq, text): two to three short blocks at the end of a page, but not all of it, become one block."""
    back = Window.partitionBy("doc_id", "page").orderBy(F.desc("seq"), F.desc("text")).rowsBetween(Window.unboundedPreceding, 0)
    page = Window.partitionBy("doc_id", "page")
    long = (F.length(F.coalesce("text", F.lit(""))) > max_chars).cast("int")
    tail = blocks.withColumn("in_tail", F.max(long).over(back) == 0).withColumn("n_tail", F.sum(F.col("in_tail").cast("int")).over(page)).withColumn("n", F.count("*").over(page))
    merged = F.col("in_tail") & F.col("n_tail").between(2, max_blocks) & (F.col("n_tail") < F.col("n"))
    key = F.when(merged, F.lit(-1)).otherwise(F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("seq", "text")))
    parts = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))))
    out = tail.withColumn("k", key).groupBy("doc_id", "page", "k").agg(F.min("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"))
    return out.select("doc_id", "page", "seq", "text")


DOC_END = r"^(?:THE\s+)?END(?:\s+OF\s+DOCUMENT)?\.?$"


def cut_after_end(blocks: DataFrame) -> DataFrame:
    """Drops the pages behind an end marker that stands alone on one of a document's last three pages."""
    text = strip(F.col("text"))
    body = (text != "") & ~text.rlike(r"^\d+$") & ~text.rlike(r"^(?:\.\s*){3,}$")
    pages = blocks.groupBy("doc_id", "page").agg(F.sum(F.when(body, 1).otherwise(0)).alias("n"), F.max(F.when(body, text)).alias("only"))
    last = pages.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("page")))).where("r <= 3")
    ends = last.where((F.col("n") == 1) & F.col("only").rlike(DOC_END)).groupBy("doc_id").agg(F.max("page").alias("end_page"))
    return blocks.join(ends, "doc_id", "left").where("end_page is null or page <= end_page").drop("end_page")


def coalesce_sentences(rows: DataFrame) -> DataFrame:
    """(doc_id, seq, text): runs of (doc_id, seq, text) are joined until one ends a sentence; an open run at the end stays split."""
    order = Window.partitionBy("doc_id").orderBy("seq")
    ended = P.has_sentence_ending(F.col("text")).cast("int")
    marked = rows.withColumn("ended", ended).withColumn("prev", F.lag("ended").over(order)).withColumn("run", F.sum(F.coalesce("prev", F.lit(0))).over(order))
    closed = marked.withColumn("closes", F.max("ended").over(Window.partitionBy("doc_id", "run")))
    key = F.when(F.col("closes") == 1, F.lit(-1)).otherwise(F.col("seq"))
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    out = closed.withColumn("k", key).groupBy("doc_id", "run", "k").agg(F.min("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"))
    return out.select("doc_id", "seq", "text")


def merge_standalone_lists(rows: DataFrame) -> DataFrame:
    """(doc_id, seq, text): rows that begin with a list marker join the row before them."""
    order = Window.partitionBy("doc_id").orderBy("seq")
    starts = (P.starts_with_bullet(F.col("text")) | P.starts_with_number(F.col("text"))).cast("int")
    island = rows.withColumn("run", F.sum(F.lit(1) - starts).over(order))
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    out = island.groupBy("doc_id", "run").agg(F.min("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return out.select("doc_id", "seq", "text")


def budget_fold(rows: DataFrame, limit: int = 400) -> DataFrame:
    """(doc_id, chunk_seq, n_lines, n_words): lines are packed in order into chunks of at most ``limit`` words.

    A line's size is the larger of its words and its characters over 4.7, and a line over the limit is a chunk of its
    own. The decision looks at what has been gathered, so it is a fold inside the row of a document, without Python.
    """
    size = F.greatest(F.size(words(F.col("text"))), F.ceil(F.length("text") / 4.7).cast("int"))
    ordered = rows.select("doc_id", "seq", size.alias("n"), F.size(words(F.col("text"))).alias("w")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "n", "w"))).alias("lines"))
    box = "struct<lines:int,words:int,size:int>"
    empty = F.struct(F.array().cast(f"array<{box}>").alias("done"), F.lit(0).alias("lines"), F.lit(0).alias("words"), F.lit(0).alias("size"))
    current = lambda acc: F.struct(acc["lines"].alias("lines"), acc["words"].alias("words"), acc["size"].alias("size"))

    def step(acc: Column, x: Column) -> Column:
        full = (acc["lines"] > 0) & (acc["size"] + x["n"] > limit)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(current(acc)))).otherwise(acc["done"]).alias("done"),
            F.when(full, 1).otherwise(acc["lines"] + 1).alias("lines"),
            F.when(full, x["w"]).otherwise(acc["words"] + x["w"]).alias("words"),
            F.when(full, x["n"]).otherwise(acc["size"] + x["n"]).alias("size"),
        )

    boxes = F.aggregate("lines", empty, step, lambda acc: F.when(acc["lines"] > 0, F.concat(acc["done"], F.array(current(acc)))).otherwise(acc["done"]))
    return ordered.select("doc_id", F.posexplode(boxes).alias("chunk_seq", "b")).select("doc_id", "chunk_seq", F.col("b.lines").alias("n_lines"), F.col("b.words").alias("n_words"))
