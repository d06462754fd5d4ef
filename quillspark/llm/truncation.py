"""Texts cut off by a limit or in transfer (problem 2).

Method: per source, histograms of text length in characters and in bytes; a crowd of rows at the maximum is a limit, and
a row in that crowd whose text has no terminal punctuation is cut. Cuts in transfer leave no crowd, so the end of every
other text is judged by its form: a sign of omission, a broken character, a bare list marker or an abbreviation that can't
end a text is a cut; a terminator is none, an ellipsis counts as one; a list item and a line in the form of a heading are
whole as written; a text in a script that ends sentences without a terminator is whole unless a vowel that leads its
consonant comes last; any other open end is running text that was cut. No verdict depends on the words of other rows.

Defined results: null and blank texts are not cut. A null source is read from the chunk id; a null chunk id too leaves
the row to the judgement of its own end. Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut
from .sentences import BEFORE_NUMBER, BLANKS, NEVER_LAST

#: A crowd reaches so far below the maximum: a cut at a word boundary, or before a sign of omission, loses up to a word.
CROWD_WIDTH = 15
#: Least chunks, and least share of the source's chunks, that make a crowd a limit.
CROWD_ROWS, CROWD_SHARE = 3, 0.08
#: Signs, terminators and abbreviations at the end of a text are shorter than this; the patterns bound their blanks too.
TAIL = 60
#: A heading has no more characters than this.
HEADING_CHARS = 120

SIGN = r"(?:\[(?:\.{3}|…)\]?|>>|\(cont[^)\n]{0,20}\)?|\x{FFFD})$"
ELLIPSIS = r"(?:\.\.|…)[”’\"»」)]{0,4}$"
STOPS = tuple(".!?。！？｡।॥؟;;")
CLOSERS = "”’\"'»“』」）)] "
MARKER = r"(?:[•‣◦▪●○*\-]|\d{1,3}[.)])"
ITEM = rf"[ \t]*{MARKER}[ \t]"
BLOCK = rf"\n[ \t]*\n\s*|\n(?={ITEM})"
# Scripts whose sentences end without a terminator, and their vowels that lead a consonant; fixed values.
NO_TERMINATOR, LEADING_VOWELS = (("ก", "๎"), ("ກ", "ໝ")), tuple("เแโใไເແໂໃໄ")
# A word with a capital, a number, a small word within; words of scripts without case on both sides of a divider.
CAPITAL, NUMBER, SMALL = r"\p{Lu}[\p{L}\p{M}\p{N}'’\-]*+", r"\p{N}[\p{N}.,]*+", r"\p{Ll}{1,4}"
TITLE = rf"^(?:{CAPITAL}|{NUMBER})[:)]?(?:[  ]++(?:[–—:·/&]|(?:{CAPITAL}|{NUMBER}):?|{SMALL}))*?[  ]++(?:{CAPITAL}|{NUMBER})$"
CASELESS = r"[\p{Lo}\p{Lm}\p{M}\p{N}]++(?: [\p{Lo}\p{Lm}\p{M}\p{N}]++){0,2}"
DIVIDED = rf"^{CASELESS} ?[–—·|:] ?{CASELESS}$"


def book_of(source: Column, chunk_id: Column) -> Column:
    """The book of a row: its source or, where that is null or blank, the part of the chunk id before ``_p<page>_c<seq>``."""
    own = F.regexp_extract(chunk_id, r"^(.+)_p\d+_c\d+$", 1)
    return F.coalesce(F.nullif(F.trim(source), F.lit("")), F.nullif(own, F.lit("")))


def _last_in(text: Column, ranges: tuple[tuple[str, str], ...]) -> Column:
    """Whether the last character lies in one of some ranges; a comparison, since a search for it would read the whole text."""
    char = F.right(text, F.lit(1))
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | char.between(low, high)
    return inside


def _stops(tail: Column) -> Column:
    """Whether the end of a text is a terminator, behind any closing quotes, brackets and note mark."""
    bare = F.when(_last_in(tail, (("0", "9"), ("]", "]"))), F.regexp_replace(tail, r"\[\d{1,3}\]?$", "")).otherwise(tail)
    return F.right(F.rtrim(bare, F.lit(CLOSERS)), F.lit(1)).isin(*STOPS)


def is_title(block: Column) -> Column:
    """Whether a block has the form of a heading: words with capitals or numbers but for small ones within, two at least, or
    words of a script without case around a divider. Null is none."""
    short = F.length(block) <= HEADING_CHARS
    return F.coalesce(short & (block.rlike(TITLE) | block.rlike(DIVIDED)), F.lit(False))


def ending(text: Column) -> Column:
    """How a text ends: blank, sign, broken, ellipsis, stop, item, title, unmarked (no terminator in its script) or open."""
    trimmed = F.rtrim(text, F.lit(BLANKS))
    never = "|".join(w.replace(".", r"\.") for w in (*NEVER_LAST, *BEFORE_NUMBER))
    tail = F.right(trimmed, F.lit(TAIL))
    paragraph = F.substring_index(trimmed, "\n\n", -1)
    block = F.when(F.contains(paragraph, F.lit("\n")), F.element_at(F.split(paragraph, BLOCK), -1)).otherwise(paragraph)
    return (
        F.when(F.coalesce(tail, F.lit("")) == "", "blank")
        .when(tail.rlike(SIGN), "sign")
        .when(tail.rlike(ELLIPSIS), "ellipsis")
        .when(tail.rlike(rf"\n[ \t]{{0,40}}{MARKER}$") | tail.rlike(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{never}|\p{{Lu}})\.$"), "broken")
        .when(_stops(tail), "stop")
        .when(_last_in(tail, NO_TERMINATOR) & ~F.right(tail, F.lit(1)).isin(*LEADING_VOWELS), "unmarked")
        .when(block.rlike("^" + ITEM), "item")
        .when(is_title(F.trim(block)), "title")
        .otherwise("open")
    )


def _features(df: DataFrame, id_col: str, text_col: str, chunk_col: str, source: Column) -> DataFrame:
    """What the judgement needs of each row, without the text."""
    raw = F.col(text_col)
    return df.select(
        F.col(id_col).alias("__id"), F.col(chunk_col).cast("string").alias("__chunk"), book_of(source, F.col(chunk_col)).alias("__book"),
        F.length(raw).alias("__chars"), F.octet_length(raw).alias("__bytes"), ending(raw).alias("__end"),
    )


def limits(features: DataFrame) -> DataFrame:
    """(book, measure, low, near, high): the crowds at the maximum length, in characters or bytes, of each source.

    A length is counted once for a chunk. The histogram has a row for each book and length, so nothing here is wider than
    a book's different lengths. ``low`` to ``high`` is the crowd. A book without one, whose maximum lies up to the width of
    a crowd below a length at which two other books or more have their exact limit, has that limit as well: rows of the
    exact length are at it (``low``), and from ``near`` on those that end in an ellipsis.
    """
    sizes = F.expr("stack(2, 'chars', __chars, 'bytes', __bytes) as (measure, n)")
    hist = (
        features.where("__book is not null and __chars > 0").select("__book", "__chunk", sizes).distinct().groupBy("__book", "measure", "n").agg(F.count("*").alias("rows"))
    )
    top = hist.groupBy("__book", "measure").agg(F.max("n").alias("high"), F.sum("rows").alias("all_rows"))
    from_top = F.col("high") - F.col("n")
    rows_where = lambda condition: F.sum(F.when(condition, F.col("rows")).otherwise(0))
    crowd = (
        hist.join(top, ["__book", "measure"])
        .groupBy("__book", "measure", "high", "all_rows")
        .agg(
            rows_where(from_top <= CROWD_WIDTH).alias("crowd"),
            rows_where(from_top == 0).alias("exact"),
            rows_where((from_top > CROWD_WIDTH) & (from_top <= 4 * CROWD_WIDTH)).alias("below"),
        )
    )
    own = (F.col("crowd") >= CROWD_ROWS) & (F.col("crowd") >= CROWD_SHARE * F.col("all_rows")) & (F.col("crowd") > F.col("below"))
    crowd = cut(crowd.select("__book", "measure", "high", "exact", own.alias("own")))  # a row for each book, read twice
    known = crowd.where(F.col("own") & (F.col("exact") >= CROWD_ROWS)).groupBy("measure", F.col("high").alias("limit")).agg(F.count("*").alias("books")).where("books >= 2")
    reached = crowd.where("not own").select("__book", "measure", "high", F.explode(F.sequence(F.col("high"), F.col("high") + CROWD_WIDTH)).alias("limit"))
    reached = reached.join(known.select("measure", "limit"), ["measure", "limit"]).groupBy("__book", "measure", "high").agg(F.min("limit").alias("limit"))
    of_others = reached.select("__book", "measure", F.col("limit").alias("low"), (F.col("limit") - CROWD_WIDTH).alias("near"), F.col("limit").alias("high"))
    low = F.col("high") - CROWD_WIDTH
    return crowd.where("own").select("__book", "measure", low.alias("low"), low.alias("near"), "high").unionByName(of_others)


def truncated(df: DataFrame, id_col: str = "row_id", text_col: str = "text", chunk_col: str = "chunk_id", source: Column | None = None) -> DataFrame:
    """One row per row of ``df``: its id, ``book``, ``ending`` and ``is_cut``."""
    source = F.col("metadata.source") if source is None else source
    features = cut(_features(df, id_col, text_col, chunk_col, source))  # read twice; it holds no text
    at = limits(features).groupBy("__book").agg(
        *(F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}") for m in ("chars", "bytes") for c in ("low", "near", "high"))
    )
    within = lambda c: F.coalesce(
        F.col("__chars").between(F.col(f"chars_{c}"), F.col("chars_high")), F.lit(False)
    ) | F.coalesce(F.col("__bytes").between(F.col(f"bytes_{c}"), F.col("bytes_high")), F.lit(False))
    end = F.col("__end")
    is_cut = (
        F.when(end.isin("sign", "broken", "open"), True)
        .when(end.isin("item", "title", "unmarked"), within("low"))
        .when(end == "ellipsis", within("near"))
        .otherwise(False)
    )
    return features.join(at, "__book", "left").select(F.col("__id").alias(id_col), F.col("__book").alias("book"), end.alias("ending"), is_cut.alias("is_cut"))


def truncation_shares(cut: DataFrame) -> DataFrame:
    """(book, n_rows, n_cut, cut_share) of each source; rows without a source and a readable chunk id count as one."""
    return cut.groupBy("book").agg(F.count("*").alias("n_rows"), F.count_if("is_cut").alias("n_cut")).withColumn("cut_share", F.col("n_cut") / F.col("n_rows"))
