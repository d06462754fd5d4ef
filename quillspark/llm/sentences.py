"""Sentence boundaries across languages and scripts (problem 1).

Method: full stops that end no sentence (decimals, addresses, initials, abbreviations, list numbers) are masked by a
private-use placeholder, terminators are found by script-specific patterns, a private-use separator is put behind each,
and the text is split there. Placeholders have the length of what they mask, so the offsets of the pieces are those of
the original text and a unit is restored exactly by ``substring``. Everything is a JVM expression on one row: no
shuffle, no Python.

Defined results: a null, empty or blank text has no unit. Private-use characters that occur in the text itself are
neutral characters. Repeated rows give repeated units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK, SEP, NEUTRAL = "\ue000", "\ue00f", "\ue0ff"
# Terminators outside Latin-1 stand as control characters while the patterns run: a class within Latin-1 is a bit set to
# the regular-expression engine, which makes the search about three times as fast.
PROXY = {"…": "\x86", "。": "\x87", "！": "\x88", "？": "\x89", "।": "\x8a", "॥": "\x8b", "؟": "\x8c", "｡": "\x8d", "\u037e": "\x8e"}
# White space in the sense of Unicode; fixed values.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
# Abbreviations after which a sentence never ends; fixed values.
NEVER_LAST = (
    "Dr Mr Mrs Ms Prof St Messrs Mt Gen Col Capt Lt Sgt Rev Hon Sr Sra Srta Mme Mlle Hr Hrn Frl Dipl Ing "
    "e.g i.e cf Cf vs approx viz ca Vgl vgl bzw Bd Nr Abb Kap Tab vol Vol vols pp Fig Figs núm Núm pág págs Pág "
    "σελ Βλ βλ αρ κ См см рис Рис стр гл напр им тел डॉ पृ श्री ص د พ.ศ ค.ศ ดร"
).split()
# Abbreviations of several parts, the parts divided by a space; fixed values.
NEVER_LAST_PARTS = ("z. B", "d. h", "u. a", "p. ex", "p. ej", "т. е", "т. к", "π.χ", "δηλ", "i. e", "e. g")
# Words that are abbreviations only before a number; fixed values.
BEFORE_NUMBER = "no No art Art fig p S s f ch Ch sec Sec n Nos nos".split()
EDGE = r"(?<![\p{L}\p{M}\p{N}])"
GERMAN_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
# Speaker phrases that run on from a closed quotation; fixed values.
ARABIC_SAID = "قال|قالت|سأل|سألت|أجاب|أجابت|صاح|صاحت|هتف|أضاف"
KOREAN_SAID = "하고|라고|라며|라는|이라고|이라며|고 "
HINDI_SAID = r"[^\s।]+(?: [^\s।]+){0,2} ने (?:कहा|पूछा|बताया|बोला)"
CHINESE_SAID = r"[^，。！？：；、\s“”「」]{1,8}(?:说|问|道|答|喊|叫)[。，！]"
JAPANESE_SAID = "と|って"


def _abbreviations() -> str:
    """Look-behinds for the abbreviations, one for each length: a fixed length is checked at one place only."""
    by_length: dict[int, list[str]] = {}
    for word in (*NEVER_LAST, *NEVER_LAST_PARTS):
        by_length.setdefault(len(word), []).append(word.replace(".", "[.]"))
    return "|".join(rf"(?<={EDGE}(?:{'|'.join(words)})\.)" for _, words in sorted(by_length.items()))


def mask_pattern() -> str:
    """Matches a full stop that ends no sentence."""
    return (
        r"\.(?:"
        r"(?<=[\p{L}\p{N}]\.)(?=[\p{Ll}\p{N}])(?!\p{Ll}\p{Lu}\p{Ll})"  # decimals, versions, addresses, e.g
        rf"|(?<={EDGE}\p{{Lu}}\.)"  # initials
        rf"|(?<={EDGE}[\p{{Ll}}\p{{Lo}}]\.)(?=\p{{L}}|\s[\p{{Ll}}\d]|\s?\p{{Lu}}\.)"  # dotted abbreviations
        r"|(?<=\d\.)(?:"
        r"(?<=(?:^|\n)[ \t]{0,8}(?:[•‣◦▪●○*·\-–] ){0,2}\d{1,3}\.)(?=[ \t])"  # numbers of list items
        rf"|(?<=[^\d]\d{{1,2}}\.)(?=\s(?:{GERMAN_MONTHS})))"  # ordinals
        rf"|(?<=[\p{{L}}\p{{M}}]\.)(?=[ \u00a0\n][^\n])(?:{_abbreviations()})"
        rf"|(?=\s\d)(?:(?<={EDGE}(?:{'|'.join(w for w in BEFORE_NUMBER if len(w) == 1)})\.)|(?<={EDGE}(?:{'|'.join(w for w in BEFORE_NUMBER if len(w) > 1)})\.))"
        r")"
    )


def boundary_pattern() -> str:
    """Matches what ends a unit, with the quotes, brackets and note marks that close it."""
    stop = r"(?:[.!?…؟]|(?<=[\u0370-\u03ff\u1f00-\u1fff])[;\u037e])"
    closers = (
        r"(?:[»›](?![\p{L}\p{N}])|[ \u00a0\u202f][»›](?![\p{L}\p{N}])|[”’\"'](?!\p{L})|[)\]}]|“(?![\p{L}¿¡])"
        r"|\[\d{1,3}\]|[¹²³⁰-⁹†‡*])*+"
    )
    cjk = r"\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    cjk_closers = r"[”’」』）)】》〉\"'\]]*+"
    cjk_said = rf"(?!(?<=[”’」』\"'])(?:{JAPANESE_SAID}|{CHINESE_SAID}))"
    opener = r"[“\"'‘«„‹(\[{¿¡—–\-「『（ \u00a0\u202f]*+"
    first = r"(?:[\p{Lu}\p{Lt}\p{Lo}\p{N}$€£]|\p{Ll}\p{Lu})"
    glued = r"(?:[“\"'‘«„(¿¡—]{0,3}\p{Lu}[\p{Ll}.\ue000’']|\p{Ll}\p{Lu}\p{Ll})"
    after_quote = rf"(?!(?<=[”’»\"'“])\s*(?:{ARABIC_SAID}|{KOREAN_SAID}|{HINDI_SAID}))"
    marker = rf"[ \t]*(?:[•‣◦▪●○*·\-]|\d{{1,3}}[.){MASK}](?!\s(?:{GERMAN_MONTHS}))|[a-z]\)|\(\w{{1,3}}\))[ \t]"
    thai = r"\u0e01-\u0e4e"
    pattern = (
        r"(?=[.!?…؟;\u037e।॥。！？｡ \n])(?:"
        # Thai: a space between words, but not beside a numeral or an abbreviation
        rf" ++(?:(?<=[{thai}][”’\"')]? {{1,9}})(?=[“‘\"'(]?[{thai}\p{{IsLatin}}])|(?=[“‘\"'(]?[{thai}])(?<=\p{{IsLatin}} {{1,9}}))(?![{thai}]{{1,4}}[.{MASK}])"
        r"|\n(?:[ \t\u00a0]*\n\s*"
        rf"|(?={marker}))"
        # an ellipsis: only before a new sentence, and never by itself in scripts without case
        rf"|(?:\.{{2,}}|…+){closers}(?=\s+{opener}(?:[\p{{Lu}}\p{{Lt}}]|\p{{Ll}}\p{{Lu}})|{glued})"
        rf"|(?!\.\.|…+[^.!?…]){stop}++{closers}(?:(?=\s+{opener}{first}|\s*\n\s*\n){after_quote}"
        rf"|(?<![^\p{{Ll}}]\p{{L}}[.!?])(?={glued}))"
        rf"|[!?]++{cjk_closers}(?=[{cjk}]){cjk_said}"
        rf"|[।॥]++{closers}{after_quote}"
        rf"|[。！？｡]++{cjk_closers}{cjk_said}"
        r")"
    )
    for char, proxy in PROXY.items():
        pattern = pattern.replace(char, proxy).replace("\\u037e", proxy if char == "\u037e" else "\\u037e")
    return pattern


def masked(text: Column) -> Column:
    """The text with full stops that end no sentence masked; same length."""
    own = MASK + SEP + "".join(PROXY.values())
    foreign = F.contains(text, F.lit(MASK)) | F.contains(text, F.lit(SEP)) | text.rlike(r"[\x86-\x8e]")
    clean = F.when(foreign, F.translate(text, own, NEUTRAL * len(own))).otherwise(text)
    for char, proxy in PROXY.items():
        clean = F.replace(clean, F.lit(char), F.lit(proxy))
    return F.regexp_replace(clean, F.lit(mask_pattern()), F.lit(MASK))


def placed(pieces: Column) -> Column:
    """(sent_start, sent_end) of the pieces that hold more than white space. Both are one number until the end, since the state of an
    aggregate is copied at each step."""

    def place(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        start, stop = end - F.length(F.ltrim(piece, F.lit(BLANKS))), acc["at"] + F.length(F.rtrim(piece, F.lit(BLANKS)))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.shiftleft(start.cast("bigint"), 32) + stop)).alias("out"))

    low = F.lit(0xFFFFFFFF)
    both = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<bigint>").alias("out")), place, lambda acc: F.filter(acc["out"], lambda x: x.bitwiseAND(low) > F.shiftright(x, 32)))
    return F.transform(both, lambda x: F.struct(F.shiftright(x, 32).cast("int").alias("sent_start"), x.bitwiseAND(low).cast("int").alias("sent_end")))


def _marked(text: Column) -> Column:
    """The masked text with a separator behind each boundary and the white space that follows it."""
    return F.regexp_replace(masked(text), F.lit(f"(?:{boundary_pattern()})[{BLANKS}]*+"), F.lit(f"$0{SEP}"))


def sentence_spans(text: Column) -> Column:
    """ARRAY<STRUCT<sent_start, sent_end>> of the units of a text: code points from 0, ends exclusive, in order."""
    return placed(F.split(_marked(text), SEP))


def sentence_pieces(text: Column) -> Column:
    """The pieces of a text that ``placed`` takes, each a unit with the white space up to the next one, to be compared with one another
    only: terminators outside Latin-1 stand as the control characters of ``PROXY``, and private-use characters are neutral. Both are so
    wherever the character stands, so equal stretches of two texts stay equal."""
    return F.split(F.replace(_marked(text), F.lit(MASK), F.lit(".")), SEP)


def sentences(df: DataFrame, id_col: str = "row_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per unit: the id, ``sent_start``, ``sent_end`` and, if asked for, ``sent_index`` and ``sentence``."""
    base = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text")).where(F.col("__text").isNotNull() & (F.col("__text") != ""))
    spans = base.select(id_col, *(["__text"] if with_text else []), F.posexplode(sentence_spans(F.col("__text"))).alias("sent_index", "__u"))
    cols = [F.col(id_col), F.col("__u.sent_start").alias("sent_start"), F.col("__u.sent_end").alias("sent_end")]
    if with_text:
        cols += [F.col("sent_index"), F.expr("substring(__text, __u.sent_start + 1, __u.sent_end - __u.sent_start)").alias("sentence")]
    return spans.select(*cols)
