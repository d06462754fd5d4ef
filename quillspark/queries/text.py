"""Queries of the cleaning functions, the classifiers and the text scores: one row for each document, block or chunk."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import predicates as P
from ..functions import text as T
from ._base import ORACLE_SQL, QUERIES, TRIMMED, s_ended, s_heading, s_heading_level, s_bullet, s_normalized, s_number, s_rstrip, s_spaces, s_strip, s_words, table

B = T.BULLETS
NB, ZW = T.NBSP_LIKE, T.ZERO_WIDTH
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{202C}\x{202D}]"


def _t(a: str, b: str, x: str) -> str:
    return f"translate({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"


def _r(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace(chr(39), chr(39) * 2)}', 'g')"


def _ligatures(x: str) -> str:
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


QUOTES = lambda x: _r(_r(_r(_t(*T.CURLY_QUOTES, _t(*T.CP1252_QUOTES, x)), r'([A-Za-z])"(\w)', r'\1 "\2'), '"{2,}', '"'), "'{2,}", "'")
HYPHENS = lambda x: _r(x, r"([A-Za-z]+)[-\x{2010}\x{2011}][ \t]*\n[ \t]*([a-z]+)", r"\1\2")
LINE = lambda keep: f"array_to_string(list_filter(string_split(text, chr(10)), lambda l: {keep}), chr(10))"
DOTLESS = r"CASE WHEN regexp_matches(l, '\.\s*\.') THEN " + s_rstrip(_r("l", r"\.\s*\..*$", "")) + " ELSE l END"
COUNT = lambda pattern, x="text": f"len(regexp_extract_all({x}, '{pattern}'))"
PARA, ITEM = T.PARAGRAPH, T.ITEM
SINGLE = _r(_r("text", r"\n{2,}", PARA), rf"\n([ \t]*{T.LIST_START})", ITEM + r"\1")
SINGLE = f"replace({_t(ITEM, chr(10), f'replace({SINGLE}, chr(10), chr(32))')}, '{PARA}', chr(10) || chr(10))"
QUOTE_COUNT = "(length(text) - length(replace(text, '\"', '')))"



def _place(sep: str) -> str:
    return f"(CASE WHEN contains(h, {sep}) THEN length(h) - length(list_extract(string_split(h, {sep}), -1)) - length({sep}) ELSE -1 END)"


#: name: (Column of documents.text, SQL of the same)
ON_DOCUMENTS = {
    "clean_nbsp": (T.normalize_nbsp, _r(_t(NB + ZW, " " * len(NB), "text"), " {2,}", " ")),
    "clean_newlines": (T.normalize_newlines, _r("text", "\r\n|\r| | ", "\n")),
    "clean_control": (T.remove_control_characters, _r("text", CONTROL, "")),
    "clean_whitespace": (T.consolidate_whitespace, s_strip(_r("text", r"[ \t\r\f\x0B]+", " "))),
    "clean_quotes": (T.normalize_quotes, QUOTES("text")),
    "clean_circumflex": (T.drop_stray_circumflex, _r("text", r"(^|\s)Â(\s)", r"\1 \2")),
    "clean_ligatures": (T.expand_ligatures, _ligatures("text")),
    "clean_soft_hyphens": (T.remove_soft_hyphens, "replace(text, '­', '')"),
    "clean_hyphen_breaks": (T.join_hyphenated, HYPHENS("text")),
    "clean_colon_lists": (T.collapse_colon_list_breaks, _r("text", rf":\n{{2,}}([ \t]*(?:[{B}]|- |\d))", ":\n\\1")),
    "clean_artifact_breaks": (T.collapse_artifact_breaks, _r("text", r"([._])\n([\p{L}_])", r"\1 \2")),
    "clean_piped_lines": (T.drop_piped_lines, LINE("NOT contains(l, '|')")),
    "clean_pipes": (T.replace_pipes, "translate(text, '|', ':')"),
    "clean_single_newlines": (T.collapse_single_newlines, SINGLE),
    "clean_footnote_marks": (T.normalize_inline_footnotes, _r(_t(*T.SUPERSCRIPTS, "text"), r"(^|[^0-9])\.([0-9]+)(\s|$)", r"\1[\2].\3")),
    "clean_glued_words": (T.split_glued_words, _r("text", "([a-z])([A-Z])", r"\1 \2")),
    "clean_dot_leaders": (T.strip_dot_leaders, f"array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda l: {DOTLESS}), lambda l: l <> ''), chr(10))"),
    "clean_number_suffixes": (
        T.merge_number_suffixes,
        rf"""(SELECT array_to_string(list_transform(ls, lambda l, i: CASE WHEN i = 1 THEN '' WHEN regexp_matches(l, '^\d+\.') AND {s_strip('ls[i - 1]')} <> '' AND NOT regexp_matches({s_strip('ls[i - 1]')}, '^\d+[.)]')
        AND right({s_strip('ls[i - 1]')}, 1) NOT IN (':', '.', '!', '?') AND NOT regexp_matches({s_strip('ls[i - 1]')}, '(?i)(?:^|\s)chapter$') THEN ' ' ELSE chr(10) END || l), '') FROM (SELECT string_split(text, chr(10)) AS ls))""",
    ),
    "clean_number_markers": (T.drop_number_markers, None),
    "clean_stray_bullets": (T.remove_stray_bullets, None),
    "clean_numbered_lists": (T.break_numbered_lists, None),
    "clean_wrapped_items": (
        T.join_wrapped_items,
        rf"""(SELECT array_to_string(list_transform(ls, lambda l, i: CASE WHEN i = 1 THEN l WHEN regexp_matches(ls[i - 1], '^\s*{T.MARKER}') AND {s_strip('l')} <> '' AND NOT regexp_matches(l, '^\s*{T.MARKER}')
        THEN ' ' || ltrim(l, '{TRIMMED}') ELSE chr(10) || l END), '') FROM (SELECT string_split(text, chr(10)) AS ls))""",
    ),
    "clean_paragraphs": (lambda c: T.merge_paragraphs(c, P.probable_heading), None),
    "clean_underscores": (T.remove_underscore_emphasis, None),
    "clean_leading_capital": (T.restore_leading_capital, None),
    "clean_paragraph": (T.clean_paragraph, None),
    "clean_text": (T.clean_text, None),
    "json_safe": (T.json_safe, None),
    "json_issues": (
        lambda c: F.array_join(T.json_issues(c), ","),
        f"""array_to_string(list_filter([CASE WHEN regexp_matches(text, '{CONTROL}') THEN 'control_characters' END, CASE WHEN {QUOTE_COUNT} % 2 <> 0 THEN 'unbalanced_quotes' END,
        CASE WHEN left({s_strip('text')}, 1) IN ('"', ',') THEN 'bad_start' END, CASE WHEN right({s_strip('text')}, 1) IN ('"', ',') THEN 'bad_end' END], lambda x: x IS NOT NULL), ',')""",
    ),
    "word_count": (lambda c: P.word_count(c).cast("bigint"), f"CAST({COUNT(r'[\p{L}\p{N}_]+')} AS BIGINT)"),
    "text_normalized": (P.normalized, s_normalized("text")),
    "leading_word": (P.leading_word, rf"lower(regexp_extract(ltrim({s_spaces('text')}), '^([\p{{L}}\p{{N}}_'']+)', 1))"),
    "continuation_lead": (P.starts_with_continuation, rf"lower(regexp_extract(ltrim({s_spaces('text')}), '^([\p{{L}}\p{{N}}_'']+)', 1)) IN ({', '.join(repr(w) for w in P.CONTINUATION_LEADS)})"),
    "sentence_ending": (P.has_sentence_ending, s_ended("text")),
    "mid_sentence_start": (P.starts_mid_sentence, f"{s_strip('text')} <> '' AND NOT regexp_matches({s_strip('text')}, '^[\"''(]*[A-Z0-9]')"),
    "coherent_text": (
        P.coherent,
        f"length({s_strip('text')}) >= 40 AND NOT ({s_strip('text')} <> '' AND NOT regexp_matches({s_strip('text')}, '^[\"''(]*[A-Z0-9]')) AND {s_ended('text')}",
    ),
    "last_sentence": (P.last_sentence, None),
    "first_list_number": (P.first_list_number, r"TRY_CAST(regexp_extract_all(text, '(?:^|\n)[ \t]*(\d+)[.)]\s', 1)[1] AS BIGINT)"),
    "last_list_number": (P.last_list_number, r"TRY_CAST(regexp_extract_all(text, '(?:^|\n)[ \t]*(\d+)[.)]\s', 1)[-1] AS BIGINT)"),
    "contains_bullet": (P.contains_bullet, rf"regexp_matches(text, '(?:^|\n)[ \t]*(?:[{B}]|-\s)')"),
    "unbalanced_quotes": (P.unbalanced_quotes, f"{QUOTE_COUNT} % 2 <> 0"),
    "extraction_issues": (
        lambda c: F.array_join(P.extraction_issues(c), ","),
        rf"""array_to_string(list_filter([CASE WHEN regexp_matches(text, '[a-z][A-Z]') THEN 'glued' END, CASE WHEN contains(text, '   ') THEN 'spaces' END, CASE WHEN {QUOTE_COUNT} % 2 <> 0 THEN 'quotes' END,
        CASE WHEN regexp_matches(text, '[A-Za-z]-\n[a-z]') THEN 'hyphen_break' END, CASE WHEN regexp_matches(text, '[\x{{FB00}}-\x{{FB06}}]') THEN 'ligature' END], lambda x: x IS NOT NULL), ',')""",
    ),
    "text_usable": (M.usable, f"CASE WHEN {s_strip('text')} <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
    "sentence_integrity": (
        M.sentence_integrity,
        rf"""(SELECT CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, 1.0::DOUBLE - sum((len({s_words('s')}) < 3)::INT + (regexp_matches(s, '^\p{{Ll}}'))::INT + (s LIKE '%-')::INT) / count(*)::DOUBLE), 6) END
        FROM (SELECT {s_strip('p')} AS s FROM (SELECT unnest(string_split(regexp_replace(text, '[.!?]+', '.', 'g'), '.')) AS p)) WHERE s <> '')""",
    ),
    "whitespace_quality": (
        M.whitespace_quality,
        rf"""CASE WHEN length(text) = 0 THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, 1.0::DOUBLE - least(1000.0::DOUBLE * ({COUNT(r'\n{3,}')} + {COUNT('[.!?][a-zA-Z]')} + {COUNT(' {3,}')}
        + len(list_filter(string_split(text, chr(10)), lambda l: right(l, 1) IN (' ', chr(9)))) + (contains(text, chr(9)) AND contains(text, '  '))::INT)::DOUBLE / length(text), 1.0::DOUBLE)), 6) END""",
    ),
    "ligature_quality": (
        M.ligature_quality,
        rf"CASE WHEN length(text) = 0 THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, 1.0::DOUBLE - least(1000.0::DOUBLE * ({COUNT(r'[\x{FB00}-\x{FB4F}]')} + {COUNT('[ﬀﬁﬂﬃﬄﬅﬆ﬈ﬗﬞ]')})::DOUBLE / length(text), 1.0::DOUBLE)), 6) END",
    ),
    "readability": (
        M.flesch_kincaid,
        rf"""CASE WHEN {COUNT("[A-Za-z]+")} = 0 THEN 0.0::DOUBLE ELSE round(0.39::DOUBLE * {COUNT("[A-Za-z]+")} / greatest({COUNT('[.!?]+')}, 1) + 11.8::DOUBLE * greatest({COUNT('(?i)[aeiouy]+')}, {COUNT("[A-Za-z]+")}) / {COUNT("[A-Za-z]+")} - 15.59::DOUBLE, 3) END""",
    ),
    "effective_words": (lambda c: F.greatest(T.n_words(c), F.ceil(F.length(c) / 4.7)).cast("bigint"), f"greatest(CAST(len({s_words('text')}) AS BIGINT), CAST(ceil(length(text) / 4.7::DOUBLE) AS BIGINT))"),
    "truncated_at_boundary": (
        M.truncate_chunk,
        f"""(SELECT CASE WHEN length(text) <= 8000 THEN text WHEN s > 5530 THEN {s_strip('left(text, s + 1)')} WHEN p > 5530 THEN {s_strip('left(text, p)')} WHEN w > 6320 THEN {s_strip('left(text, w)')} ELSE {s_strip('left(text, 7900)')} END
        FROM (SELECT greatest({', '.join(_place(f"'{m}' || {g}") for m in '.!?' for g in ("' '", 'chr(10)'))}) AS s, {_place('chr(10) || chr(10)')} AS p, {_place("' '")} AS w FROM (SELECT left(text, 7900) AS h)))""",
    ),
    "split_in_two": (lambda c: F.to_json(M.split_short(c)), None),
    "audit_hash": (lambda c: F.left(F.md5(c), F.lit(8)), "left(md5(text), 8)"),
}

#: The same of the lines of documents.
ON_LINES = {
    "line_heading": (P.is_heading, s_heading(s_strip("text"))),
    "line_heading_level": (P.heading_level, s_heading_level(s_strip("text"))),
    "line_probable_heading": (P.probable_heading, None),
    "line_bullet": (P.starts_with_bullet, s_bullet("text")),
    "line_number": (P.starts_with_number, s_number("text")),
    "line_caption": (P.is_caption, f"regexp_matches(lower({s_strip('text')}), '{P.CAPTION}')"),
    "line_footnote": (P.looks_like_footnote, rf"len({s_words(s_strip('text'))}) >= 3 AND (starts_with(lower({s_strip('text')}), 'footnote') OR regexp_matches({s_strip('text')}, '^(?:[0-9{T.SUPERSCRIPTS[0]}]{{1,3}}|[*†])\s+[A-Z]'))"),
    "line_artifact": (lambda c: P.is_page_artifact(c, F.lit(0)), None),
    "line_toc_entry": (
        P.is_toc_entry,
        rf"regexp_matches({s_strip('text')}, '^[A-Z][^\n]*\n\s*\d{{1,3}}$') OR (regexp_matches({s_strip('text')}, '^[A-Z][^\n]*\s+\d{{1,3}}$') AND length({s_strip('text')}) < 80 AND NOT contains(left({s_strip('text')}, greatest(length({s_strip('text')}) - 5, 0)), '.'))",
    ),
    "line_footer_title": (
        lambda c: P.standalone_footer(c)["title"],
        rf"CASE WHEN regexp_matches({s_strip('text')}, '^([A-Z][A-Za-z]*(?: [A-Za-z]+){{0,8}}) (\d{{1,3}})$') THEN regexp_extract({s_strip('text')}, '^([A-Z][A-Za-z]*(?: [A-Za-z]+){{0,8}}) (\d{{1,3}})$', 1) END",
    ),
    "line_markdown_level": (lambda c: F.length(F.regexp_extract(c, r"^(#{1,6})\s+(.*)$", 1)).cast("bigint"), r"CAST(length(regexp_extract(text, '^(#{1,6})\s+(.*)$', 1)) AS BIGINT)"),
    "line_list_like": (lambda c: P.starts_with_bullet(c) | P.starts_with_number(c), f"{s_bullet('text')} OR {s_number('text')}"),
}


def _register() -> None:
    from ..operators.blocks import lines_as_blocks
    from ._base import LINES_SQL

    for name, (column, sql) in ON_DOCUMENTS.items():
        QUERIES[name] = lambda spark, folder, c=column: table(spark, folder, "documents").select("doc_id", c(F.col("text")).alias("value"))
        if sql:
            ORACLE_SQL[name] = f"SELECT doc_id, {sql} AS value FROM documents"
    for name, (column, sql) in ON_LINES.items():
        QUERIES[name] = lambda spark, folder, c=column: lines_as_blocks(table(spark, folder, "documents")).select("doc_id", "seq", c(F.col("text")).alias("value"))
        if sql:
            ORACLE_SQL[name] = f"SELECT doc_id, seq, {sql} AS value FROM ({LINES_SQL})"


_register()
