"""Registration of queries, and pieces of SQL that several of them use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import BULLETS, WIDE_SPACES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TRIMMED = " \t\n\r\f" + WIDE_SPACES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def s_spaces(x: str) -> str:
    return f"translate({x}, '{WIDE_SPACES}', '{' ' * len(WIDE_SPACES)}')"


def s_words(x: str) -> str:
    return rf"list_filter(string_split(regexp_replace({s_spaces(x)}, '\s+', ' ', 'g'), ' '), lambda w: w <> '')"


def s_strip(x: str) -> str:
    return f"trim({x}, '{TRIMMED}')"


def s_rstrip(x: str) -> str:
    return f"rtrim({x}, '{TRIMMED}')"


def s_normalized(x: str) -> str:
    return rf"lower({s_strip(rf"regexp_replace({s_spaces(x)}, '\s+', ' ', 'g')")})"


def s_bullet(x: str) -> str:
    return rf"coalesce(regexp_matches({x}, '^[ \t]*(?:[{BULLETS}]|-\s)'), false)"


def s_number(x: str) -> str:
    return rf"coalesce(regexp_matches({x}, '^\d+[.)]'), false)"


def s_ended(x: str) -> str:
    return f"coalesce(right(rtrim({s_rstrip(x)}, '\"'')]}}'), 1) IN ('.', '?', '!'), false)"


def s_upper(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


def s_heading(x: str) -> str:
    """Whether a stripped text is a heading, by its words, case, first word and end."""
    from ..functions.predicates import ENDINGS, HEADING_STARTERS

    n, first = f"len({s_words(x)})", f"{s_words(x)}[1]"
    title = rf"(regexp_matches({x}, '\p{{L}}') AND NOT regexp_matches({x}, '(?:^|[^\p{{L}}])\p{{Ll}}') AND NOT regexp_matches({x}, '\p{{L}}\p{{Lu}}'))"
    starter = f"lower({first}) IN ({', '.join(repr(w) for w in HEADING_STARTERS)})"
    open_end = f"right({x}, 1) NOT IN ({', '.join(repr(e) for e in ENDINGS)})"
    return rf"coalesce(({n} BETWEEN 1 AND 8 AND {s_upper(x)}) OR ({open_end} AND ({n} BETWEEN 2 AND 3 OR ({n} BETWEEN 1 AND 8 AND {starter}) OR ({n} BETWEEN 2 AND 8 AND regexp_matches({first}, '^[\d.\-]+$')) OR ({n} BETWEEN 2 AND 10 AND {title}))), false)"


def s_heading_level(x: str) -> str:
    n, first = f"len({s_words(x)})", f"{s_words(x)}[1]"
    return rf"""CASE WHEN {n} <= 2 THEN 1 WHEN {s_upper(x)} THEN CASE WHEN {n} <= 4 THEN 1 ELSE 2 END WHEN lower({first}) IN ('chapter', 'part', 'book', 'volume') THEN 1
  WHEN lower({first}) IN ('section', 'appendix') THEN 2 WHEN regexp_matches({x}, '^\d+\.') THEN least(len(string_split({first}, '.')), 6) ELSE 3 END::INTEGER"""


LINES_SQL = f"""SELECT doc_id, CAST(seq AS INTEGER) AS seq, line AS text FROM (
  SELECT doc_id, unnest(range(len(l))) AS seq, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
  WHERE {s_strip('line')} <> ''"""
