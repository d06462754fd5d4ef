"""Blocks of XHTML pages and of EPUB archives.

Two readers of one page: a pattern reader that stays in the JVM, and a parser in an Arrow function that follows nesting.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_TAGS = ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6")
# Entities that both readers replace by patterns; fixed values.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
_ELEMENT = r"(?is)<(?:p|li|h[1-6])(?:\s[^>]*)?>.*?</(?:p|li|h[1-6])>"
_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>"


def _plain(html: Column) -> Column:
    text = F.regexp_replace(html, r"<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def _sql_plain(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, char in ENTITIES:
        x = f"replace({x}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return rf"trim(regexp_replace({x}, '[ \t\r\n]+', ' ', 'g'))"


HTML_SQL = f"""WITH e AS (SELECT page_id, unnest(l) AS e, unnest(range(len(l)))::INTEGER AS seq FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '{_DROPPED}', '', 'g'), '{_ELEMENT}', 0) AS l FROM pages))
  SELECT page_id, seq, lower(regexp_extract(e, '^<(\\w+)', 1)) AS tag, {_sql_plain('e')} AS text FROM e WHERE {_sql_plain('e')} <> ''"""


def html_blocks_by_pattern(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, seq, tag, text) of paragraphs, list items and headings, without comments, scripts, styles and navigation."""
    found = F.regexp_extract_all(F.regexp_replace(F.col(html_col), _DROPPED, ""), F.lit(_ELEMENT), F.lit(0))
    rows = pages.select(F.col(id_col), F.posexplode(found).alias("seq", "e"))
    return rows.select(id_col, "seq", F.lower(F.regexp_extract("e", r"^<(\w+)", 1)).alias("tag"), _plain(F.col("e")).alias("text")).where("text <> ''")


class _Blocks(HTMLParser):
    """Collects (tag, list kind, text) of block elements; text of a nested block belongs to the inner one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str | None, str]] = []
        self.open: list[tuple[str, str | None, list[str]]] = []
        self.lists: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "nav"):
            self.silent += 1
        elif tag in ("ol", "ul"):
            self.lists.append("numbered" if tag == "ol" else "bullet")
        elif tag in BLOCK_TAGS:
            if tag == "p" and self.open and self.open[-1][0] == "p":
                self._close()
            self.open.append((tag, (self.lists[-1] if self.lists else "bullet") if tag == "li" else None, []))
        elif tag == "br" and self.open:
            self.open[-1][2].append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "nav"):
            self.silent = max(0, self.silent - 1)
        elif tag in ("ol", "ul") and self.lists:
            self.lists.pop()
        elif tag in BLOCK_TAGS and any(t == tag for t, _, _ in self.open):
            while self.open and self._close() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.open and not self.silent:
            self.open[-1][2].append(data)

    def _close(self) -> str:
        tag, kind, parts = self.open.pop()
        text = " ".join("".join(parts).split())
        if text:
            self.out.append((tag, kind, text))
        return tag

    def blocks(self, html: str) -> list[tuple[str, str | None, str]]:
        self.feed(html)
        self.close()
        while self.open:
            self._close()
        return self.out


def html_blocks(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, seq, tag, list_kind, text): the blocks of each page by a parser. A null page has none."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, i, *b) for key, html in zip(batch["id"], batch["html"]) for i, b in enumerate(_Blocks().blocks(html))]
            yield pd.DataFrame(rows, columns=["id", "seq", "tag", "list_kind", "text"])

    source = pages.where(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return source.mapInPandas(run, f"id {kind}, seq int, tag string, list_kind string, text string").withColumnRenamed("id", id_col)


def spine_previews(pages: DataFrame) -> DataFrame:
    """(page_id, source, location, preview) of pages with a url; previews over 80 characters end in three dots at 80."""
    text = F.trim(F.regexp_replace(F.regexp_replace("html", "<[^>]*>", " "), r"[ \t\r\n]+", " "))
    rows = pages.where("url is not null").select("page_id", "url", text.alias("t"))
    part = lambda k: F.regexp_extract("url", r"^book:([^/]*)/(.*)$", k)
    return rows.select("page_id", part(1).alias("source"), part(2).alias("location"), F.when(F.length("t") > 80, F.concat(F.left("t", F.lit(77)), F.lit("..."))).otherwise(F.col("t")).alias("preview"))


def _spine(data: bytes) -> list[tuple[str, str]]:
    """(name, xhtml) of the spine of an EPUB archive in reading order."""
    import posixpath
    import re
    from xml.etree import ElementTree as ET

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("META-INF/container.xml"))
        opf = next(e.attrib["full-path"] for e in root.iter() if e.tag.endswith("rootfile"))
        package = ET.fromstring(z.read(opf))
        items = {e.attrib["id"]: e.attrib["href"] for e in package.iter() if re.sub(r"^\{.*\}", "", e.tag) == "item"}
        order = [e.attrib["idref"] for e in package.iter() if re.sub(r"^\{.*\}", "", e.tag) == "itemref"]
        names = [posixpath.normpath(posixpath.join(posixpath.dirname(opf), items[i])) for i in order if i in items]
        return [(n, z.read(n).decode("utf-8", "replace")) for n in names]


def read_epubs(spark: SparkSession, path: str, exclude_spines: set[int] = frozenset()) -> DataFrame:
    """(path, spine, location, seq, tag, list_kind, text) of all EPUB files below a path; spines count from 1.

    A file is one row of the binary reader, so a book is read by one task. Archives that can't be read have no block.
    """
    skip = frozenset(exclude_spines)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, data in zip(batch["path"], batch["content"]):
                try:
                    spine = _spine(data)
                except (zipfile.BadZipFile, KeyError, StopIteration, SyntaxError):
                    continue
                for i, (location, html) in enumerate(spine, 1):
                    if i not in skip:
                        rows += [(name, i, location, k, *b) for k, b in enumerate(_Blocks().blocks(html))]
            yield pd.DataFrame(rows, columns=["path", "spine", "location", "seq", "tag", "list_kind", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, spine int, location string, seq int, tag string, list_kind string, text string")
