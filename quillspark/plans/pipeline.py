"""A pipeline is an ordered list of named passes with options; running it composes DataFrame transforms into one plan.

Nothing is executed until the result is used, so Catalyst sees all passes at once.
"""

from __future__ import annotations

import json
import os
import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..operators.emitting import rows_for_output
from ..operators.folding import chunks_of_texts
from ..operators.provenance import with_metadata
from ..sources.tables import snapshot

Pass = Callable[..., DataFrame]
REGISTRY: dict[str, Pass] = {}


@dataclass(frozen=True)
class Spec:
    """The passes in order, and options by pass."""

    pipeline: tuple[str, ...]
    options: dict[str, dict[str, Any]] = field(default_factory=dict)


def register(name: str) -> Callable[[Pass], Pass]:
    def add(f: Pass) -> Pass:
        REGISTRY[name] = f
        return f

    return add


@register("text_clean")
def text_clean(df: DataFrame) -> DataFrame:
    return T.with_once(df, "text", T.clean_text(F.col("text")))


@register("detect_page_artifacts")
def detect_page_artifacts(df: DataFrame) -> DataFrame:
    """Lines that are headers or footers go, inside the row: a filter over the array of lines."""
    keep = lambda line: ~P.is_page_artifact(line, F.lit(0)) | P.starts_with_number(line)
    lines = F.filter(F.split("text", "\n"), lambda line: (line == "") | keep(line))
    return T.with_once(df, "text", F.array_join(lines, "\n"))


@register("list_detect")
def list_detect(df: DataFrame) -> DataFrame:
    return df.withColumn("has_list", P.contains_bullet(F.col("text")) | F.col("text").rlike(r"(?:^|\n)\d+[.)] "))


@register("heading_detect")
def heading_detect(df: DataFrame) -> DataFrame:
    return df.withColumn("headings", F.filter(F.split("text", "\n"), lambda line: P.is_heading(line)))


@register("split_semantic")
def split_semantic(df: DataFrame, chunk_size: int = 400, overlap: int = 50) -> DataFrame:
    """(doc_id, chunk, n_words, text): lines packed into chunks that headings and lists shape. The headings are those that
    ``heading_detect`` found, if it ran. Lines above the size are cut into stretches of it first, and each chunk but the first begins
    with the last ``overlap`` words of the one before, unless a heading begins it."""
    found = (lambda line: F.array_contains("headings", line)) if "headings" in df.columns else P.is_heading
    out = chunks_of_texts(df, chunk_size, overlap, found)
    return out.select("doc_id", "chunk", T.n_words(F.col("text")).alias("n_words"), "text")


@register("emit")
def emit(df: DataFrame, min_words: int = 1, max_chars: int = 8000) -> DataFrame:
    """Rows for output with metadata; a chunk above ``max_chars`` becomes numbered parts."""
    rows = df.where(T.n_words(F.col("text")) >= min_words)
    if "chunk" not in rows.columns:
        return with_metadata(rows)
    parts = rows_for_output(rows.select(F.struct("doc_id", "chunk").alias("at"), "text"), "at", max_chars)
    return with_metadata(parts.select("at.doc_id", "at.chunk", "chunk_part", T.n_words(F.col("text")).alias("n_words"), "text"))


def default_spec() -> Spec:
    return Spec(("detect_page_artifacts", "text_clean", "list_detect", "heading_detect", "split_semantic", "emit"))


def load_spec(path: str | None = None, overrides: dict[str, dict[str, Any]] | None = None) -> Spec:
    """A YAML file, then ``STEP__key=value`` of the environment, then ``overrides``; later ones win, by pass and key."""
    data: dict[str, Any] = {}
    if path:
        import yaml

        with open(path, encoding="utf-8") as f:
            data = yaml.safe_load(f) or {}
    steps = tuple(data.get("pipeline") or default_spec().pipeline)
    options = {k: dict(v or {}) for k, v in (data.get("options") or {}).items()}
    for key, value in os.environ.items():
        step, _, name = key.lower().partition("__")
        if name and step in steps:
            options.setdefault(step, {})[name] = int(value) if value.lstrip("-").isdigit() else value
    for step, values in (overrides or {}).items():
        options[step] = options.get(step, {}) | values
    for step in options:
        if step not in steps:
            warnings.warn(f"options for a pass that isn't in the pipeline: {step}", stacklevel=2)
    return Spec(steps, options)


def check(spec: Spec) -> None:
    """KeyError for unknown passes; ValueError where text is cleaned after it was split or two parsers are named."""
    unknown = [s for s in spec.pipeline if s not in REGISTRY]
    if unknown:
        raise KeyError(f"unknown passes: {unknown}")
    order = {s: i for i, s in enumerate(spec.pipeline)}
    if "text_clean" in order and "split_semantic" in order and order["text_clean"] > order["split_semantic"]:
        raise ValueError("text_clean must come before split_semantic")


def run(spec: Spec, df: DataFrame) -> DataFrame:
    """The passes of a specification over documents (doc_id, text, ...)."""
    check(spec)
    out = df.select("doc_id", "text").where("text is not null")
    for step in spec.pipeline:
        out = REGISTRY[step](out, **spec.options.get(step, {}))
    return out


def versions() -> dict[str, str]:
    """What a run depends on, and the settings of the environment that change passes."""
    import platform

    import pyspark

    settings = {k: v for k, v in os.environ.items() if "__" in k and k.lower().partition("__")[0] in REGISTRY}
    return {"python": platform.python_version(), "pyspark": pyspark.__version__, **settings}


def run_traced(spec: Spec, df: DataFrame, run_dir: str) -> DataFrame:
    """Like ``run``, but each pass is written to ``run_dir`` and timed; ``run_report`` there has a JSON line for the run. A pass reads what
    the one before wrote, so a run can be taken up again behind any of them."""
    check(spec)
    spark, out, report = df.sparkSession, snapshot(df.select("doc_id", "text").where("text is not null"), run_dir, "input"), []
    for step in spec.pipeline:
        began = time.time()
        out = snapshot(REGISTRY[step](out, **spec.options.get(step, {})), run_dir, step)
        report.append({"name": step, "seconds": round(time.time() - began, 3), "rows": out.count()})
    line = json.dumps({"passes": report, "options": spec.options, "versions": versions()})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(run_dir, "run_report"))
    return out


def replay(spec: Spec, spark: SparkSession, run_dir: str, after: str) -> DataFrame:
    """The passes behind ``after``, over what that pass wrote in a traced run."""
    at = spec.pipeline.index(after) + 1
    out = spark.read.parquet(os.path.join(run_dir, after))
    for step in spec.pipeline[at:]:
        out = REGISTRY[step](out, **spec.options.get(step, {}))
    return out


def duplicates_by_pass(spec: Spec, spark: SparkSession, run_dir: str) -> dict[str, int]:
    """The rows of each written pass whose text another row of it has; the first pass with any brought them in."""
    found = {}
    for step in ("input", *spec.pipeline):
        per = spark.read.parquet(os.path.join(run_dir, step)).groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("n"))
        found[step] = per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first().d
    return found


__all__ = ["REGISTRY", "Spec", "check", "default_spec", "duplicates_by_pass", "load_spec", "register", "replay", "run", "run_traced", "versions"]
