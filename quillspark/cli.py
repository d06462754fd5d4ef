"""Command line: convert documents to JSON lines, list passes, list the spine of EPUB files."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import pipeline
from .sources import html, tables


def _documents(spark: SparkSession, path: str):
    if path.lower().endswith(".epub"):
        blocks = html.read_epubs(spark, path)
        lines = F.array_sort(F.collect_list(F.struct("spine", "seq", "text")))
        return blocks.groupBy("path").agg(F.array_join(F.transform(lines, lambda x: x["text"]), "\n\n").alias("text")).select(F.xxhash64("path").alias("doc_id"), "text")
    if path.lower().endswith(".jsonl"):
        return tables.read_jsonl(spark, path, "doc_id BIGINT, text STRING").where("_bad is null").select("doc_id", "text")
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillspark")
    verbs = parser.add_subparsers(dest="verb", required=True)
    convert = verbs.add_parser("convert")
    convert.add_argument("input")
    convert.add_argument("--out", required=True)
    convert.add_argument("--spec")
    convert.add_argument("--chunk-size", type=int)
    convert.add_argument("--overlap", type=int)
    convert.add_argument("--no-metadata", action="store_true")
    convert.add_argument("--max-chars", type=int)
    convert.add_argument("--trace", help="a folder for the output of every pass and the report of the run")
    verbs.add_parser("inspect")
    spines = verbs.add_parser("list-spines")
    spines.add_argument("input")
    args = parser.parse_args(argv)
    if args.verb == "inspect":
        print(json.dumps(sorted(pipeline.REGISTRY)))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.verb == "list-spines":
        blocks = html.read_epubs(spark, args.input)
        preview = F.min_by(F.left("text", F.lit(80)), "seq")
        for row in blocks.groupBy("spine", "location").agg(preview.alias("preview")).orderBy("spine").toLocalIterator():
            print(row.spine, row.location, row.preview)
        return 0
    given = {k: v for k, v in (("chunk_size", args.chunk_size), ("overlap", args.overlap)) if v is not None}
    overrides = ({"split_semantic": given} if given else {}) | ({"emit": {"max_chars": args.max_chars}} if args.max_chars else {})
    spec = pipeline.load_spec(args.spec, overrides or None)
    began = time.time()
    rows = _documents(spark, args.input)
    made = pipeline.run_traced(spec, rows, args.trace) if args.trace else pipeline.run(spec, rows)
    chunks = made.withColumnRenamed("meta", "metadata")
    tables.write_jsonl(chunks, args.out, not args.no_metadata)
    print(json.dumps({"passes": spec.pipeline, "seconds": round(time.time() - began, 2)}), file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
