"""Searches over all rows and windows: odd ids against SQL, and what they shuffle."""

import random

import duckdb
import numpy as np
import pytest

from quillspark.operators.searching import window_starts
from quillspark.queries import ORACLE_SQL, QUERIES


def shuffled_rows(node):
    """Rows written to shuffles by a plan that has run."""
    name, metrics, total = node.nodeName(), node.metrics(), 0
    if name == "ReusedExchange":
        return 0
    if metrics.contains("shuffleRecordsWritten"):
        total += metrics.apply("shuffleRecordsWritten").value()
    inside = [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [node.plan()] if "QueryStage" in name else []
    return total + sum(shuffled_rows(x) for x in [*inside, *(node.children().apply(i) for i in range(node.children().size()))])


def compared(spark, folder, name, table):
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    df = QUERIES[name](spark, str(folder))
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(ORACLE_SQL[name])
    at = [[d[0] for d in result.description].index(c) for c in df.columns]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(rows, key=key) == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=key)
    return rows, shuffled_rows(df._jdf.queryExecution().executedPlan())


COMMON = [f"common{i}" for i in range(12)]


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    """2,000 chunks that hold the same words, among them equal texts, an id of several rows, and rows without an id, token or text."""
    rng = random.Random(2)
    texts = [" ".join(rng.sample(COMMON * 2, 20) + [f"own{i // 2}"] * (i % 3)) for i in range(2000)]
    rows = [(i, f"b{i // 40}_p1_c{i % 40}", i % 40, t) for i, t in enumerate(texts)]
    rows += [(7, "x_p1_c1", 1, texts[7]), (7, "y_p1_c1", 1, texts[7] + " common1"), (None, "z_p1_c1", 1, texts[100]), (8001, "z_p1_c2", 2, None), (8002, "z_p1_c3", 3, " — "), (-100, "z_p1_c4", 4, texts[100])]
    folder = tmp_path_factory.mktemp("chunks")
    spark.createDataFrame(rows, "row_id long, chunk_id string, chunk_seq int, text string").write.parquet(f"{folder}/epub.parquet")
    return folder


def test_recall_of_words_in_every_row(spark, chunks):
    assert compared(spark, chunks, "retrieval_recall", "epub")[1] < 8 * 2000


def test_best_rows_of_words_in_every_row(spark, chunks):
    assert compared(spark, chunks, "retrieval_topk", "epub")[1] < 8 * 2000


def test_recall_by_overlap_shuffles_texts_once(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([*COMMON, "a-b", "—", "Σας", f"own{i}"], k=1100 if i % 100 == 0 else rng.choice([30, 399, 400, 401, 550]))) for i in range(300)]
    rows = [*enumerate(texts), (500, None), (501, "  "), (502, "—"), (600, texts[200] + " " + texts[100]), (None, texts[100])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found, shuffled = compared(spark, tmp_path, "recall_by_overlap", "documents")
    assert sum(r[2] for r in found) > 10 and shuffled < 20 * 300


@pytest.mark.parametrize(("size", "overlap"), [(400, 0), (400, 150), (7, 3), (7, 6), (5, 9)])
def test_window_starts(size, overlap):
    step = max(1, size - overlap)
    plain = [(i, s) for i, n in enumerate(range(1, 60)) for s in range(0, n, step) if s == 0 or not (n - s <= overlap or (s + step >= n and min(size, n - s) <= 2 * overlap))]
    row, start, by = window_starts(np.arange(1, 60), size, overlap)
    assert by == step and list(zip(row.tolist(), start.tolist())) == plain
