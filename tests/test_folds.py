"""The folds over documents and the rules of output rows, on small examples and against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import predicates as P
from quillspark.functions import text as T
from quillspark.operators import emitting as E
from quillspark.operators import folding as D
from quillspark.plans import pipeline

BLOCKS = "doc_id long, page int, seq int, type string, text string, bbox struct<x0: double, y0: double, x1: double, y1: double>"


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("column", "text", "expected"),
    [
        (T.merge_number_suffixes, "see page\n12. Then more\n3. item", "see page 12. Then more\n3. item"),
        (T.merge_number_suffixes, "A list:\n1. a\n2. b", "A list:\n1. a\n2. b"),
        (T.merge_number_suffixes, "in Chapter\n4. Next", "in Chapter\n4. Next"),
        (T.drop_number_markers, "well-\n3. known", "well-known"),
        (T.drop_number_markers, "one\n2.\nmore", "one\nmore"),
        (T.drop_number_markers, "the end 7.", "the end"),
        (T.drop_number_markers, "see section 7.", "see section 7."),
        (T.remove_stray_bullets, "a word\n• goes on", "a word goes on"),
        (T.remove_stray_bullets, "List:\n• One\n\n• Two", "List:\n• One\n• Two"),
        (T.remove_stray_bullets, "• Sent to Ann Bell, Main Street, Riga", "Sent to Ann Bell, Main Street, Riga"),
        (T.break_numbered_lists, "Steps: 1. do this 2. do that", "Steps:\n1. do this\n2. do that"),
        (T.break_numbered_lists, "1. One.\n2. Two.\nText", "1. One.\n\n2. Two.\n\nText"),
        (T.break_numbered_lists, "1. see Table 2. and", "1. see Table 2. and"),
        (T.join_wrapped_items, "• one\n  goes on\n• two\n\ntext", "• one goes on\n• two\n\ntext"),
        (lambda c: T.merge_paragraphs(c, P.probable_heading), "He left\n\nthe room and went on.\n\n— Someone", "He left\n\nthe room and went on. — Someone"),
        (lambda c: T.merge_paragraphs(c, P.probable_heading), "and so it was that\n\nthey went on.", "and so it was that they went on."),
        (lambda c: T.merge_paragraphs(c, P.probable_heading), "• item\n\ntext here", "• item\n\ntext here"),
        (P.probable_heading, "The Quiet House", True),
        (P.probable_heading, "and then they left the quiet house at dawn", False),
        (P.probable_heading, "Note: read this", True),
        (P.probable_heading, "What a day!", True),
        (P.probable_heading, '"Open quote', False),
        (P.probable_heading, None, False),
        (P.probable_heading, "", False),
    ],
)
def test_rules(spark, column, text, expected):
    assert one(spark, column, text) == expected


@pytest.mark.parametrize("column", [T.merge_number_suffixes, T.drop_number_markers, T.remove_stray_bullets, T.break_numbered_lists, T.join_wrapped_items])
def test_null_and_empty(spark, column):
    assert one(spark, column, None) is None and one(spark, column, "") == ""


def test_semantic_chunks(spark):
    rows = [(1, 0, "Chapter One", True), (1, 1, "a " * 30, False), (1, 2, "b " * 30, False), (1, 3, "The list:", False), (1, 4, "1. x", False), (1, 5, "2. " + "y " * 60, False), (1, 6, "Plain text here", False), (1, 7, "• new item", False), (1, 8, "END NOTES", True), (2, 0, None, False), (3, 0, "z " * 500, False)]
    lines = spark.createDataFrame(rows, "doc_id long, seq int, text string, is_heading boolean")
    out = D.semantic_chunks(D.records(lines.where("text is not null")), 70).orderBy("doc_id", "chunk_seq").collect()
    assert [(r.doc_id, r.n_records) for r in out] == [(1, 5), (1, 1), (1, 1), (1, 1), (3, 1)]
    assert out[0].text.startswith("Chapter One\na ") and "2. y" in out[0].text and out[3].text == "END NOTES"
    assert D.semantic_chunks(D.records(lines.limit(0))).count() == 0


def test_page_paragraphs(spark):
    rows = [
        (1, 1, 1, None, "A Title", None), (1, 1, 2, None, "the text begins right here", None), (1, 1, 3, None, "and goes on with it", None), (1, 1, 4, None, "Figure 2 A plot", None),
        (1, 1, 5, None, "• short item", None), (1, 1, 6, None, "that goes on and on", None), (1, 2, 1, None, "new page", None), (1, 2, 2, None, None, None),
    ]
    out = D.merge_page_blocks(spark.createDataFrame(rows, BLOCKS)).orderBy("page", "run").collect()
    assert [r.text for r in out] == ["A Title", "the text begins right here and goes on with it\n\nFigure 2 A plot", "• short item that goes on and on", "new page"]


def test_continuations(spark):
    box = lambda x, y: (x, y, x + 100.0, y + 10.0)
    rows = [
        (1, 1, 1, None, "The contain-", box(10.0, 10.0)), (1, 1, 2, None, "er was full and", box(10.0, 22.0)), (1, 2, 1, None, "stayed so.", box(10.0, 10.0)), (1, 2, 2, None, "— Someone", None), (1, 3, 1, None, "Another paragraph of text stands here.", None),
        (2, 1, 1, None, "1. one", None), (2, 1, 2, None, "2. two", None), (2, 1, 3, None, "", None), (3, 1, 1, None, "open end", None), (3, 9, 1, None, "far away", None),
    ]
    out = D.merge_continuations(spark.createDataFrame(rows, BLOCKS)).orderBy("doc_id", "page", "seq").collect()
    assert [(r.doc_id, r.text) for r in out] == [
        (1, "The container was full and stayed so. — Someone"), (1, "Another paragraph of text stands here."), (2, "1. one\n2. two"), (3, "open end"), (3, "far away"),
    ]
    assert out[0].reasons == "hyphenated,sentence_across_pages,attribution"


def test_carried_headings(spark):
    rows = [(1, 0, "Some text that is here.\nThe Next Part"), (1, 1, "text of the part, it is."), (1, 2, "Foot notes of it | A Heading"), (1, 3, "Last Words"), (2, 0, ""), (2, 1, None)]
    out = D.carry_headings(spark.createDataFrame(rows, "doc_id long, chunk int, text string")).orderBy("chunk").collect()
    assert [r.text for r in out] == ["Some text that is here.", "The Next Part\ntext of the part, it is.", "Foot notes of it", "A Heading", "Last Words"]


def brute_edge(a, b):
    return next((i for i in range(min(len(a), len(b)), 0, -1) if a.endswith(b[:i])), 0)


def test_shared_edge():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert E.shared_edge(a, b) == brute_edge(a, b)
    assert E.shared_edge("x" * 20000, "x" * 20000) == 20000


def test_trim_overlap():
    assert E.trim_overlap("It ends here. And then", "And then it went on and on.") == "it went on and on."
    assert E.trim_overlap("all of it is here", "it is here") == ""
    assert E.trim_overlap("see Figure 2", "Figure 2 shows the whole") == "Figure 2 shows the whole"
    assert E.trim_overlap("the notable", "able men go on their way") == "able men go on their way"
    assert E.trim_overlap("nothing", "shared at all") == "shared at all" and E.trim_overlap("", "x") == "x" and E.trim_overlap("x", "") == ""


@pytest.mark.parametrize("text", ["A sentence here. " * 2000, "x" * 30000, ("- item one\n" * 1500), "Intro text. " * 300 + "\nThe list:\n" + "- item\n" * 900 + "After it. " * 900, "short", "", " "])
def test_split_to_limit(text):
    pieces = E.split_to_limit(text, 8000)
    assert "".join("".join(pieces).split()) == "".join(text.split())
    assert all(len(p) <= 8000 or "- item" in p for p in pieces) and all(p.strip() for p in pieces)


def test_output_rows(spark):
    rows = [(1, "A small text."), (2, "Many words stand here. " * 600), (3, None), (4, "  "), (5, "x" * 8000)]
    df = spark.createDataFrame(rows, "row_id long, text string").withColumn("id", F.lit("clash"))
    out = E.rows_for_output(df, "row_id").collect()
    assert {r.row_id for r in out} == {1, 2, 5} and [r.chunk_part for r in out if r.row_id != 2] == [None, None]
    assert sorted(r.chunk_part for r in out if r.row_id == 2) == [0, 1] and max(len(r.text) for r in out) <= 8000
    assert E.rows_for_output(df.limit(0), "row_id").count() == 0


def test_text_folds():
    assert E.fuse_sentences(["It was the", "the start of it. And more."]) == ["It was the start of it. And more."]
    assert E.fuse_sentences(["a " * 470 + "word", "goes on. " + "b " * 300]) == ["a " * 470 + "word goes on.", ("b " * 300).strip()]
    assert E.fuse_sentences(["Whole. ", "Also whole."]) == ["Whole.", "Also whole."]
    assert E.hold_and_merge(["one two", "word " * 40, "tail"]) == ["one two\n\n" + "word " * 40 + "\n\ntail"]
    assert E.hold_and_merge([]) == [] and E.hold_and_merge(["few"]) == ["few"]
    assert E.give_back_fragments(["It was", "the end. Then more."], 100) == ["It was the end.", "Then more."]
    assert E.repair_quotes(['He said "', "go now", "; then"]) == ['He said " go now', "then"]
    long = "This is a whole text of many words, " * 12 + "as it ends."
    assert E.coalesce([long, "and so", "", long.upper()]) == [long + " and so"]


def test_superscripts(spark):
    kind = "text string, s array<struct<start: int, end: int, style: string>>"
    rows = [("The end12.", [(7, 9, "superscript")]), ("A2 b", [(1, 2, "superscript")]), ("plain", []), ("none", None)]
    out = spark.createDataFrame(rows, kind).select(T.strip_superscripts(F.col("text"), F.coalesce("s", F.expr("cast(array() as array<struct<start:int,end:int,style:string>>)"))).alias("v")).collect()
    assert [(r.v.text, r.v.notes) for r in out] == [("The end.", ["12"]), ("A2 b", []), ("plain", []), ("none", [])]


def test_passes_shape_the_chunks(spark):
    text = "Chapter One\n" + "Plain words of the first part stand here. " * 8 + "\n\nChapter Two\n" + "And the second part has words as well. " * 8
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    spec = pipeline.Spec(("list_detect", "heading_detect", "split_semantic", "emit"), {"split_semantic": {"chunk_size": 400, "overlap": 5}})
    out = pipeline.run(spec, df).orderBy("chunk").collect()
    assert [r.text.split("\n")[0] for r in out] == ["Chapter One", "Chapter Two"]


def test_traced_run(spark, tmp_path):
    df = spark.createDataFrame([(1, "Some words to cut here. " * 40), (2, "Some words to cut here. " * 40), (3, None)], "doc_id long, text string")
    spec = pipeline.Spec(("text_clean", "split_semantic", "emit"), {"split_semantic": {"chunk_size": 50, "overlap": 5}})
    out = pipeline.run_traced(spec, df, str(tmp_path))
    again = pipeline.replay(spec, spark, str(tmp_path), "text_clean")
    key = lambda d: sorted((r.doc_id, r.chunk, r.text) for r in d.collect())
    assert key(out) == key(again) == key(pipeline.run(spec, df))
    report = __import__("json").loads(spark.read.text(str(tmp_path / "run_report")).first().value)
    assert [p["name"] for p in report["passes"]] == list(spec.pipeline) and report["passes"][2]["rows"] == out.count() and report["versions"]["pyspark"]
    assert pipeline.duplicates_by_pass(spec, spark, str(tmp_path))["input"] == 1


def test_asof_and_intervals(spark):
    from quillspark.operators import relational as J

    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, "a", None), (5, None, 5)], "id long, k string, t int")
    right = spark.createDataFrame([("a", 5, 10), ("a", 5, 11), ("a", 2, 9), ("a", None, 7), ("c", 1, 1)], "k string, t int, v int")
    assert {r.id: r.v_asof for r in J.asof_join(left, right, ["k"], "t", ["v"]).collect()} == {1: 11, 2: None, 3: None, 4: None, 5: None}
    points = spark.createDataFrame([(k,) for k in range(-5, 40)], "p int")
    ranges = spark.createDataFrame([(0, 10, "x"), (9, 33, "y"), (5, 5, "none"), (-3, 1, "z"), (7, None, "open")], "a int, z int, n string")
    got = {(r.p, r.n) for r in J.interval_join(points, ranges, "p", "a", "z", 4).collect()}
    assert got == {(p, n) for p in range(-5, 40) for a, z, n in ((0, 10, "x"), (9, 33, "y"), (-3, 1, "z")) if a <= p < z}
    assert J.interval_join(points.limit(0), ranges, "p", "a", "z", 4).count() == 0 and J.asof_join(left.limit(0), right, ["k"], "t", ["v"]).count() == 0


def test_better_blocks(spark):
    from quillspark.operators import quality as Q

    kind = "doc_id long, seq int, text string"
    own = spark.createDataFrame([(1, 0, "the badWord is here now"), (1, 1, "a clean line of text."), (2, 0, None), (3, 0, "gluedHere alone")], kind)
    other = spark.createDataFrame([(1, 5, "the badword is here now"), (1, 6, "something else"), (2, 0, "x")], kind)
    assert {(r.doc_id, r.seq, r.text, r.replaced) for r in Q.better_blocks(own, other).collect()} == {(1, 0, "the badword is here now", True), (1, 1, "a clean line of text.", False), (3, 0, "gluedHere alone", False)}
