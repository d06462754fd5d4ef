import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillspark.functions import metrics as M
from quillspark.functions import predicates as P
from quillspark.functions import text as T
from quillspark.operators import blocks as K
from quillspark.operators import chunks as C
from quillspark.plans import pipeline
from quillspark.sources import html, tables


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("column", "text", "expected"),
    [
        (T.normalize_nbsp, "a  b​c", "a bc"),
        (T.normalize_newlines, "a\r\nb\rc d", "a\nb\nc\nd"),
        (T.remove_control_characters, "a\x07b‭c", "abc"),
        (T.consolidate_whitespace, "  a \t b\n", "a b"),
        (T.normalize_quotes, "“Hi” ‘x’", "\"Hi\" 'x'"),
        (T.expand_ligatures, "ﬁne oﬀer", "fine offer"),
        (T.join_hyphenated, "con-\n tainer", "container"),
        (T.join_hyphenated, "Smith-\nJones", "Smith-\nJones"),
        (T.collapse_single_newlines, "a\nb\n\nc\n- d\n1. e", "a b\n\nc\n- d\n1. e"),
        (T.collapse_artifact_breaks, "end.\nNext", "end. Next"),
        (T.normalize_inline_footnotes, "end.12 Next", "end[12]. Next"),
        (T.restore_leading_capital, "- hello there", "- Hello there"),
        (T.remove_underscore_emphasis, "a _word_ and _two words_", "a word and _two words_"),
        (T.strip_dot_leaders, "Intro . . . . 3\nText", "Intro\nText"),
        (T.drop_piped_lines, "a\nb | 2\nc", "a\nc"),
        (T.json_safe, '", rest', "rest"),
        (P.is_heading, "Chapter 1", True),
        (P.is_heading, "The man walked home.", False),
        (P.is_heading, "Body", False),
        (P.is_heading, None, False),
        (P.heading_level, "1.2.3 Some longer topic", 3),
        (P.starts_with_bullet, "• x", True),
        (P.starts_with_number, "12) x", True),
        (P.starts_with_number, None, False),
        (P.last_sentence, 'One. Two "three."', 'Two "three."'),
        (P.last_sentence, "no end", "no end"),
        (P.has_sentence_ending, 'He said "go."', True),
        (P.starts_mid_sentence, "and then", True),
        (P.is_caption, "Figure 3.1 A plot", True),
        (P.word_count, "it's 3 añ", 4),
        (P.first_list_number, "x\n2. a\n7. b", 2),
        (P.last_list_number, "x\n2. a\n7. b", 7),
        (M.flesch_kincaid, "", 0.0),
        (M.usable, "  ", 0.0),
        (lambda c: M.difficulty(F.length(c)), "x" * 13, "college_level"),
        (lambda c: M.difficulty(F.length(c)), "x" * 17, "graduate_level"),
        (P.is_heading, "Summary of the findings of this year", False),
        (P.is_heading, "Introduction to the findings of this year", True),
        (P.is_heading, "THE END.", True),
        (P.is_heading, "One Two Three Four Five", True),
        (P.heading_level, "CHAPTER ONE AND THE REST OF IT", 2),
        (P.heading_level, "Appendix with some notes", 2),
        *((P.common_artifact, t, True) for t in ("12", "xiv", "Page 3 of 9", "chapter 4", "3 Chapter", "Intro | 7", "Intro | ix", "12 | Some: title", "Some title |", "INDEX", "Bibliography and more", "table of  contents", "Appendix b", "4 The Title Here")),
        *((P.common_artifact, t, False) for t in ("12. A list item", "pages", "A page 3", "chapter four", "a | b | 3", "Two words | 7", "index of names", "appendix bc", "The whole text of a paragraph.", "", None)),
        (M.split_short, "aaa bbb", ["aaa", "bbb"]),
    ],
)
def test_functions(spark, column, text, expected):
    assert one(spark, column, text) == expected


@pytest.mark.parametrize("column", [T.clean_text, T.json_safe, T.normalize_quotes, T.strip_dot_leaders, M.truncate_chunk, P.last_sentence])
def test_null_and_empty(spark, column):
    assert one(spark, column, None) is None
    assert one(spark, column, "") in ("", None)


def test_clean_text_is_stable(spark):
    once = one(spark, T.clean_text, "“A”\nline-\nbreak  x\n\n\n• item\n• two")
    assert one(spark, T.clean_text, once) == once


def brute_truncated(text):
    if len(text) <= 8000:
        return text
    room = 7900
    ends = [p for p in (text.rfind(m + g, 0, room) for m in ".!?" for g in " \n") if p > 0.7 * room]
    if ends:
        return text[: max(ends) + 1].strip()
    for sep, share in (("\n\n", 0.7), (" ", 0.8)):
        at = text.rfind(sep, 0, room)
        if at > share * room:
            return text[:at].strip()
    return text[:room].strip()


@pytest.mark.parametrize("text", ["A sentence here. " * 1000, "A" * 9000, "word " * 2000, ("w" * 50 + "\n\n") * 200, "One. " + "x" * 9000, "x" * 6200 + " " + "y" * 5000, "x" * 6400 + " " + "y" * 5000, "short", "z" * 8000, "é! " * 2700])
def test_truncation(spark, text):
    assert one(spark, M.truncate_chunk, text) == brute_truncated(text)


def test_word_joining(spark):
    import re

    for text in ("one two three", "fooBar a1b con-\n tain", "", "Über straße — x", "I am at it so we go"):
        n = len(text.split())
        hits = sum(len(re.findall(p, text, re.IGNORECASE)) for p in M.JOINING)
        assert one(spark, M.word_joining, text) == (round(max(0.0, 1 - hits / n), 6) if n else 0.0)


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbours_of_a_hot_group(spark, ahead):
    from pyspark.sql.window import Window

    from quillspark.operators.adjacency import with_neighbour

    rows = [("hot", k // 2, k, f"t{k}") for k in range(300)] + [("hot", None, 900 + k, "n") for k in range(3)] + [("cold", 7, 400, None), ("cold", 5000, 401, "far"), (None, 1, 500, "x"), (None, 2, 501, "y"), ("one", 3, 600, "z")]
    df = spark.createDataFrame(rows, "book string, n int, id long, text string").withColumn("near", F.lit("clash"))
    side = F.lead if ahead else F.lag
    w = Window.partitionBy("book").orderBy("n", "id")
    true = {r.id: (r.b, r.t) for r in df.withColumn("b", side("id").over(w)).withColumn("t", side("text").over(w)).collect()}
    for width in (1, 7, 1000):
        out = with_neighbour(df, ["book"], ["n", "id"], {"id": F.col("id"), "text": F.col("text")}, "near", ahead, width)
        assert {r.id: (r.near.id, r.near.text) if r.near else (None, None) for r in out.collect()} == true
    assert with_neighbour(df.limit(0), ["book"], ["n", "id"], {"id": F.col("id")}, "near").count() == 0


def test_shingles_of_repeated_and_empty_rows(spark):
    rows = [(1, "a b c d e f"), (2, "x A b  C d e y"), (3, "b c d e f b c d e f"), (4, None), (5, "too short"), (6, "p q r s t"), (6, "p q r s t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("clash"))
    out = {r.doc_id: (r.shingles, r.shared, r.first_shared, r.least_holder) for r in C.shared_shingles(df.where("doc_id < 6"), "doc_id").collect()}
    assert out == {1: (2, 2, "a b c d e", 1), 2: (3, 1, "a b c d e", 1), 3: (5, 1, "b c d e f", 1)}
    assert {(r.doc_id, r.first_id, r.runs) for r in C.shingle_links(df, "doc_id").collect()} == {(2, 1, 1), (3, 1, 1)}


def test_page_ranges():
    assert tables.page_ranges("1,3-5") == {1, 3, 4, 5} and tables.page_ranges(" 1 , 3-4 , 6 ") == {1, 3, 4, 6} and tables.page_ranges(None) == set()
    for bad in ("0", "2-1", "a"):
        with pytest.raises(ValueError):
            tables.page_ranges(bad)


def test_short_tails(spark):
    rows = [(1, 1, 1, "x" * 60), (1, 1, 2, "short one"), (1, 1, 3, "two"), (1, 2, 1, "all"), (1, 2, 2, "short"), (2, None, None, None)]
    out = K.merge_short_tails(spark.createDataFrame(rows, "doc_id long, page int, seq int, text string")).collect()
    assert {(r.doc_id, r.page, r.text) for r in out} == {(1, 1, "x" * 60), (1, 1, "short one two"), (1, 2, "all"), (1, 2, "short"), (2, None, "")}


def test_windows(spark):
    text = " ".join(f"w{i}" for i in range(1000))
    out = C.word_windows(spark.createDataFrame([(1, text), (2, None), (3, " "), (4, "a b")], "id long, text string"), "id").orderBy("id", "chunk").collect()
    assert [(r.id, r.n_words) for r in out] == [(1, 400), (1, 400), (1, 300), (4, 2)] and out[1].text.startswith("w350 ")


def test_attached_headings(spark):
    rows = [(1, 0, "H", True), (1, 1, "a", False), (1, 2, "I", True), (1, 3, "J", True), (1, 4, "b", False), (1, 5, "K", True)]
    out = K.attach_headings(spark.createDataFrame(rows, "doc_id long, seq int, text string, is_heading boolean")).orderBy("seq").collect()
    assert [(r.seq, r.text) for r in out] == [(1, "H\na"), (4, "I\nJ\nb")]


def test_heading_tree(spark):
    rows = [(1, 0, "a", 1), (1, 1, "b", 2), (1, 2, "c", 3), (1, 3, "d", 2), (1, 4, "e", 1)]
    out = K.heading_tree(spark.createDataFrame(rows, "doc_id long, seq int, text string, level int")).orderBy("seq").collect()
    assert [r.parent_seq for r in out] == [None, 0, 1, 0, None]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, page int, seq int, text string")
    for out in (K.merge_short_tails(empty), K.with_lists(empty), K.cut_after_end(empty), K.budget_fold(empty), K.coalesce_sentences(empty), C.exact_duplicates(empty, "doc_id")):
        assert out.count() == 0


def _epub() -> bytes:
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        z.writestr("OPS/p.opf", '<package><manifest><item id="b" href="b.xhtml"/><item id="a" href="a.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        z.writestr("OPS/a.xhtml", "<body><nav><p>no</p></nav><h1>One</h1><p>Text &amp; more</p><ol><li>first</li></ol></body>")
        z.writestr("OPS/b.xhtml", "<body><p>Second <b>page</b><script>x</script></p><ul><li>dot<ul><li>in</li></ul></li></ul></body>")
    return data.getvalue()


def test_epub(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(_epub())
    (tmp_path / "broken.epub").write_bytes(b"no archive")
    rows = html.read_epubs(spark, str(tmp_path)).orderBy("spine", "seq").collect()
    assert [(r.spine, r.tag, r.list_kind, r.text) for r in rows] == [
        (1, "h1", None, "One"), (1, "p", None, "Text & more"), (1, "li", "numbered", "first"), (2, "p", None, "Second page"), (2, "li", "bullet", "in"), (2, "li", "bullet", "dot"),
    ]
    assert {r.spine for r in html.read_epubs(spark, str(tmp_path), {1}).collect()} == {2}


def test_spec(tmp_path, monkeypatch):
    (tmp_path / "s.yaml").write_text("pipeline: [text_clean, split_semantic, emit]\noptions:\n  split_semantic: {chunk_size: 100, overlap: 5}\n")
    monkeypatch.setenv("split_semantic__overlap", "7")
    spec = pipeline.load_spec(str(tmp_path / "s.yaml"), {"split_semantic": {"chunk_size": 50}})
    assert spec.options["split_semantic"] == {"chunk_size": 50, "overlap": 7}
    with pytest.raises(KeyError):
        pipeline.check(pipeline.Spec(("nothing",)))
    with pytest.raises(ValueError):
        pipeline.check(pipeline.Spec(("split_semantic", "text_clean")))
    with pytest.warns(UserWarning):
        pipeline.load_spec(None, {"unused": {"a": 1}})


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "m"), ("b", None)], "text string, metadata string")
    tables.write_jsonl(rows, str(tmp_path / "out"), order=["text"])
    (tmp_path / "out" / "part-bad.json").write_text("{broken\n")
    back = tables.read_jsonl(spark, str(tmp_path / "out"))
    assert sorted((r.text or "", r._bad or "") for r in back.collect()) == [("", "{broken"), ("a", ""), ("b", "")]


def test_streams(spark, tmp_path):
    from quillspark.streaming import ingest

    docs = spark.createDataFrame([(1, "One sentence here now."), (2, "One  sentence here now."), (3, "Other text.")], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "timestamp'2025-01-01 00:00:00' received_at")
    docs.write.parquet(str(tmp_path / "in"))
    stream = ingest.chunk_stream(ingest.once_each(ingest.document_stream(spark, str(tmp_path / "in"))))
    ingest.start(stream.select("doc_id", "text"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_cli(spark, tmp_path, capsys):
    from quillspark import cli

    assert cli.main(["inspect"]) == 0 and "text_clean" in capsys.readouterr().out
    (tmp_path / "x.epub").write_bytes(_epub())
    assert cli.main(["list-spines", str(tmp_path / "x.epub")]) == 0
    spark.createDataFrame([(1, "Some words to cut. " * 30)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    assert cli.main(["convert", str(tmp_path / "d"), "--out", str(tmp_path / "o"), "--chunk-size", "40", "--overlap", "5"]) == 0
    assert spark.read.json(str(tmp_path / "o")).count() >= 3


def test_bench_names_what_it_skips():
    import bench

    some = bench.report({name: 1.0 for name in bench.HEADLINE[:-2]}, "/data/sf0.1/")
    assert some["value"] is None and some["skipped"] == list(bench.HEADLINE[-2:]) and some["sf"] == "sf0.1"
    every = bench.report({name: 1.0 for name in bench.HEADLINE}, "/data/sf0.1")
    assert every["value"] == len(bench.HEADLINE) and every["skipped"] == []
