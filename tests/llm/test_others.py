import itertools
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm import confusables, leakage, packing, sentences, spans, splitting, truncation

WORDS = "amber barrel canal draft engine fabric garden hammer island jagged kettle ledger market notebook orchard pattern quarry ridge".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(" ".join(rng.choice(WORDS, 9)).capitalize() + "." for _ in range(n))


# --- cut texts


def test_truncated(spark):
    rows = [(i, f"lim.epub_p1_c{i}", prose(i, 20)[:300]) for i in range(12)]
    rows += [(100 + i, f"free.epub_p1_c{i}", prose(200 + i, 3 + i)) for i in range(12)]
    rows += [(200, "free.epub_p1_c50", "The garden was [...]"), (201, "free.epub_p1_c51", "All fine.\n\n• amber garden"), (202, None, None), (203, "x_p1_c1", ""), (204, "free.epub_p1_c52", prose(9, 2) + " Amber bar")]
    rows += [(300 + i, f"free.epub_p2_c{i}", f"• amber garden\n• draft {w}\n\nDone.") for i, w in enumerate(("garden", "kettle", "garden"))]
    rows += [(400, "two_p1_c1", "One whole text. And then it goes"), (401, "two_p1_c1", "One whole text. And then it goes on to the end.")]
    df = spark.createDataFrame(rows, "row_id long, chunk_id string, text string")
    out = {r.row_id: r.is_cut for r in truncation.truncated(df, source=F.lit(None).cast("string")).collect()}
    assert len(out) == len(rows)
    assert sum(out[i] for i in range(12)) >= 10 and not any(out[100 + i] for i in range(12))
    assert out[200] and out[204] and out[400]
    assert not out[201] and not out[202] and not out[203] and not out[401]
    shares = {r.book: r.cut_share for r in truncation.truncation_shares(truncation.truncated(df, source=F.lit(None).cast("string"))).collect()}
    assert shares["lim.epub"] > 0.8 and shares["two"] == 0.5
    assert truncation.truncated(df.limit(0), source=F.lit(None).cast("string")).count() == 0


ENDINGS = {
    "stop": ["It ends.", "«Fin» (oui !)", "He said “go.”[12]", "終わりました。", "ठीक है।"],
    "ellipsis": ["It went on…", "It went on...", "She said “well…”"],
    "sign": ["It went [...]", "It went >>", "It went (cont", "слов\ufffd"],
    "broken": ["See the list:\n3.", "One.\n• ", "He met Dr."],
    "item": ["All fine.\n\n• A copper notebook", "One.\n2. Das helle Regal", "- 静かな廊下"],
    "title": ["End.\n\nShelf of the Nursery", "Brief – Theater", "Chapter 9: Fence Loom and the Oasis", "14 Shelf Nursery", "信号·一覧", "البئر – الطريق", "난로 – 사전"],
    "unmarked": ["หอคอยไกล"],
    "open": ["The open shelf delivered the early platf", "End.\n\nThe idle", "End.\n\nThe", "山のふもとで", "ท่าเรือเ", "One line\nand the", "Der helle Hügel sam"],
    "blank": [None, "", " \n "],
}


def test_endings(spark):
    rows = [(kind, text) for kind, texts in ENDINGS.items() for text in texts]
    out = spark.createDataFrame(rows, "kind string, text string").select("kind", "text", truncation.ending(F.col("text")).alias("got")).collect()
    assert [(r.text, r.got) for r in out] == [(r.text, r.kind) for r in out]


def test_a_verdict_does_not_depend_on_other_rows(spark):
    rows = [(i, f"b{i % 7}_p1_c{i}", "Amber one ends here. " * (i % 9 + 1) + end) for i, end in enumerate(["", "\n\n• A copper notebook", "The idle", "The quiet loom measured a gate…"] * 15)]
    df = spark.createDataFrame(rows, "row_id long, chunk_id string, text string").withColumn("__id", F.lit("clash")).withColumn("book", F.lit("clash"))
    none = F.lit(None).cast("string")
    whole = {r.row_id: r.is_cut for r in truncation.truncated(df, source=none).collect()}
    assert whole == {i: i % 4 == 2 for i in range(60)}
    assert {r.row_id: r.is_cut for r in truncation.truncated(df.where("row_id < 20"), source=none).collect()} == {i: whole[i] for i in range(20)}


def test_limits_of_other_books(spark):
    row = lambda book, k, text: (f"{book}_p1_c{k}", text)
    rows = [row(b, k, prose(k, 9)[:300]) for b in ("x", "y") for k in range(6)] + [row("z", k, prose(40 + k, 2)) for k in range(9)]
    rows += [row("z", 20, prose(50, 9)[:290] + "…"), row("z", 21, prose(51, 9)[:120].rsplit(" ", 1)[0] + "…")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "row_id long, chunk_id string, text string")
    out = {r.row_id: r.is_cut for r in truncation.truncated(df, source=F.lit(None).cast("string")).collect()}
    assert [out[k] for k in range(len(rows) - 2, len(rows))] == [True, False]


# --- shared spans


def brute_pairs(rows, n):
    holders = {}
    for key, text in rows:
        for i in range(len(text or "") - n + 1):
            holders.setdefault(text[i : i + n], set()).add(key)
    return {tuple(sorted(p)) for keys in holders.values() for p in itertools.combinations(sorted(k for k in keys if k), 2)}


def test_shared_pairs(spark):
    shared, long = prose(1, 4), "z" * 500
    rows = [("a", prose(2, 3) + shared + prose(3, 2)), ("b", shared[7:290] + prose(4, 2)), ("c", prose(5, 4) + shared[:199]), ("d", prose(6, 9)), ("d", prose(6, 9)), ("e", prose(6, 9)), ("f", long), ("g", long + "y"), (None, shared), ("h", None), ("i", "")]
    rows += [(f"copy{i}", prose(77, 5)) for i in range(6)]
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    assert {(r.a, r.b) for r in spans.shared_pairs(df).collect()} == brute_pairs([r for r in rows if r[0]], 200)
    assert spans.shared_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_passages_cut_anywhere(spark, seed):
    """Against brute force: passages of whole sentences and parts of such, in texts of their own and inside one long sentence."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(40):
        passage = prose(1000 + seed * 50 + k, 9)
        if k % 4 == 3:
            passage = passage.replace(".", ",").lower()
        at = int(rng.integers(0, 120))
        cut = passage[at : at + int(rng.integers(150, 420))]
        rows += [(f"a{k}", prose(2 * k, 2) + " " + passage + " " + prose(2 * k + 1, 2)), (f"b{k}", prose(5000 + k, int(rng.integers(0, 3))) + cut + prose(6000 + k, 2))]
    df = spark.createDataFrame(rows, "chunk_id string, text string").withColumn("cls", F.lit("clash")).withColumn("hash", F.lit("clash"))
    found, true = {(r.a, r.b) for r in spans.shared_pairs(df).collect()}, brute_pairs(rows, 200)
    assert found <= true
    whole = {p for p in true if brute_pairs([r for r in rows if r[0] in p], 290)}  # room for a whole sentence and 80 characters
    assert whole <= found and len(found) >= 0.9 * len(true)


def test_pairs_behind_a_differing_character(spark):
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    rows = []
    while len(rows) < 60:  # a shorter run and a run of 200 with a selected window each in one stretch of 100, and none beyond
        short, long, head = letters(70), letters(200), int(rng.integers(0, 100))
        a, b = letters(head) + short + "X" + long, letters(head) + short + "Y" + long
        both = [set(zip(*(x.tolist() for x in spans.winnowed(spans._codes(t), 64, 200)))) for t in (a, b)]
        at = sorted(p for p, _ in both[0] & both[1])
        inside = [p for p in at if p > head + 70]
        if inside and all(any(q // 100 == p // 100 and q < head + 70 for q in at) for p in inside):
            rows += [(f"a{len(rows)}", a), (f"b{len(rows)}", b)]
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    assert {(r.a, r.b) for r in spans.shared_pairs(df).collect()} == brute_pairs(rows, 200)


def test_periodic_texts(spark):
    rows = [("a", "x" * 40000), ("b", "y" + "x" * 40000 + "z"), ("c", "ab-" * 9000), ("d", "q" + "ab-" * 90), ("e", "x" * 199), ("f", " " * 5000 + "end")]
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    assert {(r.a, r.b) for r in spans.shared_pairs(df).collect()} == {("a", "b"), ("c", "d")}
    assert len(spans.winnowed(spans._codes("x" * 40000), 64, 200)[0]) < 10


def test_winnowing_keeps_a_window_of_every_run():
    rng = np.random.default_rng(0)
    for _ in range(50):
        common = rng.integers(97, 101, 200).astype(np.uint32)
        a, b = (np.r_[rng.integers(97, 101, rng.integers(0, 90)), common, rng.integers(97, 101, rng.integers(0, 90))].astype(np.uint32) for _ in range(2))
        assert set(spans.winnowed(a, 64, 200)[1].tolist()) & set(spans.winnowed(b, 64, 200)[1].tolist())


def test_shared_share(spark):
    body = prose(1, 5)
    df = spark.createDataFrame([(1, "a", body), (2, "b", prose(2, 4) + " " + body), (3, "c", prose(3, 4)), (4, "d", None)], "row_id long, chunk_id string, text string")
    out = {r.row_id: r for r in spans.shared_share(df).collect()}
    assert out[1].shared_share == 1 and out[1].repeated_chars == 0 and out[2].repeated_chars == len(body) and out[3].shared_chars == 0 and out[4].n_chars == 0


def brute_shares(rows, n):
    holders = {}
    for i, key, text in rows:
        for p in range(len(text or "") - n + 1):
            holders.setdefault(text[p : p + n], []).append((key, i))
    out = {}
    for i, _, text in rows:
        marks = [set(), set()]
        for p in range(len(text or "") - n + 1):
            held = holders[text[p : p + n]]
            if len({k for k, _ in held}) > 1:
                for kind in range(2 if min(x for _, x in held) != i else 1):
                    marks[kind].update(range(p, p + n))
        out[i] = (len(marks[0]), len(marks[1]))
    return out


def test_shared_share_of_few_sentences(spark):
    one, two, long = "Amber " + "barrel canal " * 20 + "end.", prose(1, 2)[:-1] + " and " + prose(8, 3).lower().replace(".", ",") + ".", prose(5, 9)
    rows = [(1, "a", one), (2, "b", one), (3, "c", two), (4, "d", prose(2, 2) + "\n" + two + " " + prose(3, 1)), (5, "e", long), (6, "f", prose(6, 1) + long[13:230] + "Z" + long[231:240])]
    rows += [(7, "g", "x" * 900), (8, "h", "y" + "x" * 250), (9, "i", long[:199]), (10, "e", long + " " + long[300:520]), (11, "j", "ab-" * 400), (12, "k", "ab-" * 80 + "q" + "ab-" * 70), (13, "l", None), (14, "m", prose(9, 8)), (15, "m", prose(9, 8))]
    df = spark.createDataFrame(rows, "row_id long, chunk_id string, text string")
    out = {r.row_id: r for r in spans.shared_share(df).collect()}
    assert {i: (r.shared_chars, r.repeated_chars) for i, r in out.items()} == brute_shares(rows, 200)
    assert all(out[i].shared_share == 1 for i in (1, 2, 3)) and out[4].repeated_chars == len(two)
    paired = {k for r in spans.shared_pairs(df).collect() for k in (r.a, r.b)}
    assert paired == {r.chunk_id for r in out.values() if r.shared_chars}
    assert spans.shared_share(df.limit(0)).count() == 0


def test_sentence_share(spark):
    body = "Amber one. Barrel two. Canal three."
    df = spark.createDataFrame([(1, "a", body), (2, "b", "Draft four. " + body.replace(" B", "  B")), (3, "c", "Amber one. Barrel two.")], "row_id long, chunk_id string, text string")
    out = {r.row_id: r for r in spans.sentence_share(df).collect()}
    assert out[1].shared_share == 1 and out[2].repeated_chars == len(body) + 1 and out[3].shared_chars == 0


def test_without_repeats(spark):
    body = prose(1, 4)
    texts = {1: body, 2: prose(2, 2) + "\n\n" + body + " " + prose(3, 1), 3: body.replace(" ", "  "), 4: prose(4, 3), 5: None, 6: "", 7: prose(5, 1) + " " + prose(6, 3), 8: prose(6, 3)}
    df = spark.createDataFrame([(i, f"c{i}", t) for i, t in texts.items()], "row_id long, chunk_id string, text string")
    out = {r.row_id: (r.text, r.dropped) for r in spans.without_repeats(df).collect()}
    assert out == {i: (t, 0) for i, t in texts.items()} | {2: (prose(2, 2) + "\n\n" + prose(3, 1), 4), 3: ("", 4), 8: ("", 3)}
    assert spans.without_repeats(df.limit(0)).count() == 0


# --- pieces


@pytest.mark.parametrize("text", [prose(1, 300), "x" * 30000, "字" * 20001, ("• item one\n" * 2000), prose(2, 60) + "\n\n" + prose(3, 200), " " * 9000, None, "", prose(1, 5)])
def test_pieces(spark, text):
    out = splitting.pieces(spark.createDataFrame([(1, text)], "row_id long, text string")).orderBy("piece").collect()
    if text is None or len(text) <= 8000:
        assert out == []
        return
    assert out[0].piece_start == 0 and out[-1].piece_end == len(text)
    for r in out:
        assert r.piece_text == text[r.piece_start : r.piece_end] and 0 < len(r.piece_text) <= 8000
    for a, b in zip(out, out[1:]):
        assert 200 <= a.piece_end - b.piece_start <= 264 and b.piece_end > a.piece_end


# --- containers


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4095), max_size=200), st.sampled_from([(4096,), (512, 1024, 4096)]))
def test_best_fit(sizes, capacities):
    at, caps = packing.best_fit(np.asarray(sizes, np.int64), capacities)
    held = np.zeros(len(caps), np.int64)
    np.add.at(held, at, sizes)
    assert (held <= caps).all() and (held > 0).all() and set(caps.tolist()) <= set(capacities)
    one = packing.best_fit(np.asarray(sizes, np.int64), (4096,))[1]
    assert len(one) <= max(1, -(-2 * sum(sizes) // 4096)) or not sizes
    total = lambda caps: sum(packing.attention_cost(int(c)) for c in caps)
    assert total(caps) <= total(one)


def test_capacities_are_mixed():
    rng = np.random.default_rng(3)
    sizes = np.clip(rng.lognormal(6.7, 0.8, 4000).astype(np.int64), 1, 4096)
    total = lambda caps: sum(packing.attention_cost(int(c)) for c in caps)
    at, caps = packing.best_fit(sizes, (512, 1024, 2048, 4096))
    kinds, n = np.unique(caps, return_counts=True)
    assert kinds.tolist() == [512, 1024, 2048, 4096] and n.min() > 20
    alone = [total(packing.best_fit(sizes[sizes <= c], (c,))[1]) for c in (4096,)]
    fixed = [packing._fit(np.argsort(-sizes, kind="stable"), sizes, (512, 1024, 2048, 4096), packing.attention_cost, c)[1] for c in (512, 1024, 2048, 4096)]
    assert total(caps) < 0.95 * alone[0] and total(caps) <= min(total(f) for f in fixed)
    assert sizes.sum() / caps.sum() > 0.95


def test_pack(spark):
    rows = [(i, n) for i, n in enumerate([1, 4095, 4096, 4097, 9000, 0, -3, None, 2048, 2048])] + [(None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, n long")
    out = packing.pack(df, "doc_id", F.col("n")).collect()
    assert sum(r.part_size for r in out) == 1 + 4095 + 4096 + 4097 + 9000 + 4096
    assert {r.doc_id for r in out if r.part > 0} == {3, 4}
    held = {}
    for r in out:
        held[r.container] = held.get(r.container, 0) + r.part_size
    assert max(held.values()) <= 4096 and len(held) == 7
    assert packing.pack(df.limit(0), "doc_id", F.col("n")).count() == 0


def test_byt5_size(spark):
    text = "naïve 字"
    assert spark.createDataFrame([(text,)], "t string").select(packing.byt5_tokens(F.col("t")).alias("n")).first().n == len(text.encode()) + 1


# --- leaks


def test_leaks(spark):
    item, other = prose(1, 4), prose(2, 4)
    bare = "".join(item.split())
    docs = [(1, prose(3, 5) + item[10:190] + prose(4, 2)), (2, item.upper().replace("A", "А")), (3, bare[:79]), (4, item.replace(" ", " - ")), (5, prose(5, 9)), (6, None), (7, ""), (8, other + item), (8, other + item)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(10, item), (11, other), (12, "short"), (13, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, i).collect()} == {(1, 10), (2, 10), (4, 10), (8, 10), (8, 11)}
    assert set(leakage.leaks(d.withColumn("id", F.lit("clash")), i.withColumn("letters", F.lit("clash"))).columns) == {"doc_id", "item_id"}
    assert leakage.leaks(d, i.limit(0)).count() == 0 and leakage.leaks(d.limit(0), i).count() == 0


def test_leaks_through_a_full_table_of_bits(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BITS", 7)  # every bit is set, so nothing is held back before the join
    item = prose(1, 4)
    d = spark.createDataFrame([(1, prose(3, 5) + item[10:190]), (2, prose(5, 9)), (3, item)], "doc_id long, text string")
    i = spark.createDataFrame([(10, item), (11, prose(2, 4))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, i).collect()} == {(1, 10), (3, 10)}


# --- same look

SAME = [
    ("full width", "ｆｕｌｌ　ｗｉｄｔｈ", "full width"), ("accents", "café ÅÅ", "café ÅÅ"), ("ligatures", "ﬁne oﬀer", "fine offer"), ("invisible", "a​b­c﻿", "abc"),
    ("spaces", "a b c", "a b c"), ("hyphens", "a‐b‑c", "a-b-c"), ("letters", "раура", "paypa"), ("kana", "ｶﾞｷﾞ", "ガギ"), ("arabic", "ﻻ", "لا"), ("ideographs", "⼭林", "山林"),
    ("hangul", unicodedata.normalize("NFD", "한국"), "한국"), ("marks", "ạ́", "ạ́"), ("yo", "ё", "ё"),
]
DIFFERENT = [("case", "Abc", "abc"), ("accent", "resume", "resumé"), ("raised", "x²", "x2"), ("circled", "②", "2"), ("line break", "a\nb", "a b"), ("dash", "a–b", "a-b"), ("letter", "abc", "abd")]


def test_same_look(spark):
    rows = [(k, t) for k, t in enumerate(x for n, a, b in SAME + DIFFERENT for x in (f"{a} {n}", f"{b} {n}"))] + [(1000, None), (1001, ""), (1002, "same"), (1003, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.a, r.b) for r in confusables.same_look_pairs(df).collect()}
    assert found == {(2 * k, 2 * k + 1) for k in range(len(SAME))}
    forms = {r.doc_id: r.form for r in confusables.same_look(df).collect()}
    assert forms[1000] is None and forms[1001] == ""
    again = confusables.same_look(spark.createDataFrame([(k, v) for k, v in forms.items()], "doc_id long, text string"))
    assert {r.doc_id: r.form for r in again.collect()} == forms
    assert confusables.same_look_pairs(df.limit(0)).count() == 0
    classes = {r.doc_id: (r.class_id, r.texts) for r in confusables.same_look_classes(df).collect()}
    assert classes[1] == (0, 2) and classes[1003] == (1002, 1)


def test_exploded_form_is_the_same(spark):
    rows = [(k, t) for k, t in enumerate(x for n, a, b in SAME + DIFFERENT for x in (f"{a} {n}", f"{b} {n}"))] + [(1000, None), (None, "é"), (1001, ""), (1002, "same"), (1002, "same"), (1003, "\u200b")]
    rng = np.random.default_rng(1)
    pool = list("aeéouiÅẤ字ﬁㅎがｶﾞ \u0301\u0323\u0308\u0300\u0327\u093c\u0928\u1100\u1161\u11a8\u0e49\u0e38с\u0456\u09c7\u09be\u200b")
    rows += [(2000 + k, "".join(rng.choice(pool, 12))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pos", F.lit("clash")).withColumn("g", F.lit("clash"))
    form = {r.doc_id: r.form for r in confusables.same_look(df).collect() if r.doc_id is not None and r.form is not None}
    assert {r.doc_id: r.form for r in confusables.exploded_form(df).collect()} == form
    assert confusables.exploded_form(df.limit(0)).count() == 0


def test_spans_are_hashed_without_reading_the_text_again(spark):
    """Cutting each span from the text reads the text from its start for every sentence: work in the square of its length."""
    words = "\n\n Tom ran home. \n- one\n- two\n\nWhat… “Yes!” he said. "
    texts = [words * 9, "x " + words * 5, "Über Nr. 5 ging er. 今日は。" + words * 3 + "a" * 250 + ". End", "  ", "A b."]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "cls long, text string").withColumn("part", F.lit(0))
    made = spans._class_spans(rows, 80, 200)
    assert "substring" not in made._jdf.queryExecution().optimizedPlan().toString()
    found = {r.cls: r for r in made.collect()}
    known = {r.cls: [tuple(u) for u in r.s] for r in rows.select("cls", sentences.sentence_spans(F.col("text")).alias("s")).collect()}
    by_text, by_hash = {}, {}
    for i, t in enumerate(texts):
        want = [(a, next((z for _, z in known[i][k:] if z - a >= 80), None)) for k, (a, _) in enumerate(known[i])]
        want = [(a, z) for a, z in want if z]
        assert [k.pos for k in found[i]["keys"]] == [a for a, _ in want]
        assert [(x.pos, len(x.text)) for x in found[i]["long"]] == [(a, z - a) for a, z in known[i] if z - a >= 200]
        for k, (a, z) in zip(found[i]["keys"], want):
            by_text.setdefault(t[a:z], set()).add(k.hash)
            by_hash.setdefault(k.hash, set()).add(t[a:z])
    assert all(len(x) == 1 for x in (*by_text.values(), *by_hash.values())) and len(by_text) > 9
