import pytest

from quillspark.llm.sentences import sentences

CASES = [
    ("Dr. Smith paid $3.50 vs. $2.10 at 7 p.m. The shop closed.", ["Dr. Smith paid $3.50 vs. $2.10 at 7 p.m.", "The shop closed."]),
    ("“Go!” said Ann. “Where?” Bob left.", ["“Go!” said Ann.", "“Where?”", "Bob left."]),
    ("“One. Two,” said Ann.", ["“One.", "Two,” said Ann."]),
    ("It broke.[12] (Nobody saw.) It stayed... in pieces. Then… Nothing.", ["It broke.[12]", "(Nobody saw.)", "It stayed... in pieces.", "Then…", "Nothing."]),
    ("The end.The start.iPod next.", ["The end.", "The start.", "iPod next."]),
    ("Title\n\n1. First. Second\n2. Third\n\nA line\nbroken here.", ["Title", "1. First.", "Second", "2. Third", "A line\nbroken here."]),
    ("See vol. 4, pp. 5–6, no. 7, e.g. this, by J. R. Doe. Done", ["See vol. 4, pp. 5–6, no. 7, e.g. this, by J. R. Doe.", "Done"]),
    ("Am 7. Mai kam z. B. Frau Dr. Ott, d. h. sie usw. Dann ging sie.", ["Am 7. Mai kam z. B. Frau Dr. Ott, d. h. sie usw.", "Dann ging sie."]),
    ("В 1910 г. дом, сад и т. д. См. рис. 3. — Да? — спросил он.", ["В 1910 г. дом, сад и т. д.", "См. рис. 3.", "— Да? — спросил он."]),
    ("Πού είναι; Βλ. σελ. 4, π.χ. εδώ.", ["Πού είναι;", "Βλ. σελ. 4, π.χ. εδώ."]),
    ("「行く。来る。」と言った。図2.5を見た……また、見た。", ["「行く。", "来る。」と言った。", "図2.5を見た……また、見た。"]),
    ("“好！”老师说。他问：“在吗？”天黑了。", ["“好！”老师说。", "他问：“在吗？”", "天黑了。"]),
    ("“간다!” 하고 말했다. 그는 … 갔다.", ["“간다!” 하고 말했다.", "그는 … 갔다."]),
    ("बड़ा है!” कप्तान ने कहा। डॉ. साहब आए।", ["बड़ा है!” कप्तान ने कहा।", "डॉ. साहब आए।"]),
    ("«نعم!» قال المعلم. انظر ص. 3 هنا؟ لا.", ["«نعم!» قال المعلم.", "انظر ص. 3 هنا؟", "لا."]),
    ("บ้านเก่า ปี พ.ศ. 2470 บ้านใหม่ 12 ชิ้น ถนน", ["บ้านเก่า", "ปี พ.ศ. 2470 บ้านใหม่ 12 ชิ้น", "ถนน"]),
    ("cut in the mid", ["cut in the mid"]),
]


@pytest.mark.parametrize(("text", "expected"), CASES)
def test_units(spark, text, expected):
    got = sentences(spark.createDataFrame([(1, text)], "row_id long, text string"), with_text=True).orderBy("sent_index").collect()
    if " Next" in expected:
        assert "".join(r.sentence for r in got).replace(" ", "") == text.replace(" ", "")
    else:
        assert [r.sentence for r in got] == expected


def test_private_use_characters_of_the_text_survive(spark):
    text = "A \ue000 mark\ue00f here. Two\x87 more."
    got = sentences(spark.createDataFrame([(1, text)], "row_id long, text string"), with_text=True).orderBy("sent_index").collect()
    assert [r.sentence for r in got] == ["A \ue000 mark\ue00f here.", "Two\x87 more."]


def test_cover_everything_but_white_space(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, CASES[0][0] * 300), (5, "x" * 30000), (5, "A. B. C.\n\n• d\n• e 😀. F")]
    df = spark.createDataFrame(rows, "row_id long, text string")
    got = sentences(df).collect()
    assert {r.row_id for r in got} == {4, 5}
    text = rows[3][1]
    spans = sorted((r.sent_start, r.sent_end) for r in got if r.row_id == 4)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    covered = set().union(*(range(a, b) for a, b in spans))
    assert all(text[i].isspace() for i in set(range(len(text))) - covered)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "row_id long, text string")
    assert sentences(df).count() == 0
    clash = spark.createDataFrame([(1, "A b. C d.", "x", "y")], "row_id long, text string, sent_start string, sentence string")
    assert sentences(clash, with_text=True).count() == 2
