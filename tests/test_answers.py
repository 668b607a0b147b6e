"""Answers against their evidence."""

from pyspark.sql import functions as F

from spanloom.operators import answers


def test_answers_are_validated_softened_or_replaced(spark):
    bundle = spark.createDataFrame([(q, "E1", "Lead was 1,250 mg. More.") for q in range(1, 7)] + [(q, "E2", "Zinc was 7.") for q in range(1, 7)], "question int, tag string, quote string")
    raw = [(1, "Lead was 1250 mg [E1]."), (2, "Lead was 1250 mg [E1]. Zinc was 8 [E2]."), (3, "Lead was high."), (4, "Zinc was 7 [E1]."), (5, None), (6, "Both, 7 and 1,250 [E1][E2]."), (7, "Nothing [E1].")]
    got = {r["question"]: (r["verdict"], r["answer"], r["cited"]) for r in answers.answers(spark.createDataFrame(raw, "question int, raw string"), bundle).collect()}
    assert got[1] == ("supported", "Lead was 1250 mg [E1].", "E1") and got[2] == ("softened", "Lead was 1250 mg [E1].", "E1")
    assert got[3] == got[4] == got[5] == ("fallback", "Lead was 1,250 mg [E1].", "E1")
    assert got[6][0] == "supported" and got[6][2] == "E1,E2" and got[7] == ("abstained", answers.ABSTAINED, "")


def test_a_stub_keeps_its_numbers_whole(spark):
    quotes = ["Seen from 15.193.86.107 on.\nMore.", "It rose\n by 3.5 [E7]! Then fell.", "No end", "...", ""]
    bundle = spark.createDataFrame([(q, "E1", t) for q, t in enumerate(quotes)], "question int, tag string, quote string")
    raw = bundle.select("question", answers.stub(F.create_map("tag", "quote")).alias("raw"))
    assert [r["raw"] for r in raw.orderBy("question").collect()] == ["Seen from 15.193.86.107 on [E1].", "It rose by 3.5 [E1].", "No end [E1].", " [E1].", " [E1]."]
    assert [(r["verdict"], r["cited"]) for r in answers.answers(raw, bundle).collect()] == [("supported", "E1")] * 5
