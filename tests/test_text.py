"""Scalar functions against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from spanloom.functions import numeric as N
from spanloom.functions import structured as J
from spanloom.functions import text as T
from spanloom.functions import unicode as U


def one(spark, c, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return row.select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (T.clean, " NaN ", ""),
        (T.clean, " x ", "x"),
        (T.skeleton, "A-b C.1", "abc1"),
        (T.norm_ascii, "  The  Well’s pH: 7.5! ", "the well's ph 7.5"),
        (T.licence_tier, "CC BY 4.0", 1),
        (T.licence_tier, "CC BY ND", 3),
        (T.licence_tier, "training permitted", 2),
        (T.licence_tier, "all rights reserved", 3),
        (T.licence_name, "https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-nc"),
        (T.doi_key, " https://doi.org/10.1/AbC", "10.1/abc"),
        (T.work_id, "https://x.org/w123", "W123"),
        (T.canonical_number, "1,250.500", "1250.5"),
        (T.slug, "Ab, c / d!", "ab_c_d"),
        (T.acronym, "vertical electrical sounding", "VES"),
        (T.normalise_answer, "The  Answer, is: A map.", "answer is map"),
        (T.enum_spelling, " in-vitro  test", "IN_VITRO_TEST"),
        (T.strip_tags, "<p>a<b>c</b></p><script>x</script> d", "a c d"),
        (T.token_estimate, "a b.", 11),
        (T.mask_citations, "As [1] and (Smith et al., 2019) say", "As and say"),
        (T.valid_url, "https://a.org/x", True),
        (T.valid_url, "a.org", False),
    ],
)
def test_scalar(spark, function, given, expected):
    assert one(spark, function(F.col("t")), t=given) == expected


def test_whole_words_only(spark):
    assert not one(spark, T.mentions(F.lower("t"), F.lit("eri")), t="Rainwater in Nigeria")
    assert one(spark, T.mentions(F.lower("t"), F.lit("eri")), t="by ERI (2D)")
    assert not one(spark, T.mentions(F.col("t"), F.lit("")), t="x")


def test_terms_and_sentences(spark):
    assert one(spark, T.content_terms(F.col("t")), t="Studies were testing the samples") == ["study", "test", "sample"]
    assert one(spark, T.sentences(F.col("t")), t="One. Two?\nThree") == ["One.", "Two?", "Three"]
    assert one(spark, T.sentences(F.col("t"), capital=True), t="At 3.5 mg. was it. Yes") == ["At 3.5 mg. was it.", "Yes"]


def test_answers(spark):
    assert one(spark, T.exact_match(F.col("a"), F.col("b")), a="The map", b="map!") == 1
    assert one(spark, T.token_f1(F.col("a"), F.col("b")), a="red red map", b="red map") == pytest.approx(0.8)
    assert one(spark, T.token_f1(F.col("a"), F.col("b")), a="", b="red") == 0.0


def test_paper_body(spark):
    paper = "---\ntitle: x\n---\nText <!-- PDF_PAGE: 2 -->more\n# References\nkept?\n## Two\n# References\n[1]"
    body = one(spark, T.paper_body(F.col("t")), t=paper)
    assert body.startswith("Text more") and "kept?" in body and "[1]" not in body


def test_large_quantities_are_kept():
    found = [(q["raw"], q["value"]) for q in U.quantities_of("9,999,999,999 kg, 12,345,678,901.25 kg and 1e30 m")]
    assert [r for r, _ in found] == ["9,999,999,999", "12,345,678,901.25", "1e30"]
    assert str(found[1][1].normalize()) == "12345678901.25" and found[2][1] is None


def test_quantities():
    found = [(q["raw"], float(q["value"]), q["unit"]) for q in U.quantities_of("32.7 mg/L, not 32; 1,250 ppm")]
    assert found == [("32.7", 32.7, "mg/l"), ("32", 32.0, ""), ("1,250", 1250.0, "ppm")]


def test_alignment():
    text = "The con-\ntaminant  level was high. Low level."
    assert text[slice(*U.aligned_span(text, "contaminant level"))] == "con-\ntaminant  level"
    assert U.aligned_span(text, "level") is None and U.aligned_span(text, "absent") is None


def test_family_names():
    assert [U.family_of(n) for n in ("Ada Lovelace", "Vincent van Gogh", "Smith, J.", "J. Smith Jr.", "Okoye C.")] == ["Lovelace", "van Gogh", "Smith", "Smith", "Okoye"]


def test_norm_beyond_ascii(spark):
    rows = spark.createDataFrame([("Côte d’Ivoire",), ("plain",), (None,)], "t string")
    assert [r[0] for r in rows.select(U.norm(F.col("t"))).collect()] == ["côte d'ivoire", "plain", None]


@pytest.mark.parametrize(
    ("given", "payload", "repaired"),
    [('{"a": 1}', '{"a":1}', False), ('x {"a": [1, 2,],}', '{"a":[1,2]}', True), ('{"a": [1, 2], "b": "cut', '{"a":[1,2]}', True), ("none", None, False)],
)
def test_salvage(given, payload, repaired):
    assert J.salvage(given) == (payload, repaired)


def test_evidence_shapes():
    assert J.evidence_of({"evidence": [{"quote": "a", "page": 3}, "b"]}) == [("a", "3"), ("b", "")]
    assert J.evidence_of({"source": {"span": "c"}}) == [("c", "")] and J.evidence_of(5) == []


def test_wilson(spark):
    low, high = N.wilson(F.col("s"), F.col("n"))
    got = one(spark, F.array(low, high), s=8.0, n=10.0)
    assert got == pytest.approx([0.4901625, 0.9433178], abs=1e-6)


def test_stance(spark):
    assert [one(spark, N.stance(F.col("a"), F.col("b")), a=a, b=10.0) for a in (11.0, 20.0)] == ["supporting", "conflicting"]


def test_uuid5(spark):
    import uuid

    got = one(spark, N.uuid5(uuid.NAMESPACE_DNS.hex, F.col("t")), t="python.org")
    assert got == str(uuid.uuid5(uuid.NAMESPACE_DNS, "python.org"))


@pytest.mark.parametrize("w", [["b", "a", "b", "c", "a", "b"], ["x"], [], None])
def test_an_index_gives_its_text_back(spark, w):
    row = spark.createDataFrame([(w,)], "w array<string>").select(T.inverted_index(F.col("w")).alias("x")).select("x", T.text_of_index(F.col("x")).alias("t")).first()
    places = None if w is None else [(t, [i for i, x in enumerate(w) if x == t]) for t in sorted(set(w))]
    assert row["t"] == (None if w is None else " ".join(w)) and (row["x"] and [(e["term"], e["places"]) for e in row["x"]] or row["x"]) == places


def test_texts_reach_python_in_small_batches(spark):
    from spanloom.functions.vectorized import vectorized

    @vectorized("int")
    def rows(s):
        return s.map(lambda _: len(s))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    held = spark.range(2500).coalesce(1).select(rows(F.col("id")).alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 1000
