"""The training-set funnel on a handful of pairs."""

import pytest
from pyspark.sql import functions as F

from spanloom.operators import training

COLUMNS = "pair_id paper_id pair_type question answer reasoning chosen rejected positive_quote hard_negative_quote descriptor assignment evidence citation_label".split()
DESCRIPTOR = "Obi and others in 'A study of wells in the delta' of many"


def pair(i, kind="FACTUAL", paper="p1", **more):
    base = dict(pair_id=i, paper_id=paper, pair_type=kind, question=f"what was lead in wells {i}", answer="lead was 5 mg/l", reasoning="", chosen="lead was 5 mg/l", rejected="nobody knows", positive_quote="lead was 5", hard_negative_quote="zinc was 7", descriptor=DESCRIPTOR, assignment="DUAL", evidence="lead was 5 mg/l in wells", citation_label="")
    return tuple((base | more)[c] for c in COLUMNS)


@pytest.fixture(scope="module")
def built(spark):
    pairs = [
        pair("a"), pair("b", assignment="OPEN", citation_label="Obi, 2001"), pair("c", evidence="nothing at all"), pair("d", paper="p9"), pair("e", answer=" "),
        pair("f", "PREFERENCE", citation_label="Obi, 2001"), pair("g", "PREFERENCE", rejected="LEAD was 5 mg/l."), pair("h", "RERANKER"), pair("i", "RERANKER", positive_quote=""),
        pair("j"), pair("j"), pair("k"), pair("k", answer="lead was 6 mg/l"), pair("l", question="what was lead"), pair("m", paper="p2", question="What was lead?"), pair("n", descriptor="short", evidence=""),
    ]
    manifest = spark.createDataFrame([("p1", "f1", "train"), ("p2", "f2", "test")], "paper_id string, family_id string, split string")
    frames, counts = training.build(spark.createDataFrame(pairs, ", ".join(f"{c} string" for c in COLUMNS)), manifest)
    return frames, {r["stage"]: r["n"] for r in counts.collect()}, manifest


def ids(df, key="pair_id"):
    return sorted(r[key] for r in df.collect())


def test_every_pair_has_its_place(built):
    frames, counts, _ = built
    assert ids(frames["sft_examples"], "example_id") == ["a:CLOSED", "a:OPEN", "b:OPEN", "j:CLOSED", "j:OPEN", "m:CLOSED", "m:OPEN"]
    assert ids(frames["sft_mixed"], "example_id") == sorted([*ids(frames["sft_examples"], "example_id"), "c:OPEN"])
    assert ids(frames["dpo_pairs"]) == ["f"] and ids(frames["reranker_mixed"]) == ["h"]
    out = sorted((r["pair_id"], r["stage"], r["reason"]) for n in ("quarantine", "discarded") for r in frames[n].collect())
    assert [(i, s) for i, s, _ in out] == [("c", "SUPPORT"), ("d", "STRUCTURAL"), ("e", "STRUCTURAL"), ("g", "DPO_CONTRACT"), ("i", "RERANKER"), ("k", "DUPLICATE"), ("k", "DUPLICATE"), ("l", "SPLIT_LEAKAGE"), ("n", "ASSIGNMENT"), ("n", "SUPPORT")]
    assert counts["READ"] == 16 and counts["DUPLICATE"] == 2


def test_renderings(built):
    b = built[0]["sft_examples"].where("pair_id = 'b'").first()
    assert b["response"] == "lead was 5 mg/l\n\nProvenance: Obi, 2001" and b["messages"][1]["content"] == b["response"] and "Evidence:" in b["messages"][0]["content"]
    f = built[0]["dpo_pairs"].first()
    assert f["chosen"].endswith("Obi, 2001") and f["rejected"].endswith("Obi, 2001")


def test_no_rule_is_broken_until_a_table_is(built):
    frames, _, manifest = built
    assert training.violations(frames, manifest).where("n > 0").count() == 0
    bad = dict(frames)
    bad["sft_examples"] = frames["sft_examples"].withColumns({"verification_tier": F.lit("UNVERIFIED"), "split": F.lit("test"), "response": F.lit("x")})
    bad["dpo_pairs"] = frames["dpo_pairs"].withColumn("rejected", F.lit("no footer")).unionByName(frames["dpo_pairs"])
    broken = {r["rule"] for r in training.violations(bad, manifest).where("n > 0").collect()}
    assert {"sft_examples: tier", "sft_examples: response in messages", "sft_examples: differs from the manifest", "sft_examples: differs from sft_mixed", "dpo_pairs: repeated id", "dpo_pairs: footer tells them apart", "dpo_pairs: differs from preference_mixed"} <= broken
    with pytest.raises(ValueError, match="columns differ"):
        training.violations({**frames, "dpo_pairs": frames["dpo_pairs"].drop("split")}, manifest)
