"""Plug-ins, clusters of qualifiers, spoken numbers, progress and the command line."""

import pytest
from pyspark.sql import functions as F

from spanloom.cli import main
from spanloom.functions import unicode as U
from spanloom.operators import ranks, resolve
from spanloom.plans.registry import QUERIES
from spanloom.sources.cursor import fetch_with_retries
from spanloom.streaming import progress


def test_spoken_numbers():
    assert U.speak("1,250.5 mg/L of 21 and 7% [E3] .") == "one thousand two hundred and fifty point five milligrams per litre of twenty-one and seven percent."
    assert U.speak("So 40 [E12]", keep_citations=True) == "So forty, evidence twelve,"
    said = {"0": "zero", "007": "seven", "110": "one hundred and ten", "1000": "one thousand", "1000001": "one million one", "20000300015": "twenty billion three hundred thousand fifteen", "1000000000000": "one thousand billion"}
    assert {k: U.spoken_number(k) for k in said} == said
    assert U.strict_projection("“Ab”  *c*—d") == '"ab" c-d' and U.strict_projection("a b", compact=True) == "ab"


def clusters(spark, rows):
    df = spark.createDataFrame(rows, "name string, mention int, q map<string,string>")
    return {r["mention"]: r["cluster"] for r in resolve.compatible_clusters(df, "name", "mention", "q").collect()}


def test_complementary_qualifiers_join_and_conflicts_stay_apart(spark):
    assert clusters(spark, [("n", 1, {"a": "x"}), ("n", 2, {"b": "y"}), ("n", 3, {})]) == {1: 1, 2: 1, 3: 1}
    assert clusters(spark, [("n", 1, {"a": "x"}), ("n", 2, {"a": "z"}), ("n", 3, {}), ("m", 4, {})]) == {1: 1, 2: 2, 3: 3, 4: 4}
    # a bridge that fits two rivals joins neither
    assert clusters(spark, [("n", 1, {"a": "x"}), ("n", 2, {"a": "z"}), ("n", 3, {"b": "y"})]) == {1: 1, 2: 2, 3: 3}


def test_retries_end():
    calls = []

    def fetch(cursor, size):
        calls.append(cursor)
        raise OSError("down")

    with pytest.raises(OSError):
        fetch_with_retries(fetch, 7, 10, tries=3, wait=0)
    assert calls == [7, 7, 7]


def test_limits_follow_failures():
    assert [progress.next_limit(8, f, 10) for f in (0, 1, 5)] == [9, 8, 4]
    assert progress.event_lines([{"b": 1, "a": 2}]) == 'data: {"a": 2, "b": 1}\n\n'


def test_places_are_exact_with_null_keys(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else i % 3, i) for i in range(200)], "k int, v int")
    got = {r["v"]: r["place"] for r in ranks.placed(df, ["k"], [F.desc("v")]).collect()}
    for group in ({i for i in range(200) if i % 3 == m} for m in range(3)):
        assert [got[v] for v in sorted(group, reverse=True)] == list(range(1, len(group) + 1))


def test_command_line_lists(capsys):
    assert main(["list"]) == 0 and "bm25_topk" in capsys.readouterr().out


def test_components_of_all_orders_equal_union_find(spark, tmp_path):
    keys = [k for k in range(5, 700) if k % 7]  # some parents are no customers
    spark.createDataFrame([(k,) for k in keys], "o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k in keys:
        a, b = sorted((root(k), root(k // 4)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in QUERIES["components"](spark, str(tmp_path)).collect()}
    assert got == {x: root(x) for x in parent} and {k for k in keys if k % 5 == 0} <= got.keys()


def test_spoken_texts_are_whole(spark, tmp_path):
    text = "many words " * 20 + "and the end"
    spark.createDataFrame([(1, 0, text)], "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    row = QUERIES["spoken_texts"](spark, str(tmp_path)).first()
    assert row["flat"] == text and row["spoken"].startswith(f"{text} at one thousand")


def test_random_negatives_are_of_other_groups(spark):
    from spanloom.operators import splits

    asked = spark.createDataFrame([(i, f"q{i}", f"d{i}") for i in range(50)], "g int, query string, doc string")
    got = splits.random_negatives(asked, asked.select("g", "doc"), "g", ["g"], 3, 7).collect()
    assert 100 < len(got) <= 150 and all(r["doc"] != f"d{r['g']}" for r in got) and len(set(got)) == len(got)
    assert sorted(got) == sorted(splits.random_negatives(asked.repartition(5), asked.select("g", "doc"), "g", ["g"], 3, 7).collect())
