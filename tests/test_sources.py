"""Sources, sinks and streams on small files."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.sources import readers, writers
from spanloom.streaming import ingest


def test_missing_column_is_named(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="absent"):
        readers.table(spark, f"{tmp_path}/t", ["id", "absent"])


def test_json_lines_modes(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n{"id": 3, "x')
    schema = T.StructType.fromDDL("id int")
    path = str(tmp_path / "a.jsonl")
    assert sorted(r[0] for r in readers.json_lines(spark, path, schema, "drop").collect()) == [1, 2]
    kept = readers.json_lines(spark, path, schema, "keep").cache()
    assert {r["good"]: r["lines"] for r in readers.damage_counts(kept).collect()} == {True: 2, False: 1}
    with pytest.raises(Exception):  # noqa: B017
        readers.json_lines(spark, path, schema).collect()


def test_encodings():
    assert [readers.encoding_of(b) for b in ("é".encode(), "é".encode("utf-8-sig"), "é.".encode("latin-1"), "é".encode()[:1])] == ["utf-8", "utf-8-sig", "latin-1", "utf-8"]


def test_front_matter_and_records(spark, tmp_path):
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "a.md").write_text('---\ntitle: "A b"\ndoi:\n---\nBody')
    row = readers.front_matter(spark, f"{tmp_path}/md", ["title", "doi"]).first()
    assert (row["title"], row["doi"]) == ("A b", None) and row["text"].endswith("Body")
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('{"a": 1}')
    (tmp_path / "raw" / "b.json").write_text('{"a": ')
    assert sorted(r["damaged"] for r in readers.raw_records(spark, f"{tmp_path}/raw").collect()) == [False, True]


def test_publish_moves_the_pointer_last(spark, tmp_path):
    root = str(tmp_path)
    manifest = writers.publish({"t": spark.range(5)}, root, "r1")
    assert manifest["tables"]["t"]["rows"] == 5 and readers.latest(spark, root).endswith("runs/r1")
    with pytest.raises(ValueError, match="published already"):
        writers.publish({"t": spark.range(5)}, root, "r1")
    with pytest.raises(ValueError, match="meanwhile"):
        writers.publish({"t": spark.range(6)}, root, "r2", expect="r0")
    assert json.loads((tmp_path / "LATEST.json").read_text())["run"] == "r1"


def test_a_changed_manifest_is_refused(spark, tmp_path):
    root = str(tmp_path)
    writers.publish({"t": spark.range(5)}, root, "r1")
    path = tmp_path / "runs" / "r1" / "_SUCCESS.json"
    path.write_text(path.read_text().replace('"rows": 5', '"rows": 6'))
    for crc in path.parent.glob("._SUCCESS*"):
        crc.unlink()
    with pytest.raises(ValueError, match="not the one"):
        readers.latest(spark, root)


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    for text in ("one", "two longer", ""):
        writers.put_text(spark, f"{tmp_path}/a.json", text)
        assert readers.text_of(spark, f"{tmp_path}/a.json") == text
    assert not list(tmp_path.glob("*.new"))


def test_snapshots_are_compared_by_content(spark, tmp_path):
    frames = {"entries": spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"), "crosswalks": spark.createDataFrame([], "a int")}
    writers.write_snapshot(frames, str(tmp_path))
    entries, _ = readers.authority_snapshot(spark, str(tmp_path))
    assert entries.count() == 2 and readers.digest(entries) == readers.digest(entries.orderBy(F.desc("id")).select("name", "id"))
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").write.mode("overwrite").parquet(f"{tmp_path}/entries")
    with pytest.raises(ValueError, match="entries"):
        readers.authority_snapshot(spark, str(tmp_path))


def test_policies_are_typed():
    good = {"version": 1, "accept_score": 95, "min_margin": 5, "top_k": 10, "trusted": ["A"], "allowed_types": []}
    made, key = readers.policy(json.dumps(good))
    assert made.accept_score == 95.0 and made.trusted == ("A",) and readers.policy(json.dumps(dict(reversed(good.items()))))[1] == key
    for bad in ({**good, "more": 1}, {k: v for k, v in good.items() if k != "top_k"}, {**good, "accept_score": 101}, {**good, "top_k": 0}):
        with pytest.raises(ValueError, match="policy"):
            readers.policy(json.dumps(bad))


def test_registry_tables_are_all_wanted(spark, tmp_path):
    with pytest.raises(ValueError, match="tables differ"):
        writers.write_registry({"concepts": spark.range(1)}, str(tmp_path), "r1")


def test_exact_parts(spark):
    got = writers.exact_parts(spark.range(10), ["id"], 3).groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("low")).orderBy("part").collect()
    assert [tuple(r) for r in got] == [(0, 4, 0), (1, 3, 4), (2, 3, 7)]


def test_frozen_manifest(spark, tmp_path):
    good = spark.createDataFrame([("p1", "f1", "health", "train"), ("p2", "f2", "health", "test")], "paper_id string, family_id string, domain string, split string")
    good.write.parquet(f"{tmp_path}/good")
    assert readers.frozen_manifest(spark, f"{tmp_path}/good").count() == 2
    good.unionByName(good.withColumn("paper_id", F.lit("p3")).withColumn("split", F.lit("evaluate"))).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(ValueError):
        readers.frozen_manifest(spark, f"{tmp_path}/bad")


def test_stream_skips_seen_keys_over_two_runs(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, ts timestamp")
    rows = lambda ids: spark.createDataFrame([(i, None) for i in ids], "id int, t string").select("id", F.lit("2024-01-01").cast("timestamp").alias("ts"))
    for ids in ([1, 2, 2], [2, 3]):
        rows(ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.drain(ingest.unseen(ingest.file_stream(spark, f"{tmp_path}/in", schema), "id", "ts"), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]
