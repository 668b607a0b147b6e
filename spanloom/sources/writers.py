"""Sinks: parts of exact sizes, typed CSV and Parquet, published runs, upserts, split folders (K*)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.ranks import placed
from spanloom.sources.readers import _fs, digest, manifest_hash, text_of


def exact_parts(rows: DataFrame, order: list[str], parts: int) -> DataFrame:
    """K1: rows with a part from 0; sizes differ by one at most, the first parts are the larger ones.

    No task sees all rows (:func:`~spanloom.operators.ranks.placed`).
    """
    n = rows.count()
    place = F.col("__place") - 1
    small, large = n // parts, n % parts
    part = F.when(place < large * (small + 1), F.floor(place / (small + 1))).otherwise(large + F.floor((place - large * (small + 1)) / max(1, small)))
    return placed(rows, [], [F.col(c) for c in order], "__place").withColumn("part", part.cast("int")).drop("__place")


def write_parts(rows: DataFrame, path: str, order: list[str], parts: int) -> None:
    """K1: JSON lines, a folder a part."""
    exact_parts(rows, order, parts).repartition("part").write.mode("overwrite").partitionBy("part").json(path)


def csv_ready(rows: DataFrame) -> DataFrame:
    """K2: booleans as TRUE and FALSE, lists, maps and structs as JSON."""

    def cell(name: str, kind: str) -> Column:
        c = F.col(name)
        return (F.upper(c.cast("string")) if kind == "boolean" else F.to_json(c) if kind.startswith(("array", "map", "struct")) else c).alias(name)

    return rows.select(*[cell(n, k) for n, k in rows.dtypes])


def typed(rows: DataFrame, kinds: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """K3, K4: columns coerced to kinds, what does not fit null, then the default."""
    out = {c: F.col(c).try_cast(k) for c, k in kinds.items()}
    for c, d in (defaults or {}).items():
        out[c] = F.coalesce(out.get(c, F.col(c)), F.lit(d))
    return rows.withColumns(out)


def write_csv(rows: DataFrame, path: str) -> None:
    csv_ready(rows).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_strict(rows: DataFrame, path: str, schema) -> None:
    """K5: Parquet with zstd under just this schema."""
    if [(f.name, f.dataType) for f in rows.schema.fields] != [(f.name, f.dataType) for f in schema.fields]:
        raise ValueError(f"schema differs: {rows.schema.simpleString()}")
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def publish(frames: dict[str, DataFrame], root: str, run: str, expect: str | None = None) -> dict:
    """Tables of a run, counted after they are written, and then the pointer.

    expect: the run that must still be the latest when the pointer moves (K7). A run's folder is never written twice.
    """
    spark = next(iter(frames.values())).sparkSession
    fs, folder = _fs(spark, f"{root}/runs/{run}")
    if fs.exists(folder):
        raise ValueError(f"run {run} is published already")
    manifest = {"run": run, "tables": {}}
    for name, df in frames.items():
        df.write.parquet(f"{root}/runs/{run}/{name}")
        written = spark.read.parquet(f"{root}/runs/{run}/{name}")
        manifest["tables"][name] = {"rows": written.count(), "schema": written.schema.simpleString()}
    manifest["hash"] = manifest_hash(manifest)
    put_text(spark, f"{root}/runs/{run}/_SUCCESS.json", json.dumps(manifest, sort_keys=True))
    if expect is not None and (pointer(spark, root) or {}).get("run") != expect:
        raise ValueError("another run was published meanwhile")
    put_text(spark, f"{root}/LATEST.json", json.dumps({"run": run, "hash": manifest["hash"]}))
    return manifest


def pointer(spark: SparkSession, root: str) -> dict | None:
    fs, path = _fs(spark, f"{root}/LATEST.json")
    return json.loads(text_of(spark, str(path))) if fs.exists(path) else None


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in one step: written beside its name, then renamed over it."""
    fs, target = _fs(spark, path)
    _, beside = _fs(spark, f"{path}.new")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, how)


def write_snapshot(frames: dict[str, DataFrame], path: str) -> dict:
    """Tables of a snapshot and a manifest of their rows and hashes, taken from what was written."""
    spark = next(iter(frames.values())).sparkSession
    manifest = {}
    for name, df in frames.items():
        df.write.parquet(f"{path}/{name}")
        manifest[name] = digest(spark.read.parquet(f"{path}/{name}"))
    put_text(spark, f"{path}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


#: K8: the tables of a registry, and the columns that each must have.
REGISTRY_TABLES = {
    "concepts": ["concept", "label", "entity_type", "state", "redirect", "version"], "aliases": ["concept", "alias", "trust"], "instances": ["instance", "paper_id", "context_id", "label"],
    "assignments": ["mention_id", "concept"], "constraints": ["mention_id", "rule", "target_id"], "authority_links": ["authority", "external_id", "target_id"],
    "redirects": ["retired", "target"], "events": ["version", "event", "subject", "object"],
}
#: K9: the tables of a resolution run.
RUN_TABLES = {
    "decisions": ["mention_id", "status", "method", "target", "reasons", "score", "margin"], "candidates": ["mention_id", "target_id", "score", "rank"], "conflicts": ["mention_id", "target_id", "code"],
    "proposals": ["target", "mentions"], "issues": ["mention_id", "code"], "assignments": ["mention_id", "concept"],
}


def _just(frames: dict[str, DataFrame], wanted: dict[str, list[str]]) -> dict[str, DataFrame]:
    if set(frames) != set(wanted):
        raise ValueError(f"tables differ: {sorted(set(frames) ^ set(wanted))}")
    if wrong := [n for n, columns in wanted.items() if not set(columns) <= set(frames[n].columns)]:
        raise ValueError(f"tables lack columns: {wrong}")
    return {n: df.select(*wanted[n]) for n, df in frames.items()}


def write_registry(frames: dict[str, DataFrame], root: str, run: str, expect: str | None = None) -> dict:
    """K8: the eight tables of a registry as a published run (K6, K7)."""
    return publish(_just(frames, REGISTRY_TABLES), root, run, expect)


def write_resolution(frames: dict[str, DataFrame], root: str, run: str, policy_hash: str) -> dict:
    """K9: the six tables of a resolution run, published, with a CSV of what waits for review and a summary as JSON."""
    frames = _just(frames, RUN_TABLES)
    manifest = publish(frames, root, run)
    spark, folder = frames["decisions"].sparkSession, f"{root}/runs/{run}"
    decided = spark.read.parquet(f"{folder}/decisions")
    write_csv(decided.where("status LIKE 'REVIEW%'").orderBy("status", "mention_id"), f"{folder}/review_csv")
    summary = {r["status"]: r["n"] for r in decided.groupBy("status").agg(F.count("*").alias("n")).collect()}  # a row a status
    put_text(spark, f"{folder}/summary.json", json.dumps(summary, sort_keys=True))
    put_text(spark, f"{folder}/policy.json", json.dumps({"policy": policy_hash}))
    return manifest


def append_log(rows: DataFrame, path: str) -> None:
    """K13, K16"""
    rows.write.mode("append").json(path)


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """A folder a split; folders of an earlier write go."""
    rows.repartition(split).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(split).parquet(path)


def merged(frames: list[DataFrame]) -> DataFrame:
    """Part tables as one; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merged_master(frames: list[DataFrame], newest: str, key: str) -> DataFrame:
    """Part tables as one, the newest first."""
    return merged(frames).orderBy(F.desc_nulls_last(newest), key)
