"""Sources with contracts: typed scans, JSON lines, CSV with damage, front matter, frozen manifests, pointers (S*)."""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.unicode import key_of
from spanloom.operators.funnel import contract
from spanloom.operators.joins import require_none

#: Encodings that are tried in order.
ENCODINGS = ("utf-8", "utf-8-sig", "latin-1", "cp1252")


def table(spark: SparkSession, path: str, columns: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The named columns of a Parquet table; one that is missing raises and is named."""
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*columns)


def checked_table(spark: SparkSession, path: str, columns: list[str], keys: list[str], booleans: list[str] = ()) -> DataFrame:
    """S3: like :func:`table`, and keys must be unique and booleans known; all checks are one aggregate."""
    df = table(spark, path, columns)
    found = contract(df, {f"{b} is unknown": F.col(b).isNull() for b in booleans}, unique={f"{k} repeats": k for k in keys})
    require_none(found)
    return df


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, damaged: str = "fail") -> DataFrame:
    """JSON lines under a schema, blank lines skipped. damaged: "fail", "drop" (a torn last line too), or "keep".

    "keep" adds the column _corrupt_record, null for good lines (S7).
    """
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}[damaged]
    if damaged == "keep":
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def damage_counts(rows: DataFrame) -> DataFrame:
    """Good and damaged lines of a kept read."""
    return rows.groupBy(F.col("_corrupt_record").isNull().alias("good")).agg(F.count("*").alias("lines"))


def csv_table(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None, encoding: str = "UTF-8", damaged: str = "drop") -> DataFrame:
    """CSV with quoted line breaks under a schema; rows that do not fit are dropped, kept or fail."""
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}[damaged]
    df = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', quote='"', encoding=encoding, mode=mode).csv(path)
    return df.select(*(columns or df.columns))


def encoding_of(head: bytes) -> str:
    """The first encoding of ENCODINGS that reads a file's first bytes; a character cut at their end is no fault."""
    if head.startswith(b"\xef\xbb\xbf"):
        return "utf-8-sig"
    for name in ENCODINGS:
        try:
            codecs.getincrementaldecoder(name)().decode(head)
            return name
        except UnicodeDecodeError:
            continue
    return ENCODINGS[-1]


def front_matter(spark: SparkSession, path: str, fields: list[str], head: int = 1200) -> DataFrame:
    """(path, text, chars, each field) of Markdown files with a header between lines of dashes."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    header = F.regexp_extract(F.left("text", F.lit(head)), r"(?s)\A---\n(.*?)(\n---|\z)", 1)
    picked = [F.nullif(F.trim(F.regexp_extract(header, rf"(?m)^{re.escape(f)}:[ \t]*\"?(.*?)\"?[ \t]*$", 1)), F.lit("")).alias(f) for f in fields]
    return files.select("path", "text", F.length("text").alias("chars"), *picked)


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload, damaged) of one JSON text a file; a file that is no JSON is named, not fatal."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("payload"))
    return files.withColumn("damaged", F.try_parse_json("payload").isNull())


def newest_eligible(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The last row of each paper that is ok, permitted and not retracted; so many of them, in order of the key."""
    good = rows.where("status = 'ok' and permitted and not coalesce(retracted, false)")
    last = good.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("x"))
    return last.select(key, "x.*").orderBy(key).limit(most)


def frozen_manifest(spark: SparkSession, path: str) -> DataFrame:
    """paper_id, family_id, domain, split of a split manifest that breaks none of its rules."""
    df = table(spark, path, ["paper_id", "family_id", "domain", "split"])
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    require_none(contract(df, {"blank paper": blank("paper_id"), "blank family": blank("family_id"), "unknown split": ~F.col("split").isin("train", "evaluate", "test")}, unique={"paper repeats": "paper_id"}))
    straddling = df.groupBy("family_id").agg((F.min("split") != F.max("split")).alias("bad")).where("bad")
    if not straddling.isEmpty():
        raise ValueError("a family spans several splits")
    return df


def manifest_hash(manifest: dict) -> str:
    """The hash of a run's manifest, its own entry left out."""
    return hashlib.sha256(json.dumps({k: v for k, v in manifest.items() if k != "hash"}, sort_keys=True).encode()).hexdigest()


def latest(spark: SparkSession, root: str) -> str:
    """The folder of the published run that LATEST.json names; the root itself where nothing was published.

    The run's manifest must have the hash that the pointer names.
    """
    fs, path = _fs(spark, f"{root}/LATEST.json")
    if not fs.exists(path):
        return root
    named = json.loads(text_of(spark, str(path)))
    folder = f"{root}/runs/{named['run']}"
    manifest = json.loads(text_of(spark, f"{folder}/_SUCCESS.json"))
    if manifest_hash(manifest) != named["hash"]:
        raise ValueError(f"the manifest of run {named['run']} is not the one that was published")
    return folder


def text_of(spark: SparkSession, path: str) -> str:
    """A small text file, whatever its name begins with."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def filtered(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows of the wanted values; lists are alternatives, pairs are ranges. Filters reach the scan."""
    for column, value in wanted.items():
        c = F.col(column)
        rows = rows.where(c.between(*value) if isinstance(value, tuple) else c.isin(*value) if isinstance(value, list) else c == value)
    return rows


def aliases(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """(alias, norm, canonical, lang, source) of an alias dictionary; the canonical name is an alias of itself."""
    rows = sorted({(a, key_of(a), e["canonical"], e.get("lang", "en"), e.get("source", "dictionary")) for e in entries for a in [e["canonical"], *e.get("aliases", [])]})
    return spark.createDataFrame(rows, "alias string, norm string, canonical string, lang string, source string")


@dataclass(frozen=True)
class Policy:
    """What a resolver may do, read once and never changed."""

    version: str
    accept_score: float
    min_margin: float
    top_k: int
    trusted: tuple[str, ...]
    allowed_types: tuple[str, ...]


def policy(text: str) -> tuple[Policy, str]:
    """The typed policy of a JSON text and the hash of its canonical form; unknown, missing or odd entries raise."""
    value = json.loads(text)
    names = {f.name for f in fields(Policy)}
    if set(value) != names:
        raise ValueError(f"policy entries differ: {sorted(set(value) ^ names)}")
    if not (0 <= value["accept_score"] <= 100 and 0 <= value["min_margin"] <= 100 and value["top_k"] >= 1):
        raise ValueError("policy scores lie in 0 to 100 and top_k is positive")
    made = Policy(str(value["version"]), float(value["accept_score"]), float(value["min_margin"]), int(value["top_k"]), tuple(value["trusted"]), tuple(value["allowed_types"]))
    return made, hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def digest(df: DataFrame) -> dict:
    """Rows and a hash of a table's content that no order of rows changes; each task adds up before the exchange."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    n, mixed, total = df.agg(F.count("*"), F.bit_xor(row), F.sum(F.pmod(row, F.lit(1 << 31)))).first()
    return {"rows": n, "hash": f"{(mixed or 0) & 0xFFFFFFFFFFFFFFFF:016x}{(total or 0) & 0xFFFFFFFFFFFFFFFF:016x}"}


def authority_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, crosswalks) of an authority's snapshot; each must be what its manifest says, by rows and hash."""
    manifest = json.loads(text_of(spark, f"{path}/manifest.json"))
    out = []
    for name in ("entries", "crosswalks"):
        df = spark.read.parquet(f"{path}/{name}")
        if digest(df) != manifest[name]:
            raise ValueError(f"{name} of the snapshot are not what its manifest says")
        out.append(df)
    return out[0], out[1]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
