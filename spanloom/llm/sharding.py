"""Sharding by histogram sort (operator 7, DataFrame functions only).

Rows are ordered by a hash of their text and then by doc_id, so that equal texts lie together, and the seven
boundaries between eight shards are found without sorting: each round counts the exact bytes in equal steps
between the least and the greatest key that may hold a boundary, over all partitions, and goes on within the
step that holds it, until the bytes below a candidate are within the tolerance of the aim, or the step holds one
key. Steps run over the hash first and over doc_id where one hash is left, so that a group of equal texts is cut
wherever the bytes ask for it. Then one range exchange orders the rows, and slots follow from counts of its parts.

The law is `bytes`: shard sizes differ from the mean by no more than the tolerance and one row (or the rows of one
key, where several rows are equal in text and doc_id).
Defined cases: a null text has no bytes (size 1, crc32 0); repeated rows are rows of their own, in any order among
themselves, in one shard; rows without doc_id come first within their text; any long is a doc_id; a
text of any length is a row, and cannot be cut; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import pick
from spanloom.storage import materialize

SHARDS = 8
#: Candidate boundaries between the least and the greatest key, in each round and for each boundary searched.
PROBES = 512
#: Bytes by which a boundary may miss its aim, as a share of a shard.
TOLERANCE = 0.001
#: Rows of a part of the range exchange, about.
PART_ROWS = 500_000


def _splitters(rows: DataFrame, total: int, shards: int) -> list[tuple[int, int | None]]:
    """Keys (hash, doc_id) at which the shards 1, 2, ... begin; doc_id None: with the hash's first row."""
    aims = [total * k // shards for k in range(1, shards)]
    slack = max(1, int(TOLERANCE * total / shards))
    found: dict[int, tuple[int, int | None]] = {}
    least, greatest = rows.agg(F.min("hash"), F.max("hash")).first()
    # (hash or None, least, greatest key of the search, bytes below it) -> the boundaries searched there
    open_: dict[tuple, list[int]] = {(None, least, greatest, 0): list(range(len(aims)))}
    while open_:
        spans = list(open_)
        cases: Column | None = None
        for i, (at, low, high, _) in enumerate(spans):
            key, width = F.col("hash") if at is None else F.col("id"), max(1, -(-(high - low + 1) // PROBES))
            inside = key.between(low, high) if at is None else (F.col("hash") == at) & key.between(F.lit(Decimal(low)), F.lit(Decimal(high)))
            low_, width_ = (f"{low}L", f"{width}L") if at is None else (f"{low}BD", f"{width}BD")
            step = F.expr(f"{i * PROBES} + ({'hash' if at is None else 'id'} - ({low_})) div {width_}")
            cases = F.when(inside, step.cast("int")) if cases is None else cases.when(inside, step.cast("int"))
        counted = rows.select(cases.alias("step"), "hash", "id", "size").where("step is not null").groupBy("step").agg(F.sum("size").alias("bytes"), F.min("hash").alias("h0"), F.max("hash").alias("h1"), F.min("id").alias("i0"), F.max("id").alias("i1"))
        steps: dict[int, list] = {}
        for r in sorted(counted.collect(), key=lambda r: r["step"]):  # at most PROBES rows a boundary
            own = r.asDict()
            steps.setdefault(r["step"] // PROBES, []).append(own | {"i0": int(own["i0"]), "i1": int(own["i1"])})
        following: dict[tuple, list[int]] = {}
        for i, span in enumerate(spans):
            at, _, _, below = span
            for b in open_[span]:
                under = below
                for r in steps[i]:
                    over = under + r["bytes"]
                    if over < aims[b]:
                        under = over
                        continue
                    begin = (r["h0"], None) if at is None else (at, r["i0"])
                    single = r["h0"] == r["h1"] and r["i0"] == r["i1"]
                    if aims[b] - under <= slack or (single and aims[b] - under <= over - aims[b]):
                        found[b] = begin
                    elif over - aims[b] <= slack or single:
                        found[b] = (r["h1"], r["i1"] + 1)
                    elif r["h0"] == r["h1"]:
                        following.setdefault((r["h0"], r["i0"], r["i1"], under), []).append(b)
                    else:
                        following.setdefault((None, r["h0"], r["h1"], under), []).append(b)
                    break
        open_ = following
    return [found[b] for b in range(len(aims))]


def _shard(splitters: list[tuple[int, int | None]]) -> Column:
    """The number of boundaries at or below a row's key."""
    ones = [((F.col("hash") > h) | ((F.col("hash") == h) & (F.col("id") >= F.lit(Decimal(i))) if i is not None else F.col("hash") == h)).cast("int") for h, i in splitters]
    return reduce(lambda a, b: a + b, ones, F.lit(0))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # 61 bits of the hash, so that differences of two keys stay within a long; ids as decimals, null below every long
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 3).alias("hash"),
        F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63) - 1))).cast("decimal(20,0)").alias("id"),
    )
    rows = materialize(rows, "shard-keys")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    splitters = _splitters(rows, total, shards) if count else []
    parts = max(spark.sparkContext.defaultParallelism, count // PART_ROWS + 1)
    keys = ["shard", "hash", "id"]
    placed = rows.withColumn("shard", _shard(splitters)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "shard-rows")
    starts = placed.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))  # a row for each part, and shards - 1 more
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("shard", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
