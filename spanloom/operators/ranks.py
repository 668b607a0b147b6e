"""Exact places and joins without a task that sees a whole group.

A window's row_number gathers each group in one task. Here one range exchange orders all rows, every partition
numbers its own, and counts of the partitions' groups, a row each, shift the numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.storage import materialize


#: Keys that may be dealt at once, and rows of a key that one task takes in any case.
HOT, COLD_ROWS = 1_024, 1_000


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by keys over as many tasks as the session shuffles to.

    For few bytes that much work follows: adaptive execution would put them into a task or two.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def hot_join(rows: DataFrame, side: DataFrame, keys: list[str], times: str) -> DataFrame:
    """``rows`` with ``side``, a written table of one row a key; ``times``: how many of ``rows`` have the key.

    Keys of more than a thousandth of all rows, which cannot be more than HOT, are dealt over several tasks.
    """
    total = side.agg(F.sum(times)).first()[0] or 0
    share = max(total // HOT, COLD_ROWS)
    ways = F.greatest(F.ceil(F.col(times) / F.lit(share)), F.lit(1))
    hot = side.where(F.col(times) > share).select(*keys, ways.alias("__ways"))  # at most HOT rows
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("__deal", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__ways")), F.lit(0))).drop("__ways")
    return dealt.join(side.withColumn("__deal", F.explode(F.sequence(F.lit(0), ways - 1))), [*keys, "__deal"]).drop("__deal")


def placed(rows: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their place from 1 within the keys' group, in the order; ties lie in any order."""
    sort = [F.col(k) for k in keys] + order
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    ranged = ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    ranged = materialize(ranged, "placed")  # bounds are sampled: both uses below must see the same partitions
    groups = ranged.groupBy(*keys, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = groups.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__p"), (before - F.col("__first") + 1).alias("__shift"))
    same = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return ranged.join(shift, same).select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("__at") + F.col("__shift")).alias(name))
