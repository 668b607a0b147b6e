"""The training-set funnel: stages with counts, renderings, upserts and output contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.joins import unique_left_join


def stages(rows: DataFrame, gates: dict[str, Column], key: Column) -> DataFrame:
    """(stage, rows) left after each gate in turn, and after one row of each key; one pass over the rows."""
    names = list(gates)
    passed = F.lit(len(names))
    for k in range(len(names) - 1, -1, -1):
        passed = F.when(~F.coalesce(gates[names[k]], F.lit(False)), k).otherwise(passed)
    counted = rows.select(passed.alias("passed"), key.alias("key"))
    by_gate = counted.groupBy("passed").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))
    listed = F.array(F.struct(F.lit("read").alias("stage"), F.lit(0).alias("least")), *[F.struct(F.lit(n).alias("stage"), F.lit(k + 1).alias("least")) for k, n in enumerate(names)])
    gated = by_gate.select("passed", "n", F.explode(listed).alias("s")).groupBy("s.stage").agg(F.sum(F.when(F.col("passed") >= F.col("s.least"), F.col("n")).otherwise(0)).alias("rows"))
    distinct = by_gate.agg(F.coalesce(F.sum(F.when(F.col("passed") == len(names), F.col("keys"))), F.lit(0)).alias("rows")).select(F.lit("distinct").alias("stage"), "rows")
    return gated.unionByName(distinct)


def render_modes(assignment: Column) -> Column:
    """C14: a pair for both modes gives a row for each."""
    return F.explode(F.when(assignment == "DUAL", F.array(F.lit("OPEN"), F.lit("CLOSED"))).otherwise(F.array(assignment)))


def upsert(rows: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of ``new`` where it has their key; never a row more or less."""
    fresh = [c for c in new.columns if c not in keys]
    renamed = new.withColumnsRenamed({c: f"__new_{c}" for c in fresh}).withColumn("__has", F.lit(True))
    joined = unique_left_join(rows, renamed, keys)
    return joined.select(*[F.when(F.col("__has"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in rows.columns])


def contract(rows: DataFrame, rules: dict[str, Column], unique: dict[str, str] | None = None) -> DataFrame:
    """(rule, n) of the rows that break each rule, and of the repeated values of unique columns; one pass."""
    counts = {name: F.count_if(c) for name, c in rules.items()} | {name: F.count(c) - F.countDistinct(c) for name, c in (unique or {}).items()}
    one = rows.agg(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("n")) for k, v in counts.items()]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.rule", "x.n")
