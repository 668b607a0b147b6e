"""Measurements across studies: scalar values, stances, differing conditions, and differences of registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.numeric import stance


def scalar(value: Column, values: Column, low: Column, high: Column) -> Column:
    """The value, else the mean of the values, else the middle of the range."""
    mean = F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values))
    return F.coalesce(value, mean, (low + high) / 2)


def disagreement(rows: DataFrame) -> DataFrame:
    """For each subject and facet the median, and how many studies support it.

    rows: subject, facet, family, value, conditions map<string,string>. A condition differs where the supporting and
    the conflicting rows share no value of it.
    """
    keys = ["subject", "facet"]
    middle = rows.groupBy(*keys).agg(F.median("value").alias("reference"))
    judged = rows.join(middle, keys).withColumn("stance", stance(F.col("value"), F.col("reference")))
    counts = [F.count_if(F.col("stance") == s).alias(s) for s in ("supporting", "conflicting", "inconclusive")]
    out = judged.groupBy(*keys).agg(F.round(F.min("reference"), 8).alias("reference"), F.countDistinct("family").alias("families"), *counts)
    said = judged.where("stance <> 'inconclusive'").select(*keys, "stance", F.explode("conditions").alias("condition", "said"))
    sets = said.groupBy(*keys, "condition").agg(F.collect_set(F.when(F.col("stance") == "supporting", F.col("said"))).alias("a"), F.collect_set(F.when(F.col("stance") == "conflicting", F.col("said"))).alias("b"))
    differ = sets.where((F.size("a") > 0) & (F.size("b") > 0) & ~F.arrays_overlap("a", "b")).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("condition")), ",").alias("differing"))
    return out.join(differ, keys, "left").withColumn("differing", F.coalesce("differing", F.lit("")))


def registry_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added and removed ids of each kind."""
    both = before.withColumn("old", F.lit(1)).join(after.withColumn("new", F.lit(1)), ["kind", "id"], "full")
    return both.groupBy("kind").agg(F.count_if(F.col("old").isNull()).alias("added"), F.count_if(F.col("new").isNull()).alias("removed"))
