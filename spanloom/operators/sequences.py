"""Operators on ordered rows of one document: duplicates, neighbours, packing, windows of tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_outcomes(rows: DataFrame, key: str, signature: str) -> DataFrame:
    """Of each key whether its rows are kept, collapse to one, or are dropped because they differ."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"), (F.min(signature) != F.max(signature)).alias("differ"))
    return counts.select(key, F.when(F.col("differ"), "dropped").when(F.col("n") > 1, "collapsed").otherwise("kept").alias("outcome"))


def neighbours(rows: DataFrame, hits: DataFrame, key: str, place: str, radius: int) -> DataFrame:
    """Rows within a radius of a hit, with the number of hits that near."""
    near = hits.select(key, F.explode(F.sequence(F.col(place) - radius, F.col(place) + radius)).alias(place))
    counted = near.groupBy(key, place).agg(F.count("*").alias("near_hits"))
    return rows.select(key, place).join(counted, [key, place])


def pack(rows: DataFrame, key: str, place: str, size: str, most: int) -> DataFrame:
    """(key, place, chunk): rows in order into chunks of at most so much; a larger row is a chunk of its own."""

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, chunk, used, out = pdf.sort_values(place), 0, 0, []
        for n in pdf[size].fillna(0):
            if used and used + n > most:
                chunk, used = chunk + 1, 0
            used += n
            out.append(chunk)
        return pd.DataFrame({key: pdf[key], place: pdf[place], "chunk": out})

    return rows.groupBy(key).applyInPandas(greedy, f"{key} bigint, {place} bigint, chunk int")


def token_windows(rows: DataFrame, key: str, tokens: str, length: int) -> DataFrame:
    """(key, part, size) of consecutive windows over an array of tokens, nothing lost."""
    n = F.size(tokens)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(length))).otherwise(F.array().cast("array<int>"))
    return rows.select(key, n.alias("n"), F.posexplode(starts).alias("part", "start")).select(key, "part", F.least(F.lit(length), F.col("n") - F.col("start")).alias("size"))


def merge_spans(spans: DataFrame, key: str, start: str, stop: str, gap: int = 0) -> DataFrame:
    """Spans of a key that overlap, touch or lie within a gap, as one."""
    from pyspark.sql import Window

    order = Window.partitionBy(key).orderBy(start, stop)
    reach = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.col(start) > reach + gap) | reach.isNull()
    island = F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return spans.withColumn("__island", island).groupBy(key, "__island").agg(F.min(start).alias(start), F.max(stop).alias(stop)).drop("__island")
