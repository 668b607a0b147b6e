"""Evaluation metrics over tables of judgements."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.numeric import dcg_gain


def latency(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median, and the value of rank floor(0.95 n), at least 1."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"))
    order = Window.partitionBy(*keys).orderBy(value)
    placed = counted.withColumn("upto", F.sum("times").over(order)).withColumn("n", F.sum("times").over(Window.partitionBy(*keys)))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col(value)))
    low, high, p95 = F.floor((F.col("n") + 1) / 2), F.ceil((F.col("n") + 1) / 2), F.greatest(F.lit(1), F.floor(F.col("n") * 0.95))
    return placed.groupBy(*keys).agg(F.round((at(low) + at(high)) / 2, 6).alias("p50"), F.round(at(p95), 6).alias("p95"))


def value_counts(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(field, value, n) of several columns."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(c).cast("string").alias("value")) for k, c in fields.items()])
    return rows.select(F.explode(pairs).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def shares(rows: DataFrame, key: str) -> DataFrame:
    """Counts and percentages."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(key, "n", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("percent"))  # one row of totals


def pair_metrics(rows: DataFrame) -> DataFrame:
    """Accuracy, recall of the same pairs and false merges. rows: predicted, same."""
    p, s = F.col("predicted"), F.col("same")
    return rows.agg(F.count("*").alias("pairs"), F.round(F.avg((p == s).cast("double")), 6).alias("accuracy"), F.round(F.try_divide(F.count_if(p & s), F.count_if(s)), 6).alias("same_recall"), F.count_if(p & ~s).alias("false_merges"))


def classifier(rows: DataFrame, decision: str, gold: str) -> DataFrame:
    """Accuracy, the share of includes kept and of excludes left out."""
    d, g = F.col(decision), F.col(gold)
    share = lambda hit, of: F.round(F.try_divide(F.count_if(hit), F.count_if(of)), 4)
    return rows.agg(F.count("*").alias("n"), share(d == g, F.lit(True)).alias("accuracy"), share((g == "include") & (d == "include"), g == "include").alias("include_retention"), share((g == "exclude") & (d == "exclude"), g == "exclude").alias("exclusion_safety"))


def ranking(rows: DataFrame, group: str, domain: str, k: int, score: str = "score", relevant: str = "relevant", tie: str = "doc_id") -> DataFrame:
    """Top-1, precision, recall, reciprocal rank and nDCG at k, overall and by domain."""
    rel = F.col(relevant)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), tie))).withColumn("ideal", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(relevant), F.desc(score), tie)))
    gain = lambda rank: F.sum(F.when(F.col(rank) <= k, dcg_gain(rel, F.col(rank))).otherwise(0.0))
    per = ranked.groupBy(group, domain).agg(F.max(F.when(F.col("rank") == 1, rel).otherwise(0)).alias("top1"), F.sum(F.when(F.col("rank") <= k, rel).otherwise(0)).alias("hits"), F.sum(rel).alias("relevant"), F.max(F.when(rel == 1, 1 / F.col("rank")).otherwise(0.0)).alias("rr"), gain("rank").alias("dcg"), gain("ideal").alias("idcg"))
    mean = lambda c: F.round(F.avg(c), 6)
    zero = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    out = per.rollup(domain).agg(F.count("*").alias("groups"), mean("top1").alias("top1"), mean(F.col("hits") / k).alias(f"precision_at_{k}"), mean(zero("hits", "relevant")).alias(f"recall_at_{k}"), mean("rr").alias("mrr"), mean(zero("dcg", "idcg")).alias(f"ndcg_at_{k}"))
    return out.withColumn(domain, F.coalesce(domain, F.lit("all")))


def perplexity(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exp of the mean negative log likelihood, and bits a byte. rows: nll, tokens, bytes."""
    return rows.groupBy(*keys).agg(F.round(F.exp(F.sum("nll") / F.sum("tokens")), 6).alias("perplexity"), F.round(F.sum("nll") / F.log(F.lit(2.0)) / F.sum("bytes"), 6).alias("bits_per_byte"))


def bootstrap(papers: DataFrame, key: str, value: str, resamples: int = 2000, seed: int = 7) -> DataFrame:
    """The mean of per-paper means and its percentile interval; papers: one row a paper.

    Each group's resamples are drawn from a histogram of its distinct means, so that a task holds distinct values.
    """
    counted = papers.groupBy(key, value).agg(F.count("*").alias("times"))

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(value)
        n, x = int(pdf["times"].sum()), pdf[value].to_numpy(float)
        rng = np.random.default_rng([seed, n])
        means = rng.multinomial(n, pdf["times"].to_numpy(float) / n, size=resamples) @ x / n
        low, high = np.percentile(means, [2.5, 97.5])
        return pd.DataFrame({key: [pdf[key].iloc[0]], "papers": [n], "mean": [float((pdf["times"] * x).sum() / n)], "low": [low], "high": [high]})

    return counted.groupBy(key).applyInPandas(draw, f"{key} string, papers bigint, mean double, low double, high double")


def overlap_share(left: Column, right: Column) -> Column:
    """Jaccard of two arrays as sets; 0 if either is empty."""
    a, b = F.array_distinct(left), F.array_distinct(right)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))
