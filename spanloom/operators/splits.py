"""Leakage-free splits, quotas and curricula."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.numeric import unit_hash
from spanloom.operators.ranks import placed
from spanloom.storage import materialize


def seeded(seed: int, *parts: Column) -> Column:
    """An order that looks random and is the same every time."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)


def stratified_split(papers: DataFrame, family: str, domain: str, evaluate: float = 0.03, test: float = 0.03, floor: int = 0, seed: int = 7) -> DataFrame:
    """(family, domain, split): whole families to evaluate, test and train, by shares of each domain.

    A family belongs to the least of its domains. ``floor``: families of a domain for evaluate and for test at least,
    but no more than a fifth of the domain.
    """
    families = papers.groupBy(family).agg(F.min(domain).alias(domain))
    size = families.groupBy(domain).agg(F.count("*").alias("n"))
    quota = lambda share: F.least(F.greatest(F.floor(F.col("n") * share), F.lit(floor)), F.floor(F.col("n") / 5)) if floor else F.floor(F.col("n") * share)
    ranked = placed(families, [domain], [seeded(seed, F.col(family)), F.col(family)]).join(size, domain)
    first, second = quota(evaluate), quota(test)
    return ranked.select(family, domain, F.when(F.col("place") <= first, "evaluate").when(F.col("place") <= first + second, "test").otherwise("train").alias("split"))


def hold_out(families: DataFrame, family: str, size: str, target: int, seed: int = 7) -> DataFrame:
    """Families held out in seeded order while those before hold fewer rows than the target.

    The running sum goes over a table of one row a family, in two levels: parts of the order, then within a part.
    """
    keyed = families.withColumn("key", seeded(seed, F.col(family))).withColumn("part", F.substring("key", 1, 2))
    parts = keyed.groupBy("part").agg(F.sum(size).alias("inside"))
    before = parts.withColumn("before", F.coalesce(F.sum("inside").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("inside")  # 256 rows
    within = F.coalesce(F.sum(size).over(Window.partitionBy("part").orderBy("key", family).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return keyed.withColumn("within", within).join(F.broadcast(before), "part").select(family, (F.col("before") + F.col("within") < target).alias("held_out"))


def suppress_crossing(rows: DataFrame, key: str, split: str) -> DataFrame:
    """Rows whose key occurs in several splits stay only in test, else in evaluate."""
    owner = rows.groupBy(key).agg(F.min(F.when(F.col(split) == "test", 0).when(F.col(split) == "evaluate", 1).otherwise(2)).alias("__owner"))
    name = F.element_at(F.array(F.lit("test"), F.lit("evaluate"), F.lit("train")), F.col("__owner") + 1)
    return rows.join(owner, key).where(F.col(split) == name).drop("__owner")


def heal(rows: DataFrame, key: str, split: str) -> DataFrame:
    """Rows whose key crosses splits move to train; moved tells which changed."""
    crossing = rows.groupBy(key).agg((F.min(split) != F.max(split)).alias("__crosses"))
    joined = rows.join(crossing, key)
    return joined.withColumn("moved", F.col("__crosses") & (F.col(split) != "train")).withColumn(split, F.when(F.col("__crosses"), "train").otherwise(F.col(split))).drop("__crosses")


def curriculum_mode(pair: Column, seed: int, open_share: float, closed_share: float) -> Column:
    """H1: OPEN, CLOSED or DUAL by the hash of a pair."""
    u = unit_hash(F.concat_ws(":", F.lit(str(seed)), pair.cast("string")))
    return F.when(u < open_share, "OPEN").when(u < open_share + closed_share, "CLOSED").otherwise("DUAL")


def quota_batches(rows: DataFrame, field: str, quota: int, order: list[Column]) -> DataFrame:
    """Batches that take so many rows of every field, in order."""
    return placed(rows, [field], order).withColumn("batch", F.ceil(F.col("place") / quota).cast("int")).drop("place")


def two_pass_selection(rows: DataFrame, field: str, quota: int, total: int, order: list[Column], key: str) -> DataFrame:
    """The first rows of each field, then the best of the rest up to the total; (key, pass)."""
    first = rows.withColumn("__p", F.row_number().over(Window.partitionBy(field).orderBy(*order))).where(F.col("__p") <= quota).drop("__p")
    rest = rows.join(first.select(key), key, "left_anti")
    room = max(0, total - first.count())
    return first.select(key, F.lit(1).alias("pass")).unionByName(rest.orderBy(*order).limit(room).select(key, F.lit(2).alias("pass")))


def assign_curriculum(rows: DataFrame, split: str, shares: dict[str, float], seed: int = 7) -> DataFrame:
    """OPEN, CLOSED or DUAL for each row, the longest first, so that token masses approach the shares.

    Each choice depends on all before it in its split, so a split is one sequence; only its ids and sizes travel.
    rows: pair_id, split, open_tokens, closed_tokens, closed_ready.
    """
    import hashlib

    names = list(shares)

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        pdf = pdf.assign(size=pdf[["open_tokens", "closed_tokens"]].max(axis=1), tie=[digest(f"{seed}:{p}") for p in pdf["pair_id"]]).sort_values(["size", "tie"], ascending=[False, True])
        mass, out = dict.fromkeys(names, 0), []
        for row in pdf.itertuples():
            cost = {"OPEN": row.open_tokens, "CLOSED": row.closed_tokens, "DUAL": row.open_tokens + row.closed_tokens}

            def miss(name: str, cost=cost, pair=row.pair_id) -> tuple[float, str]:
                whole = max(1, sum(mass.values()) + cost[name])
                return sum(((mass[n] + cost[n] * (n == name)) / whole - shares[n]) ** 2 for n in names), digest(f"{seed}:{pair}:{name}")

            chosen = min(names if row.closed_ready else ["OPEN"], key=miss)
            mass[chosen] += cost[chosen]
            out.append(chosen)
        return pd.DataFrame({"pair_id": pdf["pair_id"], "split": pdf[split], "assignment": out})

    kind = rows.schema["pair_id"].dataType.simpleString()
    return rows.select("pair_id", split, "open_tokens", "closed_tokens", "closed_ready").groupBy(split).applyInPandas(greedy, f"pair_id {kind}, split string, assignment string")


def capped_sample(rows: DataFrame, caps: list[tuple[str, int]], seed: int, key: str) -> DataFrame:
    """A seeded sample with at most so many rows of each column's values, one cap after another."""
    for column, most in caps:
        place = F.row_number().over(Window.partitionBy(column).orderBy(seeded(seed, F.col(key)), key))
        rows = rows.withColumn("__p", place).where(F.col("__p") <= most).drop("__p")
    return rows


def largest_remainder(weights: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Whole shares of a total: the floor of each, and one more for the largest remainders."""
    whole = weights.agg(F.sum(weight).alias("__sum"))
    exact = weights.crossJoin(F.broadcast(whole)).withColumn("exact", F.col(weight) * total / F.col("__sum"))  # one row of totals
    floored = exact.withColumn("share", F.floor("exact")).withColumn("rest", F.col("exact") - F.floor("exact"))
    given = floored.agg((F.lit(total) - F.sum("share")).alias("__left"))
    place = F.row_number().over(Window.orderBy(F.desc("rest"), F.desc(weight), key))  # a budget's handful of parts
    return floored.withColumn("place", place).crossJoin(F.broadcast(given)).select(key, (F.col("share") + (F.col("place") <= F.col("__left")).cast("bigint")).alias("share"))


def random_negatives(asked: DataFrame, pool: DataFrame, group: str, key: list[str], most: int, seed: int) -> DataFrame:
    """Every row of ``asked`` with up to ``most`` documents of other groups, drawn by a seeded hash.

    asked: the key, query, doc, group; pool: group, doc. Draws are places in the pool, joined by place, so that no task
    sees the pool; a draw of the own group or of the own document falls out, and equal draws are one.
    """
    listed = materialize(placed(pool, [], [F.col(group), F.col("doc")], "place"), "pool")
    size = listed.count()
    draws = F.transform(F.sequence(F.lit(1), F.lit(most)), lambda j: F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key], j), F.lit(max(size, 1))) + 1)
    drawn = asked.withColumn("place", F.explode(F.array_distinct(draws))).withColumnRenamed("doc", "__own")
    found = drawn.join(listed.select("place", F.col(group).alias("__group"), "doc"), "place")
    return found.where((F.col("__group") != F.col(group)) & (F.col("doc") != F.col("__own"))).select(*asked.columns)
