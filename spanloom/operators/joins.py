"""Joins with contracts: unique sides, cascades of keys, redirects, ranges, as-of, violations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.ranks import spread
from spanloom.storage import materialize

#: Keys of equal values that are held together, and rows of a block whose pairs one task makes.
CHUNK, BLOCK_ROWS = 1_024, 4_096


def unique_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join; a key that the right side has twice stops the job where the two rows meet."""
    counted = right.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.any_value(c).alias(c) for c in right.columns if c not in keys])
    checked = counted.withColumn("__ok", F.assert_true(F.col("__n") == 1, F.lit("a key occurs twice on the right side")))
    return left.join(checked.where("__ok is null").drop("__n", "__ok"), keys, "left")


def cascade(rows: DataFrame, methods: dict[str, DataFrame], key: str) -> DataFrame:
    """The first method, in order, that finds targets for a row, and its target if that is the only one.

    methods: (key, target, ...) by name, the most trusted first. Gives key, method, target, status.
    """
    names = list(methods)
    found = reduce(DataFrame.unionByName, [m.select(key, F.lit(i).alias("method"), F.col("target").cast("bigint").alias("target")) for i, m in enumerate(methods.values())])
    each = found.groupBy(key, "method").agg(F.min("target").alias("low"), F.max("target").alias("high"))
    best = each.groupBy(key).agg(F.min_by(F.struct("method", "low", "high"), "method").alias("best"))
    status = F.when(F.col("best").isNull(), "UNMATCHED").when(F.col("best.low") == F.col("best.high"), "LINKED").otherwise("AMBIGUOUS")
    method = F.coalesce(F.try_element_at(F.array(*map(F.lit, names)), F.col("best.method") + 1), F.lit("none"))
    return rows.select(key).join(best, key, "left").select(key, method.alias("method"), F.when(status == "LINKED", F.col("best.low")).alias("target"), status.alias("status"))


def resolve_redirects(edges: DataFrame, most: int = 64) -> DataFrame:
    """Each retired id with the active id at the end of its redirects. edges: retired, target.

    Every round doubles the length of the paths followed; a cycle never ends in an active id and raises.
    """
    now = materialize(edges.select("retired", "target"), "redirects")
    for _ in range(most):
        step = now.select(F.col("retired").alias("target"), F.col("target").alias("next"))
        after = materialize(now.join(step, "target", "left").select("retired", F.coalesce("next", "target").alias("target"), F.col("next").isNotNull().alias("moved")), "redirects")
        if after.where("moved").isEmpty():
            return after.select("retired", F.col("target").alias("active"))
        if not after.where("retired = target").isEmpty():
            raise ValueError("redirects form a cycle")
        now = after.select("retired", "target")
    raise ValueError("redirects are too long or form a cycle")


def range_join(spans: DataFrame, chunks: DataFrame, key: str, span: tuple[str, str], chunk: tuple[str, str], width: int) -> DataFrame:
    """Chunks that hold a span's first or last place, by an equi-join on cells of a fixed width.

    width: about the length of chunks; a chunk enters every cell that it touches.
    """
    a, b = span
    low, high = chunk
    cell = lambda c: F.floor(c / F.lit(width))
    ends = spans.withColumn("__cell", F.explode(F.array_distinct(F.array(cell(F.col(a)), cell(F.col(b) - 1)))))
    held = chunks.withColumn("__cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high) - 1))))
    starts, stops = (F.col(low) <= F.col(a)) & (F.col(a) < F.col(high)), (F.col(low) < F.col(b)) & (F.col(b) <= F.col(high))
    return ends.join(held, [key, "__cell"]).where(starts | stops).drop("__cell").distinct()


def pairs_within(rows: DataFrame, blocks: list[str], key: str, value: str, measure: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """(x, y, name) of all pairs of keys x < y of a block, with a symmetric measure of their values.

    Rows of a block and an equal value are one group, in chunks of about CHUNK keys, so that a measure is taken once for
    two groups and the pairs are told off their keys. Blocks of more than BLOCK_ROWS rows are dealt over several tasks.
    """
    many = rows.groupBy(*blocks, value).agg(F.count("*").alias("__n")).where(F.col("__n") > CHUNK).select(*[F.col(c).alias(f"__{c}") for c in (*blocks, value)], "__n")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*blocks, value)])
    ways = lambda n, most: F.greatest(F.ceil(n / F.lit(most)), F.lit(1))
    chunk = F.pmod(F.xxhash64(key), ways(F.coalesce("__n", F.lit(1)), CHUNK))
    groups = rows.join(many, same, "left").groupBy(*blocks, value, chunk.alias("__chunk")).agg(F.collect_list(key).alias("__keys"))
    wide = rows.groupBy(*blocks).agg(ways(F.count("*"), BLOCK_ROWS).alias("__ways"))
    held = groups.join(wide, blocks)
    side = lambda p: [*blocks, "__deal", F.struct(value, "__chunk").alias(f"{p}_group"), F.col("__keys").alias(f"{p}_keys")]
    left = spread(held.withColumn("__deal", F.pmod(F.xxhash64(value, "__chunk"), "__ways")).select(*side("a")), *blocks, "__deal")
    right = spread(held.withColumn("__deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__ways") - 1))).select(*side("b")), *blocks, "__deal")
    met = left.join(right, [*blocks, "__deal"]).where(F.col("a_group") <= F.col("b_group"))
    told = met.select((F.col("a_group") == F.col("b_group")).alias("own"), measure(F.col("a_group")[value], F.col("b_group")[value]).alias(name), "a_keys", "b_keys")
    told = told.select("own", name, "b_keys", F.explode("a_keys").alias("a")).select("own", name, "a", F.explode("b_keys").alias("b"))
    told = told.where((~F.col("own") & (F.col("a") != F.col("b"))) | (F.col("a") < F.col("b")))
    return told.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), name)


def as_of(rows: DataFrame, marks: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each row with the last mark at or before it; ties of the place go to the greater mark."""
    both = marks.select(key, at, F.col(value).alias("__mark"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in (key, at)], F.lit(0).alias("__row"))
    both = both.unionByName(rows.withColumns({"__mark": F.lit(None).cast(marks.schema[value].dataType), "__row": F.lit(1)}))
    order = Window.partitionBy(key).orderBy(at, "__row", "__mark").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("__mark", ignorenulls=True).over(order)).where("__row = 1").drop("__mark", "__row")


def symmetric(edges: DataFrame) -> DataFrame:
    """Edges in both directions."""
    a, b = edges.columns
    return edges.unionByName(edges.select(F.col(b).alias(a), F.col(a).alias(b)))


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """How many rows break each rule, zero included."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in rules.items()])


def require_none(found: DataFrame) -> None:
    """Raise if any rule of :func:`violations` is broken."""
    broken = {r["rule"]: r["n"] for r in found.where("n > 0").collect()}  # one row a rule
    if broken:
        raise ValueError(f"contract broken: {broken}")


def union_top(rows: DataFrame, query: str, item: str, score: str, each: int, most: int) -> DataFrame:
    """The best of every query, united by their best score."""
    ranked = rows.withColumn("__k", F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), item))).where(F.col("__k") <= each)
    return ranked.groupBy(item).agg(F.max(score).alias(score)).orderBy(F.desc(score), item).limit(most)
