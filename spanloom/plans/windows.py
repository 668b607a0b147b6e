"""Order-dependent operators (W*, splits, curricula)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.operators import sequences, splits
from spanloom.plans.base import query, read

Spark = SparkSession


@query("keep_last", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def keep_last(spark: Spark, sf: str) -> DataFrame:
    """By an aggregate, which adds up before the exchange."""
    best = read(spark, sf, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "value"), "event_id").alias("x"))
    return best.select("user_id", "x.event_id", "x.value")


@query("keep_first", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def keep_first(spark: Spark, sf: str) -> DataFrame:
    """W3 S23 U3"""
    best = read(spark, sf, "orders").groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("x"))
    return best.select("o_custkey", F.col("x.o_orderkey").alias("o_orderkey"))


@query(
    "duplicate_conflicts",
    """WITH s AS (SELECT doc_id % 700 AS pair, text FROM documents), g AS (SELECT pair, count(*) AS n, count(DISTINCT text) AS signatures FROM s GROUP BY pair)
    SELECT pair, CASE WHEN signatures > 1 THEN 'dropped' WHEN n > 1 THEN 'collapsed' ELSE 'kept' END AS outcome FROM g""",
)
def duplicate_conflicts(spark: Spark, sf: str) -> DataFrame:
    """Exact copies of an id collapse, an id of different rows goes."""
    rows = read(spark, sf, "documents").select((F.col("doc_id") % 700).alias("pair"), F.sha2("text", 256).alias("signature"))
    return sequences.duplicate_outcomes(rows, "pair", "signature")


@query(
    "stratified_split",
    """WITH f AS (SELECT source || '/' || doc_id % 11 AS family, min(lang) AS lang FROM documents GROUP BY ALL), n AS (SELECT lang, count(*) AS n FROM f GROUP BY lang),
    r AS (SELECT family, lang, n, row_number() OVER (PARTITION BY lang ORDER BY sha256('7:' || family), family) AS place FROM f JOIN n USING (lang)),
    q AS (SELECT *, least(greatest(floor(n * 0.03), 5), floor(n / 5)) AS k FROM r)
    SELECT family, lang, CASE WHEN place <= k THEN 'evaluate' WHEN place <= 2 * k THEN 'test' ELSE 'train' END AS split FROM q""",
)
def stratified_split(spark: Spark, sf: str) -> DataFrame:
    """Families of documents, balanced by language."""
    docs = read(spark, sf, "documents").select(F.concat_ws("/", "source", (F.col("doc_id") % 11).cast("string")).alias("family"), "lang")
    return splits.stratified_split(docs, "family", "lang", floor=5)


@query("seeded_selection", "SELECT doc_id FROM documents ORDER BY sha256('7:' || doc_id), doc_id LIMIT 50")
def seeded_selection(spark: Spark, sf: str) -> DataFrame:
    """A seeded choice of papers, the same every time."""
    return read(spark, sf, "documents").select("doc_id").orderBy(splits.seeded(7, F.col("doc_id")), "doc_id").limit(50)


@query("quota_batches", "SELECT o_orderkey, CAST(ceil(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) / 40.0) AS INT) AS batch FROM orders")
def quota_batches(spark: Spark, sf: str) -> DataFrame:
    """W8 W9"""
    return splits.quota_batches(read(spark, sf, "orders"), "o_orderpriority", 40, [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "batch")


@query("curriculum")
def curriculum(spark: Spark, sf: str) -> DataFrame:
    """Greedy token masses of three splits."""
    rows = read(spark, sf, "conversations").groupBy("conv_id").agg(F.sum(F.length("text")).alias("open_tokens"), F.max(F.length("text")).cast("bigint").alias("closed_tokens"))
    rows = rows.select(F.col("conv_id").alias("pair_id"), F.element_at(F.array(F.lit("train"), F.lit("evaluate"), F.lit("test")), (F.col("conv_id") % 3 + 1).cast("int")).alias("split"), "open_tokens", "closed_tokens", (F.col("conv_id") % 4 != 0).alias("closed_ready"))
    return splits.assign_curriculum(rows, "split", {"OPEN": 0.5, "CLOSED": 0.2, "DUAL": 0.3})


@query("curriculum_hash", "SELECT conv_id, CASE WHEN u < 0.5 THEN 'OPEN' WHEN u < 0.7 THEN 'CLOSED' ELSE 'DUAL' END AS mode FROM (SELECT conv_id, CAST(('0x' || left(sha256('7:' || conv_id), 16)) AS UBIGINT) / 18446744073709551616.0 AS u FROM (SELECT DISTINCT conv_id FROM conversations))")
def curriculum_hash(spark: Spark, sf: str) -> DataFrame:
    """H1"""
    return read(spark, sf, "conversations").select("conv_id").distinct().select("conv_id", splits.curriculum_mode(F.col("conv_id"), 7, 0.5, 0.2).alias("mode"))


@query(
    "capped_sample",
    """WITH a AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY source ORDER BY sha256('3:' || doc_id), doc_id) AS r FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sha256('3:' || doc_id), doc_id) AS q FROM a WHERE r <= 10) SELECT doc_id, lang, source FROM b WHERE q <= 30""",
)
def capped_sample(spark: Spark, sf: str) -> DataFrame:
    """At most ten of a source, then thirty of a language."""
    return splits.capped_sample(read(spark, sf, "documents").select("doc_id", "lang", "source"), [("source", 10), ("lang", 30)], 3, "doc_id")


@query(
    "neighbours",
    """WITH h AS (SELECT conv_id, turn FROM conversations WHERE length(text) % 5 = 0) SELECT c.conv_id, c.turn, count(*) AS near_hits FROM conversations c JOIN h ON h.conv_id = c.conv_id AND abs(h.turn - c.turn) <= 1 GROUP BY ALL""",
)
def neighbours(spark: Spark, sf: str) -> DataFrame:
    """The turns within one of a hit, by an equi-join on the shifted place."""
    rows = read(spark, sf, "conversations")
    return sequences.neighbours(rows, rows.where(F.length("text") % 5 == 0), "conv_id", "turn", 1)


@query("running_budget", "SELECT conv_id, turn FROM (SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS used FROM conversations) WHERE used <= 600")
def running_budget(spark: Spark, sf: str) -> DataFrame:
    """W13"""
    used = F.sum(F.length("text")).over(Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    return read(spark, sf, "conversations").withColumn("used", used).where("used <= 600").select("conv_id", "turn")


@query(
    "bin_packing",
    """WITH RECURSIVE n AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    r AS (SELECT conv_id, turn, k, CAST(0 AS INT) AS chunk, size AS used FROM n WHERE k = 1 UNION ALL SELECT n.conv_id, n.turn, n.k, CAST(CASE WHEN used > 0 AND used + size > 800 THEN chunk + 1 ELSE chunk END AS INT), CASE WHEN used > 0 AND used + size > 800 THEN size ELSE used + size END FROM r JOIN n ON n.conv_id = r.conv_id AND n.k = r.k + 1)
    SELECT conv_id, turn, chunk FROM r""",
)
def bin_packing(spark: Spark, sf: str) -> DataFrame:
    """Turns packed in order into chunks of at most 800 characters."""
    rows = read(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return sequences.pack(rows, "conv_id", "turn", "size", 800)


@query("top_candidates", "SELECT l_orderkey, l_linenumber, rank FROM (SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS INT) AS rank FROM lineitem) WHERE rank <= 2")
def top_candidates(spark: Spark, sf: str) -> DataFrame:
    """W16"""
    from spanloom.operators.search import top_k

    return top_k(read(spark, sf, "lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_linenumber")], 2).select("l_orderkey", "l_linenumber", "rank")


@query(
    "score_margin",
    """WITH r AS (SELECT l_orderkey, l_extendedprice AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS k FROM lineitem)
    SELECT l_orderkey, round(max(s) FILTER (WHERE k = 1), 2) AS top, round(max(s) FILTER (WHERE k = 1) - coalesce(max(s) FILTER (WHERE k = 2), 0), 2) AS margin FROM r GROUP BY l_orderkey""",
)
def score_margin(spark: Spark, sf: str) -> DataFrame:
    """The best score's lead, by two aggregates in one pass."""
    from spanloom.operators.search import top_k

    best = top_k(read(spark, sf, "lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_linenumber")], 2, "k")
    at = lambda k: F.max(F.when(F.col("k") == k, F.col("l_extendedprice")))
    return best.groupBy("l_orderkey").agg(F.round(at(1), 2).alias("top"), F.round(at(1) - F.coalesce(at(2), F.lit(0.0)), 2).alias("margin"))


@query(
    "two_pass_selection",
    """WITH a AS (SELECT o_orderkey, o_totalprice, o_orderdate, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) AS r FROM orders), f AS (SELECT o_orderkey, 1 AS pass FROM a WHERE r <= 20),
    s AS (SELECT o_orderkey, 2 AS pass FROM a WHERE r > 20 ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey LIMIT 50) SELECT * FROM f UNION ALL SELECT * FROM s""",
)
def two_pass_selection(spark: Spark, sf: str) -> DataFrame:
    """W18"""
    return splits.two_pass_selection(read(spark, sf, "orders"), "o_orderpriority", 20, 150, [F.desc("o_totalprice"), F.desc("o_orderdate"), F.col("o_orderkey")], "o_orderkey")


@query(
    "hold_out",
    """WITH f AS (SELECT o_custkey AS family, count(*) AS n FROM orders GROUP BY ALL), r AS (SELECT family, coalesce(sum(n) OVER (ORDER BY sha256('7:' || family), family ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f) SELECT family, before < 500 AS held_out FROM r""",
)
def hold_out(spark: Spark, sf: str) -> DataFrame:
    """C30"""
    families = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("family")).agg(F.count("*").alias("n"))
    return splits.hold_out(families, "family", "n", 500)


@query("token_windows", "WITH d AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n FROM documents), w AS (SELECT doc_id, n, unnest(range(0, n, 512)) AS s FROM d) SELECT doc_id, CAST(s // 512 AS INT) AS part, CAST(least(512, n - s) AS INT) AS size FROM w")
def token_windows(spark: Spark, sf: str) -> DataFrame:
    """Windows of 512 tokens without loss."""
    from spanloom.functions.text import words

    rows = read(spark, sf, "documents").select("doc_id", words(F.col("text")).alias("w"))
    return sequences.token_windows(rows, "doc_id", "w", 512)


@query("largest_remainder", "WITH w AS (SELECT o_orderpriority AS k, count(*) AS w FROM orders GROUP BY ALL), e AS (SELECT k, w, w * 1000 / sum(w) OVER () AS x FROM w), f AS (SELECT k, w, floor(x) AS s, x - floor(x) AS r, row_number() OVER (ORDER BY x - floor(x) DESC, w DESC, k) AS p FROM e) SELECT k, CAST(s + CASE WHEN p <= 1000 - (SELECT sum(s) FROM f) THEN 1 ELSE 0 END AS BIGINT) AS share FROM f")
def largest_remainder(spark: Spark, sf: str) -> DataFrame:
    """H12"""
    weights = read(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("w"))
    return splits.largest_remainder(weights, "k", "w", 1000)
