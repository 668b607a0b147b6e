"""Grouped statistics (A*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import numeric as N
from spanloom.functions import text as T
from spanloom.operators import compare, metrics
from spanloom.plans.base import query, read

Spark = SparkSession


@query("facet_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL ORDER BY n DESC, lang, source")
def facet_counts(spark: Spark, sf: str) -> DataFrame:
    """A1 C7 S16"""
    return read(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang", "source")


@query("family_count", "SELECT o_orderpriority, count(DISTINCT coalesce(nullif(o_custkey % 7, 0), o_orderkey)) AS families FROM orders GROUP BY ALL")
def family_count(spark: Spark, sf: str) -> DataFrame:
    """A5: the family, or the paper itself where it has none."""
    return read(spark, sf, "orders").groupBy("o_orderpriority").agg(F.countDistinct(F.coalesce(F.nullif(F.col("o_custkey") % 7, F.lit(0)), F.col("o_orderkey"))).alias("families"))


@query(
    "disagreement",
    """WITH r AS (SELECT l_partkey AS subject, l_suppkey AS facet, l_orderkey * 10 + l_linenumber AS claim, l_orderkey % 97 AS family, l_extendedprice * (1 + l_linenumber % 3 * 0.3) / l_quantity AS v, l_shipmode AS c FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem)),
    m AS (SELECT subject, facet, median(v) AS ref FROM r GROUP BY ALL),
    s AS (SELECT r.*, ref, CASE WHEN abs(v - ref) / ((abs(v) + abs(ref)) / 2) <= 0.25 THEN 'supporting' ELSE 'conflicting' END AS stance FROM r JOIN m USING (subject, facet)),
    g AS (SELECT subject, facet, round(min(ref), 8) AS reference, count(DISTINCT family) AS families, count(*) FILTER (WHERE stance = 'supporting') AS supporting, count(*) FILTER (WHERE stance = 'conflicting') AS conflicting,
      list_distinct(list(c) FILTER (WHERE stance = 'supporting')) AS a, list_distinct(list(c) FILTER (WHERE stance = 'conflicting')) AS b FROM s GROUP BY ALL)
    SELECT subject, facet, reference, families, supporting, conflicting, CAST(0 AS BIGINT) AS inconclusive, CASE WHEN len(a) > 0 AND len(b) > 0 AND len(list_intersect(a, b)) = 0 THEN 'flag' ELSE '' END AS differing FROM g""",
)
def disagreement(spark: Spark, sf: str) -> DataFrame:
    """Prices of a part from one supplier as measured values, the return flag as their condition."""
    lines = read(spark, sf, "lineitem")
    value = F.col("l_extendedprice") * (1 + F.col("l_linenumber") % 3 * 0.3) / F.col("l_quantity")
    rows = lines.select(F.col("l_partkey").alias("subject"), F.col("l_suppkey").alias("facet"), (F.col("l_orderkey") % 97).alias("family"), value.alias("value"), F.create_map(F.lit("flag"), F.col("l_returnflag")).alias("conditions"))
    return compare.disagreement(rows)


@query("scalar_value", "SELECT event_id, round(CASE WHEN event_id % 3 = 0 THEN value WHEN event_id % 3 = 1 THEN (value + value * 2) / 2 ELSE (value + value + 3) / 2 END, 6) AS scalar FROM events")
def scalar_value(spark: Spark, sf: str) -> DataFrame:
    """A value, else the mean of values, else the middle of the least and the greatest."""
    v, kind = F.col("value"), F.col("event_id") % 3
    rows = read(spark, sf, "events").select("event_id", F.when(kind == 0, v).alias("value"), F.when(kind == 1, F.array(v, v * 2)).alias("values"), F.when(kind == 2, v).alias("low"), F.when(kind == 2, v + 3).alias("high"))
    return rows.select("event_id", F.round(compare.scalar(F.col("value"), F.col("values"), F.col("low"), F.col("high")), 6).alias("scalar"))


@query(
    "latency_percentiles",
    """WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events WHERE value IS NOT NULL GROUP BY event_type)
    SELECT event_type, round(list_aggregate(v, 'median'), 6) AS p50, round(v[greatest(1, CAST(floor(len(v) * 0.95) AS INT))], 6) AS p95 FROM s""",
)
def latency_percentiles(spark: Spark, sf: str) -> DataFrame:
    """The median, and the 95th percentile by the nearest rank below."""
    return metrics.latency(read(spark, sf, "events"), ["event_type"], "value")


@query(
    "token_sums",
    """SELECT user_id, CAST(sum(length(props)) AS BIGINT) AS tokens, count(*) FILTER (WHERE value < 10) AS cut, coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (WHERE value < 10), '') AS truncated, bool_and(NOT coalesce(value < 10, false)) AS complete FROM events GROUP BY user_id""",
)
def token_sums(spark: Spark, sf: str) -> DataFrame:
    """Sums of a paper's tasks, the list of truncated ones, and whether none is."""
    cut = F.coalesce(F.col("value") < 10, F.lit(False))
    return read(spark, sf, "events").groupBy("user_id").agg(F.sum(F.length("props")).alias("tokens"), F.count_if(cut).alias("cut"), F.array_join(F.array_sort(F.collect_set(F.when(cut, F.col("event_type")))), ",").alias("truncated"), F.bool_and(~cut).alias("complete"))


@query("enum_counts", "SELECT 'priority' AS field, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY ALL")
def enum_counts(spark: Spark, sf: str) -> DataFrame:
    """Value counts of several columns in one pass."""
    return metrics.value_counts(read(spark, sf, "orders"), {"priority": "o_orderpriority", "status": "o_orderstatus"})


@query("decision_share", "SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM orders GROUP BY ALL")
def decision_share(spark: Spark, sf: str) -> DataFrame:
    """A15"""
    return metrics.shares(read(spark, sf, "orders"), "o_orderstatus")


@query("document_frequency", "SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM documents) GROUP BY term")
def document_frequency(spark: Spark, sf: str) -> DataFrame:
    """A16"""
    return read(spark, sf, "documents").select(F.explode(F.array_distinct(T.words(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


@query("term_frequency", "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY ALL")
def term_frequency(spark: Spark, sf: str) -> DataFrame:
    """A17"""
    return read(spark, sf, "documents").select("doc_id", F.explode(T.words(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


@query("straddling_families", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS splits FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1")
def straddling_families(spark: Spark, sf: str) -> DataFrame:
    """A18"""
    return read(spark, sf, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("splits")).where("splits > 1")


@query(
    "crossing_titles",
    """WITH k AS (SELECT p_partkey, p_brand AS split, array_to_string(list_slice(list_sort(list_distinct(regexp_extract_all(lower(p_name), '[a-z]{4,}'))), 1, 5), ' ') AS key FROM part)
    SELECT key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM k GROUP BY key HAVING count(DISTINCT split) > 1""",
)
def crossing_titles(spark: Spark, sf: str) -> DataFrame:
    """Title fingerprints that occur in more than one split."""
    keyed = read(spark, sf, "part").select(F.col("p_brand").alias("split"), F.array_join(T.rare_key(F.col("p_name")), " ").alias("key"))
    return keyed.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"), F.countDistinct("split").alias("n")).where("n > 1").drop("n")


@query("family_size", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS family_size FROM orders")
def family_size(spark: Spark, sf: str) -> DataFrame:
    """By a count joined back, so that one large family stays split over tasks."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(orders.groupBy("o_custkey").agg(F.count("*").alias("family_size")), "o_custkey").select("o_orderkey", "family_size")


@query("grouped_pairs", "SELECT coalesce(o_orderpriority, '') || ' | ' || coalesce(o_orderstatus, '') AS pair, count(*) AS n FROM orders GROUP BY ALL")
def grouped_pairs(spark: Spark, sf: str) -> DataFrame:
    """A23"""
    return read(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).select(F.concat_ws(" | ", F.coalesce("o_orderpriority", F.lit("")), F.coalesce("o_orderstatus", F.lit(""))).alias("pair"), "n")


@query("token_mass", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS mass FROM lineitem GROUP BY ALL")
def token_mass(spark: Spark, sf: str) -> DataFrame:
    """A24"""
    return read(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("mass"))


@query(
    "review_rows",
    """WITH g AS (SELECT p_brand, p_type, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS ids, min(p_partkey) AS first_id, max(p_size) AS risk FROM part GROUP BY ALL)
    SELECT p_brand, p_type, n, ids, first_id, round(risk * 0.5 * (1 + least(n, 100) / 10), 3) AS priority FROM g ORDER BY priority DESC, first_id""",
)
def review_rows(spark: Spark, sf: str) -> DataFrame:
    """Decisions of one signature as one task, the urgent first."""
    grouped = read(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda x: x.cast("string")), ",").alias("ids"), F.min("p_partkey").alias("first_id"), F.max("p_size").alias("risk"))
    return grouped.select("p_brand", "p_type", "n", "ids", "first_id", N.review_priority(F.col("risk"), F.lit(0.5), F.col("n")).alias("priority")).orderBy(F.desc("priority"), "first_id")


@query(
    "resolution_precision",
    """WITH d AS (SELECT documents.lang AS kind, toxic AS correct, quality AS automatic FROM labels JOIN documents USING (doc_id))
    SELECT coalesce(kind, 'all') AS kind, count(*) AS total, count(*) FILTER (WHERE automatic = 1) AS automatic, round(avg(correct) FILTER (WHERE automatic = 1), 6) AS precision, round(avg(automatic), 6) AS coverage FROM d GROUP BY GROUPING SETS ((), (kind))""",
)
def resolution_precision(spark: Spark, sf: str) -> DataFrame:
    """Labels as gold, quality as the automatic decision."""
    labels, docs = read(spark, sf, "labels", "documents")
    rows = labels.join(docs.select("doc_id", "lang"), "doc_id").select(F.col("lang").alias("kind"), F.col("toxic").alias("correct"), F.col("quality").alias("automatic"))
    out = rows.rollup("kind").agg(F.count("*").alias("total"), F.count_if(F.col("automatic") == 1).alias("automatic_n"), F.round(F.avg(F.when(F.col("automatic") == 1, F.col("correct"))), 6).alias("precision"), F.round(F.avg("automatic"), 6).alias("coverage"))
    return out.select(F.coalesce("kind", F.lit("all")).alias("kind"), "total", F.col("automatic_n").alias("automatic"), "precision", "coverage")


@query(
    "wilson_interval",
    """WITH g AS (SELECT lang, CAST(sum(toxic) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS n FROM labels JOIN documents USING (doc_id) GROUP BY lang), c AS (SELECT lang, s, n, s / n AS p, 1.959963984540054 AS z FROM g)
    SELECT lang, round(greatest(0, (p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS low, round(least(1, (p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)), 6) AS high FROM c""",
)
def wilson_interval(spark: Spark, sf: str) -> DataFrame:
    """A28"""
    labels, docs = read(spark, sf, "labels", "documents")
    counts = labels.join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.sum("toxic").cast("double").alias("s"), F.count("*").cast("double").alias("n"))
    low, high = N.wilson(F.col("s"), F.col("n"))
    return counts.select("lang", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query(
    "pair_metrics",
    """WITH p AS (SELECT doc_id, quality = 1 AS predicted, toxic = 0 AS same FROM labels)
    SELECT count(*) AS pairs, round(avg(CASE WHEN predicted = same THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(count(*) FILTER (WHERE predicted AND same) / count(*) FILTER (WHERE same), 6) AS same_recall, count(*) FILTER (WHERE predicted AND NOT same) AS false_merges FROM p""",
)
def pair_metrics(spark: Spark, sf: str) -> DataFrame:
    """A29"""
    return metrics.pair_metrics(read(spark, sf, "labels").select((F.col("quality") == 1).alias("predicted"), (F.col("toxic") == 0).alias("same")))


@query(
    "classifier_metrics",
    """SELECT count(*) AS n, round(count(*) FILTER (WHERE quality = 1 - toxic) / count(*), 4) AS accuracy, round(count(*) FILTER (WHERE toxic = 0 AND quality = 1) / nullif(count(*) FILTER (WHERE toxic = 0), 0), 4) AS include_retention,
    round(count(*) FILTER (WHERE toxic = 1 AND quality = 0) / nullif(count(*) FILTER (WHERE toxic = 1), 0), 4) AS exclusion_safety FROM labels""",
)
def classifier_metrics(spark: Spark, sf: str) -> DataFrame:
    """Quality as the decision, toxicity as the reason to exclude."""
    rows = read(spark, sf, "labels").select(F.when(F.col("quality") == 1, "include").otherwise("exclude").alias("decision"), F.when(F.col("toxic") == 0, "include").otherwise("exclude").alias("gold"))
    return metrics.classifier(rows, "decision", "gold")


_RANKED = """WITH r AS (SELECT lang, source, toxic AS rel, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS DOUBLE) AS rank, CAST(row_number() OVER (PARTITION BY source ORDER BY toxic DESC, n_chars DESC, doc_id) AS DOUBLE) AS ideal FROM labels JOIN documents USING (doc_id)),
g AS (SELECT source, CASE WHEN source < 'src2' THEN 'low' ELSE 'high' END AS domain, max(CASE WHEN rank = 1 THEN rel ELSE 0 END) AS top1, CAST(sum(CASE WHEN rank <= 10 THEN rel ELSE 0 END) AS DOUBLE) AS hits, CAST(sum(rel) AS DOUBLE) AS relevant, max(CASE WHEN rel = 1 THEN 1 / rank ELSE 0 END) AS rr,
sum(CASE WHEN rank <= 10 THEN rel / log2(rank + 1) ELSE 0 END) AS dcg, sum(CASE WHEN ideal <= 10 THEN rel / log2(ideal + 1) ELSE 0 END) AS idcg FROM r GROUP BY source)"""


@query(
    "ranking_metrics",
    _RANKED + """ SELECT coalesce(domain, 'all') AS domain, count(*) AS groups, round(avg(top1), 6) AS top1, round(avg(hits / 10), 6) AS precision_at_10, round(avg(CASE WHEN relevant > 0 THEN hits / relevant ELSE 0 END), 6) AS recall_at_10, round(avg(rr), 6) AS mrr, round(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END), 6) AS ndcg_at_10 FROM g GROUP BY GROUPING SETS ((), (domain))""",
)
def ranking_metrics(spark: Spark, sf: str) -> DataFrame:
    """Sources as groups, length as the score, toxicity as relevance, overall and by domain."""
    labels, docs = read(spark, sf, "labels", "documents")
    rows = labels.join(docs, "doc_id").select("source", F.when(F.col("source") < "src2", "low").otherwise("high").alias("domain"), F.col("n_chars").alias("score"), F.col("toxic").alias("relevant"), "doc_id")
    return metrics.ranking(rows, "source", "domain", 10)


@query("perplexity", "SELECT lang, round(exp(sum(n_chars / 10.0) / sum(length(text) + 1)), 6) AS perplexity, round(sum(n_chars / 10.0) / ln(2) / sum(octet_length(encode(text))), 6) AS bits_per_byte FROM documents GROUP BY lang")
def perplexity(spark: Spark, sf: str) -> DataFrame:
    """A tenth of the length stands in for the negative log likelihood."""
    rows = read(spark, sf, "documents").select("lang", (F.col("n_chars") / 10.0).alias("nll"), (F.length("text") + 1).alias("tokens"), F.octet_length("text").alias("bytes"))
    return metrics.perplexity(rows, ["lang"])


@query("mean_ignoring_nulls", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM (SELECT event_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events) GROUP BY ALL")
def mean_ignoring_nulls(spark: Spark, sf: str) -> DataFrame:
    """A35"""
    return read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("event_id") % 5 != 0, F.col("value"))), 6).alias("mean"))


@query("crosstab_margins", "SELECT coalesce(o_orderpriority, 'All') AS split, coalesce(o_orderstatus, 'All') AS mode, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def crosstab_margins(spark: Spark, sf: str) -> DataFrame:
    """A36"""
    return read(spark, sf, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).select(F.coalesce("o_orderpriority", F.lit("All")).alias("split"), F.coalesce("o_orderstatus", F.lit("All")).alias("mode"), "n")


@query("harvest_state", "SELECT event_type, max(ts) AS newest, min(ts) AS oldest, count(*) AS n FROM events GROUP BY event_type")
def harvest_state(spark: Spark, sf: str) -> DataFrame:
    """A37"""
    return read(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("newest"), F.min("ts").alias("oldest"), F.count("*").alias("n"))


@query(
    "registry_diff",
    """WITH a AS (SELECT c_mktsegment AS kind, c_custkey AS id FROM customer WHERE c_acctbal > 0), b AS (SELECT c_mktsegment AS kind, c_custkey AS id FROM customer WHERE c_acctbal < 5000)
    SELECT coalesce(a.kind, b.kind) AS kind, count(*) FILTER (WHERE a.id IS NULL) AS added, count(*) FILTER (WHERE b.id IS NULL) AS removed FROM a FULL JOIN b ON a.kind = b.kind AND a.id = b.id GROUP BY ALL""",
)
def registry_diff(spark: Spark, sf: str) -> DataFrame:
    """A38"""
    c = read(spark, sf, "customer").select(F.col("c_mktsegment").alias("kind"), F.col("c_custkey").alias("id"), "c_acctbal")
    return compare.registry_diff(c.where("c_acctbal > 0").select("kind", "id"), c.where("c_acctbal < 5000").select("kind", "id"))


@query("composite_score", "SELECT event_id, round(0.5 * (value / 100) + 0.3 * least(value / 15, 1.0) + 0.2 * greatest(0.0, 1 - value * 50 / 7168) - CASE WHEN event_id % 7 = 0 THEN 0.1 ELSE 0.0 END, 12) AS score FROM events")
def composite_score(spark: Spark, sf: str) -> DataFrame:
    """A39"""
    v = F.col("value")
    return read(spark, sf, "events").select("event_id", N.composite_score(v / 100, v, v * 50, F.col("event_id") % 7 == 0).alias("score"))


@query("licence_tiers", "WITH t AS (SELECT lang, CASE WHEN source IN ('src0', 'src1') THEN 1 WHEN source = 'src2' THEN 2 WHEN source = 'src3' THEN 3 WHEN source = 'src4' THEN 4 ELSE 5 END AS tier FROM documents) SELECT lang, tier, count(*) AS n FROM t GROUP BY ALL")
def licence_tiers(spark: Spark, sf: str) -> DataFrame:
    """Sources stand in for licences."""
    tier = T.licence_rank(F.when(F.col("source") == "src4", "").otherwise(F.col("source")), {1: ["src0", "src1"], 2: ["src2"], 3: ["src3"]})
    return read(spark, sf, "documents").groupBy("lang", tier.alias("tier")).agg(F.count("*").alias("n"))


@query("split_summary", "SELECT lang, count(*) AS papers, count(DISTINCT source) AS families, count(*) FILTER (WHERE contains(text, '|')) AS tables, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def split_summary(spark: Spark, sf: str) -> DataFrame:
    """A41"""
    return read(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("papers"), F.countDistinct("source").alias("families"), F.count_if(F.contains("text", F.lit("|"))).alias("tables"), F.sum("n_chars").alias("chars"))


@query("row_shares", "WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) SELECT source, lang, round(n / sum(n) OVER (PARTITION BY source), 6) AS share FROM c")
def row_shares(spark: Spark, sf: str) -> DataFrame:
    """A42"""
    counts = read(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return counts.select("source", "lang", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6).alias("share"))


@query("selection_summary", "WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS selected, string_agg(o_orderpriority || '=' || n, ',' ORDER BY o_orderpriority) AS by_field FROM c GROUP BY o_orderstatus")
def selection_summary(spark: Spark, sf: str) -> DataFrame:
    """A43"""
    counts = read(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    entry = F.concat("o_orderpriority", F.lit("="), F.col("n").cast("string"))
    return counts.groupBy("o_orderstatus").agg(F.sum("n").alias("selected"), F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("by_field"))


@query("bootstrap_interval")
def bootstrap_interval(spark: Spark, sf: str) -> DataFrame:
    """2,000 resamples of the documents' mean values, by language; seeded, so the same every time."""
    docs = read(spark, sf, "documents").groupBy("lang", "source").agg(F.avg("n_chars").alias("mean"))
    return metrics.bootstrap(docs, "lang", "mean", resamples=2000, seed=7)
