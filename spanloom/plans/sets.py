"""Set operations, deduplication and components (U*, families)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import families, splits
from spanloom.operators.graph import connected_components
from spanloom.plans.base import query, read

Spark = SparkSession


@query("union_batches", "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def union_batches(spark: Spark, sf: str) -> DataFrame:
    """U1"""
    a, b = read(spark, sf, "customer", "supplier")
    left = a.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    right = b.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return left.unionByName(right, allowMissingColumns=True)


@query("union_distinct", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 49 UNION SELECT p_partkey FROM part WHERE p_size = 1")
def union_distinct(spark: Spark, sf: str) -> DataFrame:
    """U2"""
    lines, parts = read(spark, sf, "lineitem", "part")
    return lines.where("l_quantity > 49").select(F.col("l_partkey").alias("k")).union(parts.where("p_size = 1").select("p_partkey")).distinct()


@query("union_keep_first", "SELECT k, source FROM (SELECT k, source, row_number() OVER (PARTITION BY k ORDER BY p) AS r FROM (SELECT c_nationkey AS k, 'customer' AS source, 1 AS p FROM customer WHERE c_acctbal > 9900 UNION ALL SELECT s_nationkey, 'supplier', 2 FROM supplier)) WHERE r = 1")
def union_keep_first(spark: Spark, sf: str) -> DataFrame:
    """A union in which the earlier source wins."""
    a, b = read(spark, sf, "customer", "supplier")
    rows = a.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("source"), F.lit(1).alias("p")).unionByName(b.select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("source"), F.lit(2).alias("p")))
    return rows.groupBy("k").agg(F.min_by("source", "p").alias("source"))


@query("except_ids", "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def except_ids(spark: Spark, sf: str) -> DataFrame:
    """U4"""
    orders, customer = read(spark, sf, "orders", "customer")
    return orders.select(F.col("o_custkey").alias("k")).subtract(customer.where("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("intersect_ids", "SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def intersect_ids(spark: Spark, sf: str) -> DataFrame:
    """U5"""
    supplier, customer = read(spark, sf, "supplier", "customer")
    return supplier.select(F.col("s_nationkey").alias("k")).intersect(customer.select("c_nationkey"))


@query("subset_violations", "SELECT count(*) AS missing FROM (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 1000)")
def subset_violations(spark: Spark, sf: str) -> DataFrame:
    """Rows of the strict set that the mixed one lacks."""
    orders = read(spark, sf, "orders")
    strict = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    return strict.exceptAll(orders.where("o_totalprice > 1000").select("o_orderkey", "o_orderstatus")).agg(F.count("*").alias("missing"))


@query("ordered_unique", "SELECT item_id, string_agg(w, ' ' ORDER BY p) AS words FROM (SELECT item_id, w, min(p) AS p FROM (SELECT item_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS ws FROM benchmark)) GROUP BY ALL) GROUP BY item_id")
def ordered_unique(spark: Spark, sf: str) -> DataFrame:
    """U7"""
    return read(spark, sf, "benchmark").select("item_id", F.array_join(F.array_distinct(T.words(F.col("text"))), " ").alias("words"))


@query("span_dedupe", "SELECT source, page, quote, min(doc_id) AS first_doc FROM (SELECT source, doc_id, CAST(doc_id % 3 AS VARCHAR) AS page, text AS quote FROM documents) GROUP BY ALL")
def span_dedupe(spark: Spark, sf: str) -> DataFrame:
    """A page of "3.0" is page "3"."""
    page = F.regexp_replace((F.col("doc_id") % 3).cast("double").cast("string"), r"^(\d+)\.0+$", "$1")
    return read(spark, sf, "documents").groupBy("source", page.alias("page"), F.col("text").alias("quote")).agg(F.min("doc_id").alias("first_doc"))


_LANES = "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'evaluate' ELSE 'test' END AS split, md5(text) AS k FROM documents"


def _lanes(spark: Spark, sf: str) -> DataFrame:
    split = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "evaluate").otherwise("test")
    return read(spark, sf, "documents").select("doc_id", split.alias("split"), F.md5("text").alias("k"))


@query("leakage_suppress", f"WITH r AS ({_LANES}), o AS (SELECT k, min(CASE split WHEN 'test' THEN 0 WHEN 'evaluate' THEN 1 ELSE 2 END) AS o FROM r GROUP BY k) SELECT doc_id, split FROM r JOIN o USING (k) WHERE o = CASE split WHEN 'test' THEN 0 WHEN 'evaluate' THEN 1 ELSE 2 END")
def leakage_suppress(spark: Spark, sf: str) -> DataFrame:
    """U10"""
    return splits.suppress_crossing(_lanes(spark, sf), "k", "split").select("doc_id", "split")


@query("healed_splits", f"WITH r AS ({_LANES}), c AS (SELECT k, count(DISTINCT split) > 1 AS crosses FROM r GROUP BY k) SELECT doc_id, CASE WHEN crosses THEN 'train' ELSE split END AS split, crosses AND split <> 'train' AS moved FROM r JOIN c USING (k)")
def healed_splits(spark: Spark, sf: str) -> DataFrame:
    """U11"""
    return splits.heal(_lanes(spark, sf), "k", "split").select("doc_id", "split", "moved")


@query("cross_split_pairs", f"WITH r AS ({_LANES}) SELECT DISTINCT a.doc_id FROM r a JOIN r b ON a.k = b.k AND a.split <> b.split")
def cross_split_pairs(spark: Spark, sf: str) -> DataFrame:
    """Rows whose content also stands in another split, without pairing them."""
    rows = _lanes(spark, sf)
    crossing = rows.groupBy("k").agg((F.min("split") != F.max("split")).alias("crosses")).where("crosses").select("k")
    return rows.join(crossing, "k", "left_semi").select("doc_id")


@query("content_identity", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def content_identity(spark: Spark, sf: str) -> DataFrame:
    """U16 H2: one row of each content, by the hash of its canonical JSON."""
    key = F.sha2(F.to_json(F.struct("lang", "text")), 256)
    return read(spark, sf, "documents").groupBy(key.alias("k")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("id_collisions", "SELECT k, count(DISTINCT text) AS records FROM (SELECT doc_id % 500 AS k, text FROM documents) GROUP BY k HAVING count(DISTINCT text) > 1")
def id_collisions(spark: Spark, sf: str) -> DataFrame:
    """U17"""
    rows = read(spark, sf, "documents").select((F.col("doc_id") % 500).alias("k"), F.xxhash64("text").alias("h"))
    return rows.groupBy("k").agg(F.countDistinct("h").alias("records")).where("records > 1")


@query("components")
def components(spark: Spark, sf: str) -> DataFrame:
    """Over all orders, where one component holds every node; too slow in recursive SQL."""
    edges = read(spark, sf, "orders").select(F.col("o_custkey").alias("a"), F.floor(F.col("o_custkey") / 4).alias("b")).distinct()
    return connected_components(edges.where("a <> b"))


_WORDS = "list_sort(list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda w: length(w) > 2)))"
_SHARE = "CASE WHEN len({0}) = 0 OR len({1}) = 0 THEN 0.0 ELSE len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1}))) END"
#: Parts as papers: the name, brand and size are the title, the name and type the abstract, equal prices an equal DOI.
_PAIRS = f"""WITH t AS (SELECT p_partkey AS k, {_WORDS.format("p_name || ' ' || p_brand || p_size")} AS w, {_WORDS.format("p_name || ' ' || p_type")} AS a, list_sort(list_distinct(regexp_extract_all(p_name || ' ' || p_brand || p_size, '[0-9]+'))) AS n, CAST(p_retailprice AS VARCHAR) AS d, list_distinct([p_type, p_brand]) AS s, 1990 + p_size // 4 AS y FROM part),
singles AS (SELECT k, 'w ' || unnest(w) AS b FROM t), wholes AS (SELECT k, 't ' || array_to_string(w, ' ') AS b FROM t WHERE len(w) > 0),
ok AS (SELECT b FROM singles GROUP BY b HAVING count(*) BETWEEN 2 AND 40 UNION ALL SELECT b FROM wholes GROUP BY b HAVING count(*) BETWEEN 2 AND 60),
rows AS (SELECT * FROM (SELECT * FROM singles UNION ALL SELECT * FROM wholes) SEMI JOIN ok USING (b)),
pairs AS (SELECT DISTINCT x.k AS i, y.k AS j FROM rows x JOIN rows y ON x.b = y.b AND x.k < y.k),
s AS (SELECT i, j, {_SHARE.format("p.w", "q.w")} AS title, {_SHARE.format("p.a", "q.a")} AS abstract, {_SHARE.format("p.s", "q.s")} AS author, abs(p.y - q.y) AS gap, p.n <> q.n AS differ, p.d = q.d AS same FROM pairs JOIN t p ON p.k = i JOIN t q ON q.k = j),
v AS (SELECT i, j, round(title, 6) AS title, CASE WHEN same THEN 'merge' WHEN gap > 6 OR (differ AND abstract < 0.85) THEN CASE WHEN title >= 0.72 THEN 'review' ELSE 'separate' END
  WHEN abstract >= 0.85 OR (title >= 0.9 AND abstract >= 0.6) OR (title >= 0.8 AND author >= 0.6 AND abstract >= 0.5) THEN 'merge' WHEN title >= 0.72 THEN 'review' ELSE 'separate' END AS decision,
  CASE WHEN same THEN 'identical DOI' WHEN gap > 6 THEN CASE WHEN title >= 0.72 THEN 'years too far apart' ELSE '' END WHEN differ AND abstract < 0.85 THEN CASE WHEN title >= 0.72 THEN 'titles differ by a number' ELSE '' END
  WHEN abstract >= 0.85 THEN printf('abstract %.2f', abstract) WHEN title >= 0.9 AND abstract >= 0.6 THEN printf('title %.2f + abstract %.2f', title, abstract)
  WHEN title >= 0.8 AND author >= 0.6 AND abstract >= 0.5 THEN printf('title %.2f + authors %.2f + abstract %.2f', title, author, abstract) WHEN title >= 0.72 THEN 'close, not confirmed' ELSE '' END AS why FROM s WHERE title >= 0.55)"""


def _verdicts(spark: Spark, sf: str) -> DataFrame:
    title = F.concat("p_name", F.lit(" "), "p_brand", F.col("p_size").cast("string"))
    fields = {"title": title, "abstract": F.concat_ws(" ", "p_name", "p_type"), "doi": F.concat(F.lit("https://doi.org/"), F.col("p_retailprice").cast("string")), "surnames": F.array("p_type", "p_brand"), "year": 1990 + F.expr("p_size div 4")}
    papers = read(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in fields.items()])
    return families.decide(families.score(families.block(papers, "p_partkey", "title"), papers, "p_partkey")).withColumn("title", F.round("title", 6))


@query("family_pairs", f"{_PAIRS} SELECT i, j, title, decision, why FROM v")
def family_pairs(spark: Spark, sf: str) -> DataFrame:
    """F27 J13 F31 C11 U2"""
    return _verdicts(spark, sf).select("i", "j", "title", "decision", "why")


@query(
    "study_families",
    f"""WITH RECURSIVE {_PAIRS[5:]}, e AS (SELECT i AS a, j AS b FROM v WHERE decision = 'merge'), l AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e), r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
    f AS (SELECT p_partkey, least(p_partkey, coalesce(min(v), p_partkey)) AS family FROM part LEFT JOIN r ON u = p_partkey GROUP BY p_partkey) SELECT p_partkey, family, count(*) OVER (PARTITION BY family) AS family_size FROM f""",
)
def study_families(spark: Spark, sf: str) -> DataFrame:
    """Families of merged pairs; pairs for review stay apart."""
    merges = _verdicts(spark, sf).where("decision = 'merge'").select("i", "j")
    return families.families(merges, read(spark, sf, "part"), "p_partkey")


@query("family_reviews", f"{_PAIRS} SELECT why, count(*) AS pairs, min(i) AS first_i FROM v WHERE decision = 'review' GROUP BY why")
def family_reviews(spark: Spark, sf: str) -> DataFrame:
    """What waits for a person, by reason."""
    return _verdicts(spark, sf).where("decision = 'review'").groupBy("why").agg(F.count("*").alias("pairs"), F.min("i").alias("first_i"))


@query("binary_pairs", "SELECT conv_id, role, CAST(role = 'user' AS INT) AS label, count(*) AS n FROM conversations GROUP BY ALL")
def binary_pairs(spark: Spark, sf: str) -> DataFrame:
    """Groups of texts and labels exploded into pairs."""
    groups = read(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("docs"), F.collect_list((F.col("role") == "user").cast("int")).alias("labels"))
    pairs = groups.select("conv_id", F.explode(F.arrays_zip("docs", "labels")).alias("x")).select("conv_id", F.col("x.docs").alias("role"), F.col("x.labels").alias("label"))
    return pairs.groupBy("conv_id", "role", "label").agg(F.count("*").alias("n"))


@query("positive_negative", "SELECT a.conv_id, a.turn AS positive, b.turn AS negative FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id WHERE a.role = 'user' AND b.role <> 'user' AND lower(a.text) <> lower(b.text)")
def positive_negative(spark: Spark, sf: str) -> DataFrame:
    """Positives with negatives of one group, without equal texts."""
    rows = read(spark, sf, "conversations")
    good = rows.where("role = 'user'").select("conv_id", F.col("turn").alias("positive"), F.lower("text").alias("p"))
    bad = rows.where("role <> 'user'").select("conv_id", F.col("turn").alias("negative"), F.lower("text").alias("q"))
    return good.join(bad, "conv_id").where("p <> q").select("conv_id", "positive", "negative")
