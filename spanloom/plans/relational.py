"""Joins, top-k, predicates and projections (J*, T*, P*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import joins, rules
from spanloom.plans.base import query, read

Spark = SparkSession


@query("claims_with_spans", "SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate, p_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey")
def claims_with_spans(spark: Spark, sf: str) -> DataFrame:
    """Claims with their paper, and with the evidence where there is any."""
    lines, orders, parts = read(spark, sf, "lineitem", "orders", "part")
    spans = parts.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    papers = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey").join(papers, "l_orderkey").join(spans, "l_partkey", "left").drop("l_partkey")


@query("counted_paging", "SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer ORDER BY n DESC, c_custkey LIMIT 20 OFFSET 40")
def counted_paging(spark: Spark, sf: str) -> DataFrame:
    """A count for each paper, as pages of twenty."""
    customer, orders = read(spark, sf, "customer", "orders")
    n = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return customer.join(n, "c_custkey", "left").select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), "c_custkey").offset(40).limit(20)


@query("place_rank", "SELECT n_name, count(DISTINCT c_custkey) AS papers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY papers DESC, n_name LIMIT 20")
def place_rank(spark: Spark, sf: str) -> DataFrame:
    """J5"""
    nation, customer = read(spark, sf, "nation", "customer")
    return nation.join(customer, nation["n_nationkey"] == customer["c_nationkey"]).groupBy("n_name").agg(F.countDistinct("c_custkey").alias("papers")).orderBy(F.desc("papers"), "n_name").limit(20)


@query("one_to_one_join", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def one_to_one_join(spark: Spark, sf: str) -> DataFrame:
    """A left join that stops if the right side has a key twice."""
    orders, customer = read(spark, sf, "orders", "customer")
    right = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.unique_left_join(orders.select("o_orderkey", "o_custkey"), right, ["o_custkey"]).select("o_orderkey", "c_name")


@query("semi_and_anti", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_and_anti(spark: Spark, sf: str) -> DataFrame:
    """Eligible, and not sent yet."""
    customer, orders = read(spark, sf, "customer", "orders")
    o = orders.withColumnRenamed("o_custkey", "c_custkey")
    return customer.select("c_custkey").join(o.where("o_orderstatus = 'F'"), "c_custkey", "left_semi").join(o.where("o_orderpriority = '1-URGENT'"), "c_custkey", "left_anti")


@query("next_unclassified", "SELECT o_orderkey FROM orders ANTI JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_quantity > 45) USING (o_orderkey) ORDER BY o_orderkey LIMIT 400")
def next_unclassified(spark: Spark, sf: str) -> DataFrame:
    """The next 400 papers without a result."""
    orders, lines = read(spark, sf, "orders", "lineitem")
    return orders.select("o_orderkey").join(lines.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").orderBy("o_orderkey").limit(400)


@query(
    "redirects",
    """WITH RECURSIVE e AS (SELECT p_partkey AS retired, p_partkey // 3 AS target FROM part WHERE p_partkey > 2), w AS (SELECT retired, target FROM e UNION ALL SELECT w.retired, e.target FROM w JOIN e ON w.target = e.retired)
    SELECT retired, min(target) AS active FROM w WHERE target NOT IN (SELECT retired FROM e) GROUP BY retired""",
)
def redirects(spark: Spark, sf: str) -> DataFrame:
    """Retired ids followed to the active one."""
    parts = read(spark, sf, "part").where("p_partkey > 2")
    return joins.resolve_redirects(parts.select(F.col("p_partkey").alias("retired"), F.floor(F.col("p_partkey") / 3).cast("bigint").alias("target")))


@query("key_cascade", """WITH m AS (SELECT event_id, user_id, lower(event_type) AS name FROM events),
a AS (SELECT event_id, 1 AS method, CAST(c_custkey AS BIGINT) AS target FROM m JOIN customer ON c_custkey = user_id * 20), b AS (SELECT event_id, 2 AS method, CAST(s_suppkey AS BIGINT) AS target FROM m JOIN supplier ON s_suppkey = user_id),
c AS (SELECT event_id, 3 AS method, CAST(n_nationkey AS BIGINT) AS target FROM m JOIN nation ON n_nationkey = event_id % 40),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c), best AS (SELECT event_id, min(method) AS method FROM u GROUP BY event_id),
t AS (SELECT event_id, method, min(target) AS target, count(DISTINCT target) AS n FROM u JOIN best USING (event_id, method) GROUP BY ALL)
SELECT event_id, CASE coalesce(method, 0) WHEN 1 THEN 'authority' WHEN 2 THEN 'alias' WHEN 3 THEN 'primary' ELSE 'none' END AS method, CASE WHEN n = 1 THEN target ELSE -1 END AS target, CASE WHEN n IS NULL THEN 'UNMATCHED' WHEN n = 1 THEN 'LINKED' ELSE 'AMBIGUOUS' END AS status FROM m LEFT JOIN t USING (event_id)""")
def key_cascade(spark: Spark, sf: str) -> DataFrame:
    """Exact keys in order of trust; a method decides if it finds just one target."""
    events, customer, supplier, nation = read(spark, sf, "events", "customer", "supplier", "nation")
    m = events.select("event_id", "user_id", F.lower("event_type").alias("name"), (F.col("user_id") * 20).alias("authority"), (F.col("event_id") % 40).alias("place"))
    keys = {
        "authority": m.join(customer.select(F.col("c_custkey").alias("authority"), F.col("c_custkey").alias("target")), "authority"),
        "alias": m.join(supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_suppkey").alias("target")), "user_id"),
        "primary": m.join(nation.select(F.col("n_nationkey").cast("bigint").alias("place"), F.col("n_nationkey").cast("bigint").alias("target")), "place"),
    }
    return joins.cascade(m, keys, "event_id").na.fill(-1, ["target"])


@query(
    "integrity_violations",
    """SELECT 'line without order' AS rule, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') UNION ALL SELECT 'order without customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    UNION ALL SELECT 'page disagrees', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def integrity_violations(spark: Spark, sf: str) -> DataFrame:
    """Rows without an owner, and rows that disagree with theirs."""
    lines, orders, customer = read(spark, sf, "lineitem", "orders", "customer")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus")
    return joins.violations(
        {
            "line without order": lines.join(o.where("o_orderstatus <> 'P'"), "l_orderkey", "left_anti"),
            "order without customer": orders.join(customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti"),
            "page disagrees": lines.join(o, "l_orderkey").where("l_shipdate < o_orderdate"),
        }
    )


@query(
    "span_containment",
    """WITH s AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS a, CAST(floor(value) AS BIGINT) + 5 AS b FROM events WHERE event_id % 2 = 0), c AS (SELECT user_id, event_id AS chunk, CAST(floor(value) AS BIGINT) AS ca, CAST(floor(value) AS BIGINT) + 8 AS cb FROM events WHERE event_id % 2 = 1)
    SELECT event_id, count(*) AS chunks, min(chunk) AS first_chunk FROM s JOIN c USING (user_id) WHERE (ca <= a AND a < cb) OR (ca < b AND b <= cb) GROUP BY event_id""",
)
def span_containment(spark: Spark, sf: str) -> DataFrame:
    """Chunks of the same paper that hold a span's start or end."""
    e = read(spark, sf, "events").withColumn("v", F.floor("value"))
    s = e.where("event_id % 2 = 0").select("user_id", "event_id", F.col("v").alias("a"), (F.col("v") + 5).alias("b"))
    c = e.where("event_id % 2 = 1").select("user_id", F.col("event_id").alias("chunk"), F.col("v").alias("ca"), (F.col("v") + 8).alias("cb"))
    return joins.range_join(s, c, "user_id", ("a", "b"), ("ca", "cb"), width=8).groupBy("event_id").agg(F.count("*").alias("chunks"), F.min("chunk").alias("first_chunk"))


@query(
    "as_of_lookup",
    """WITH m AS (SELECT user_id, ts, event_id AS page FROM events WHERE event_type = (SELECT min(event_type) FROM events)), q AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> (SELECT min(event_type) FROM events))
    SELECT event_id, coalesce((SELECT arg_max(page, (ts, page)) FROM m WHERE m.user_id = q.user_id AND m.ts <= q.ts), -1) AS page FROM q""",
)
def as_of_lookup(spark: Spark, sf: str) -> DataFrame:
    """The last page marker at or before each place, in the same document."""
    e = read(spark, sf, "events")
    first = e.agg(F.min("event_type").alias("marker"))
    e = e.crossJoin(F.broadcast(first))  # one row
    marks = e.where("event_type = marker").select("user_id", "ts", F.col("event_id").alias("page"))
    return joins.as_of(e.where("event_type <> marker").select("event_id", "user_id", "ts"), marks, "user_id", "ts", "page").select("event_id", F.coalesce("page", F.lit(-1)).alias("page"))


@query("crosswalked", "WITH e AS (SELECT n_nationkey AS a, n_regionkey AS b FROM nation), p AS (SELECT x.n_nationkey AS a, y.r_regionkey AS b FROM nation x, region y UNION ALL SELECT y.r_regionkey, x.n_nationkey FROM nation x, region y) SELECT DISTINCT a, b FROM p SEMI JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) USING (a, b)")
def crosswalked(spark: Spark, sf: str) -> DataFrame:
    """Pairs of authorities that a crosswalk links in either direction."""
    edges = read(spark, sf, "nation").select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b"))
    return joins.symmetric(edges).distinct()


@query("citation_order", "SELECT o_orderkey, rank FROM (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY coalesce(TRY_CAST(CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE), -1) DESC, o_orderdate DESC, o_orderkey) AS INT) AS rank FROM orders) WHERE rank <= 100")
def citation_order(spark: Spark, sf: str) -> DataFrame:
    """T4 T5: most cited first, unknown counts last, then the newest, then the id."""
    cited = F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    orders = read(spark, sf, "orders").withColumn("cites", F.coalesce(cited.try_cast("double"), F.lit(-1.0)))
    best = orders.orderBy(F.desc("cites"), F.desc("o_orderdate"), "o_orderkey").limit(100)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("cites"), F.desc("o_orderdate"), "o_orderkey"))).select("o_orderkey", "rank")


@query(
    "query_union_top",
    """WITH s AS (SELECT vec_id % 7 AS q, vec_id AS chunk, round(CAST(embedding[1] AS DOUBLE), 6) AS score FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, chunk) AS k FROM s), m AS (SELECT chunk, max(score) AS score FROM r WHERE k <= 6 GROUP BY chunk)
    SELECT chunk, score FROM m ORDER BY score DESC, chunk LIMIT 12""",
)
def query_union_top(spark: Spark, sf: str) -> DataFrame:
    """The best of each query variant, united, at most twelve by their best score."""
    rows = read(spark, sf, "embeddings").select((F.col("vec_id") % 7).alias("q"), F.col("vec_id").alias("chunk"), F.round(F.col("embedding")[0].cast("double"), 6).alias("score"))
    return joins.union_top(rows, "q", "chunk", "score", 6, 12)


@query(
    "discard_reasons",
    """WITH r AS (SELECT doc_id, list_filter([CASE WHEN trim(text) = '' THEN 'blank text' END, CASE WHEN n_chars < 50 THEN 'too short' END, CASE WHEN regexp_matches(text, '(?s)(\\.{3}|…).*(\\.{3}|…)') THEN 'placeholder ellipsis' END, CASE WHEN contains(text, '�') THEN 'text encoding corruption' END,
      CASE WHEN toxic = 1 THEN 'judged not real' END], lambda x: x IS NOT NULL) AS reasons FROM documents LEFT JOIN labels USING (doc_id)) SELECT doc_id, array_to_string(reasons, '|') AS reasons, len(reasons) = 0 AS keep FROM r""",
)
def discard_reasons(spark: Spark, sf: str) -> DataFrame:
    """Every reason that fires, and whether none does; unknown verdicts pass."""
    docs, labels = read(spark, sf, "documents", "labels")
    t = F.col("text")
    fired = rules.reasons({"blank text": T.clean(t) == "", "too short": F.col("n_chars") < 50, "placeholder ellipsis": T.repeated_ellipsis(t), "text encoding corruption": T.mojibake(t), "judged not real": F.col("toxic") == 1})
    return docs.join(labels, "doc_id", "left").select("doc_id", fired.alias("r")).select("doc_id", F.array_join("r", "|").alias("reasons"), (F.size("r") == 0).alias("keep"))


@query("wrong_script", "SELECT doc_id, len(regexp_extract_all(text, '[éèêçàùâîôû]')) / greatest(length(text), 1) >= 0.1 AS wrong, regexp_matches(text, '�|â€') AS corrupt FROM documents")
def wrong_script(spark: Spark, sf: str) -> DataFrame:
    """P3 P4 over a marked-letter class, which the documents do hold."""
    t = F.col("text")
    hits = F.length(F.regexp_replace(t, "[^éèêçàùâîôû]", ""))
    return read(spark, sf, "documents").select("doc_id", (hits / F.greatest(F.length(t), F.lit(1)) >= 0.1).alias("wrong"), F.rlike(t, F.lit("�|â€")).alias("corrupt"))


@query("assistant_turn", "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'chosen: ' || trim(text) WHEN turn % 3 = 1 AND role = 'assistant' THEN role || chr(10) || chr(10) || 'Answer: ' || trim(text) ELSE trim(text) END AS target FROM conversations")
def assistant_turn(spark: Spark, sf: str) -> DataFrame:
    """The target of a pair by its type."""
    kind = F.when(F.col("turn") % 3 == 0, "PREFERENCE").when((F.col("turn") % 3 == 1) & (F.col("role") == "assistant"), "REASONING").otherwise("FACTUAL")
    rows = read(spark, sf, "conversations").withColumn("answer", F.trim("text"))
    return rows.select("conv_id", "turn", rules.assistant_turn(kind, F.concat(F.lit("chosen: "), F.col("answer")), F.col("role"), F.col("answer")).alias("target"))


@query(
    "decision_rule",
    """WITH s AS (SELECT p_partkey, p_size % 5 AS c, p_partkey % 5 AS d, (p_size + p_partkey) % 5 AS k, p_size // 10 AS sp, p_partkey // 7 % 5 AS a, p_partkey % 31 = 0 AS hard, CASE p_partkey % 6 WHEN 0 THEN 'review' ELSE 'include' END AS said FROM part)
    SELECT p_partkey, c + d + k + sp + a AS total, CASE WHEN hard THEN 'exclude' WHEN c >= 2 AND d >= 2 AND c + d + k + sp + a >= 14 THEN 'include' WHEN c >= 1 THEN 'review' ELSE 'exclude' END AS rule,
    CASE WHEN hard THEN 'exclude' WHEN said = 'review' THEN 'review' WHEN c + d + k + sp + a >= 14 AND c >= 2 AND d >= 2 THEN 'include' WHEN c + d + k + sp + a >= 10 THEN 'review' ELSE 'exclude' END AS production FROM s""",
)
def decision_rule(spark: Spark, sf: str) -> DataFrame:
    """Scores of five aspects to a decision."""
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = read(spark, sf, "part").select("p_partkey", (size % 5).alias("c"), (key % 5).alias("d"), ((size + key) % 5).alias("k"), F.expr("p_size div 10").alias("sp"), (F.expr("p_partkey div 7") % 5).alias("a"), (key % 31 == 0).alias("hard"), F.when(key % 6 == 0, "review").otherwise("include").alias("said"))
    total = F.col("c") + F.col("d") + F.col("k") + F.col("sp") + F.col("a")
    return rows.select("p_partkey", total.alias("total"), rules.decide(F.col("hard"), F.lit("direct"), F.col("c"), F.col("d"), total).alias("rule"), rules.decide_production(F.col("hard"), F.col("said"), F.col("c"), F.col("d"), total).alias("production"))


@query("tier_projection", "SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN NULL ELSE text END AS quote FROM documents")
def tier_projection(spark: Spark, sf: str) -> DataFrame:
    """P25"""
    return read(spark, sf, "documents").select("doc_id", F.when(~F.col("source").isin("src0", "src1"), F.col("text")).alias("quote"))


@query("safety_route", "SELECT conv_id, turn, contains(lower(text), 'moron') OR contains(lower(text), 'password') AS safety FROM conversations")
def safety_route(spark: Spark, sf: str) -> DataFrame:
    """P22"""
    return read(spark, sf, "conversations").select("conv_id", "turn", rules.holds_any(F.col("text"), ["moron", "password"]).alias("safety"))


@query(
    "lexicon_evidence",
    """WITH x AS (SELECT doc_id, list_filter(['the', 'and', 'que', 'der'], lambda t: regexp_matches(lower(text), '(^|[^a-z])' || t || '($|[^a-z])')) AS found FROM documents)
    SELECT doc_id, array_to_string(found, ',') AS terms, coalesce(found[1], '') AS first_term FROM x""",
)
def lexicon_evidence(spark: Spark, sf: str) -> DataFrame:
    """The terms of a lexicon that a text holds as words, and the first in the declared order."""
    found = rules.lexicon_terms(F.col("text"), ["the", "and", "que", "der"])
    return read(spark, sf, "documents").select("doc_id", found.alias("f")).select("doc_id", F.array_join("f", ",").alias("terms"), F.coalesce(F.try_element_at("f", F.lit(1)), F.lit("")).alias("first_term"))


@query("exclusion_ladder", "SELECT page_id, CASE WHEN contains(lower(html), '<table') THEN 'table' WHEN length(html) < 500 THEN 'short page' WHEN contains(lower(url), 'blog') THEN 'editorial' END AS exclusion FROM pages")
def exclusion_ladder(spark: Spark, sf: str) -> DataFrame:
    """The first rule of a ladder that holds."""
    rows = read(spark, sf, "pages")
    return rows.select("page_id", rules.first_reason({"table": F.contains(F.lower("html"), F.lit("<table")), "short page": F.length("html") < 500, "editorial": F.contains(F.lower("url"), F.lit("blog"))}).alias("exclusion"))


@query("contradiction_window", "SELECT doc_id, regexp_matches(lower(text), '(^|[^a-z])of($|[^a-z])(?s:.{0,120})(^|[^a-z])stupid($|[^a-z])') OR regexp_matches(lower(text), '(^|[^a-z])stupid($|[^a-z])(?s:.{0,120})(^|[^a-z])of($|[^a-z])') AS near FROM documents")
def contradiction_window(spark: Spark, sf: str) -> DataFrame:
    """One word within 120 characters of another, on either side."""
    return read(spark, sf, "documents").select("doc_id", rules.near(F.col("text"), "of", "stupid", 120).alias("near"))


@query("permitted_urls", "SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE '' END AS urls, CASE WHEN regexp_matches(url, '^https?://') THEN 'PERMITTED' ELSE 'NONE' END AS rights FROM pages")
def permitted_urls(spark: Spark, sf: str) -> DataFrame:
    """The distinct usable addresses in order of trust, and whether there is one."""
    urls = rules.permitted([F.col("url"), F.col("url")], lambda u: F.rlike(u, F.lit("^https?://")))
    return read(spark, sf, "pages").select("page_id", F.array_join(urls, " ").alias("urls"), F.when(F.size(urls) > 0, "PERMITTED").otherwise("NONE").alias("rights"))


@query("allow_list", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') GROUP BY ALL")
def allow_list(spark: Spark, sf: str) -> DataFrame:
    """Allowed and denied values; a name that the column lacks stops the plan."""
    orders = read(spark, sf, "orders")
    return rules.allowed(orders, "o_orderpriority", allow=["1-URGENT", "2-HIGH"]).where(~F.col("o_orderstatus").isin("P")).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("contract_errors", """WITH e AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_quantity > 40 THEN 'QUANTITY_RANGE' END, CASE WHEN l_shipdate IS NULL THEN 'NO_DATE' END, CASE WHEN l_discount > 0.05 AND l_tax > 0.05 THEN 'BOTH_RATES' END, CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'FLAG_ENUM' END], lambda x: x IS NOT NULL) AS errors FROM lineitem)
SELECT array_to_string(errors, '|') AS errors, count(*) AS n FROM e GROUP BY ALL""")
def contract_errors(spark: Spark, sf: str) -> DataFrame:
    """All broken rules as a list of codes, counted."""
    broken = rules.reasons({"QUANTITY_RANGE": F.col("l_quantity") > 40, "NO_DATE": F.col("l_shipdate").isNull(), "BOTH_RATES": (F.col("l_discount") > 0.05) & (F.col("l_tax") > 0.05), "FLAG_ENUM": ~F.col("l_returnflag").isin("A", "N")})
    return read(spark, sf, "lineitem").groupBy(F.array_join(broken, "|").alias("errors")).agg(F.count("*").alias("n"))


@query("group_consistency", "SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority || o_orderstatus) AS signatures FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority || o_orderstatus) > 1 OR count(*) > count(DISTINCT o_orderkey)")
def group_consistency(spark: Spark, sf: str) -> DataFrame:
    """Groups whose members disagree or repeat."""
    signature = F.concat("o_orderpriority", "o_orderstatus")
    grouped = read(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.countDistinct(signature).alias("signatures"), F.countDistinct("o_orderkey").alias("atoms"))
    return grouped.where("signatures > 1 or n > atoms").drop("atoms")


@query("failure_class", "SELECT event_id, CASE WHEN regexp_matches(props, '[0-4]') THEN 'retryable' ELSE 'permanent' END AS class FROM events")
def failure_class(spark: Spark, sf: str) -> DataFrame:
    """A failure is worth another try if any of its codes is."""
    codes = F.regexp_extract_all("props", F.lit("[0-9]"), 0)
    return read(spark, sf, "events").select("event_id", F.when(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in "01234"])), "retryable").otherwise("permanent").alias("class"))


@query("thin_answers", "SELECT conv_id, count(*) FILTER (WHERE length(trim(text)) < 20) = count(*) AS thin FROM conversations GROUP BY conv_id")
def thin_answers(spark: Spark, sf: str) -> DataFrame:
    """No item with enough in the field that the task requires."""
    return read(spark, sf, "conversations").groupBy("conv_id").agg((~F.bool_or(F.length(F.trim("text")) >= 20)).alias("thin"))


@query("quality_flags", "SELECT doc_id, array_to_string(list_sort(list_filter([CASE WHEN contains(text, '|') THEN 'TABLE' END, CASE WHEN n_chars > 5000 THEN 'LONG' END, CASE WHEN regexp_matches(text, '[0-9]{3}') THEN 'NUMBERS' END], lambda x: x IS NOT NULL)), ',') AS flags FROM documents")
def quality_flags(spark: Spark, sf: str) -> DataFrame:
    """Sorted flags of a row."""
    flags = rules.reasons({"TABLE": F.contains("text", F.lit("|")), "LONG": F.col("n_chars") > 5000, "NUMBERS": F.rlike("text", F.lit("[0-9]{3}"))})
    return read(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(flags), ",").alias("flags"))


@query("title_identity", """WITH p AS (SELECT a.p_partkey AS x, b.p_partkey AS y, list_distinct(string_split(lower(a.p_name), ' ')) AS u, list_distinct(string_split(lower(b.p_name), ' ')) AS v FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT x, y, round(len(list_intersect(u, v)) / len(list_distinct(list_concat(u, v))), 6) AS overlap FROM p""")
def title_identity(spark: Spark, sf: str) -> DataFrame:
    """Word overlap of titles within a block."""
    from spanloom.operators.metrics import overlap_share

    p = read(spark, sf, "part").select("p_partkey", "p_brand", "p_size", F.array_distinct(F.split(F.lower("p_name"), " ")).alias("w"))
    return joins.pairs_within(p, ["p_brand", "p_size"], "p_partkey", "w", lambda a, b: F.round(overlap_share(a, b), 6), "overlap")
