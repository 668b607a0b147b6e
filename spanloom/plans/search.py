"""Retrieval queries: ``documents`` as the corpus, ``benchmark`` as the questions, ``embeddings`` as the vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.operators import answers
from spanloom.operators import search as S
from spanloom.plans.base import query, read
from spanloom.streaming import ingest

_BM25 = """
docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
sized AS (SELECT doc_id, w, len(w) AS len FROM docs),
totals AS (SELECT count(*) AS n, avg(len) AS mean_len FROM sized),
asked AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM benchmark),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len, unnest(w) AS term FROM sized) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
idf AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, mean_len FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
scores AS (SELECT item_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean_len))), 6) AS score FROM tf JOIN idf USING (term) JOIN asked USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores)
"""


def _hits(spark: SparkSession, sf: str, k: int) -> DataFrame:
    docs, bench = read(spark, sf, "documents", "benchmark")
    return S.bm25(docs, bench, k)


@query("bm25_topk", f"WITH {_BM25} SELECT item_id, doc_id, score, rank FROM ranked WHERE rank <= 10")
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """F2 A16 A17 H20 T1 J2"""
    return _hits(spark, sf, 10)


@query("indexed_search", f"WITH {_BM25} SELECT item_id, doc_id, score, rank FROM ranked WHERE rank <= 10")
def indexed_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same from an inverted index that is built first."""
    path = ingest.work_dir(spark, "index")
    docs, bench = read(spark, sf, "documents", "benchmark")
    S.build_index(docs, path)
    return S.search_index(spark, path, bench, 10)


@query(
    "cosine_topk",
    """WITH q AS (SELECT vec_id AS query, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 20 = 0),
    v AS (SELECT vec_id AS found, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    s AS (SELECT query, found, round(list_dot_product(q.e, v.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(v.e, v.e)), 6) AS cosine FROM q JOIN v ON query <> found),
    r AS (SELECT query, found, cosine, CAST(row_number() OVER (PARTITION BY query ORDER BY cosine DESC, found) AS INT) AS rank FROM s)
    SELECT query, found, cosine, rank FROM r WHERE rank <= 10""",
)
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector whose id is divisible by 20 against all."""
    vectors = read(spark, sf, "embeddings")
    return S.cosine_top_k(vectors, vectors.where("vec_id % 20 = 0"), 10)


_FUSED = f"""{_BM25},
overlap AS (SELECT item_id, doc_id, count(*) AS n FROM tf JOIN asked USING (term) GROUP BY ALL),
second AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, doc_id) AS rank FROM overlap),
channels AS (SELECT item_id, doc_id, 'lexical' AS channel, 1.0 AS weight, rank FROM ranked WHERE rank <= 50 UNION ALL SELECT item_id, doc_id, 'entity', 0.8, rank FROM second WHERE rank <= 50),
fused AS (SELECT item_id AS question, doc_id AS doc, round(sum(weight / (60 + rank)), 9) AS score, string_agg(channel, ',' ORDER BY channel) AS channels FROM channels GROUP BY ALL)
"""


def _fused(spark: SparkSession, sf: str) -> DataFrame:
    docs, bench = read(spark, sf, "documents", "benchmark")
    channels = S.lexical_channels(docs, bench, 50)
    return S.fuse(channels, {"lexical": 1.0, "entity": 0.8})


@query("rrf_fusion", f"WITH {_FUSED} SELECT question, doc, score, channels FROM fused")
def rrf_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """W1 A4 U1"""
    return _fused(spark, sf)


@query(
    "hybrid_search",
    f"""WITH {_FUSED}, placed AS (SELECT fused.*, source, row_number() OVER (PARTITION BY question, source ORDER BY score DESC, doc) AS p FROM fused JOIN documents ON doc_id = doc),
    reduced AS (SELECT question, doc, score, source, round(score * pow(0.85, greatest(0, p - 3)), 6) AS reduced FROM placed),
    final AS (SELECT *, CAST(row_number() OVER (PARTITION BY question ORDER BY reduced DESC, score DESC, doc) AS INT) AS place FROM reduced)
    SELECT question, doc, score, source, reduced, place FROM final WHERE place <= 10""",
)
def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Two channels fused, then diversified by source."""
    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "source")
    return S.diversify(_fused(spark, sf).join(docs, "doc").select("question", "doc", "score", "source"), 10, ["question"], "source")


@query(
    "diversify_decay",
    f"""WITH {_BM25}, placed AS (SELECT item_id, doc_id, score, source, row_number() OVER (PARTITION BY item_id, source ORDER BY score DESC, doc_id) AS p FROM ranked JOIN documents USING (doc_id) WHERE rank <= 50),
    reduced AS (SELECT item_id, doc_id, score, source, round(score * pow(0.85, greatest(0, p - 3)), 6) AS reduced FROM placed),
    final AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY reduced DESC, score DESC, doc_id) AS INT) AS place FROM reduced)
    SELECT item_id, doc_id, score, source, reduced, place FROM final WHERE place <= 10""",
)
def diversify_decay(spark: SparkSession, sf: str) -> DataFrame:
    """W5"""
    docs = read(spark, sf, "documents").select("doc_id", "source")
    return S.diversify(_hits(spark, sf, 50).drop("rank").join(docs, "doc_id").select("item_id", "doc_id", "score", "source"), 10, ["item_id"], "source", tie="doc_id")


@query(
    "one_hop",
    """WITH e AS (SELECT DISTINCT l_orderkey AS claim, l_partkey AS entity FROM lineitem), seeds AS (SELECT DISTINCT o_orderkey AS claim FROM orders WHERE o_orderkey % 20 = 0),
    near AS (SELECT DISTINCT entity FROM e SEMI JOIN seeds USING (claim)),
    o AS (SELECT * FROM e WHERE entity IN (SELECT entity FROM near) AND claim NOT IN (SELECT claim FROM seeds))
    SELECT claim, count(DISTINCT entity) AS shared, string_agg(DISTINCT CAST(entity AS VARCHAR), ',' ORDER BY CAST(entity AS VARCHAR)) AS entities FROM o GROUP BY claim ORDER BY shared DESC, claim LIMIT 50""",
)
def one_hop(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are claims, parts are entities."""
    lines, orders = read(spark, sf, "lineitem", "orders")
    edges = lines.select(F.col("l_orderkey").alias("claim"), F.col("l_partkey").alias("entity")).distinct()
    return S.one_hop(edges, orders.where("o_orderkey % 20 = 0").select(F.col("o_orderkey").alias("claim")), 50)


@query(
    "entity_rank",
    """SELECT l_orderkey, count(DISTINCT l_partkey) AS matched, CAST(sum(length(p_name)) AS BIGINT) AS name_length FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey
    WHERE p_brand = (SELECT min(p_brand) FROM part) GROUP BY l_orderkey ORDER BY matched DESC, name_length DESC, l_orderkey LIMIT 50""",
)
def entity_rank(spark: SparkSession, sf: str) -> DataFrame:
    """J3 A3"""
    lines, parts = read(spark, sf, "lineitem", "part")
    chosen = parts.join(parts.agg(F.min("p_brand").alias("p_brand")), "p_brand", "left_semi").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return S.entity_rank(lines, chosen, 50, "l_orderkey", "l_partkey", "p_name")


@query(
    "phrase_matches",
    """WITH p AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
    q AS (SELECT item_id, ' ' || array_to_string(w, ' ') || ' ' AS wanted FROM p WHERE len(w) > 0),
    d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') || ' ' AS held FROM documents)
    SELECT doc_id, item_id FROM d JOIN q ON contains(held, wanted)""",
)
def phrase_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item, whole, as a phrase."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    phrases = bench.select("item_id", F.array_join(T.words(F.col("text")), " ").alias("phrase"))
    return S.phrase_matches(docs, phrases, "doc_id", "text", "item_id", "phrase")


@query(
    "expand_query",
    """WITH a AS (SELECT p_type AS canonical, lower(split_part(p_name, ' ', 1)) AS alias FROM part GROUP BY ALL), q AS (SELECT n_nationkey AS id, lower(n_name) AS q FROM nation),
    parts AS (SELECT p_partkey, lower(p_name) AS n FROM part),
    m AS (SELECT DISTINCT p_partkey, canonical FROM parts JOIN a ON list_contains(string_split(n, ' '), alias) AND NOT contains(n, lower(canonical)))
    SELECT p_partkey, string_agg(canonical, ' ' ORDER BY canonical) AS added FROM m GROUP BY p_partkey""",
)
def expand_query(spark: SparkSession, sf: str) -> DataFrame:
    """Part names expanded by the types that share their first word, unless they hold the type already."""
    parts = read(spark, sf, "part")
    aliases = parts.select(F.col("p_type").alias("canonical"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("alias"))
    return S.expand(parts.select("p_partkey", F.lower("p_name").alias("n")), aliases, "p_partkey", "n")


_GATE = f"""{_BM25},
hits AS (SELECT item_id AS question, doc_id, rank, [lang, source] AS facets FROM ranked JOIN documents USING (doc_id) WHERE rank <= 10),
wanted AS (SELECT item_id AS question, CASE item_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'en' WHEN 2 THEN 'fr' ELSE 'src3' END AS prim FROM benchmark),
stats AS (SELECT question, count(*) AS candidates, count(*) FILTER (WHERE list_contains(facets, prim)) AS supporting FROM hits JOIN wanted USING (question) GROUP BY question),
f AS (SELECT question, facet, count(*) AS n FROM (SELECT question, prim, unnest(facets) AS facet FROM hits JOIN wanted USING (question)) WHERE facet <> 'src1' AND facet IS DISTINCT FROM prim GROUP BY ALL),
have AS (SELECT question, string_agg(facet, ',' ORDER BY n DESC, facet) AS available FROM f GROUP BY question),
decided AS (SELECT question, CASE WHEN coalesce(candidates, 0) = 0 THEN 'no_candidates' WHEN prim IS NULL THEN 'no_property_constraint' WHEN supporting > 0 THEN 'both_axes_matched' ELSE 'property_absent' END AS reason, coalesce(supporting, 0) AS supporting, coalesce(available, '') AS available FROM wanted LEFT JOIN stats USING (question) LEFT JOIN have USING (question))
"""


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    docs, bench = read(spark, sf, "documents", "benchmark")
    hits = _hits(spark, sf, 10).join(docs.select("doc_id", F.array("lang", "source").alias("facets")), "doc_id").select(F.col("item_id").alias("question"), "doc_id", "rank", "facets")
    wanted = bench.select(F.col("item_id").alias("question"), F.expr("CASE item_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'en' WHEN 2 THEN 'fr' ELSE 'src3' END").alias("primary"))
    return S.gate(hits, wanted, ["src1"])


@query("coverage_gate", f"WITH {_GATE} SELECT question, reason, supporting, CASE WHEN reason = 'property_absent' THEN available ELSE '' END AS available, reason IN ('no_property_constraint', 'both_axes_matched') AS answerable FROM decided")
def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Languages and sources stand in for the facets."""
    return _gated(spark, sf)


@query(
    "evidence_bundle",
    f"""WITH {_BM25} SELECT item_id AS question, doc_id AS doc, 'E' || rank AS tag, CASE WHEN source IN ('src0', 'src1', 'src2') THEN NULL ELSE trim(split_part(text, chr(10), 1)) END AS quote FROM ranked JOIN documents USING (doc_id) WHERE rank <= 5""",
)
def evidence_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources stand in for licences that forbid quotes."""
    docs = read(spark, sf, "documents")
    hits = _hits(spark, sf, 5).join(docs, "doc_id").withColumnsRenamed({"item_id": "question", "doc_id": "doc"})
    return S.bundle(hits, F.trim(F.split_part("text", F.lit("\n"), F.lit(1))), F.when(F.col("source").isin("src0", "src1", "src2"), 3).otherwise(1))


@query(
    "stub_answer",
    f"""WITH {_BM25} SELECT item_id AS question, regexp_extract(trim(text), '^[^.!?]*[.!?]?') || ' [E1]' AS answer FROM ranked JOIN documents USING (doc_id) WHERE rank = 1""",
)
def stub_answer(spark: SparkSession, sf: str) -> DataFrame:
    """The first sentence of the best hit and its tag."""
    docs = read(spark, sf, "documents")
    return _hits(spark, sf, 1).join(docs, "doc_id").select(F.col("item_id").alias("question"), F.concat(F.regexp_extract(F.trim("text"), "^[^.!?]*[.!?]?", 0), F.lit(" [E1]")).alias("answer"))


@query("checked_answers", f"WITH {_BM25}, hit AS (SELECT DISTINCT item_id FROM ranked) SELECT b.item_id AS question, CASE WHEN hit.item_id IS NULL THEN 'abstained' ELSE ['supported', 'softened', 'fallback', 'fallback'][b.item_id % 4 + 1] END AS verdict, CASE WHEN hit.item_id IS NULL THEN '' ELSE 'E1' END AS cited FROM benchmark b LEFT JOIN hit USING (item_id)")
def checked_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers validated against their evidence, softened, or replaced by the stub."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    hits = _hits(spark, sf, 3).join(docs, "doc_id").select(F.col("item_id").alias("question"), F.concat(F.lit("E"), F.col("rank").cast("string")).alias("tag"), F.col("text").alias("quote"))
    best = hits.where("tag = 'E1'").select("question", answers.stub(F.create_map("tag", F.regexp_replace("quote", r"\s+", " "))).alias("good"))
    k = F.col("item_id") % 4
    said = F.when(k == 0, F.col("good")).when(k == 1, F.concat("good", F.lit(" It was 777123 there [E1]."))).when(k == 2, "It is so.").otherwise("It is so [E99].")
    raw = bench.join(best, bench["item_id"] == best["question"], "left").select(F.col("item_id").alias("question"), said.alias("raw"))
    return answers.answers(raw, hits).select("question", "verdict", "cited")


@query(
    "chunk_scores",
    """WITH d AS (SELECT doc_id, lang, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS words, length(text) AS chars, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
    tf AS (SELECT doc_id, chars, term, count(*) AS tf FROM (SELECT doc_id, chars, unnest(w) AS term FROM d) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), n AS (SELECT count(*) AS n FROM documents),
    q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL),
    s AS (SELECT item_id, doc_id, round(sum(least(tf, qf) * (ln((n + 1) / (df + 1)) + 1)) / (1 + ln(1 + chars / 800)), 6) AS score FROM tf JOIN q USING (term) JOIN df USING (term), n GROUP BY item_id, doc_id, chars),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id DESC) AS INT) AS rank FROM s)
    SELECT item_id, doc_id, score, rank FROM r WHERE rank <= 6""",
)
def chunk_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Lexical chunk scores with a length penalty; ties go to the later chunk."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    return S.chunk_scores(docs, bench, 6)


@query(
    "retrieval_metrics",
    f"""WITH {_BM25}, gold AS (SELECT item_id, doc_id FROM documents JOIN benchmark ON contains(documents.text, benchmark.text)),
    per AS (SELECT g.item_id, count(*) AS expected, count(r.doc_id) AS found FROM gold g LEFT JOIN (SELECT * FROM ranked WHERE rank <= 10) r USING (item_id, doc_id) GROUP BY g.item_id)
    SELECT count(*) AS questions, round(avg(CASE WHEN found > 0 THEN 1.0 ELSE 0.0 END), 6) AS any_hit, round(avg(found / expected), 6) AS recall_at_10, round(avg(CASE WHEN found = expected THEN 1.0 ELSE 0.0 END), 6) AS all_found FROM per""",
)
def retrieval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a whole benchmark item are its expected hits."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    likely = S.phrase_matches(docs, bench, "doc_id", "text", "item_id", "text")
    gold = likely.join(docs.select("doc_id", F.col("text").alias("held")), "doc_id").join(bench.select("item_id", "text"), "item_id").where(F.contains("held", "text")).select("item_id", "doc_id")
    hit = _hits(spark, sf, 10).select("item_id", "doc_id", F.lit(1).alias("hit"))
    per = gold.join(hit, ["item_id", "doc_id"], "left").groupBy("item_id").agg(F.count("*").alias("expected"), F.count("hit").alias("found"))
    share = lambda c: F.round(F.avg(c), 6)
    return per.agg(F.count("*").alias("questions"), share((F.col("found") > 0).cast("double")).alias("any_hit"), share(F.col("found") / F.col("expected")).alias("recall_at_10"), share((F.col("found") == F.col("expected")).cast("double")).alias("all_found"))
