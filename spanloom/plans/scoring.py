"""Hashes, vectors, scores and the composite operators (H*, C*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import numeric as N
from spanloom.functions import text as T
from spanloom.operators import citations, classify, funnel, grounding, joins, registry, resolve, rules, training
from spanloom.plans.base import query, read

Spark = SparkSession


@query("stable_ids", "SELECT p_partkey, 'ENT-' || left(sha256(p_name || chr(31) || p_brand), 24) AS id, left(sha256(p_type), 32) AS proposal FROM part")
def stable_ids(spark: Spark, sf: str) -> DataFrame:
    """H5 H22"""
    return read(spark, sf, "part").select("p_partkey", N.stable_id("ENT", F.col("p_name"), F.col("p_brand")).alias("id"), F.left(F.sha2("p_type", 256), F.lit(32)).alias("proposal"))


@query("uuid5_ids")
def uuid5_ids(spark: Spark, sf: str) -> DataFrame:
    """H4: names in the DNS namespace."""
    return read(spark, sf, "nation").select("n_name", N.uuid5("6ba7b8109dad11d180b400c04fd430c8", F.col("n_name")).alias("id"))


@query("table_hash", "SELECT sha256(string_agg(h, '' ORDER BY h)) AS hash FROM (SELECT sha256(n_nationkey || ',' || n_name) AS h FROM nation)")
def table_hash(spark: Spark, sf: str) -> DataFrame:
    """H2 H3 H6: a table's hash, whatever the order of its rows. Meant for manifests, a row for each file."""
    row = F.sha2(F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name"), 256)
    return read(spark, sf, "nation").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(row)), ""), 256).alias("hash"))


@query("quantized_vectors", "WITH m AS (SELECT max(list_max(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x)))) AS top FROM embeddings) SELECT vec_id, CAST(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(round_even(x / top * 127, 0)))) AS BIGINT) AS mass FROM embeddings, m")
def quantized_vectors(spark: Spark, sf: str) -> DataFrame:
    """H8: one global scale; shown by the sum of magnitudes."""
    rows = read(spark, sf, "embeddings")
    top = rows.agg(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))).alias("top"))
    q = rows.crossJoin(F.broadcast(top)).select("vec_id", N.quantized(F.col("embedding"), F.col("top")).alias("q"))  # one row
    return q.select("vec_id", F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + F.abs(x)).alias("mass"))


@query("unit_vectors", "SELECT vec_id, round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first_component, round(least(100, greatest(0, (e[1] / sqrt(list_dot_product(e, e)) + 1) / 2 * 100)), 4) AS percent FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)")
def unit_vectors(spark: Spark, sf: str) -> DataFrame:
    """The cosine with the first axis."""
    e = F.col("embedding")
    axis = F.transform(e, lambda x, i: F.when(i == 0, 1.0).otherwise(0.0))
    return read(spark, sf, "embeddings").select("vec_id", F.round(N.normalized(e)[0], 6).alias("first_component"), F.round(N.cosine_percent(e, axis), 4).alias("percent"))


@query("number_support", "SELECT l_orderkey, l_linenumber, abs(l_extendedprice - round(l_extendedprice, 1)) <= 1e-5 * greatest(abs(l_extendedprice), abs(round(l_extendedprice, 1))) AS close, abs((l_extendedprice - l_quantity) - (l_extendedprice - l_quantity + 0.005)) <= 0.01 AS difference FROM lineitem")
def number_support(spark: Spark, sf: str) -> DataFrame:
    """Numbers equal but for rounding, and differences within a hundredth."""
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", N.close(p, F.round(p, 1), 1e-5).alias("close"), grounding.difference_supported(p, q, p - q + 0.005).alias("difference"))


@query("year_gaps", "SELECT a.o_orderkey, CAST(coalesce(abs(CASE WHEN a.o_orderkey % 4 = 0 THEN NULL ELSE year(a.o_orderdate) END - 1995), 99) AS INT) AS gap FROM orders a")
def year_gaps(spark: Spark, sf: str) -> DataFrame:
    """H16"""
    return read(spark, sf, "orders").select("o_orderkey", N.year_gap(F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate")), F.lit(1995)).alias("gap"))


@query("aspect_scores", "SELECT doc_id, CASE WHEN f THEN 4 ELSE 1 END AS centrality, CASE WHEN f AND g THEN 4 WHEN f OR g THEN 3 ELSE 2 END AS specificity, CAST(contains(lower(text), 'the') AS INT) + CAST(contains(lower(text), 'of') AS INT) + CAST(contains(lower(text), 'is') AS INT) AS hits FROM (SELECT doc_id, text, lang = 'en' AS f, source = 'src0' AS g FROM documents)")
def aspect_scores(spark: Spark, sf: str) -> DataFrame:
    """H21"""
    focus = F.when(F.col("lang") == "en", "essential").otherwise("none")
    places = F.array_compact(F.array(F.when(F.col("lang") == "en", "EN"), F.when(F.col("source") == "src0", "S0")))
    return read(spark, sf, "documents").select("doc_id", rules.centrality(F.lit("direct"), focus).alias("centrality"), rules.specificity(F.lit("direct"), places, focus).alias("specificity"), rules.hits(F.col("text"), ["the", "of", "is"]).alias("hits"))


@query("classified_documents", """WITH t AS (SELECT doc_id, lower(text) AS t, n_chars, list_filter(['the', 'and', 'of'], lambda w: regexp_matches(lower(text), '(^|[^a-z])' || w || '($|[^a-z])')) AS d, list_filter(['de', 'der'], lambda w: regexp_matches(lower(text), '(^|[^a-z])' || w || '($|[^a-z])')) AS l FROM documents),
s AS (SELECT doc_id, CASE WHEN len(d) > 0 THEN 'direct' WHEN len(l) > 0 THEN 'latent' ELSE 'absent' END AS level, CASE WHEN len(d) >= 3 THEN 'essential' WHEN len(d) = 2 THEN 'meaningful' WHEN len(d) = 1 THEN 'incidental' ELSE 'none' END AS focus, len(d) AS n, n_chars < 30 AS hard, least(4, n_chars // 500) AS depth FROM t),
c AS (SELECT *, CASE WHEN level = 'direct' THEN CASE focus WHEN 'essential' THEN 4 WHEN 'meaningful' THEN 3 ELSE 2 END WHEN level = 'latent' THEN 1 ELSE 0 END AS centrality, CASE WHEN level = 'direct' THEN CASE WHEN n >= 2 THEN 4 ELSE 3 END WHEN level = 'latent' THEN 1 ELSE 0 END AS specificity FROM s)
SELECT doc_id, level, focus, CAST(centrality + specificity + depth AS BIGINT) AS total, CASE WHEN hard OR level = 'absent' THEN 'exclude' WHEN level = 'direct' AND centrality >= 2 AND depth >= 2 AND centrality + specificity + depth >= 10 THEN 'include' WHEN level = 'direct' OR level = 'latent' THEN 'review' ELSE 'exclude' END AS decision FROM c""")
def classified_documents(spark: Spark, sf: str) -> DataFrame:
    """Lexicons to a decision; common words stand in for places."""
    return classify.relevance(read(spark, sf, "documents"), "doc_id", F.col("text"), direct=["the", "and", "of"], latent=["de", "der"], hard=F.col("n_chars") < 30, depth=F.least(F.lit(4), F.expr("n_chars div 500")), include_from=10)


@query("support_report")
def support_report(spark: Spark, sf: str) -> DataFrame:
    """Is a turn's statement carried by the turn before it, as an answer to that turn?"""
    rows = read(spark, sf, "conversations")
    before = rows.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("evidence"))
    return rows.join(before, ["conv_id", "turn"]).select("conv_id", "turn", grounding.support(F.col("text"), F.col("evidence"), F.col("evidence")).alias("r")).select("conv_id", "turn", "r.*")


@query("grounding_router")
def grounding_router(spark: Spark, sf: str) -> DataFrame:
    """Benchmark items routed against the documents that BM25 finds for them."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    from spanloom.operators.search import bm25

    near = bm25(docs, bench, 5)
    spans = near.join(docs.select("doc_id", "text"), "doc_id").select(F.col("item_id").alias("paper_id"), F.col("doc_id").alias("span_id"), F.col("rank"), F.col("text").alias("quote"))
    pairs = bench.select(F.col("item_id").alias("paper_id"), F.col("item_id").alias("pair_id"), F.col("text").alias("target"))
    return grounding.route(pairs, spans)


@query("funnel_stages", """WITH p AS (SELECT conv_id, turn, role, text, lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g')) AS k FROM conversations), a AS (SELECT * FROM p WHERE length(trim(text)) > 0), b AS (SELECT * FROM a WHERE length(text) >= 10), c AS (SELECT DISTINCT ON (k) * FROM b ORDER BY k, conv_id, turn)
SELECT 'read' AS stage, count(*) AS rows FROM p UNION ALL SELECT 'not blank', count(*) FROM a UNION ALL SELECT 'long enough', count(*) FROM b UNION ALL SELECT 'distinct', count(*) FROM c""")
def funnel_stages(spark: Spark, sf: str) -> DataFrame:
    """Rows left after every gate, counted in one pass."""
    return funnel.stages(read(spark, sf, "conversations"), {"not blank": F.length(F.trim("text")) > 0, "long enough": F.length("text") >= 10}, key=T.skeleton(F.col("text")))


def _training(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts as pairs of four types, brands as papers; sizes decide what fails."""
    k, s = F.col("p_partkey"), F.col("p_size")
    said = F.concat(F.lit("lead was "), s.cast("string"), F.lit(" mg/l there"))
    kinds = F.element_at(F.array(*map(F.lit, ("FACTUAL", "REASONING", "PREFERENCE", "RERANKER"))), (k % 4).cast("int") + 1)
    number = F.when(s % 3 == 0, F.floor(k / 2)).otherwise(k)
    pairs = read(spark, sf, "part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("pair_id"), F.when(s == 50, "nowhere").otherwise(F.col("p_brand")).alias("paper_id"), kinds.alias("pair_type"), F.concat(F.lit("what was lead in site "), number.cast("string")).alias("question"),
        F.when(s == 1, " ").otherwise(said).alias("answer"), F.lit("").alias("reasoning"), said.alias("chosen"), F.when(s % 11 == 0, F.upper(said)).otherwise("nobody knows").alias("rejected"),
        F.when(s % 7 == 0, "").otherwise(said).alias("positive_quote"), F.lit("other words").alias("hard_negative_quote"), F.concat("p_name", F.lit(" in the study 'A long and telling title' of many")).alias("descriptor"),
        F.when(s % 2 == 0, "DUAL").otherwise("OPEN").alias("assignment"), F.when(s % 5 == 0, "nothing was seen").otherwise(said).alias("evidence"), F.when(s % 4 == 0, "Obi, 2001").otherwise("").alias("citation_label"),
    )
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    split = F.when(brand % 5 == 0, "test").when(brand % 5 == 1, "evaluate").otherwise("train")
    return pairs, read(spark, sf, "part").select(F.col("p_brand").alias("paper_id"), F.concat(F.lit("F"), "p_brand").alias("family_id"), split.alias("split")).distinct()


_TRAINED = """x AS (SELECT p_partkey AS k, p_partkey % 4 AS t, p_size AS s, p_size % 5 <> 0 AS supported, CASE WHEN p_size % 3 = 0 THEN p_partkey // 2 ELSE p_partkey END AS q, CASE CAST(regexp_extract(p_brand, '[0-9]+') AS INT) % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS split FROM part),
y AS (SELECT *, CASE WHEN s = 50 OR (t < 2 AND s = 1) THEN 'STRUCTURAL' WHEN t = 3 AND s % 7 = 0 THEN 'RERANKER' WHEN t = 2 AND s % 11 = 0 THEN 'DPO_CONTRACT' END AS out FROM x),
z AS (SELECT *, min(split) OVER (PARTITION BY q) <> split AS leaked FROM y WHERE out IS NULL),
e AS (SELECT *, CASE WHEN s % 2 = 0 AND supported THEN 2 ELSE 1 END AS modes FROM z WHERE NOT leaked)"""


@query("training_set", f"""WITH {_TRAINED} SELECT 'READ' AS stage, count(*) AS n FROM x UNION ALL SELECT out, count(*) FROM y WHERE out IS NOT NULL GROUP BY out UNION ALL SELECT 'SUPPORT', count(*) FROM z WHERE t < 3 AND NOT supported UNION ALL SELECT 'SPLIT_LEAKAGE', count(*) FROM z WHERE leaked
UNION ALL SELECT 'sft_examples', CAST(sum(modes) AS BIGINT) FROM e WHERE t < 2 AND supported UNION ALL SELECT 'sft_mixed', CAST(sum(modes) AS BIGINT) FROM e WHERE t < 2 UNION ALL SELECT 'dpo_pairs', count(*) FROM e WHERE t = 2 AND supported UNION ALL SELECT 'preference_mixed', count(*) FROM e WHERE t = 2 UNION ALL SELECT 'reranker_mixed', count(*) FROM e WHERE t = 3
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM z WHERE t < 3 AND NOT supported) + (SELECT count(*) FROM z WHERE leaked) UNION ALL SELECT 'discarded', count(*) FROM y WHERE out IS NOT NULL""")
def training_set(spark: Spark, sf: str) -> DataFrame:
    """Pairs through all stages to seven tables, with the rows of each."""
    return training.build(*_training(spark, sf))[1]


@query("training_invariants", "SELECT 48 AS rules, 0 AS broken")
def training_invariants(spark: Spark, sf: str) -> DataFrame:
    """Every invariant of the seven tables, and how many are broken."""
    pairs, manifest = _training(spark, sf)
    found = training.violations(training.build(pairs, manifest)[0], manifest)
    return found.agg(F.count("*").cast("int").alias("rules"), F.count_if(F.col("n") > 0).cast("int").alias("broken"))


@query("dual_rendering", "SELECT conv_id, mode FROM (SELECT DISTINCT conv_id FROM conversations), (VALUES ('OPEN'), ('CLOSED')) v(mode) WHERE CASE conv_id % 3 WHEN 0 THEN mode = 'OPEN' WHEN 1 THEN mode = 'CLOSED' ELSE true END")
def dual_rendering(spark: Spark, sf: str) -> DataFrame:
    """C14: a pair for both modes gives two examples."""
    rows = read(spark, sf, "conversations").select("conv_id").distinct()
    assignment = F.when(F.col("conv_id") % 3 == 0, "OPEN").when(F.col("conv_id") % 3 == 1, "CLOSED").otherwise("DUAL")
    return rows.select("conv_id", funnel.render_modes(assignment).alias("mode"))


_CITED = """c AS (SELECT c_custkey AS k, c_custkey % 5 AS a, c_custkey % 7 AS y, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS family FROM customer),
d AS (SELECT *, CASE WHEN a = 0 THEN '' WHEN a = 1 THEN 'Okoro' WHEN a = 2 THEN 'Doe' ELSE family END AS own, CASE WHEN a = 0 THEN 'METADATA_ONLY' WHEN a = 1 THEN 'CORRECTED' WHEN a = 2 THEN 'CONFLICT' ELSE 'VERIFIED' END AS author_status,
  CASE WHEN y IN (1, 2) THEN '' WHEN y = 0 THEN '1999' ELSE '2001' END AS own_year, CASE WHEN y = 1 THEN 'CONFLICT' WHEN y = 2 THEN 'METADATA_ONLY' WHEN y = 0 THEN 'CORRECTED' ELSE 'VERIFIED' END AS year_status FROM c),
e AS (SELECT *, CASE WHEN author_status = 'CONFLICT' OR year_status = 'CONFLICT' THEN 'CONFLICT' WHEN author_status = 'CORRECTED' OR year_status = 'CORRECTED' THEN 'CORRECTED' WHEN author_status = 'VERIFIED' AND year_status = 'VERIFIED' THEN 'VERIFIED' ELSE 'METADATA_ONLY' END AS status, CASE WHEN a = 1 THEN 'okoro' ELSE lower(family) END || '|' || CASE WHEN y = 0 THEN '1999' ELSE '2001' END AS key FROM d)"""


def _cited(spark: Spark, sf: str) -> DataFrame:
    """Customers as papers: the segment is the first author, and first pages tell authors and years in several ways."""
    k, family = F.col("c_custkey"), F.initcap(F.lower("c_mktsegment"))
    first = F.concat(F.lit("Ann "), family)
    byline = F.when(k % 5 == 0, "Some words").when(k % 5 == 1, F.concat(F.lit("Bob Okoro, "), first)).when(k % 5 == 2, "## Jane Doe").otherwise(F.concat(first, F.lit(" and Bob Okoro")))
    years = F.when(k % 7 == 0, "Published 1999").when(k % 7 == 1, "Published 1999\nCopyright 2001").when(k % 7 == 2, "We went there in 1999").otherwise("Published 2001, Vol. 3")
    page = F.concat(F.lit("# A title\n"), byline, F.lit("\n"), years, F.lit("\nAbstract\nOkoro was there.\n"))
    return read(spark, sf, "customer").select(k.alias("paper_id"), F.concat(F.lit("W"), k.cast("string")).alias("openalex_id"), F.col("c_name").alias("title"), F.array(first, F.lit("Bob Okoro")).alias("authors"), F.lit(2001).alias("year"), page.alias("page"))


@query("citation_audit", f"WITH {_CITED} SELECT k AS paper_id, family AS openalex_first_author_family, own AS document_first_author_family, own_year AS document_year, author_status, year_status, status AS citation_status, key AS collision_key, count(*) OVER (PARTITION BY key) AS collision_count, CASE WHEN author_status = 'CORRECTED' OR year_status = 'CORRECTED' THEN 'OPENALEX+DOCUMENT_CORRECTION' WHEN author_status = 'VERIFIED' OR year_status = 'VERIFIED' THEN 'OPENALEX+DOCUMENT' ELSE 'OPENALEX' END AS metadata_source FROM e")
def citation_audit(spark: Spark, sf: str) -> DataFrame:
    """C16 F42 F43 F44 F76 F77 A21"""
    return citations.audit(_cited(spark, sf)).select("paper_id", "openalex_first_author_family", "document_first_author_family", "document_year", "author_status", "year_status", "citation_status", "collision_key", "collision_count", "metadata_source")


@query("citation_summary", f"WITH {_CITED} SELECT status AS citation_status, author_status, year_status, count(*) AS n FROM e GROUP BY ALL")
def citation_summary(spark: Spark, sf: str) -> DataFrame:
    """A22"""
    return citations.audit(_cited(spark, sf)).groupBy("citation_status", "author_status", "year_status").agg(F.count("*").alias("n"))


@query("document_years", "SELECT p_partkey, CASE WHEN 1990 + p_size % 20 = 1980 + p_size % 30 OR p_size % 2 = 0 THEN 1990 + p_size % 20 ELSE -1 END AS year FROM part")
def document_years(spark: Spark, sf: str) -> DataFrame:
    """a first page's year by the signals of its lines; a tie of two years is none."""
    size = F.col("p_size")
    page = F.concat_ws("\n", F.concat(F.lit("Published "), (1990 + size % 20).cast("string")), F.concat(F.when(size % 2 == 0, "Seen in ").otherwise("Copyright "), (1980 + size % 30).cast("string")))
    return citations.document_year(read(spark, sf, "part").select("p_partkey", page.alias("page")), "p_partkey", "page").na.fill(-1, ["year"])


@query("refined_rows", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'refined' ELSE o_orderstatus END AS status FROM orders")
def refined_rows(spark: Spark, sf: str) -> DataFrame:
    """Results over their rows, no row more or less."""
    orders = read(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("refined").alias("status"))
    return funnel.upsert(orders, new, ["o_orderkey"])


#: Parts as mentions (some misspelled) and as concepts of a registry; every twentieth asks where only a query set does.
_ER = """m AS (SELECT p_partkey AS mention_id, lower(CASE WHEN p_size % 5 = 0 THEN replace(p_name, 'e', 'a') ELSE p_name END || ' ' || p_brand) AS a, p_type AS block, p_brand AS paper, p_size % 3 AS q, p_size <> 7 AS safe FROM part),
t AS (SELECT 'C' || min(p_partkey) AS target_id, lower(p_name || ' ' || p_brand) AS b, p_type AS block, min(p_size) % 3 AS tq FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_name, p_brand, p_type)"""
_LEXICAL = """tw AS (SELECT *, regexp_extract_all(b, '[a-z0-9]+') AS w, '^' || array_to_string(regexp_extract_all(b, '[a-z0-9]+'), ' ') || '$' AS s FROM t),
mw AS (SELECT DISTINCT block, a, regexp_extract_all(a, '[a-z0-9]+') AS w, '^' || array_to_string(regexp_extract_all(a, '[a-z0-9]+'), ' ') || '$' AS s FROM asking),
tk AS (SELECT block, target_id, 0 AS kind, unnest(list_distinct(w)) AS key FROM tw UNION ALL SELECT block, target_id, 1, unnest(list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, CAST(i AS INT), 3)))) FROM tw),
mk AS (SELECT block, a, 0 AS kind, unnest(list_distinct(w)) AS key FROM mw UNION ALL SELECT block, a, 1, unnest(list_distinct(list_transform(range(1, length(s) - 1), lambda i: substr(s, CAST(i AS INT), 3)))) FROM mw),
sizes AS (SELECT block, kind, key, count(*) AS n FROM tk GROUP BY ALL HAVING count(*) <= 500),
chosen AS (SELECT * FROM mk JOIN sizes USING (block, kind, key) QUALIFY row_number() OVER (PARTITION BY block, a ORDER BY n, kind, key) <= 24),
hits AS (SELECT block, a, target_id, count(*) FILTER (WHERE kind = 0) AS tokens, count(*) FILTER (WHERE kind = 1) AS grams, round(sum(1 / n), 9) AS rarity FROM chosen JOIN tk USING (block, kind, key) GROUP BY ALL),
pool AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY block, a ORDER BY tokens DESC, rarity DESC, grams DESC, target_id) <= 100),
scored AS (SELECT mention_id, target_id, q, tq, round(100 * greatest(1 - levenshtein(asking.a, b) / greatest(length(asking.a), length(b), 1), len(list_intersect(regexp_extract_all(asking.a, '[a-z0-9]+'), w)) / greatest(len(list_distinct(list_concat(regexp_extract_all(asking.a, '[a-z0-9]+'), w))), 1)), 4) AS score FROM asking JOIN pool ON pool.block = asking.block AND pool.a = asking.a JOIN tw USING (target_id)),
near AS (SELECT *, CAST(row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, target_id) AS INT) AS rank FROM scored WHERE score >= 60 QUALIFY rank <= 10)"""


def _mentions_and_targets(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame]:
    p = read(spark, sf, "part")
    name = F.concat(F.when(F.col("p_size") % 5 == 0, F.replace("p_name", F.lit("e"), F.lit("a"))).otherwise(F.col("p_name")), F.lit(" "), "p_brand")
    size = lambda c: F.create_map(F.lit("size"), (c % 3).cast("string"))
    nothing = F.lit(None).cast("string")
    mentions = p.select(F.col("p_partkey").alias("mention_id"), name.alias("name"), F.col("p_type").alias("entity_type"), F.lit("CANONICAL").alias("scope"), F.col("p_brand").alias("paper_id"), nothing.alias("context_id"), size(F.col("p_size")).alias("qualifiers"), (F.col("p_size") != 7).alias("safe"))
    concepts = p.where("p_brand <> 'Brand#1'").groupBy("p_name", "p_brand", "p_type").agg(F.min("p_partkey").alias("k"), F.min("p_size").alias("size"))
    targets = concepts.select(F.concat(F.lit("C"), F.col("k").cast("string")).alias("target_id"), F.lit("CONCEPT").alias("target_kind"), F.concat("p_name", F.lit(" "), "p_brand").alias("label"), F.col("p_type").alias("entity_type"), nothing.alias("paper_id"), nothing.alias("context_id"), size(F.col("size")).alias("qualifiers"))
    return mentions, targets


@query("lexical_candidates", f"WITH {_ER}, asking AS (SELECT * FROM m WHERE mention_id % 20 = 0), {_LEXICAL} SELECT mention_id, target_id, score, rank FROM near")
def lexical_candidates(spark: Spark, sf: str) -> DataFrame:
    """By postings of words and three-grams; every row whose id is divisible by 20 asks all targets."""
    mentions, targets = _mentions_and_targets(spark, sf)
    return resolve.lexical_candidates(mentions.where("mention_id % 20 = 0"), targets)


@query("target_conflicts", f"WITH {_ER}, asking AS (SELECT * FROM m WHERE mention_id % 20 = 0), {_LEXICAL} SELECT mention_id, target_id, CASE WHEN q <> tq THEN 'IDENTITY_QUALIFIER_CONFLICT:size' ELSE '' END AS codes FROM near")
def target_conflicts(spark: Spark, sf: str) -> DataFrame:
    """Why a mention cannot be each of its candidates."""
    mentions, targets = _mentions_and_targets(spark, sf)
    asking = mentions.where("mention_id % 20 = 0")
    return resolve.judged(resolve.lexical_candidates(asking, targets).select("mention_id", "target_id"), asking, targets).select("mention_id", "target_id", F.array_join("conflicts", "|").alias("codes"))


@query("exact_links", f"WITH {_ER} SELECT mention_id, target_id, 'NORMALIZED_PRIMARY' AS method FROM m JOIN t ON m.block = t.block AND a = b")
def exact_links(spark: Spark, sf: str) -> DataFrame:
    """Mentions and concepts of one type and primary key."""
    hits = resolve.exact_hits(*_mentions_and_targets(spark, sf))
    return hits.select("mention_id", "target_id", F.element_at(F.array(*map(F.lit, resolve.METHODS)), F.col("method") + 1).alias("method"))


_DECIDED = f"""{_ER}, fit AS (SELECT mention_id, min(target_id) AS target, count(*) AS n FROM m JOIN t ON m.block = t.block AND a = b AND q = tq GROUP BY mention_id),
asking AS (SELECT * FROM m ANTI JOIN fit USING (mention_id)), {_LEXICAL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, target_id) AS r FROM near WHERE q = tq),
best AS (SELECT mention_id, max(score) AS score, max(score) FILTER (WHERE r = 2) AS runner, max(target_id) FILTER (WHERE r = 1) AS candidate FROM ranked GROUP BY mention_id),
blocked AS (SELECT DISTINCT mention_id FROM near WHERE q <> tq),
rest AS (SELECT asking.*, score, round(score - coalesce(runner, 0), 4) AS margin, candidate, blocked.mention_id IS NOT NULL AS is_blocked, coalesce(safe AND score >= 95 AND score - coalesce(runner, 0) >= 5, false) AS linked FROM asking LEFT JOIN best USING (mention_id) LEFT JOIN blocked USING (mention_id)),
g AS (SELECT block, a, q, count(DISTINCT paper) AS papers FROM rest WHERE NOT linked AND safe GROUP BY ALL),
decided AS (SELECT mention_id, 'MATCHED' AS status, 'NORMALIZED_PRIMARY' AS method, target, CASE WHEN n > 1 THEN 'AUTO_MERGE_EXACT_DUPLICATE_CONCEPTS' ELSE 'COLLISION_FREE' END AS reasons, 100.0 AS score, -1.0 AS margin FROM fit UNION ALL
SELECT mention_id, CASE WHEN linked THEN 'MATCHED' WHEN safe AND papers >= 2 THEN 'PROPOSED' WHEN safe THEN 'REVIEW' ELSE 'REVIEW_REQUIRED' END, CASE WHEN linked THEN 'LEXICAL_CALIBRATED' WHEN safe THEN 'BOOTSTRAP' WHEN candidate IS NOT NULL THEN 'AMBIGUOUS_CANDIDATES' WHEN is_blocked THEN 'HARD_CONFLICT' ELSE 'NO_SAFE_DECISION' END,
CASE WHEN linked THEN candidate WHEN safe THEN 'NEW-' || left(sha256(block || chr(31) || a || chr(31) || '{{"size":"' || q || '"}}'), 24) ELSE '' END,
CASE WHEN linked THEN 'CALIBRATED_TYPE_POLICY' WHEN NOT safe THEN 'SOURCE_REQUIRES_REVIEW' WHEN candidate IS NOT NULL THEN 'APPROXIMATE_CANDIDATES_REQUIRE_REVIEW' WHEN is_blocked THEN 'ALL_CANDIDATES_BLOCKED' ELSE 'NO_CANDIDATE' END, coalesce(score, -1), coalesce(margin, -1) FROM rest LEFT JOIN g USING (block, a, q))"""


@query("resolved_mentions", f"WITH {_DECIDED} SELECT * FROM decided")
def resolved_mentions(spark: Spark, sf: str) -> DataFrame:
    """Exact keys, calibrated candidates and proposals of all mentions."""
    return resolve.resolve(*_mentions_and_targets(spark, sf)).na.fill(-1.0, ["score", "margin"]).na.fill("", ["target"])


@query("committed_registry", f"""WITH {_DECIDED}, said AS (SELECT target AS concept, status, a, block FROM decided JOIN m USING (mention_id) WHERE status IN ('MATCHED', 'PROPOSED')), new AS (SELECT concept, min(a) AS label FROM said WHERE status = 'PROPOSED' GROUP BY concept),
known AS (SELECT target_id AS concept, b AS a FROM t UNION SELECT concept, label FROM new), learned AS (SELECT DISTINCT concept, a FROM said ANTI JOIN known USING (concept, a))
SELECT 'CREATE' AS event, concept AS subject, label AS object FROM new UNION ALL SELECT 'LEARN_ALIAS', concept, a FROM learned""")
def committed_registry(spark: Spark, sf: str) -> DataFrame:
    """The events of a commit: concepts made of ready proposals and names learned from matched mentions."""
    mentions, targets = _mentions_and_targets(spark, sf)
    mentions, targets = mentions.withColumn("name", F.lower("name")), targets.withColumn("label", F.lower("label"))
    concepts = targets.select(F.col("target_id").alias("concept"), "label", "entity_type", F.lit("ACTIVE").alias("state"), F.lit(None).cast("string").alias("redirect"), F.lit(1).alias("version"))
    aliases = spark.createDataFrame([], "concept string, alias string, trust string")
    _, _, events = registry.commit(concepts, aliases, mentions, resolve.resolve(mentions, targets), 2)
    return events.select("event", "subject", "object")


_REGISTRY = "c AS (SELECT n_nationkey AS k, 'N' || n_nationkey AS concept, n_regionkey AS kind FROM nation), a AS (SELECT c_custkey AS mention_id, 'N' || c_nationkey AS concept FROM customer)"


def _registry(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame]:
    concept = lambda c: F.concat(F.lit("N"), F.col(c).cast("string")).alias("concept")
    concepts = read(spark, sf, "nation").select(concept("n_nationkey"), F.col("n_name").alias("label"), F.col("n_regionkey").cast("string").alias("entity_type"), F.lit("ACTIVE").alias("state"), F.lit(None).cast("string").alias("redirect"), F.lit(1).alias("version"))
    return concepts, read(spark, sf, "customer").select(F.col("c_custkey").alias("mention_id"), concept("c_nationkey"))


@query("registry_events", f"WITH {_REGISTRY}, r AS (SELECT k, concept AS source, 'N' || (k // 2) AS target FROM c WHERE k % 6 = 1), j AS (SELECT r.source, r.target, x.kind AS s, y.kind AS t, z.source IS NOT NULL AS leaves FROM r JOIN c x ON x.concept = r.source JOIN c y ON y.concept = r.target LEFT JOIN r z ON z.source = r.target) SELECT source, target, CASE WHEN source = target THEN 'SELF_MERGE' WHEN s <> t THEN 'TYPE_CONFLICT' WHEN leaves THEN 'TARGET_IS_MERGED' ELSE 'MERGE' END AS outcome FROM j")
def registry_events(spark: Spark, sf: str) -> DataFrame:
    """Requests to merge concepts, done or refused."""
    concepts, _ = _registry(spark, sf)
    key = F.substring("concept", 2, 9).cast("int")
    requests = concepts.where(key % 6 == 1).select(F.col("concept").alias("source"), F.concat(F.lit("N"), F.floor(key / 2).cast("string")).alias("target"))
    _, events, refused = registry.merge(concepts, requests, 2)
    return events.select(F.col("subject").alias("source"), F.col("object").alias("target"), F.col("event").alias("outcome")).unionByName(refused.select("source", "target", F.col("why").alias("outcome")))


@query("split_concepts", f"WITH {_REGISTRY} SELECT mention_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SPLIT-' || left(sha256(concept || chr(31) || c_mktsegment), 24) ELSE concept END AS concept FROM a JOIN customer ON c_custkey = mention_id")
def split_concepts(spark: Spark, sf: str) -> DataFrame:
    """Mentions of one segment leave their concepts for new ones."""
    concepts, assignments = _registry(spark, sf)
    parts = read(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("mention_id"), F.col("c_mktsegment").alias("label"))
    return registry.split(concepts, assignments, parts, 2)[1]


@query("reassigned_mentions", f"WITH {_REGISTRY} SELECT mention_id, CASE WHEN c_acctbal < 0 AND c_custkey % 30 < 25 THEN 'N' || (c_custkey % 30) ELSE concept END AS concept FROM a JOIN customer ON c_custkey = mention_id")
def reassigned_mentions(spark: Spark, sf: str) -> DataFrame:
    """Moves to concepts of the registry; those to unknown ones are left out."""
    concepts, assignments = _registry(spark, sf)
    moves = read(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("mention_id"), F.concat(F.lit("N"), (F.col("c_custkey") % 30).cast("string")).alias("to"))
    return registry.reassign(assignments, moves, concepts, 2)[0]


@query("constrained_mentions", "WITH o AS (SELECT DISTINCT o_custkey AS mention_id, CASE WHEN o_orderstatus = 'F' THEN 'CANNOT_LINK' ELSE 'MUST_LINK' END AS rule, 'N' || (o_orderkey % 2) AS target_id FROM orders WHERE o_orderstatus IN ('F', 'P')), b AS (SELECT mention_id, target_id, count(DISTINCT rule) > 1 AS both_ FROM o GROUP BY ALL), w AS (SELECT mention_id, count(DISTINCT target_id) > 1 AS twice FROM o WHERE rule = 'MUST_LINK' GROUP BY mention_id) SELECT mention_id, rule, target_id, CASE WHEN both_ THEN 'CONFLICTING_MUST_AND_CANNOT_LINK' WHEN rule = 'MUST_LINK' AND twice THEN 'CONFLICTING_MUST_LINKS' ELSE '' END AS why FROM o JOIN b USING (mention_id, target_id) LEFT JOIN w USING (mention_id)")
def constrained_mentions(spark: Spark, sf: str) -> DataFrame:
    """Human rules, taken or refused."""
    rule = F.when(F.col("o_orderstatus") == "F", "CANNOT_LINK").otherwise("MUST_LINK")
    asked = read(spark, sf, "orders").where("o_orderstatus IN ('F', 'P')").select(F.col("o_custkey").alias("mention_id"), rule.alias("rule"), F.concat(F.lit("N"), (F.col("o_orderkey") % 2).cast("string")).alias("target_id"))
    taken, _, refused = registry.constrain(asked.limit(0), asked, 2)
    return taken.withColumn("why", F.lit("")).unionByName(refused)


@query("group_budgets", "WITH w AS (SELECT lang AS k, count(*) AS w FROM documents GROUP BY lang), e AS (SELECT k, w, w * 48 / sum(w) OVER () AS x FROM w), f AS (SELECT k, floor(x) AS s, row_number() OVER (ORDER BY x - floor(x) DESC, w DESC, k) AS p FROM e) SELECT k, CAST(s + CASE WHEN p <= 48 - (SELECT sum(s) FROM f) THEN 1 ELSE 0 END AS BIGINT) AS share FROM f")
def group_budgets(spark: Spark, sf: str) -> DataFrame:
    """A budget of pairs over the kinds of tasks."""
    from spanloom.operators.splits import largest_remainder

    return largest_remainder(read(spark, sf, "documents").groupBy(F.col("lang").alias("k")).agg(F.count("*").alias("w")), "k", "w", 48)


@query("contract_report", "SELECT 'bad split' AS rule, count(*) FILTER (WHERE lang NOT IN ('en', 'fr', 'de', 'es')) AS n FROM documents UNION ALL SELECT 'blank text', count(*) FILTER (WHERE trim(text) = '') FROM documents UNION ALL SELECT 'repeated id', count(*) - count(DISTINCT doc_id) FROM documents")
def contract_report(spark: Spark, sf: str) -> DataFrame:
    """An output's invariants in one pass."""
    docs = read(spark, sf, "documents")
    return funnel.contract(docs, {"bad split": ~F.col("lang").isin("en", "fr", "de", "es"), "blank text": F.trim("text") == ""}, unique={"repeated id": "doc_id"})


@query("semantic_reroute")
def semantic_reroute(spark: Spark, sf: str) -> DataFrame:
    """Quarantined items tried again with the neighbours of their hits."""
    docs, bench = read(spark, sf, "documents", "benchmark")
    from spanloom.operators.search import bm25

    near = bm25(docs, bench, 3).select("item_id", F.explode(F.array(F.col("doc_id") - 1, F.col("doc_id"), F.col("doc_id") + 1)).alias("doc_id")).distinct()
    spans = near.join(docs.select("doc_id", "text"), "doc_id").select(F.col("item_id").alias("paper_id"), F.col("doc_id").alias("span_id"), F.col("doc_id").alias("rank"), F.col("text").alias("quote"))
    return grounding.route(bench.select(F.col("item_id").alias("paper_id"), F.col("item_id").alias("pair_id"), F.col("text").alias("target")), spans)


@query("broken_rules", "SELECT 'a line without a part' AS rule, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)")
def broken_rules(spark: Spark, sf: str) -> DataFrame:
    """J20"""
    lines, parts = read(spark, sf, "lineitem", "part")
    return joins.violations({"a line without a part": lines.join(parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti")})
