"""Scalar text functions over documents, conversations, parts and pages (F*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as T
from spanloom.functions import unicode as U
from spanloom.plans.base import query, read

Spark = SparkSession
_STOP = "['" + "', '".join(T.STOPWORDS) + "']"
_W = "regexp_extract_all(lower(text), '[a-z0-9]+')"


@query("content_tokens", f"SELECT conv_id, turn, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(translate(lower(text), '’–—', '''--'), '[^\\pL\\pN_\\s\\-/%.'']', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND NOT list_contains({_STOP}, w)), ' ') AS tokens FROM conversations")
def content_tokens(spark: Spark, sf: str) -> DataFrame:
    """F1 F2"""
    return read(spark, sf, "conversations").select("conv_id", "turn", F.array_join(T.tokens(F.col("text"), 3), " ").alias("tokens"))


@query("norm_key")
def norm_key(spark: Spark, sf: str) -> DataFrame:
    """F1 with NFKC and case folding, in Python for texts beyond ASCII only."""
    return read(spark, sf, "documents").select("doc_id", F.sha2(U.norm(F.col("text")), 256).alias("key"))


@query("or_query", f"SELECT item_id, array_to_string(list_transform(list_filter(list_distinct_in_order, lambda w: true), lambda w: '\"' || w || '\"'), ' OR ') AS q FROM (SELECT item_id, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\\pL\\pN_\\s\\-/%.'']', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND NOT list_contains({_STOP}, w)), lambda w: [w])), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_in_order FROM benchmark)")
def or_query(spark: Spark, sf: str) -> DataFrame:
    """F3"""
    return read(spark, sf, "benchmark").select("item_id", T.or_query(F.col("text")).alias("q"))


@query("char_ngrams", "SELECT p_partkey, array_to_string(list_transform(range(1, length(p_name) + 1), lambda i: substring(' ' || lower(p_name) || ' ', i, 3)), '|') AS grams FROM part")
def char_ngrams(spark: Spark, sf: str) -> DataFrame:
    """F4 F57"""
    return read(spark, sf, "part").select("p_partkey", F.array_join(T.ngrams(F.lower("p_name")), "|").alias("grams"))


@query("whole_word", "SELECT doc_id, regexp_matches(text, '(^|[^\\pL\\pN_])' || lang || '($|[^\\pL\\pN_])') AS found FROM documents")
def whole_word(spark: Spark, sf: str) -> DataFrame:
    """the language code as a whole word of the text."""
    return read(spark, sf, "documents").select("doc_id", T.mentions(F.col("text"), F.col("lang")).alias("found"))


@query("skeleton_key", "SELECT conv_id, turn, sha256(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g')) AS key FROM conversations")
def skeleton_key(spark: Spark, sf: str) -> DataFrame:
    """F6"""
    return read(spark, sf, "conversations").select("conv_id", "turn", F.sha2(T.skeleton(F.col("text")), 256).alias("key"))


_TERM = "CASE WHEN length(w) > 5 AND suffix(w, 'ies') THEN left(w, length(w) - 3) || 'y' WHEN length(w) > 5 AND suffix(w, 'ing') THEN left(w, length(w) - 3) WHEN length(w) > 4 AND suffix(w, 'ed') THEN left(w, length(w) - 2) WHEN length(w) > 4 AND suffix(w, 's') AND NOT suffix(w, 'ss') THEN left(w, length(w) - 1) ELSE w END"


@query("stemmed_terms", f"SELECT term, count(*) AS n FROM (SELECT {_TERM} AS term FROM (SELECT unnest({_W}) AS w FROM documents) WHERE length(w) >= 3 AND NOT list_contains({_STOP}, w)) GROUP BY term")
def stemmed_terms(spark: Spark, sf: str) -> DataFrame:
    """F7 F8"""
    rows = read(spark, sf, "documents").select(F.explode(T.words(F.col("text"))).alias("w")).where((F.length("w") >= 3) & ~F.col("w").isin(*T.STOPWORDS))
    return rows.groupBy(T.term(F.col("w")).alias("term")).agg(F.count("*").alias("n"))


@query("quantities")
def quantities(spark: Spark, sf: str) -> DataFrame:
    """F9 F10 F11"""
    rows = read(spark, sf, "documents").where(F.rlike("text", F.lit("[0-9]"))).select("doc_id", F.explode(U.quantities(F.col("text"))).alias("q"))
    return rows.select("doc_id", "q.raw", "q.value", "q.unit", "q.start", "q.stop")


@query("sentence_counts", "SELECT doc_id, len(list_filter(string_split_regex(text, '[.!?]\\s+|\\n+'), lambda s: length(trim(s)) > 0)) AS sentences FROM documents")
def sentence_counts(spark: Spark, sf: str) -> DataFrame:
    """the count; the cut keeps the mark with its sentence."""
    return read(spark, sf, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).cast("bigint").alias("sentences"))


@query("capital_sentences", "SELECT doc_id, 1 + len(regexp_extract_all(trim(text, chr(10) || ' '), '[.!?]\\s+[A-Z0-9]')) AS sentences FROM documents WHERE length(trim(text)) > 0")
def capital_sentences(spark: Spark, sf: str) -> DataFrame:
    """F13"""
    return read(spark, sf, "documents").where(F.length(F.trim("text")) > 0).select("doc_id", F.size(T.sentences(F.col("text"), capital=True)).cast("bigint").alias("sentences"))


@query("near_terms", f"SELECT doc_id, array_to_string(list_slice(regexp_extract_all(lower(substring(text, greatest(1, strpos(text, ',') - 100), 201)), '[a-z0-9]+'), 1, 5), ' ') AS near FROM documents WHERE strpos(text, ',') > 100")
def near_terms(spark: Spark, sf: str) -> DataFrame:
    """words within 100 characters of a place."""
    at = F.instr("text", F.lit(","))
    piece = F.substring(F.col("text"), F.greatest(F.lit(1), at - 100), F.lit(201))
    return read(spark, sf, "documents").where(at > 100).select("doc_id", F.array_join(F.slice(T.words(piece), 1, 5), " ").alias("near"))


@query("citation_labels", "SELECT DISTINCT CASE p_size % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN p_brand WHEN 2 THEN p_brand || ' & ' || p_type ELSE p_brand || ' et al.' END || ', ' || CASE WHEN p_size % 5 = 0 THEN 'n.d.' ELSE CAST(1990 + p_size AS VARCHAR) END AS label FROM part")
def citation_labels(spark: Spark, sf: str) -> DataFrame:
    """F20 F40 F41"""
    n = F.col("p_size") % 4
    families = F.slice(F.array("p_brand", "p_type", "p_type"), F.lit(1), n)
    return read(spark, sf, "part").select(T.citation_label(families, F.when(F.col("p_size") % 5 != 0, 1990 + F.col("p_size"))).alias("label")).distinct()


@query("basis_fragment", "SELECT conv_id, turn, array_to_string(list_slice(string_split_regex(trim(text), '\\s+'), 1, 36), ' ') AS basis FROM conversations")
def basis_fragment(spark: Spark, sf: str) -> DataFrame:
    """F21 F23"""
    return read(spark, sf, "conversations").select("conv_id", "turn", T.words_first(F.col("text"), 36).alias("basis"))


@query("provenance_footer", "SELECT doc_id, text || chr(10) || chr(10) || 'Source: ' || source || ' (' || lang || ')' AS response FROM documents")
def provenance_footer(spark: Spark, sf: str) -> DataFrame:
    """F24 F25 N24"""
    return read(spark, sf, "documents").select("doc_id", F.concat("text", F.lit("\n\nSource: "), "source", F.lit(" ("), "lang", F.lit(")")).alias("response"))


@query("token_estimate", "SELECT doc_id, CAST(greatest(1, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) + 8) AS INT) AS tokens FROM documents")
def token_estimate(spark: Spark, sf: str) -> DataFrame:
    """F26"""
    return read(spark, sf, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query("title_tokens", f"SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(translate(regexp_replace(regexp_replace(lower(html), '<[^>]*>', ' ', 'g'), '&[a-z]+;|&#[0-9]+;', ' ', 'g'), '{T.ACCENTED}', '{T.PLAIN}'), '[a-z0-9]+'), lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w)))), ' ') AS tokens FROM pages")
def title_tokens(spark: Spark, sf: str) -> DataFrame:
    """F27 F28"""
    return read(spark, sf, "pages").select("page_id", F.array_join(T.title_tokens(F.col("html")), " ").alias("tokens"))


@query("author_surnames", """SELECT DISTINCT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'customer,smith' END AS names FROM customer""")
def author_surnames(spark: Spark, sf: str) -> DataFrame:
    """Last words of a JSON list of names; a damaged list has none."""
    authors = F.when(F.col("c_custkey") % 3 == 0, '["broken').otherwise(F.concat(F.lit('["Ann Smith", "The Customer"]')))
    return read(spark, sf, "customer").select("c_custkey", F.array_join(T.surnames(authors), ",").alias("names"))


@query("title_numbers", "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]+'))), ',') AS numbers FROM documents")
def title_numbers(spark: Spark, sf: str) -> DataFrame:
    """F30"""
    return read(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(T.numbers(F.col("text"))), ",").alias("numbers"))


@query("set_overlap", f"WITH w AS (SELECT conv_id, turn, list_distinct({_W}) AS w FROM conversations) SELECT a.conv_id, a.turn, round(CASE WHEN len(a.w) = 0 OR len(b.w) = 0 THEN 0 ELSE len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) END, 6) AS overlap FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def set_overlap(spark: Spark, sf: str) -> DataFrame:
    """F31"""
    from spanloom.operators.metrics import overlap_share

    w = read(spark, sf, "conversations").select("conv_id", "turn", T.words(F.col("text")).alias("w"))
    after = w.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    return w.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(overlap_share(F.col("w"), F.col("v")), 6).alias("overlap"))


@query("family_keys", f"SELECT p_partkey, array_to_string(list_slice(list_sort(list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z]{{4,}}'), lambda w: NOT list_contains({_STOP}, w)))), 1, 5), ' ') AS title_key, p_brand || '|' || array_to_string(list_slice(list_sort(list_filter(regexp_extract_all(lower(p_name), '[a-z]{{4,}}'), lambda w: NOT list_contains({_STOP}, w))), 1, 4), ' ') AS family_key FROM part")
def family_keys(spark: Spark, sf: str) -> DataFrame:
    """F32 F33"""
    name = F.col("p_name")
    return read(spark, sf, "part").select("p_partkey", F.array_join(T.rare_key(name), " ").alias("title_key"), T.family_key(F.col("p_brand"), name).alias("family_key"))


@query("licences", "SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'open access' WHEN n_nationkey % 2 = 0 THEN 'cc-by-nd' ELSE 'cc-by' END AS licence, CAST(1 AS INT) AS tier FROM nation")
def licences(spark: Spark, sf: str) -> DataFrame:
    """The first licence of two columns, its name and tier."""
    url = F.concat(F.lit("https://creativecommons.org/licenses/by"), F.when(F.col("n_nationkey") % 2 == 0, "-nd").otherwise(""), F.lit("/4.0/"))
    rows = read(spark, sf, "nation").select("n_name", F.coalesce(F.nullif(F.when(F.col("n_nationkey") % 3 == 0, "open access").otherwise(""), F.lit("")), url).alias("raw"))
    return rows.select("n_name", T.licence_name(F.col("raw")).alias("licence"), T.licence_tier(T.licence_name(F.col("raw"))).alias("tier"))


@query("doi_keys", "SELECT page_id, regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '/+$', '') AS key FROM pages")
def doi_keys(spark: Spark, sf: str) -> DataFrame:
    """F37 over addresses: the scheme off and lower case."""
    return read(spark, sf, "pages").select("page_id", F.regexp_replace(F.regexp_replace(F.lower(F.trim("url")), "^https?://", ""), "/+$", "").alias("key"))


@query("work_ids", "SELECT o_orderkey, upper(regexp_extract('https://works.example/w' || o_orderkey, '([Ww][0-9]+)', 1)) AS work, CASE WHEN CAST(regexp_extract(CAST(o_orderdate AS VARCHAR), '([0-9]{4})', 1) AS INT) BETWEEN 1800 AND 2027 THEN CAST(regexp_extract(CAST(o_orderdate AS VARCHAR), '([0-9]{4})', 1) AS INT) END AS year FROM orders")
def work_ids(spark: Spark, sf: str) -> DataFrame:
    """F38 F40"""
    return read(spark, sf, "orders").select("o_orderkey", T.work_id(F.concat(F.lit("https://works.example/w"), F.col("o_orderkey").cast("string"))).alias("work"), T.plausible_year(F.col("o_orderdate").cast("string"), 2026).alias("year"))


@query("line_lookup", "SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: contains(lower(s), 'the'))[1] AS line FROM documents")
def line_lookup(spark: Spark, sf: str) -> DataFrame:
    """F45"""
    return read(spark, sf, "documents").select("doc_id", T.line_with(F.col("text"), F.lit("the")).alias("line"))


@query("page_text", "SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS digest FROM pages")
def page_text(spark: Spark, sf: str) -> DataFrame:
    """Tags off."""
    return read(spark, sf, "pages").select("page_id", F.md5(T.strip_tags(F.col("html"))).alias("digest"))


@query("page_unescaped")
def page_unescaped(spark: Spark, sf: str) -> DataFrame:
    """tags off and entities as characters."""
    return read(spark, sf, "pages").select("page_id", U.unescaped(T.strip_tags(F.col("html"))).alias("text"))


@query("abstract_of_index", f"SELECT doc_id, array_to_string({_W}, ' ') AS abstract FROM documents")
def abstract_of_index(spark: Spark, sf: str) -> DataFrame:
    """a text from its inverted index (term, places)."""
    index = read(spark, sf, "documents").select("doc_id", T.inverted_index(T.words(F.col("text"))).alias("index"))
    return index.select("doc_id", T.text_of_index(F.col("index")).alias("abstract"))


@query("slugs", "SELECT p_partkey, left(trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_'), 70) AS slug, regexp_matches('http://' || p_brand || '.example.org/x', '^https?://[A-Za-z0-9.-]+\\.[A-Za-z]{2,}(:[0-9]+)?(/\\S*)?$') AS valid FROM part")
def slugs(spark: Spark, sf: str) -> DataFrame:
    """F48 F49"""
    return read(spark, sf, "part").select("p_partkey", T.slug(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug"), T.valid_url(F.concat(F.lit("http://"), "p_brand", F.lit(".example.org/x"))).alias("valid"))


@query("excerpts", "SELECT doc_id, array_to_string(list_slice(list_filter(string_split_regex(substring(text, greatest(1, strpos(lower(text), ' the ') - 60), least(strpos(lower(text), ' the ') - 1, 60) + 65), '\\s+'), lambda w: length(w) > 0), 1, 25), ' ') AS excerpt FROM documents WHERE strpos(lower(text), ' the ') > 0")
def excerpts(spark: Spark, sf: str) -> DataFrame:
    """F50"""
    e = T.excerpt(F.col("text"), F.lit(" the "))
    return read(spark, sf, "documents").where(F.instr(F.lower("text"), F.lit(" the ")) > 0).select("doc_id", e.alias("excerpt"))


@query("canonical_numbers", "SELECT l_orderkey, l_linenumber, CASE WHEN contains(v, '.') THEN regexp_replace(regexp_replace(v, '0+$', ''), '\\.$', '') ELSE v END AS n FROM (SELECT l_orderkey, l_linenumber, replace(printf('%.3f', l_quantity), ',', '') AS v FROM lineitem)")
def canonical_numbers(spark: Spark, sf: str) -> DataFrame:
    """F51"""
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", T.canonical_number(F.format_string("%.3f", "l_quantity")).alias("n"))


@query("masked_citations", "SELECT p_partkey, 'Seen ' || p_name || ' and in' AS masked FROM part")
def masked_citations(spark: Spark, sf: str) -> DataFrame:
    """F52"""
    text = F.concat(F.lit("Seen [1, 2] "), "p_name", F.lit(" (Smith et al., 2019) and in Fig. 3"))
    return read(spark, sf, "part").select("p_partkey", T.mask_citations(text).alias("masked"))


@query("enum_spelling", "SELECT DISTINCT o_orderpriority, regexp_replace(upper(trim(o_orderpriority)), '[\\s-]+', '_', 'g') AS spelled FROM orders")
def enum_spelling(spark: Spark, sf: str) -> DataFrame:
    """F54"""
    return read(spark, sf, "orders").select("o_orderpriority", T.enum_spelling(F.col("o_orderpriority")).alias("spelled")).distinct()


@query("entity_keys", "SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS primary_key, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS loose_key, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]+'))), ' ') AS token_key, upper(array_to_string(list_transform(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda w: left(w, 1)), '')) AS acronym, array_to_string(list_slice(string_split(lower(trim(p_name)), ' '), 1, 2), ' ') AS organism FROM part")
def entity_keys(spark: Spark, sf: str) -> DataFrame:
    """F55 F56 F58 F59"""
    n = F.col("p_name")
    return read(spark, sf, "part").select("p_partkey", T.primary_key(n).alias("primary_key"), T.loose_key(n).alias("loose_key"), T.token_key(n).alias("token_key"), T.acronym(n).alias("acronym"), T.organism_key(n).alias("organism"))


@query("label_scores", "SELECT a.n_nationkey AS x, b.n_nationkey AS y, round(100 * (1 - levenshtein(lower(a.n_name), lower(b.n_name)) / greatest(length(a.n_name), length(b.n_name))), 4) AS score FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def label_scores(spark: Spark, sf: str) -> DataFrame:
    """edit similarity of labels within a block."""
    n = read(spark, sf, "nation")
    pairs = n.alias("a").join(n.alias("b"), (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    far = F.levenshtein(F.lower("a.n_name"), F.lower("b.n_name")) / F.greatest(F.length("a.n_name"), F.length("b.n_name"))
    return pairs.select(F.col("a.n_nationkey").alias("x"), F.col("b.n_nationkey").alias("y"), F.round(100 * (1 - far), 4).alias("score"))


@query("aligned_quotes")
def aligned_quotes(spark: Spark, sf: str) -> DataFrame:
    """The place of each document's first sentence, if it is the only one."""
    quote = F.regexp_extract("text", "^[^.!?]*", 0)
    return read(spark, sf, "documents").select("doc_id", U.align(F.col("text"), quote).alias("x")).select("doc_id", "x.start", "x.stop")


@query("occurrence_counts", "SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS n FROM documents")
def occurrence_counts(spark: Spark, sf: str) -> DataFrame:
    """A needle that cannot overlap itself."""
    return read(spark, sf, "documents").select("doc_id", F.size(U.occurrences(F.col("text"), F.lit("the"))).cast("bigint").alias("n"))


@query("paper_bodies", "SELECT doc_id, sha256(trim(regexp_replace(text, '<!--[^>]*-->', '', 'g'))) AS digest FROM documents")
def paper_bodies(spark: Spark, sf: str) -> DataFrame:
    """each text given front matter and references, which come off again."""
    paper = F.concat(F.lit("---\ntitle: x\n---\n"), "text", F.lit("\n# References\n[1] A. Smith"))
    return read(spark, sf, "documents").select("doc_id", F.sha2(T.paper_body(paper), 256).alias("digest"))


@query(
    "answer_scores",
    """WITH n AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]+', ' ', 'g'), '\\b(a|an|the)\\b', ' ', 'g'), ' +', ' ', 'g')) AS t FROM conversations),
    p AS (SELECT a.conv_id, a.turn, a.t AS x, b.t AS y FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
    wx AS (SELECT conv_id, turn, w, count(*) AS c FROM (SELECT conv_id, turn, unnest(string_split(x, ' ')) AS w FROM p) WHERE w <> '' GROUP BY ALL), wy AS (SELECT conv_id, turn, w, count(*) AS c FROM (SELECT conv_id, turn, unnest(string_split(y, ' ')) AS w FROM p) WHERE w <> '' GROUP BY ALL),
    same AS (SELECT conv_id, turn, sum(least(wx.c, wy.c)) AS s FROM wx JOIN wy USING (conv_id, turn, w) GROUP BY ALL), nx AS (SELECT conv_id, turn, sum(c) AS n FROM wx GROUP BY ALL), ny AS (SELECT conv_id, turn, sum(c) AS n FROM wy GROUP BY ALL)
    SELECT p.conv_id, p.turn, CAST(x = y AS INT) AS exact, round(coalesce(2.0 * s / (nx.n + ny.n), 0), 6) AS f1 FROM p LEFT JOIN same USING (conv_id, turn) LEFT JOIN nx USING (conv_id, turn) LEFT JOIN ny USING (conv_id, turn)""",
)
def answer_scores(spark: Spark, sf: str) -> DataFrame:
    """Each turn against the next."""
    rows = read(spark, sf, "conversations").select("conv_id", "turn", "text")
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    return rows.join(after, ["conv_id", "turn"]).select("conv_id", "turn", T.exact_match(F.col("text"), F.col("next")).alias("exact"), F.round(T.token_f1(F.col("text"), F.col("next")), 6).alias("f1"))


@query("format_compliance", "SELECT event_id, event_id % 2 = 0 AS complies FROM events")
def format_compliance(spark: Spark, sf: str) -> DataFrame:
    """F71"""
    answer = F.when(F.col("event_id") % 2 == 0, F.concat("event_type", F.lit(' said "yes" [E1]'))).otherwise(F.col("event_type"))
    return read(spark, sf, "events").select("event_id", T.has_format(answer).alias("complies"))


@query("hashed_embedding")
def hashed_embedding(spark: Spark, sf: str) -> DataFrame:
    """A unit vector of hashed words and four-grams, shown by its norm and first components."""
    v = U.embed(F.col("text"))
    return read(spark, sf, "benchmark").select("item_id", v.alias("v")).select("item_id", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 6).alias("norm"), F.size("v").alias("size"))


@query("byline_regions", "SELECT item_id, length(text) + 8 AS first_page, CASE WHEN item_id % 2 = 0 THEN 7 ELSE length(text) + 8 END AS region FROM benchmark")
def byline_regions(spark: Spark, sf: str) -> DataFrame:
    """The first page, and its part before the abstract."""
    head = F.when(F.col("item_id") % 2 == 0, "A Title\nAbstract").otherwise("A Title\nForeword")
    page = F.concat(head, F.lit("\n"), "text", F.lit("PDF_PAGE: 2 of more"))
    rows = read(spark, sf, "benchmark").select("item_id", T.first_page(page).alias("p"))
    return rows.select("item_id", (F.length("p") - 9).cast("bigint").alias("first_page"), F.when(F.length(T.byline_region(F.col("p"))) == 7, 7).otherwise(F.length(T.byline_region(F.col("p"))) - 9).cast("bigint").alias("region"))


@query("author_families", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'van der Berg' WHEN 1 THEN 'Okoro' WHEN 2 THEN 'Smith' ELSE c_mktsegment END AS family FROM customer")
def author_families(spark: Spark, sf: str) -> DataFrame:
    """family names with particles, without suffixes and trailing initials."""
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, "Jan van der Berg").when(k == 1, "Okoro, Bob").when(k == 2, "Ann Smith Jr.").otherwise(F.concat(F.lit("Eve "), "c_mktsegment", F.lit(" B.")))
    return read(spark, sf, "customer").select("c_custkey", U.family_name(name).alias("family"))
