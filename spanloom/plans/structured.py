"""JSON, array and map queries (N*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import structured as J
from spanloom.functions import text as T
from spanloom.plans.base import query, read

Spark = SparkSession


@query("json_fields", "SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, CAST(len(json_keys(props)) AS INT) AS n FROM events")
def json_fields(spark: Spark, sf: str) -> DataFrame:
    """The first field of a JSON object, and how many there are."""
    m = F.from_json("props", "map<string,string>")
    return read(spark, sf, "events").select("event_id", F.try_element_at(F.map_values(m), F.lit(1)).alias("first_value"), F.size(m).alias("n"))


@query("json_salvage")
def json_salvage(spark: Spark, sf: str) -> DataFrame:
    """Every third text cut off before its end, and repaired."""
    torn = F.when(F.col("event_id") % 3 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return read(spark, sf, "events").select("event_id", J.salvaged(torn).alias("x")).select("event_id", "x.payload", "x.salvaged")


@query("strict_json", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS payload FROM events")
def strict_json(spark: Spark, sf: str) -> DataFrame:
    """A thinking block goes; text outside the braces refuses the object."""
    said = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("Sure: "), "props")).otherwise(F.concat(F.lit("<think>{x}</think> "), "props"))
    return read(spark, sf, "events").select("event_id", J.strict_object(said).alias("payload"))


@query("first_objects", "SELECT event_id, props AS payload FROM events")
def first_objects(spark: Spark, sf: str) -> DataFrame:
    """An object, or the first of a list; the text as JSON writes it."""
    said = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    rows = read(spark, sf, "events").select("event_id", "props", J.first_object(said).alias("got"), J.first_object(F.col("props")).alias("want"))
    return rows.select("event_id", F.when(F.col("got") == F.col("want"), F.col("props")).alias("payload"))


@query("flattened", "SELECT conv_id, conv_id || ':o' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS local_id, role FROM conversations")
def flattened(spark: Spark, sf: str) -> DataFrame:
    """A nested record per conversation, back to rows with made ids."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role")))
    records = read(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(turns.alias("observations"))).alias("payload"))
    flat = J.flatten_records(records, "conv_id", "payload", "observations", "o")
    return flat.select("conv_id", "local_id", F.get_json_object("item", "$.role").alias("role"))


@query("recovered_evidence", "SELECT event_id, CASE event_id % 5 WHEN 4 THEN '' ELSE event_type END AS quotes FROM events")
def recovered_evidence(spark: Spark, sf: str) -> DataFrame:
    """Five shapes of evidence, one of them none."""
    t, k = F.col("event_type"), F.col("event_id") % 5
    shapes = F.when(k == 0, F.to_json(F.struct(t.alias("quote")))).when(k == 1, F.concat(F.lit('["'), t, F.lit('"]'))).when(k == 2, F.to_json(F.struct(F.array(F.struct(t.alias("text"), F.lit(3).alias("page"))).alias("evidence")))).when(k == 3, F.to_json(F.struct(F.struct(t.alias("span")).alias("source")))).otherwise("[]")
    return read(spark, sf, "events").select("event_id", J.recovered_evidence(shapes).alias("e")).select("event_id", F.array_join(F.transform("e", lambda x: x["quote"]), "|").alias("quotes"))


@query("evidence_bundles", "SELECT conv_id, string_agg(t, ' | ' ORDER BY first_turn) AS quotes FROM (SELECT conv_id, text AS t, min(turn) AS first_turn FROM conversations GROUP BY ALL) GROUP BY conv_id")
def evidence_bundles(spark: Spark, sf: str) -> DataFrame:
    """Spans of an owner in order, each once."""
    spans = read(spark, sf, "conversations").groupBy("conv_id", F.col("text").alias("t")).agg(F.min("turn").alias("first_turn"))
    return spans.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_turn", "t"))), lambda x: x["t"]), " | ").alias("quotes"))


@query("download_candidates", "SELECT p_partkey, 'http://' || p_brand || ' http://' || p_type AS urls, CASE WHEN p_size % 2 = 0 THEN 'http://' || p_type END AS first_open FROM part")
def download_candidates(spark: Spark, sf: str) -> DataFrame:
    """Locations in order, each address once, and the first open one."""
    place = lambda c, open_: F.struct(F.concat(F.lit("http://"), c).alias("url"), open_.alias("is_open"))
    listed = F.array(place("p_brand", F.lit(False)), place("p_type", F.col("p_size") % 2 == 0), place("p_brand", F.lit(False)))
    rows = read(spark, sf, "part").select("p_partkey", listed.alias("l"))
    return rows.select("p_partkey", F.array_join(F.array_distinct(F.transform("l", lambda x: x["url"])), " ").alias("urls"), F.try_element_at(F.filter("l", lambda x: x["is_open"]), F.lit(1))["url"].alias("first_open"))


@query("names_line", "SELECT p_partkey, left(array_to_string(list_slice(string_split(p_name, ' '), 1, 3), '; '), 30) AS line FROM part")
def names_line(spark: Spark, sf: str) -> DataFrame:
    """Words of a name are distinct here."""
    return read(spark, sf, "part").select("p_partkey", J.names_line(F.to_json(F.split("p_name", " ")), 3, 30).alias("line"))


@query("alias_records", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'KIND' WHEN 2 THEN 'LANGUAGE' ELSE 'REPEATED' END AS errors FROM part")
def alias_records(spark: Spark, sf: str) -> DataFrame:
    """N15"""
    k = F.col("p_partkey") % 4
    alias = lambda text: F.struct(text.alias("text"), F.when(k == 1, "nick").otherwise("SYNONYM").alias("kind"), F.when(k == 2, "eng").otherwise("en").alias("language"))
    records = F.array(alias(F.col("p_name")), alias(F.when(k == 3, F.upper("p_name")).otherwise(F.col("p_brand"))))
    return read(spark, sf, "part").select("p_partkey", F.array_join(J.alias_errors(records, ["SYNONYM", "ACRONYM"]), ",").alias("errors"))


@query("qualifier_union", "SELECT p_brand, 'size' AS kind, CASE WHEN min(p_size % 2) = max(p_size % 2) THEN CAST(min(p_size % 2) AS VARCHAR) END AS value, min(p_size % 2) <> max(p_size % 2) AS conflict FROM part GROUP BY p_brand")
def qualifier_union(spark: Spark, sf: str) -> DataFrame:
    """N16 N17 N19"""
    q = J.signature(F.array(F.struct(F.lit("size").alias("kind"), (F.col("p_size") % 2).cast("string").alias("value")), F.struct(F.lit("note").alias("kind"), F.col("p_name").alias("value"))), ["size"])
    return J.merged_qualifiers(read(spark, sf, "part").select("p_brand", q.alias("q")), "p_brand", "q")


@query("map_agreement", "SELECT a.event_id, true AS agree FROM events a WHERE a.event_id % 2 = 0 UNION ALL SELECT event_id, false FROM events WHERE event_id % 2 = 1")
def map_agreement(spark: Spark, sf: str) -> DataFrame:
    """Maps that share a key agree on it in every second row."""
    a = F.create_map(F.lit("x"), F.col("event_type"), F.lit("only left"), F.lit("1"))
    b = F.create_map(F.lit("x"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("other"), F.lit("only right"), F.lit("2"))
    return read(spark, sf, "events").select("event_id", J.maps_agree(a, b).alias("agree"))


@query("soften", "SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s)), lambda s: length(s) > 0 AND NOT regexp_matches(s, '[0-9]')), ' ') AS kept FROM documents")
def soften(spark: Spark, sf: str) -> DataFrame:
    """Lines that state numbers go, as unsupported sentences do."""
    lines = F.transform(F.split("text", "\n"), lambda s: F.trim(s))
    return read(spark, sf, "documents").select("doc_id", F.array_join(F.filter(lines, lambda s: (F.length(s) > 0) & ~F.rlike(s, F.lit("[0-9]"))), " ").alias("kept"))


@query("chat_messages", "SELECT a.conv_id, a.turn, 'user=' || a.text || ';assistant=' || b.text AS rendered FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'")
def chat_messages(spark: Spark, sf: str) -> DataFrame:
    """N25 C13"""
    rows = read(spark, sf, "conversations")
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    pairs = rows.where("role = 'user'").join(after, ["conv_id", "turn"])
    m = J.messages(F.col("text"), F.col("answer"))
    return pairs.select("conv_id", "turn", F.array_join(F.transform(m, lambda x: F.concat_ws("=", x["role"], x["content"])), ";").alias("rendered"))


@query("context_selection", """WITH w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM conversations), s AS (SELECT a.conv_id, a.turn, b.turn AS other, len(list_intersect(a.w, b.w)) AS n FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.turn <> b.turn),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, other) AS k FROM s) SELECT conv_id, turn, string_agg(CAST(other AS VARCHAR), ',' ORDER BY k) AS chosen FROM r WHERE k <= 3 GROUP BY ALL""")
def context_selection(spark: Spark, sf: str) -> DataFrame:
    """The three other turns with most terms in common."""
    from spanloom.operators.search import top_k

    w = read(spark, sf, "conversations").select("conv_id", "turn", F.explode(F.array_distinct(T.words(F.col("text")))).alias("term"))
    ids = read(spark, sf, "conversations").select("conv_id", "turn")
    pairs = ids.join(ids.select("conv_id", F.col("turn").alias("other")), "conv_id").where("turn <> other")
    shared = w.join(w.select("conv_id", F.col("turn").alias("other"), "term"), ["conv_id", "term"]).where("turn <> other").groupBy("conv_id", "turn", "other").agg(F.count("*").alias("n"))
    best = top_k(pairs.join(shared, ["conv_id", "turn", "other"], "left").withColumn("n", F.coalesce("n", F.lit(0))), ["conv_id", "turn"], [F.desc("n"), F.col("other")], 3, "k")
    return best.groupBy("conv_id", "turn").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "other"))), lambda x: x["other"].cast("string")), ",").alias("chosen"))


@query("paragraph_chunks")
def paragraph_chunks(spark: Spark, sf: str) -> DataFrame:
    """Chunks of paragraphs with their places."""
    from spanloom.operators.chunks import chunk_documents

    return chunk_documents(read(spark, sf, "documents"), "doc_id", "text", 1200)


@query("query_variants", "SELECT DISTINCT item_id, v FROM (SELECT item_id, text AS v FROM benchmark UNION ALL SELECT item_id, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s)), lambda s: length(s) > 0)) FROM benchmark)")
def query_variants(spark: Spark, sf: str) -> DataFrame:
    """The whole question and its lines, each once."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)
    return read(spark, sf, "benchmark").select("item_id", F.explode(F.array_distinct(F.concat(F.array("text"), lines))).alias("v"))


@query("sorted_maps", """SELECT p_partkey, '{"brand":"' || p_brand || '","size":"' || p_size || '"}' AS line FROM part""")
def sorted_maps(spark: Spark, sf: str) -> DataFrame:
    """N33"""
    m = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand"))
    return read(spark, sf, "part").select("p_partkey", J.sorted_map_line(m).alias("line"))


@query("facet_rules", """SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(lower(text), '(^|[^a-z])(the|of)($|[^a-z])') THEN 'english' END, CASE WHEN regexp_matches(lower(text), '(^|[^a-z])(le|des)($|[^a-z])') THEN 'french' END, CASE WHEN contains(text, '|') THEN 'table' END, lang], lambda x: x IS NOT NULL), ',') AS facets,
list_filter([CASE WHEN regexp_matches(lower(text), '(^|[^a-z])(the|of)($|[^a-z])') THEN 'english' END, CASE WHEN regexp_matches(lower(text), '(^|[^a-z])(le|des)($|[^a-z])') THEN 'french' END, lang], lambda x: x IS NOT NULL AND x <> 'english')[1] AS prim FROM documents""")
def facet_rules(spark: Spark, sf: str) -> DataFrame:
    """Facets from rules and fields; the first that is not weak."""
    from spanloom.operators.rules import reasons

    low = F.lower("text")
    rules = {"english": F.rlike(low, F.lit("(^|[^a-z])(the|of)($|[^a-z])")), "french": F.rlike(low, F.lit("(^|[^a-z])(le|des)($|[^a-z])"))}
    facets = F.array_compact(F.concat(reasons(rules | {"table": F.contains("text", F.lit("|"))}), F.array("lang")))
    primary = F.try_element_at(F.array_except(F.array_compact(F.concat(reasons(rules), F.array("lang"))), F.array(F.lit("english"))), F.lit(1))
    return read(spark, sf, "documents").select("doc_id", F.array_join(F.array_distinct(facets), ",").alias("facets"), primary.alias("prim"))
