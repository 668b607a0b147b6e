"""Sources, plug-ins and rules that stand beside the main groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import numeric as N
from spanloom.functions import plugins
from spanloom.functions import unicode as U
from spanloom.operators import resolve, splits
from spanloom.plans.base import query, read
from spanloom.sources import readers, writers
from spanloom.sources.cursor import CursorSource
from spanloom.streaming import ingest

Spark = SparkSession


@query("cursor_pages", "SELECT year, count(*) AS works FROM (SELECT CAST(2000 + i % 25 AS INT) AS year FROM range(2500) t(i)) GROUP BY year")
def cursor_pages(spark: Spark, sf: str) -> DataFrame:
    """A paged source read in parallel, a partition a range of cursors."""
    spark.dataSource.register(CursorSource)
    return spark.read.format("cursor").option("total", 2500).load().groupBy("year").agg(F.count("*").alias("works"))


@query("cursor_stream", "SELECT count(*) AS works, count(DISTINCT i) AS ids FROM range(2500) t(i)")
def cursor_stream(spark: Spark, sf: str) -> DataFrame:
    """The same source as a stream; the checkpoint is the cursor."""
    spark.dataSource.register(CursorSource)
    folder = ingest.work_dir(spark, "cursor")
    stream = spark.readStream.format("cursor").option("size", 1000).load()
    running = stream.writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).option("checkpointLocation", f"{folder}/state").start()
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(f"{folder}/out").agg(F.count("*").alias("works"), F.countDistinct("id").alias("ids"))


@query("authority_links", "SELECT n_nationkey AS id, r_name AS name FROM nation JOIN region ON r_regionkey = n_regionkey")
def authority_links(spark: Spark, sf: str) -> DataFrame:
    """An authority's snapshot, checked against its manifest."""
    nation, region = read(spark, sf, "nation", "region")
    folder = ingest.work_dir(spark, "authority")
    writers.write_snapshot({"entries": region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")), "crosswalks": nation.select("n_nationkey", "n_regionkey")}, folder)
    entries, links = readers.authority_snapshot(spark, folder)
    return links.join(entries, links["n_regionkey"] == entries["id"]).select(F.col("n_nationkey").alias("id"), "name")


@query("ungrounded_conditions", "SELECT doc_id, CASE WHEN contains(text, source) THEN '' ELSE 'source' END AS missing FROM documents")
def ungrounded_conditions(spark: Spark, sf: str) -> DataFrame:
    """Conditions whose value the evidence does not hold."""
    given = F.create_map(F.lit("source"), F.col("source"), F.lit("start"), F.left("text", F.lit(5)))
    return read(spark, sf, "documents").select("doc_id", F.array_join(resolve.grounded_conditions(given, F.array("text")), ",").alias("missing"))


@query("blank_filled", "SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, coalesce(CAST(toxic AS VARCHAR), '') AS toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def blank_filled(spark: Spark, sf: str) -> DataFrame:
    """Results beside their rows, blank where there are none."""
    docs, labels = read(spark, sf, "documents", "labels")
    return docs.select("doc_id").join(labels.select("doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string")), "doc_id", "left").na.fill("")


@query("compatible_clusters")
def compatible_clusters(spark: Spark, sf: str) -> DataFrame:
    """Mentions of a brand by their sizes and types, where known."""
    key = F.col("p_partkey")
    given = F.map_filter(F.create_map(F.lit("size"), F.when(key % 3 == 0, (F.col("p_size") % 3).cast("string")), F.lit("type"), F.when(key % 5 == 0, F.left("p_type", F.lit(2)))), lambda k, v: v.isNotNull())
    return resolve.compatible_clusters(read(spark, sf, "part").select("p_brand", "p_partkey", given.alias("given")), "p_brand", "p_partkey", "given")


@query("context_fields", "SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def context_fields(spark: Spark, sf: str) -> DataFrame:
    """the fields of a described context."""
    text = F.concat(F.lit("Brand: "), "p_brand", F.lit("; no field; size : "), F.col("p_size").cast("string"), F.lit("; brand: other"))
    fields = resolve.context_fields(text)
    return read(spark, sf, "part").select("p_partkey", fields.alias("f")).select("p_partkey", F.try_element_at("f", F.lit("brand")).alias("brand"), F.try_element_at("f", F.lit("size")).alias("size"))


@query("qualifier_values", "SELECT n_nationkey, ['KE', 'CI', 'CI', 'NG', 'GW', 'nation x'][n_nationkey % 6 + 1] AS country, CASE n_nationkey % 3 WHEN 0 THEN 'river' WHEN 1 THEN 'basin' ELSE 'estuary mouth' END AS feature, lower(n_name) AS other FROM nation")
def qualifier_values(spark: Spark, sf: str) -> DataFrame:
    """spellings of countries and feature classes; other kinds only lose their case."""
    k = F.col("n_nationkey")
    said = F.element_at(F.array(*map(F.lit, ("Kenyan", "Côte d'Ivoire", "IVORY  coast", "ng", "Guinea-Bissau", "Nation X"))), (k % 6 + 1).cast("int"))
    feature = F.when(k % 3 == 0, "Rivers").when(k % 3 == 1, "Watershed").otherwise("Estuary  Mouth")
    return read(spark, sf, "nation").select("n_nationkey", resolve.qualifier_value(F.lit("country"), said).alias("country"), resolve.qualifier_value(F.lit("feature_class"), feature).alias("feature"), resolve.qualifier_value(F.lit("SEASON"), F.col("n_name")).alias("other"))


@query("iso_times", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, CAST(floor(epoch(ts) - epoch(min(ts) OVER ())) AS BIGINT) AS elapsed FROM events")
def iso_times(spark: Spark, sf: str) -> DataFrame:
    """Times in ISO 8601, and whole seconds since the first event."""
    events = read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first = events.agg(F.min("ts").alias("first"))
    return events.crossJoin(F.broadcast(first)).select("event_id", N.iso_utc(F.col("ts")).alias("at"), N.elapsed_seconds(F.col("first"), F.col("ts")).alias("elapsed"))  # one row


@query("random_negatives")
def random_negatives(spark: Spark, sf: str) -> DataFrame:
    """Each question with its own answer, labelled 1, and two answers of other conversations, labelled 0."""
    rows = read(spark, sf, "conversations")
    asked = rows.where("role = 'user'").select("conv_id", F.col("turn").alias("turn"), F.col("text").alias("query"))
    replies = rows.where("role <> 'user'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("doc"))
    own = asked.join(replies, ["conv_id", "turn"]).select("conv_id", "turn", "query", "doc", F.lit(1).alias("label"))
    return own.unionByName(splits.random_negatives(own.drop("label"), replies.select("conv_id", "doc"), "conv_id", ["conv_id", "turn"], 2, 7).withColumn("label", F.lit(0)))


@query("spoken_texts")
def spoken_texts(spark: Spark, sf: str) -> DataFrame:
    """Numbers as words, and the strict projection."""
    rows = read(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("t"))
    return rows.select("conv_id", "turn", U.speakable(F.concat("t", F.lit(" at 1,250.5 mg/l"))).alias("spoken"), U.strictly_projected(F.col("t")).alias("flat"))


@query("plugged_functions", "SELECT item_id, regexp_extract(trim(text), '^[^.!?]*[.!?]?') || ' [E1]' AS answer, CAST(384 AS INT) AS size FROM benchmark")
def plugged_functions(spark: Spark, sf: str) -> DataFrame:
    """The built-in embedder and the stub generator through the plug-in surface."""
    return read(spark, sf, "benchmark").select("item_id", plugins.generate_with(plugins.first_sentence, F.col("text")).alias("answer"), F.size(plugins.embed_with(plugins.hashing, F.col("text"))).alias("size"))
