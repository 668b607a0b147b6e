"""Streams drained to the end (R*), and sources and sinks round-tripped (S*, K*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators import resolve
from spanloom.operators.ranks import placed
from spanloom.plans import scoring
from spanloom.plans.base import query, read
from spanloom.sources import readers, writers
from spanloom.storage import materialize
from spanloom.streaming import ingest, progress

Spark = SparkSession


def _drained(spark: Spark, stream: DataFrame, label: str) -> DataFrame:
    folder = ingest.work_dir(spark, label)
    ingest.drain(stream, f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").drop("batch")


def _stream(spark: Spark, sf: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return ingest.file_stream(spark, f"{sf}/{name}.parquet*", schema)


@query("incremental_ingest", "SELECT DISTINCT user_id, event_type FROM events")
def incremental_ingest(spark: Spark, sf: str) -> DataFrame:
    """Events as files that arrive; keys seen before are skipped."""
    keyed = _stream(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"))
    return _drained(spark, ingest.unseen(keyed, "key", "ts", "36500 days"), "ingest").select("user_id", "event_type")


@query("windowed_events", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_events(spark: Spark, sf: str) -> DataFrame:
    """Tumbling windows of a stream, drained; totals rounded to four places."""
    stream = _stream(spark, sf, "events")
    grouped = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
    folder = ingest.work_dir(spark, "windows")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")  # complete mode: the last batch holds everything

    grouped.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("reused_results", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0")
def reused_results(spark: Spark, sf: str) -> DataFrame:
    """Papers whose content has no result yet."""
    orders = read(spark, sf, "orders").withColumn("content", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"), 256))
    done = orders.where("o_orderkey % 3 = 0").select("o_orderkey", "content")
    return ingest.reuse(orders.select("o_orderkey", "content"), done, ["o_orderkey", "content"]).select("o_orderkey")


@query("json_round_trip", "SELECT n_nationkey, n_name, n_nationkey % 2 = 0 AS even FROM nation")
def json_round_trip(spark: Spark, sf: str) -> DataFrame:
    """JSON lines written in parts of exact sizes and read under a schema."""
    folder = ingest.work_dir(spark, "json")
    rows = read(spark, sf, "nation").select("n_nationkey", "n_name", (F.col("n_nationkey") % 2 == 0).alias("even"))
    writers.write_parts(rows, f"{folder}/parts", ["n_nationkey"], 4)
    back = readers.json_lines(spark, f"{folder}/parts", rows.schema, damaged="keep")
    return back.where("_corrupt_record is null").select("n_nationkey", "n_name", "even")


@query("exact_parts", "SELECT CAST(i AS INT) AS part, (SELECT count(*) FROM orders) // 7 + CASE WHEN i < (SELECT count(*) FROM orders) % 7 THEN 1 ELSE 0 END AS n FROM range(7) t(i)")
def exact_parts(spark: Spark, sf: str) -> DataFrame:
    """Seven parts whose sizes differ by one at most."""
    return writers.exact_parts(read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 7).groupBy("part").agg(F.count("*").alias("n"))


@query("csv_round_trip", "SELECT r_regionkey, r_name, CASE WHEN r_regionkey > 2 THEN 'TRUE' ELSE 'FALSE' END AS large, '[\"a\",\"b, c\"]' AS tags FROM region")
def csv_round_trip(spark: Spark, sf: str) -> DataFrame:
    """Booleans and lists in CSV, with commas inside."""
    folder = ingest.work_dir(spark, "csv")
    rows = read(spark, sf, "region").select("r_regionkey", "r_name", (F.col("r_regionkey") > 2).alias("large"), F.array(F.lit("a"), F.lit("b, c")).alias("tags"))
    writers.write_csv(rows, f"{folder}/csv")
    return readers.csv_table(spark, f"{folder}/csv", T.StructType.fromDDL("r_regionkey int, r_name string, large string, tags string"))


@query("published_run", "SELECT c_custkey, c_mktsegment FROM customer")
def published_run(spark: Spark, sf: str) -> DataFrame:
    """A run published behind a pointer, found through it; its manifest has the hash that the pointer names."""
    folder = ingest.work_dir(spark, "runs")
    writers.publish({"customers": read(spark, sf, "customer").select("c_custkey", "c_mktsegment")}, folder, "r1")
    return spark.read.parquet(f"{readers.latest(spark, folder)}/customers")


@query("typed_defaults", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(event_id AS INT) END AS n, round(value, 3) AS v FROM events")
def typed_defaults(spark: Spark, sf: str) -> DataFrame:
    """K3 K4: what is no number becomes the default."""
    raw = read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("event_id").cast("string")).alias("n"), "value")
    return writers.typed(raw, {"n": "int"}, {"n": 0}).select("event_id", "n", F.round("value", 3).alias("v"))


@query("split_folders", "SELECT lang AS split, count(*) AS n FROM documents GROUP BY lang")
def split_folders(spark: Spark, sf: str) -> DataFrame:
    """A folder a split, read back with the split as a partition."""
    folder = ingest.work_dir(spark, "splits")
    writers.write_splits(read(spark, sf, "documents").select("doc_id", F.col("lang").alias("split")), f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").groupBy("split").agg(F.count("*").alias("n"))


@query("master_order", "SELECT o_orderkey, o_orderdate, CAST(row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS BIGINT) AS place FROM orders")
def master_order(spark: Spark, sf: str) -> DataFrame:
    """All parts merged, the newest first, with each row's place."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    halves = [orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")]
    return placed(writers.merged(halves), [], [F.desc_nulls_last("o_orderdate"), F.col("o_orderkey")])


@query("source_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT' AND o_totalprice BETWEEN 1000 AND 200000")
def source_filter(spark: Spark, sf: str) -> DataFrame:
    """Filters and the column list reach the scan."""
    orders = readers.table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    return readers.filtered(orders, o_orderstatus=["F", "O"], o_orderpriority="1-URGENT", o_totalprice=(1000, 200000)).select("o_orderkey")


@query("alias_dictionary", "SELECT n_name AS alias, lower(n_name) AS norm, n_name AS canonical, 'en' AS lang, 'nations' AS source FROM nation UNION SELECT lower(n_name), lower(n_name), n_name, 'en', 'nations' FROM nation")
def alias_dictionary(spark: Spark, sf: str) -> DataFrame:
    """A dictionary in a configuration, one row a nation."""
    names = [r["n_name"] for r in read(spark, sf, "nation").select("n_name").collect()]  # a configuration
    return readers.aliases(spark, [{"canonical": n, "aliases": [n.lower()], "source": "nations"} for n in names])


@query("policy_choices", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL")
def policy_choices(spark: Spark, sf: str) -> DataFrame:
    """A typed policy decides what is read."""
    chosen, _ = readers.policy('{"version": "1", "accept_score": 95, "min_margin": 5, "top_k": 10, "trusted": ["REVIEWED"], "allowed_types": ["1-URGENT", "2-HIGH"]}')
    return readers.filtered(read(spark, sf, "orders"), o_orderpriority=list(chosen.allowed_types)).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


def _files(spark: Spark, rows: DataFrame, label: str) -> str:
    """A folder of text files, one a row of ``value``."""
    folder = f"{ingest.work_dir(spark, label)}/files"
    rows.write.option("maxRecordsPerFile", 1).text(folder)
    return folder


@query("torn_lines", "SELECT count(*) AS rows, CAST(sum(n_nationkey) AS BIGINT) AS keys FROM nation")
def torn_lines(spark: Spark, sf: str) -> DataFrame:
    """JSON lines whose last one was torn; what is whole is read."""
    lines = read(spark, sf, "nation").select(F.to_json(F.struct("n_nationkey", "n_name")).alias("value"))
    torn = lines.unionByName(spark.createDataFrame([('{"n_nationkey": 99, "n_na',)], "value string"))
    folder = f"{ingest.work_dir(spark, 'torn')}/lines"
    torn.coalesce(1).write.text(folder)
    good = readers.json_lines(spark, folder, T.StructType.fromDDL("n_nationkey int, n_name string"), "drop")
    return good.agg(F.count("*").alias("rows"), F.sum("n_nationkey").cast("bigint").alias("keys"))


@query("front_matter_papers", "SELECT item_id, 'Item ' || item_id AS title, CASE WHEN item_id % 2 = 0 THEN '10.1/' || item_id ELSE '' END AS doi, length(text) AS body FROM benchmark")
def front_matter_papers(spark: Spark, sf: str) -> DataFrame:
    """A Markdown file a paper, with a header, read whole."""
    bench = read(spark, sf, "benchmark")
    doi = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("10.1/"), F.col("item_id").cast("string"))).otherwise("")
    page = F.concat(F.lit('---\ntitle: "Item '), F.col("item_id").cast("string"), F.lit('"\ndoi: '), doi, F.lit("\n---\n"), "text")
    found = readers.front_matter(spark, _files(spark, bench.select(page.alias("value")), "papers"), ["title", "doi"])
    body = F.length(F.regexp_replace(F.regexp_replace("text", r"(?s)\A---\n.*?\n---\n", ""), r"\n\z", ""))  # a text file ends its line
    return found.select(F.regexp_extract("title", "[0-9]+", 0).cast("bigint").alias("item_id"), "title", F.coalesce("doi", F.lit("")).alias("doi"), body.cast("bigint").alias("body"))


@query("damaged_records", "SELECT n_nationkey % 5 = 0 AS damaged, count(*) AS files FROM nation GROUP BY ALL")
def damaged_records(spark: Spark, sf: str) -> DataFrame:
    """A JSON file a record; damaged ones are told, not fatal."""
    nation = read(spark, sf, "nation")
    whole = F.to_json(F.struct("n_nationkey", "n_name"))
    rows = nation.select(F.when(F.col("n_nationkey") % 5 == 0, F.left(whole, F.length(whole) - 1)).otherwise(whole).alias("value"))
    return readers.raw_records(spark, _files(spark, rows, "records")).groupBy("damaged").agg(F.count("*").alias("files"))


@query("strict_table", "SELECT c_custkey, c_mktsegment FROM customer")
def strict_table(spark: Spark, sf: str) -> DataFrame:
    """K5: Parquet under just one schema."""
    rows = read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    folder = f"{ingest.work_dir(spark, 'strict')}/table"
    writers.write_strict(rows, folder, rows.schema)
    return spark.read.parquet(folder)


@query("derived_run", "SELECT 'r2' AS run, count(*) AS n FROM nation UNION ALL SELECT 'refused', 1")
def derived_run(spark: Spark, sf: str) -> DataFrame:
    """K7: a derived run advances the pointer only while its source is the latest."""
    folder, nation = ingest.work_dir(spark, "derived"), read(spark, sf, "nation")
    writers.publish({"t": nation}, folder, "r1")
    writers.publish({"t": nation}, folder, "r2", expect="r1")
    try:
        writers.publish({"t": nation.limit(1)}, folder, "r3", expect="r1")
        refused = 0
    except ValueError:
        refused = 1
    run = readers.latest(spark, folder)
    return spark.read.parquet(f"{run}/t").agg(F.lit(run.rsplit("/", 1)[1]).alias("run"), F.count("*").alias("n")).unionByName(spark.createDataFrame([("refused", refused)], "run string, n bigint"))


@query("registry_snapshot", "SELECT 'concepts' AS t, count(*) AS n FROM nation UNION ALL SELECT 'assignments', count(*) FROM customer UNION ALL SELECT unnest(['aliases', 'instances', 'constraints', 'authority_links', 'redirects', 'events']), 0")
def registry_snapshot(spark: Spark, sf: str) -> DataFrame:
    """K8: the eight tables of a registry, published with their manifest."""
    concepts, assignments = scoring._registry(spark, sf)
    empty = lambda name: spark.createDataFrame([], ", ".join(f"{c} string" for c in writers.REGISTRY_TABLES[name]))
    frames = {n: empty(n) for n in writers.REGISTRY_TABLES} | {"concepts": concepts, "assignments": assignments}
    manifest = writers.write_registry(frames, ingest.work_dir(spark, "registry"), "r1")
    return spark.createDataFrame([(n, t["rows"]) for n, t in manifest["tables"].items()], "t string, n bigint")


@query("resolution_run", f"WITH {scoring._DECIDED} SELECT status, count(*) AS n FROM decided WHERE status LIKE 'REVIEW%' GROUP BY status")
def resolution_run(spark: Spark, sf: str) -> DataFrame:
    """K9: the six tables of a resolution run, its summary, and the CSV for review, read back."""
    mentions, targets = scoring._mentions_and_targets(spark, sf)
    decisions = materialize(resolve.resolve(mentions, targets), "decisions")
    near = materialize(resolve.lexical_candidates(mentions, targets), "candidates")
    conflicts = resolve.judged(near.select("mention_id", "target_id"), mentions, targets).select("mention_id", "target_id", F.explode("conflicts").alias("code"))
    frames = {
        "decisions": decisions, "candidates": near, "conflicts": conflicts, "proposals": decisions.where("status = 'PROPOSED'").groupBy("target").agg(F.count("*").alias("mentions")),
        "issues": spark.createDataFrame([], "mention_id bigint, code string"), "assignments": decisions.where("status = 'MATCHED'").select("mention_id", F.col("target").alias("concept")),
    }
    folder = ingest.work_dir(spark, "resolution")
    writers.write_resolution(frames, folder, "r1", "none")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in writers.RUN_TABLES["decisions"]])
    review = readers.csv_table(spark, f"{folder}/runs/r1/review_csv", schema)
    return review.groupBy("status").agg(F.count("*").alias("n"))


@query("failure_log", "SELECT 'too small' AS reason, count(*) AS n FROM orders WHERE o_totalprice < 50000 UNION ALL SELECT 'too large', count(*) FROM orders WHERE o_totalprice > 400000")
def failure_log(spark: Spark, sf: str) -> DataFrame:
    """Rows that fail, with why, appended to a log."""
    folder, orders = f"{ingest.work_dir(spark, 'failures')}/log", read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for reason, failed in (("too small", F.col("o_totalprice") < 50000), ("too large", F.col("o_totalprice") > 400000)):
        writers.append_log(orders.where(failed).withColumn("reason", F.lit(reason)), folder)
    return spark.read.schema("o_orderkey bigint, reason string").json(folder).groupBy("reason").agg(F.count("*").alias("n"))


@query("stage_events", "SELECT count(*) AS rows FROM events")
def stage_events(spark: Spark, sf: str) -> DataFrame:
    """What a running stream tells, as events."""
    folder = ingest.work_dir(spark, "events")
    running = _stream(spark, sf, "events").writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    told = progress.stage_events(running)
    assert progress.event_lines(told).count("data: ") == len(told)
    return spark.createDataFrame([(e["rows"],) for e in told], "rows bigint").agg(F.sum("rows").alias("rows"))
