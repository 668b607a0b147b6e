"""Incremental ingest with Structured Streaming (R*): keyed, idempotent, resumable, with late data bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.sources.readers import _fs
from spanloom.storage import shared_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files: int = 100, age: str = "36500d") -> DataFrame:
    """New Parquet files of a folder, so many a batch, however old they are.

    age: files that are so much older than the newest one are not read; the default leaves none out.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("maxFileAge", age).parquet(path)


def unseen(stream: DataFrame, key: str, at: str, late: str = "30 days") -> DataFrame:
    """The first row of each key; a key is remembered until the watermark has passed its time.

    A row later than the watermark is dropped. The state so stays bounded by the keys of the window.
    """
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, at: str, keys: list[str], value: str, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums of tumbling windows; a window is final when the watermark passes it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of a key that end after a gap."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), "n")


def drain(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Everything that is there now, as Parquet; each batch writes its own folder, so a retry overwrites it."""

    def write(batch: DataFrame, number: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def appended(stream: DataFrame, path: str, checkpoint: str) -> None:
    """All rows that are final now, appended by the file sink, which commits each batch once."""
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()


def reuse(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What has no result under its content hash yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def remembered(decisions: DataFrame, memo: DataFrame, key: str, value: str) -> DataFrame:
    """Earlier decisions reused under their memo key."""
    old = memo.select(key, F.col(value).alias("__old"))
    return decisions.join(old, key, "left").withColumn(value, F.coalesce("__old", value)).drop("__old")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for a stream's output and checkpoint."""
    import uuid

    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    return path
