"""Tables that cut lineage: written once to the shared folder the cluster names, then read back.

A plan that is used several times, or that grows with every round of an iteration, is written as Parquet
below ``spark.checkpoint.dir``. Files in a shared folder survive a lost executor, unlike a cached block.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where a local session names none (tests), a fresh local one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spanloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`materialize` that no plan will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._spanloom_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
