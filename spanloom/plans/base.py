"""Registration of queries with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir) under a name, with DuckDB SQL for its rows where SQL can express them."""

    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame | list[DataFrame]:
    out = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return out[0] if len(out) == 1 else out
