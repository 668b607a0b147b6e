"""Arrow-batched functions that are made when they are used, so that their modules import without a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import pandas_udf

#: Rows of an Arrow batch at most, where the session keeps Spark's default of 10,000: texts are long.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession | None) -> None:
    """Ask the session for Arrow batches of few rows, unless it has a number of its own."""
    if spark is not None and spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def vectorized(kind: str) -> Callable[[Callable], Callable[..., Column]]:
    """A function of pandas Series as a function of Columns, of the given result type."""

    def wrap(f: Callable) -> Callable[..., Column]:
        @wraps(f)
        def call(*columns: Column) -> Column:
            bound_batches(SparkSession.getActiveSession())
            return pandas_udf(f, kind)(*columns)

        return call

    return wrap
