"""The session that the engine's plans expect: UTC, adaptive execution, Arrow, no driver-side result limits."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "spanloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=CONF | conf)
    return (builder.master(master) if master else builder).getOrCreate()
