"""One place that builds a session, with the settings that large shuffles want."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app: str = "ledgerline", **settings: str) -> SparkSession:
    """The active session, or a new one; ``settings`` win over the defaults here."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
