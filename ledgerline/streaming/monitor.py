"""Beyond the batch pipeline: CSV drops as they arrive, and PSI of each micro-batch against a baseline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.stability import Cohorts, psi_report


def ingest_drops(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str) -> StreamingQuery:
    """Appends all CSV files that have come since the last run, then stops; the schema is a contract's."""
    drops = spark.readStream.schema(schema).option("header", True).csv(folder)
    return drops.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def monitor(stream: DataFrame, baseline: DataFrame, features: list[str], sink: Callable[[DataFrame, int], None], checkpoint: str, bins: int = 10) -> StreamingQuery:
    """Calls ``sink`` with the PSI report of each micro-batch and its number."""

    def assess(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                sink(psi_report(f"batch_{number}", Cohorts.of(baseline, batch, features), features, bins), number)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(assess).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_payments_by_window(stream: DataFrame, time: str, value: str, key: str, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts and sums by event-time window and key; state is dropped once the watermark has passed."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")
