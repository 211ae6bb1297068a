"""SQL over Parquet: in memory, or with tables that stay in a warehouse folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import get_session


class Engine:
    """``query`` runs SQL. With a path, ``save`` keeps tables there; without one, views last as long as the session."""

    def __init__(self, path: str | None = ":memory:", spark: SparkSession | None = None) -> None:
        self.spark, self.path = spark or get_session(), None if path == ":memory:" else path or "data/warehouse"

    def query(self, sql: str, **views: DataFrame) -> DataFrame:
        """``views`` are frames that the SQL names."""
        return self.spark.sql(sql, **views) if views else self.spark.sql(sql)

    def register(self, name: str, path: str) -> None:
        self.spark.read.parquet(path).createOrReplaceTempView(name)

    def save(self, name: str, df: DataFrame) -> None:
        if self.path is None:
            df.createOrReplaceTempView(name)
        else:
            df.write.mode("overwrite").parquet(f"{self.path}/{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name) if self.path is None else self.spark.read.parquet(f"{self.path}/{name}")

    def close(self) -> None:
        self.spark = None

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *why) -> None:
        self.close()
