"""Tables by path, through Spark's own file systems: local folders and remote stores alike."""

from __future__ import annotations

import logging
import posixpath

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _hadoop(spark, path)
    return system.exists(at)


def table_path(folder: str, name: str) -> str:
    return posixpath.join(str(folder), f"{name}.parquet")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Raises FileNotFoundError for a table that is not there."""
    path = table_path(folder, name)
    if not exists(spark, path):
        raise FileNotFoundError(f"table not found: {path}")
    return spark.read.parquet(path)


def read_if_present(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """None, with a warning, for a table that is not there."""
    path = table_path(folder, name)
    if not exists(spark, path):
        logger.warning("%s not found; skipping", path)
        return None
    return spark.read.parquet(path)


def write_table(df: DataFrame, folder: str, name: str, codec: str = "zstd") -> str:
    path = table_path(folder, name)
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return path


def write_report(df: DataFrame, folder: str, name: str) -> None:
    """A report (a table of a few rows) as Parquet, and as one CSV file beside it."""
    write_table(df, folder, name)
    spark = df.sparkSession
    folder_path = posixpath.join(str(folder), f".{name}.csv")
    spark.read.parquet(table_path(folder, name)).coalesce(1).write.mode("overwrite").option("header", True).csv(folder_path)
    at, system = _hadoop(spark, folder_path)
    final, _ = _hadoop(spark, posixpath.join(str(folder), f"{name}.csv"))
    part = next(f.getPath() for f in system.listStatus(at) if f.getPath().getName().startswith("part-"))
    system.delete(final, True)
    system.rename(part, final)
    system.delete(at, True)
    side = final.getParent().suffix(f"/.{final.getName()}.crc")
    system.delete(side, False)


def write_bytes(spark: SparkSession, data: bytes, path: str) -> None:
    at, system = _hadoop(spark, path)
    out = system.create(at, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, text: str, path: str) -> None:
    write_bytes(spark, text.encode(), path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file (a config, metrics)."""
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(str(path)).collect())
