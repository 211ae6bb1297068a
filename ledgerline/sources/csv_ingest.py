"""CSV files of a folder tree to typed Parquet tables.

Types come from the whole file: a column is long, double or string. Spark infers more kinds, so dates,
timestamps and booleans are read again as strings, and integers are widened. Text that is not UTF-8 is
read as Latin-1: Spark puts U+FFFD where it can't decode, so the raw bytes are looked at. A file that
fails does not stop the others.
"""

from __future__ import annotations

import logging
import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import _hadoop

logger = logging.getLogger(__name__)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def human_size(n: float) -> str:
    """Bytes in steps of 1024, gigabytes at most."""
    for unit in ("B", "KB", "MB"):
        if n < 1024:
            return f"{n:.2f} {unit}"
        n /= 1024
    return f"{n:.2f} GB"


def discover(spark: SparkSession, folder: str) -> list[str]:
    """All CSV files below the folder, in order. Raises FileNotFoundError without the folder."""
    at, system = _hadoop(spark, folder)
    if not system.exists(at):
        raise FileNotFoundError(f"input folder not found: {folder}")
    found, files = [], system.listFiles(at, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        if path.lower().endswith(".csv"):
            found.append(path)
    return sorted(found)


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line is valid UTF-8 (checked by the executors)."""
    lines = spark.read.text(path)
    return lines.where(~F.is_valid_utf8("value")).isEmpty()


def contract_type(kind: T.DataType) -> T.DataType:
    """Of an inferred type: long, double or string."""
    if isinstance(kind, _WHOLE):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, _REAL) else T.StringType()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A typed frame. With a schema (a contract), nothing is inferred."""
    encoding = "UTF-8"
    if not is_utf8(spark, path):
        logger.warning("Encoding issue in %s; reading it as Latin-1", path)
        encoding = "ISO-8859-1"
    reader = spark.read.option("header", True).option("encoding", encoding)
    if schema is None:
        found = reader.option("inferSchema", True).csv(path).schema
        if not found.fields:
            raise ValueError(f"no columns in {path}")
        schema = T.StructType([T.StructField(f.name, contract_type(f.dataType), True) for f in found])
    return reader.schema(schema).csv(path)


@dataclass
class CsvToParquet:
    """Converts every CSV file below ``source``; folders below it are mirrored below ``target``."""

    spark: SparkSession
    source: str
    target: str
    codec: str = "zstd"

    def convert_all(self) -> list[str]:
        paths, done = discover(self.spark, self.source), []
        if not paths:
            logger.warning("no CSV files in %s", self.source)
        base = _hadoop(self.spark, self.source)[0]
        root = base.getFileSystem(self.spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/")
        for path in paths:
            relative = posixpath.relpath(path.split(":", 1)[-1], root.split(":", 1)[-1])
            out = posixpath.join(str(self.target), posixpath.splitext(relative)[0] + ".parquet")
            try:
                read_csv(self.spark, path).write.mode("overwrite").option("compression", self.codec).parquet(out)
            except Exception as why:  # one bad file must not stop the batch
                logger.error("skipping %s: %s", path, str(why).splitlines()[0] if str(why) else type(why).__name__)
                continue
            self._log(path, out)
            done.append(out)
        return done

    def _log(self, path: str, out: str) -> None:
        (a, system), (b, _) = _hadoop(self.spark, path), _hadoop(self.spark, out)
        before, after = system.getContentSummary(a).getLength(), system.getContentSummary(b).getLength()
        logger.info("%s: %s to %s (%.1fx)", path, human_size(before), human_size(after), before / max(1, after))
