"""What the operators of this subpackage share: tables in the shared folder, token hashes, components.

Intermediate results are written as Parquet under the folder that the session names in
``spark.checkpoint.dir``; every executor can read them again, so a lost executor costs a retry only.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no checkpoint folder, as in tests on one machine.
LOCAL_FOLDER = "file:///tmp/checkpoints/ledgerline"
#: Rows of a file that a table of known length has at least.
FILE_ROWS = 4096


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so their Python workers can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_ledgerline_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp()  # on the driver, which serves the file as long as the session lasts
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(name)
    context._ledgerline_shipped = True


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or LOCAL_FOLDER).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def gathered(df: DataFrame, rows: int, work: bool = False) -> DataFrame:
    """For about so many rows: no more tasks than files of ``FILE_ROWS`` rows take. All rows stay, and tables that would need over half of the shuffle's width keep it.

    ``work``: the rows cost more than their number tells, so all tasks make them, and another shuffle gathers them.
    """
    files = max(1, -(-rows // FILE_ROWS))
    if 2 * files > max(2, shuffle_width(df.sparkSession)):  # else some tasks would do twice what others do
        return df
    return df.repartition(files) if work else df.coalesce(files)


def written(df: DataFrame, name: str, path: str | None = None, rows: int | None = None, work: bool = False) -> DataFrame:
    """Cut the lineage: write the rows into the shared folder and read them again.

    ``rows`` (and ``work``, see ``gathered``): about how many there are, if that is known. Short tables then get few files, whatever the shuffle's width;
    for each file, Hadoop's local file system starts two processes (``chmod``) from within the executor.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df = df if rows is None else gathered(df, rows, work)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Remove written tables that no later plan reads, and let Spark drop the shuffle files behind them."""
    jvm = spark._jvm
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def release(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM collects the plans that made them."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches (views of the large ones), so that Python holds the objects of few rows at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def pieces(items: Iterable[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive items with about ``limit`` bytes in all (a longer one alone), and the first one's place."""
    held, size, first = [], 0, 0
    for place, item in enumerate(items):
        if held and size + len(item) > limit:
            yield first, held
            held, size, first = [], 0, place
        held.append(item)
        size += len(item)
    if held:
        yield first, held


# ---------------------------------------------------------------------------------------------
# Hashes of byte spans, for whole buffers at once

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of an odd base and of its inverse modulo 2^64, up to the exponent n."""
    if which not in _POWERS or len(_POWERS[which][0]) <= n:
        base, size = _BASES[which], max(1 << 20, n + 1)
        out = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        if size > 1 << 22:
            return out[0], out[1]
        _POWERS[which] = (out[0], out[1])
    return _POWERS[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """One 64-bit hash for each byte span, of its content and length alone. Spans are in order and apart."""
    if len(data) > 1 << 21 and len(starts) > 1:  # in slices, for the sake of memory
        out, low = np.empty(len(starts), np.uint64), 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + (1 << 20))))
            at = starts[low]
            out[low:high] = span_hashes(data[at : ends[high - 1]], starts[low:high] - at, ends[low:high] - at, which)
            low = high
        return out
    power, inverse = powers(which, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_class(inside: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return table


#: Words between ASCII white space.
SPACED = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Words of ASCII letters, digits and everything beyond ASCII (upper case is lowered before).
ALPHANUMERIC = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


class Words:
    """The words of several documents, found and hashed together.

    ``first[d]:first[d + 1]`` are the words of document d; ``starts`` and ``ends`` are places in ``data``.
    """

    def __init__(self, documents: list[bytes], inside: np.ndarray, lower: bool) -> None:
        joined = b" ".join(documents)
        if lower:
            joined = joined.lower()  # of bytes: A-Z only
        self.joined, self.data = joined, np.frombuffer(joined, np.uint8)
        flags = np.zeros(len(joined) + 2, np.int8)
        flags[1:-1] = inside[self.data]
        edges = np.diff(flags)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        begins = np.cumsum([0] + [len(x) + 1 for x in documents])
        self.first = np.searchsorted(self.starts, begins)
        self.offsets = begins

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, which)

    def document_of(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """How many words of the same document begin at each word, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes (len(words) - n + 1 of them)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    power = powers(1, n)[0]
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += words[k : k + count] * power[k]
    return mix(total + np.uint64(n))


# ---------------------------------------------------------------------------------------------
# Connected components


class Forest:
    """Union-find over any hashable nodes; the root is the smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self.parent[high] = low
            self.parent.setdefault(low, low)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = [x for x in self.parent if self.root(x) != x]
        return nodes, [self.root(x) for x in nodes]


EDGE = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) > 200_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest.edges()], schema=EDGE)
            forest = Forest()
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest.edges()], schema=EDGE)


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: each node's neighbours (larger ones, or itself and smaller ones) meet at its smallest neighbour.

    Grouping takes the minimum before the shuffle, and the join back is one that Spark splits where a node is hot.
    """
    both = edges.select("src", "dst")
    if large:
        both = both.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    if large:
        least = least.select("src", F.least("src", "least").alias("least"))
        out = both.join(least, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    else:
        moved = both.join(least, "src").where("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
        out = moved.unionByName(least.select("src", F.col("least").alias("dst")))
    return out.where("src <> dst").distinct()


def _joined_at_once(now: DataFrame) -> DataFrame:
    after = written(now.coalesce(1).mapInArrow(_spanning, "src long, dst long"), "edges")
    discard(now.sparkSession, now)
    return after


def _settled(now: DataFrame, mark: Row, digest: Callable[[DataFrame], Row], rounds: int) -> DataFrame:
    for _ in range(rounds):
        after = written(_starred(_starred(now, True), False), "edges")
        stop = (new := digest(after)) == mark
        discard(now.sparkSession, now)
        now, mark = after, new
        if stop:
            return now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def components(edges: DataFrame, rounds: int = 60, few: int = 0) -> DataFrame:
    """(node, component) of all nodes with an edge; component is the smallest node that can be reached.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until nothing moves; each round is
    written to the shared folder. Nodes and edges stay distributed. Raises if ``rounds`` are not enough.
    Where forests leave at most ``few`` edges (100,000 at most), one task joins them all, without those steps.
    """
    if few > 100_000:
        raise ValueError("one task joins at most 100,000 edges")
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("src", "dst").cast("long").alias("src"), F.least("src", "dst").cast("long").alias("dst")).where("src <> dst")
    now = written(ordered.mapInArrow(_spanning, "src long, dst long"), "edges")
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    mark = digest(now)
    if mark[0] == 0:
        return now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    if mark[0] <= few:
        now = _joined_at_once(now)
    else:
        now = _settled(now, mark, digest, rounds)
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
