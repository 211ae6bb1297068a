"""Substring deduplication over a log-structured fingerprint index.

A window is 13 consecutive words of one document. The index holds the hashes of all windows of earlier
documents (64 bits to sort by, and 32 bits of another hash that every hit must match) as sorted
immutable runs. Documents come in batches in the
order of doc_id. Each batch's window hashes are dealt by bucket, sorted, and merge-joined with the
bucket's piece of every run; a window that history holds, or a smaller doc_id of the batch, is a hit. Hashes that
are new become the batch's run, and runs of equal age are compacted into one as it is written, so a
batch meets about log2 of the number of batches.

A batch's hashes go through one shuffle as packed arrays, a row for each bucket and megabyte of text, to
where the bucketed table of runs has its buckets; the history itself is not shuffled. The hash space is
worked off in slices, so files of one slice only take room at a time. Buckets are even, as they are dealt
by hash; a window that many documents share is some bytes for each in one bucket.

Defined results: a null text has no words; a very long text's windows are taken whole, as any other's; documents with a null doc_id have no place in the order, so
nothing is removed from them and they are no history; rows that repeat a doc_id are one document for the
order, and each returns a row; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import SPACED, Words, as_bytes, discard, mix, new_path, pieces, release, run_hashes, shuffle_width, small_batches

WINDOW = 13
BATCHES = 4
SLICES = 3
#: Documents whose hits travel together (dealt by a hash of doc_id): hits are a row for each bucket and group.
GROUP_DOCUMENTS = 1024
_MERGE = pa.schema([("kind", pa.int32()), ("key", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


# ---------------------------------------------------------------------------------------------
# Runs: sorted 64-bit hashes as gaps, and a second hash of each


def pack(one: np.ndarray, two: np.ndarray) -> tuple[bytes, bytes]:
    """Gaps take five bytes where all fit, else eight; the first byte says which."""
    gaps = np.diff(one, prepend=np.uint64(0))
    if len(gaps) and int(gaps.max()) >> 40:
        return b"8" + gaps.tobytes(), two.tobytes()
    return b"5" + np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), two.tobytes()


def unpack(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    if a[:1] == b"8":
        gaps = np.frombuffer(a, np.uint64, offset=1)
    else:
        wide = np.zeros((len(a) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(a, np.uint8, offset=1).reshape(-1, 5)
        gaps = wide.view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.frombuffer(b, np.uint32)


def held_by(run: tuple[np.ndarray, np.ndarray], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs of hashes a sorted run holds; a hit counts only if the second hash agrees."""
    ones, twos = run
    low = np.searchsorted(ones, one, "left")
    inside = low < len(ones)
    out = np.zeros(len(one), bool)
    at = np.flatnonzero(inside)
    at = at[ones[low[at]] == one[at]]
    step = low[at]
    while len(at):
        out[at] |= twos[step] == two[at]
        step = step + 1
        more = ~out[at] & (step < len(ones))
        at, step = at[more], step[more]
        same = ones[step] == one[at]
        at, step = at[same], step[same]
    return out


# ---------------------------------------------------------------------------------------------
# Executors' work


def _windows(window: int, slices: int, piece: int, buckets: int):
    """bucket, and packed arrays: doc_id, place, first hash, second hash of each window in the slice."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, texts in pieces(x or b"" for x in as_bytes(batch.column(1))):
                found = Words(texts, SPACED, lower=False)
                one = run_hashes(found.hashes(0), window)
                at = np.flatnonzero((found.room()[: len(one)] >= window) & (one % np.uint64(slices) == np.uint64(piece)))
                if not len(at):
                    continue
                two = (run_hashes(found.hashes(1), window)[at] >> np.uint64(32)).astype(np.uint32)
                one, owner = one[at], found.document_of()[at]
                bucket = (one // np.uint64(slices) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                place = (at - found.first[owner]).astype(np.uint32)
                columns = [ids[first + owner][order], place[order], one[order], two[order]]
                rows = [[], [], [], []]
                for low, high in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                    for out, values in zip(rows, columns, strict=True):
                        out.append(values[low:high].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order][cuts]), *(pa.array(x, pa.binary()) for x in rows)], ["bucket", "ids", "places", "a", "b"])

    return cut


def _merge(groups: int, folded: int, keep: bool):
    """One bucket of a batch beside the bucket's piece of every run. Gives hits (kind 1, key group of doc_id: ids, places) and, if the batch is to be kept, its run (kind 0, key bucket).

    Runs with a number of at least ``folded`` go into the new one.
    """

    def merge(batch: pa.Table, history: pa.Table) -> pa.Table:
        kinds, keys, a, b = [], [], [], []
        runs = [(row["run"], unpack(row["a"], row["b"])) for row in history.to_pylist()]
        fold = [run for number, run in runs if number >= folded]
        bucket = (batch if batch.num_rows else history).column("bucket" if batch.num_rows else "key")[0].as_py()
        if batch.num_rows:
            ids, places, one, two = (np.concatenate([np.frombuffer(x, kind) for x in batch.column(c).to_pylist()]) for c, kind in (("ids", np.int64), ("places", np.uint32), ("a", np.uint64), ("b", np.uint32)))
            order = np.lexsort((ids, two, one))
            ids, places, one, two = ids[order], places[order], one[order], two[order]
            head = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
            starts = np.flatnonzero(head)
            known = np.zeros(len(starts), bool)
            for _, run in runs:
                known |= held_by(run, one[starts], two[starts])
            group = np.cumsum(head) - 1
            hit = np.flatnonzero(known[group] | (ids > ids[starts][group]))  # the smallest doc_id stands first
            fold.append((one[starts][~known], two[starts][~known]))
            dealt = (mix(ids[hit].view(np.uint64)) % np.uint64(groups)).astype(np.int32)
            order = np.argsort(dealt, kind="stable")
            hit, dealt = hit[order], dealt[order]
            cuts = np.flatnonzero(np.diff(dealt, prepend=-1))
            for low, high in zip(cuts, np.append(cuts[1:], len(hit)), strict=True):
                kinds.append(1)
                keys.append(int(dealt[low]))
                a.append(ids[hit[low:high]].tobytes())
                b.append(places[hit[low:high]].tobytes())
        if keep and fold and sum(len(one) for one, _ in fold):
            one, two = (np.concatenate([x[k] for x in fold]) for k in (0, 1))
            order = np.lexsort((two, one))
            first, second = pack(one[order], two[order])
            kinds.append(0)
            keys.append(bucket)
            a.append(first)
            b.append(second)
        return pa.Table.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=_MERGE)

    return merge


def _apply(window: int):
    """Rows sorted by group and kind: hits (kind 0), then documents (kind 1). Gives doc_id, n_words, n_removed, kept_text."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, places, ready = None, [], [], None
        for batch in small_batches(batches):
            names, counts, removed, kept = [], [], [], []
            for group, kind, doc_id, text, a, b in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), as_bytes(batch.column(3)), *(batch.column(k).to_pylist() for k in (4, 5)), strict=True):
                if group != now:
                    now, ids, places, ready = group, [], [], None
                if kind == 0:
                    ids.append(np.frombuffer(a, np.int64))
                    places.append(np.frombuffer(b, np.uint32))
                    continue
                if ready is None:
                    one, two = np.concatenate([np.zeros(0, np.int64), *ids]), np.concatenate([np.zeros(0, np.uint32), *places])
                    order = np.argsort(one, kind="stable")
                    ready = one[order], two[order]
                    ids, places = [], []
                words = (text or b"").split()  # bytes.split() cuts at the six ASCII spaces
                low, high = (np.searchsorted(ready[0], doc_id, side) for side in ("left", "right")) if doc_id is not None else (0, 0)
                names.append(doc_id)
                counts.append(len(words))
                if low == high:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                marks = np.zeros(len(words) + 1, np.int64)
                at = np.unique(ready[1][low:high]).astype(np.int64)
                at = at[at + window <= len(words)]
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                stay = np.cumsum(marks[:-1]) == 0
                removed.append(int((~stay).sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(stay)]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return cover


# ---------------------------------------------------------------------------------------------
# The index


_ROWS = "key int, a binary, b binary"


class Index:
    """Runs of one slice of the hash space, oldest first: (number, batches it stands for).

    The runs are partitions of one table that is bucketed by hash bucket in the shared folder, so a batch
    is dealt to where the runs lie: history is read in place and never shuffled again, except for runs
    that are compacted. ``manifest()`` and ``Index(spark, **manifest)`` carry an index to another session.
    """

    def __init__(self, spark: SparkSession, piece: int = 0, slices: int = 1, buckets: int | None = None, window: int = WINDOW, runs: list[tuple[int, int]] | None = None, path: str | None = None) -> None:
        self.spark, self.piece, self.slices, self.window = spark, piece, slices, window
        self.buckets = buckets or max(16, shuffle_width(spark))
        self.runs = [tuple(x) for x in runs or []]
        self.path, self.name = path or new_path(spark, "index"), f"window_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} (key INT, a BINARY, b BINARY, run INT) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (run) CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if self.runs:
            spark.catalog.recoverPartitions(self.name)

    def manifest(self) -> dict:
        return {"piece": self.piece, "slices": self.slices, "buckets": self.buckets, "window": self.window, "runs": self.runs, "path": self.path}

    def history(self) -> DataFrame:
        """key (the bucket), run, a, b of all live runs."""
        return self.spark.table(self.name).where(F.col("run").isin([number for number, _ in self.runs])).select("key", "run", "a", "b")

    def add(self, documents: DataFrame, groups: int, keep: bool = True) -> DataFrame:
        """Merge-join a batch, all of whose doc_ids are larger than those before; hits as (key, a, b): group, doc_ids, places. Without ``keep``, the index stays as it was."""
        named = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        batch = named.mapInArrow(_windows(self.window, self.slices, self.piece, self.buckets), "bucket int, ids binary, places binary, a binary, b binary")
        age, folded = 1, len(self.runs)
        while folded and self.runs[folded - 1][1] <= age:
            folded -= 1
            age += self.runs[folded][1]
        old = self.runs[folded:]
        least = old[0][0] if old else 1 << 30
        met = batch.groupBy("bucket").cogroup(self.history().groupBy("key")).applyInArrow(_merge(groups, least, keep), "kind int, key int, a binary, b binary")
        path = new_path(self.spark, "merged")
        met.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        if keep and self._exists(f"{path}/kind=0"):
            self._append(f"{path}/kind=0", old, folded, age)
        return self.spark.read.schema(_ROWS).parquet(f"{path}/kind=1") if self._exists(f"{path}/kind=1") else self.spark.createDataFrame([], _ROWS)

    def _append(self, path: str, old: list[tuple[int, int]], folded: int, age: int) -> None:
        """The new run joins the table as a whole partition; those it has taken in go."""
        number = 1 + max((n for n, _ in self.runs), default=0)
        rows = self.spark.read.schema(_ROWS).parquet(path).repartition(self.buckets, "key").withColumn("run", F.lit(number))
        rows.write.mode("append").format("parquet").partitionBy("run").bucketBy(self.buckets, "key").option("path", self.path).option("compression", "zstd").saveAsTable(self.name)
        self.runs = [*self.runs[:folded], (number, age)]
        for gone, _ in old:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (run = {gone})")
        discard(self.spark, path, *(f"{self.path}/run={n}" for n, _ in old))

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def close(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def drop(self) -> None:
        self.close()
        discard(self.spark, self.path)


def batches_of(documents: DataFrame, batches: int) -> list[DataFrame]:
    """Consecutive ranges of doc_id with about as many rows each."""
    cuts = documents.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted({int(x) for x in cuts}), None]
    out = []
    for low, high in zip(edges, edges[1:], strict=False):
        part = documents.where("doc_id is not null")
        part = part if low is None else part.where(F.col("doc_id") > low)
        out.append(part if high is None else part.where(F.col("doc_id") <= high))
    return out


def apply_hits(documents: DataFrame, hits: DataFrame, groups: int, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    # the same deal as in _merge: mix() of the doc_id
    none = F.lit(None).cast("binary")
    ids = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).fill_null(0).to_numpy()
            group = (mix(values.view(np.uint64)) % np.uint64(groups)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["key", "doc_id", "text"])

    rows = ids.mapInArrow(dealt, "key int, doc_id long, text string").select("key", F.lit(1).alias("kind"), "doc_id", "text", none.alias("a"), none.alias("b"))
    found = hits.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "a", "b")
    out = found.unionByName(rows).repartition("key").sortWithinPartitions("key", "kind").mapInArrow(_apply(window), "doc_id long, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))


def deduplicate(documents: DataFrame, window: int = WINDOW, batches: int = BATCHES, slices: int = SLICES) -> DataFrame:
    """Remove every word that a window covers which also starts in a document with a smaller doc_id.

    One row per document: doc_id, n_words, n_removed, kept_text.
    """
    spark = documents.sparkSession
    groups = max(8, documents.count() // GROUP_DOCUMENTS)
    parts = batches_of(documents, batches)
    hits = spark.createDataFrame([], _ROWS)
    for piece in range(slices):
        index = Index(spark, piece, slices, window=window)
        for part in parts:
            # nothing is merge-joined with the last batch, and the index of a single pass goes
            hits = hits.unionByName(index.add(part, groups, keep=part is not parts[-1]))
            release(spark)
        index.drop()
    return apply_hits(documents, hits, groups, window)


