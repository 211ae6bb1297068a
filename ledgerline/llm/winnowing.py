"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item (a shorter item is one window). Of each window of
L words, the least hash of its k-grams is its fingerprint; as the same is kept for every sliding window
of L words of a document, equal windows have equal fingerprints, so no shared window is missed.
Documents' fingerprints meet the benchmark's, and each hit is extended to its whole window, which must
agree in two independent 64-bit hashes over all its words.

The benchmark's index is broadcast while its size, which is counted first, stays within a bound. Beyond
the bound, fingerprints and then windows are joined by shuffles, with the same results.

Defined results: a null text has no words; a very long text is taken whole; a null item_id is no item; items that repeat an id are one
item with the windows of all; repeated documents each return a row; a null doc_id is carried through; an
empty benchmark hits nothing; an empty table of documents returns no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import ALPHANUMERIC, Words, as_bytes, pieces, run_hashes, small_batches, text_or_empty, written

WINDOW = 10
GRAM = 4
#: The index is broadcast up to this size.
BROADCAST_BYTES = 64 << 20
#: What one window takes in the index.
ROW_BYTES = 64
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def window_hashes(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The hash of the ``length`` words at each place."""
    return run_hashes(words[at[:, None] + np.arange(length)].ravel(), length)[::length] if len(at) else np.zeros(0, np.uint64)


def fingerprints(words: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The least gram hash of each ``length`` consecutive words (one for each window, from the first on)."""
    gram = min(gram, length)
    grams, count = run_hashes(words, gram), len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    least = grams[:count].copy()
    for k in range(1, length - gram + 1):
        np.minimum(least, grams[k : k + count], out=least)
    return least


def windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """size, mark (the fingerprint), one, two (hashes of the whole window), item_id: the distinct windows of all items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for first, texts in pieces(x or b"" for x in as_bytes(batch.column(1))):
                found = Words(texts, ALPHANUMERIC, lower=True)
                one, two = found.hashes(0), found.hashes(1)
                for k in range(len(texts)):
                    low, high = found.first[k], found.first[k + 1]
                    if high == low:
                        continue
                    size = min(window, high - low)
                    at = np.arange(low, high - size + 1)
                    columns = [np.full(len(at), size, np.int32), fingerprints(one[low:high], size, gram), window_hashes(one, at, size), window_hashes(two, at, size)]
                    arrays = [pa.array(columns[0]), *(pa.array(x.view(np.int64)) for x in columns[1:]), pa.array([batch.column(0)[first + k].as_py()] * len(at), batch.column(0).type)]
                    yield pa.RecordBatch.from_arrays(arrays, ["size", "mark", "one", "two", "item_id"])

    named = benchmark.where("item_id is not null").select("item_id", F.col("text").cast("string"))
    kind = named.schema["item_id"].dataType.simpleString()
    return named.mapInArrow(cut, f"size int, mark long, one long, two long, item_id {kind}").distinct()


class Index(NamedTuple):
    """For each window size: sorted fingerprints; windows sorted by hash, and the items of each."""

    marks: dict[int, np.ndarray]
    one: dict[int, np.ndarray]
    two: dict[int, np.ndarray]
    items: dict[int, list[str]]
    gram: int


def index_of(table: pa.Table, gram: int) -> Index:
    out = Index({}, {}, {}, {}, gram)
    sizes = table["size"].to_numpy()
    for size in np.unique(sizes).tolist():
        part = table.filter(pa.array(sizes == size))
        one = part["one"].to_numpy().view(np.uint64)
        order = np.argsort(one, kind="stable")
        names = [str(x) for x in part["item_id"].to_pylist()]
        out.marks[size] = np.unique(part["mark"].to_numpy().view(np.uint64))
        out.one[size], out.two[size] = one[order], part["two"].to_numpy().view(np.uint64)[order]
        out.items[size] = [names[i] for i in order]
    return out


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values if len(of) else np.zeros(len(values), bool)


def candidates(words: np.ndarray, room: np.ndarray, size: int, marks: np.ndarray, gram: int) -> np.ndarray:
    """Places of windows whose fingerprint is in ``marks``."""
    least = fingerprints(words, size, gram)
    if not len(least):
        return np.zeros(0, np.int64)
    turns = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])  # neighbouring windows mostly share theirs
    hit = np.repeat(member(least[turns], marks), np.diff(np.r_[turns, len(least)]))
    return np.flatnonzero(hit & (room[: len(least)] >= size))


def measure(texts: list[bytes], index: Index) -> Iterator[tuple[int, int, list[str]]]:
    """Words, words hit, and the items found, of each text."""
    found = Words(texts, ALPHANUMERIC, lower=True)
    one, room, owner = found.hashes(0), found.room(), found.document_of()
    cover, items, two = np.zeros(len(found) + 1, np.int64), [set() for _ in texts], None
    for size, marks in index.marks.items():
        at = candidates(one, room, size, marks, index.gram)
        if not len(at):
            continue
        two = found.hashes(1) if two is None else two
        first, second = window_hashes(one, at, size), window_hashes(two, at, size)
        low, high = np.searchsorted(index.one[size], first, "left"), np.searchsorted(index.one[size], first, "right")
        for k in np.flatnonzero(high > low):
            same = [j for j in range(low[k], high[k]) if index.two[size][j] == second[k]]
            if same:
                cover[at[k]] += 1
                cover[at[k] + size] -= 1
                items[owner[at[k]]].update(index.items[size][j] for j in same)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    for k in range(len(texts)):
        low, high = found.first[k], found.first[k + 1]
        yield int(high - low), int(hit[high] - hit[low]), sorted(items[k])


def _scan(held, clean_only: bool):
    """Over rows (row struct, text): the result columns beside ``row``, or clean rows alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in small_batches(batches):
            row = batch.column(0)
            got = [x for _, texts in pieces(x or b"" for x in as_bytes(row.field("text"))) for x in measure(texts, index)]
            if clean_only:
                yield batch.filter(pa.array([not hit for _, hit, _ in got], pa.bool_()))
                continue
            digests = [hashlib.sha256(",".join(items).encode()).hexdigest() for *_, items in got]
            numbers = [pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64()), pa.array([len(x[2]) for x in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([row.field("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array([x[1] > 0 for x in got], pa.bool_())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return scan


def _by_shuffle(documents: DataFrame, table: DataFrame, gram: int) -> DataFrame:
    """doc_id, key (of the text) and the result columns, where the benchmark is too large to broadcast."""
    sizes = sorted(x[0] for x in table.select("size").distinct().collect())  # at most ``window`` rows
    keyed = documents.select("doc_id", F.md5(text_or_empty().cast("binary")).alias("key"), text_or_empty().alias("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for first, texts in pieces(as_bytes(batch.column(1))):
                found = Words(texts, ALPHANUMERIC, lower=True)
                one = found.hashes(0)
                for k in range(len(texts)):
                    own, size, mark = one[found.first[k] : found.first[k + 1]], [], []
                    for length in sizes:
                        got = np.unique(fingerprints(own, length, gram))
                        size.append(np.full(len(got), length, np.int32))
                        mark.append(got)
                    size, mark = np.concatenate([np.zeros(0, np.int32), *size]), np.concatenate([np.zeros(0, np.uint64), *mark])
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[first + k].as_py()] * len(size), pa.string()), pa.array(size), pa.array(mark.view(np.int64))], ["key", "size", "mark"])

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for key, text, marks in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                found = Words([text], ALPHANUMERIC, lower=True)
                one, two, room = found.hashes(0), found.hashes(1), found.room()
                for length in {x["size"] for x in marks}:
                    wanted = np.unique(np.array([x["mark"] for x in marks if x["size"] == length], np.int64).view(np.uint64))
                    at = candidates(one, room, length, wanted, gram)
                    hashes = [pa.array(window_hashes(x, at, length).view(np.int64)) for x in (one, two)]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(at), pa.string()), pa.array(np.full(len(at), length, np.int32)), *hashes, pa.array(at)], ["key", "size", "one", "two", "place"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n = [int(c) for _, texts in pieces(as_bytes(batch.column(2))) for c in np.diff(Words(texts, ALPHANUMERIC, lower=True).first)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "key", "n_words"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    texts = keyed.select("key", "text").dropDuplicates(["key"])
    met = texts.select("key", "text").mapInArrow(marked, "key string, size int, mark long").join(table.select("size", "mark").distinct(), ["size", "mark"], "left_semi")
    wanted = met.groupBy("key").agg(F.collect_list(F.struct("size", "mark")).alias("marks"))
    spans = texts.join(wanted, "key").select("key", "text", "marks").mapInArrow(extended, "key string, size int, one long, two long, place long")
    hits = written(spans.join(table.select("size", "one", "two", F.col("item_id").cast("string").alias("item")), ["size", "one", "two"]), "hits")
    names = hits.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    covered = hits.select("key", F.explode(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("word")).distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    counts = keyed.select("doc_id", "key", "text").mapInArrow(counted, f"doc_id {kind}, key string, n_words long")
    out = counts.join(names.join(covered, "key"), "key", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    digest = F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "key", "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _held(benchmark: DataFrame, window: int, gram: int, broadcast_bytes: int):
    """The windows, and their broadcast index where it is small enough (else None)."""
    table = written(windows(benchmark, window, gram), "windows")
    size = table.agg(F.sum(F.octet_length(F.coalesce(F.col("item_id").cast("string"), F.lit(""))) + ROW_BYTES)).first()[0]
    if (size or 0) > broadcast_bytes:
        return table, None
    return table, benchmark.sparkSession.sparkContext.broadcast(index_of(table.toArrow(), gram))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    table, held = _held(benchmark, window, gram, broadcast_bytes)
    if held is None:
        return _by_shuffle(documents, table, gram).drop("key")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(F.struct("doc_id", F.col("text").cast("string").alias("text")).alias("row")).mapInArrow(_scan(held, False), f"doc_id {kind}, {RESULT}")


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents that no window occurs in, all columns unchanged."""
    table, held = _held(benchmark, window, gram, broadcast_bytes)
    if held is None:
        hit = _by_shuffle(documents, table, gram).where("contaminated").select("key").distinct()
        return documents.join(hit, F.md5(text_or_empty().cast("binary")) == hit["key"], "left_anti")
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    return rows.mapInArrow(_scan(held, True), rows.schema).select("row.*")
