"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint has 64 bits, by majority vote of the hashes of its 4-word shingles. Two
fingerprints that differ in at most four bits agree, in at least one of three segments, but for one bit:
if all three differed in two or more, six bits would differ. So each fingerprint is indexed under every
segment with one bit left out (a wildcard), 64 keys in all; equal keys meet and are verified.

Copies are no concern: equal fingerprints are one node. Keys met by very many fingerprints are dealt as
pairs of blocks, so that no task holds such a key's rows together. Only a spanning forest of the links
leaves a task, never all pairs.

``similar_groups`` finds near copies in another sense, by the Jaccard similarity of their shingle sets, which at 0.8
differ in some 15 % of the bits. Fingerprints there have as many segments as it takes to find such a pair, and what
they miss is found by shingles that the sets' prefixes share, so that no link is left out.

Defined results: a very long text is hashed block by block; a null or wordless text has the fingerprint zero, linked like any other; a null doc_id
is carried through and is never a component's id unless the component has no other; repeated rows each
return a row; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import SPACED, Forest, Words, as_bytes, components, discard, gathered, mix, pieces, release, run_hashes, small_batches, written

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Lowest and one beyond the highest bit of each segment.
SEGMENTS = ((0, 21), (21, 42), (42, 64))
#: Fingerprints under one key that one task compares; keys with more are dealt as pairs of blocks.
BUCKET_ROWS = 4096
#: For near copies by shingle sets: words of a shingle, Jaccard similarity, the chance at which a pair right at that similarity is found (above it, it rises fast), and what is granted to the second fingerprint.
SIMILAR_SHINGLE, SIMILARITY, FOUND, SIGMAS = 5, 0.8, 0.95, 4
#: Sets that tell which shingles are common, and shingles to know so, so that rare ones come first (no result depends on them).
ORDER_SETS, ORDER_GRAMS = 20_000, 100_000
#: Names (of eight bytes) of the sets to compare that are broadcast at most.
BROADCAST_NODES = 1_000_000
#: Links that one task joins to components, where steps of all tasks would move little.
FEW_EDGES = 100_000
_SPACE = re.compile(rb"[\x09-\x0d\x20]")


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words in order, about ``size`` bytes at a time."""
    low = 0
    while low < len(text):
        cut = _SPACE.search(text, low + size)
        high = cut.start() if cut else len(text)
        yield text[low:high].split()  # at the six ASCII spaces
        low = high


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Of UTF-8 bytes; unsigned. Words are hashed block by block, so a long text needs little memory."""
    hashed, votes, count, held = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []

    def vote(grams: list[int]) -> None:
        octets = np.array(grams, np.uint64).view(np.uint8).reshape(-1, 8)
        votes[:] += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)

    for block in word_blocks(text.lower()):
        words = held + block
        for low in range(0, len(words) - shingle + 1, 1 << 14):
            grams = [hashed(b" ".join(words[i : i + shingle]), seed) for i in range(low, min(len(words) - shingle + 1, low + (1 << 14)))]
            vote(grams)
            count += len(grams)
        held = words[-(shingle - 1) :] if shingle > 1 else []
    if not count and held:
        vote([hashed(b" ".join(held), seed)])
        count = 1
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.uint64)[0]) if count else 0


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            values = [fingerprint(text or b"", shingle, seed) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fp"])

    # bytes.split() cuts at the six ASCII spaces only, and bytes.lower() changes A-Z only
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(hashed, "doc_id long, fp long")


def variants(nodes: DataFrame) -> DataFrame:
    """part, fp: the 64 one-wildcard keys of each fingerprint."""
    keys = []
    for low, high in SEGMENTS:
        for bit in range(low, high):
            mask = ((1 << high) - (1 << low)) & ~(1 << bit)
            signed = mask - (1 << 64) if mask >> 63 else mask
            value = F.shiftrightunsigned(F.col("fp").bitwiseAND(F.lit(signed).cast("long")), low)
            keys.append(value.bitwiseOR(F.lit(bit << 32).cast("long")))
    return nodes.select("fp", F.explode(F.array(*keys)).alias("part"))


def _near(keys: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs under the same key (keys are sorted) that differ in at most ``distance`` bits."""
    left, right, at, gap = [], [], np.arange(len(keys)), 1
    while len(at := at[at + gap < len(keys)]):
        at = at[keys[at] == keys[at + gap]]
        close = at[np.bitwise_count(values[at] ^ values[at + gap]) <= distance]
        left.append(values[close])
        right.append(values[close + gap])
        gap += 1
    none = np.zeros(0, values.dtype)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _linker(distance: int, limit: int | None, closest: bool = False):
    """Over rows sorted by part: kind 0 rows are edges (a, b), kind 1 rows belong to a part of over ``limit`` rows.

    Edges are a forest of all links that a task has met; with ``closest``, one for each batch of parts, grown from the least distance.
    """

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held_k, held_v, over = Forest(), np.zeros(0, np.int64), np.zeros(0, np.uint64), None

        def take(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            one, two = _near(keys, values, distance)
            if not closest:
                for a, b in {*zip(*(x.view(np.int64).tolist() for x in (one, two)), strict=True)}:
                    forest.join(a, b)
                return
            tree, kept = Forest(), []
            order = np.argsort(np.bitwise_count(one ^ two), kind="stable")
            for a, b in zip(one[order].view(np.int64).tolist(), two[order].view(np.int64).tolist(), strict=True):
                if tree.root(a) != tree.root(b):
                    tree.join(a, b)
                    kept.append((a, b))
            yield rows(0, *(np.array([x[k] for x in kept], np.int64) for k in (0, 1)))

        for batch in batches:
            keys = np.concatenate([held_k, batch.column(0).to_numpy()])
            values = np.concatenate([held_v, batch.column(1).to_numpy().view(np.uint64)])
            if over is not None:  # the part goes on
                n = int(np.searchsorted(keys, over, "right"))
                yield rows(1, keys[:n], values[:n])
                keys, values = keys[n:], values[n:]
            if not len(keys):
                held_k, held_v = keys, values
                continue
            over = None
            begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[begins, len(keys)])
            large = np.repeat(sizes > limit, sizes) if limit else np.zeros(len(keys), bool)
            last = begins[-1]
            if large[-1]:
                over, last = keys[-1], len(keys)
            if large.any():
                yield rows(1, keys[large], values[large])
            held_k, held_v = keys[last:].copy(), values[last:].copy()
            whole = ~large
            whole[last:] = False
            yield from take(keys[whole], values[whole])
            if len(forest.parent) > 500_000:
                yield rows(0, *(np.array(x, np.int64) for x in forest.edges()))
                forest = Forest()
        yield from take(held_k, held_v)
        yield rows(0, *(np.array(x, np.int64) for x in forest.edges()))

    return link


def links(nodes: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """src, dst: edges that connect all distinct fingerprints (column fp) within ``distance`` bits of each other."""
    if not 0 <= distance <= 5:
        raise ValueError("three segments with one wildcard serve distances up to 5")
    schema = "kind int, a long, b long"
    found = written(variants(nodes).repartition("part").sortWithinPartitions("part").select("part", "fp").mapInArrow(_linker(distance, bucket_rows), schema), "links")
    return _dealt(found, distance, bucket_rows)


def _dealt(found: DataFrame, distance: int, bucket_rows: int, closest: bool = False) -> DataFrame:
    """src, dst: the edges that a linker found, and those among the rows of crowded parts, dealt as pairs of blocks."""
    edges = found.where("kind = 0").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    crowded = found.where("kind = 1").select(F.col("a").alias("part"), F.col("b").alias("fp"))
    if crowded.isEmpty():
        return edges
    half = max(1, bucket_rows // 2)
    sizes = crowded.groupBy("part").agg(F.ceil(F.count("*") / half).cast("int").alias("blocks"))
    dealt = crowded.join(sizes, "part").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = dealt.select(F.xxhash64("part", F.least("own", "other"), F.greatest("own", "other")).alias("part"), "fp")
    more = cell.repartition("part").sortWithinPartitions("part").mapInArrow(_linker(distance, None, closest), "kind int, a long, b long")
    return edges.unionByName(more.select(F.col("a").alias("src"), F.col("b").alias("dst")))


def near_duplicates(documents: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach)."""
    marked = written(fingerprints(documents, shingle, seed), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    reached = components(links(nodes.select("fp"), distance, bucket_rows))
    grouped = nodes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.select("fp", "component").join(heads, "component").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------------------------------------
# Similarity of shingle sets


def chance(bits: int, similarity: float) -> float:
    """That ``bits`` bits of two fingerprints differ in one at most, for sets of that Jaccard similarity (of like size)."""
    flip = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return (1 - flip) ** bits + bits * flip * (1 - flip) ** (bits - 1)


def plan(nodes: int, similarity: float, found: float) -> tuple[int, int]:
    """Bits of a segment, which grow with the nodes so that unlike ones seldom meet, and how many segments it takes to find a pair at the threshold with the chance ``found``."""
    bits = min(30, max(16, math.ceil(math.log2(max(1, nodes))) + 2))
    return bits, math.ceil(math.log(1 - found) / math.log(1 - chance(bits, similarity)))


def _shingles(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches, and of each text (the last column) the distinct hashes of its lowered words' shingles, sorted; of fewer words, of the whole sequence."""
    for batch in small_batches(batches):
        out = []
        for _, texts in pieces(x or b"" for x in as_bytes(batch.column(batch.num_columns - 1))):
            found = Words(texts, SPACED, lower=True)
            words = found.hashes(0)
            grams = run_hashes(words, shingle)
            for low, high in zip(found.first, found.first[1:], strict=False):
                own = grams[low : high - shingle + 1] if high - low >= shingle else run_hashes(words[low:high], int(high - low)) if high > low else words[:0]
                out.append(np.unique(own))
        yield batch, out


def _node(grams: np.ndarray) -> int:
    """Names a set of shingles."""
    return xxhash.xxh64_intdigest(grams.tobytes())


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _marked(shingle: int, words: int):
    """From (doc_id, text): doc_id, node, fp (64 bits to verify by), wide (the words that are cut into segments)."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _shingles(batches, shingle):
            prints = [wide_fingerprint(x, words + 1) for x in sets]
            columns = [batch.column(0), _signed([_node(x) for x in sets]), _signed([x[0] for x in prints]), pa.array([x[1:].tobytes() for x in prints], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "fp", "wide"])

    return marked


def _sets(shingle: int):
    """From texts: node, grams (32 bits of each hash, packed). A set that the task has met is not told again while it is kept in mind."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for _, found in _shingles(batches, shingle):
            named = {_node(x): x for x in found}
            fresh = {k: x for k, x in named.items() if k not in met}
            met = (met if len(met) < 1_000_000 else set()) | fresh.keys()
            yield pa.RecordBatch.from_arrays([_signed(list(fresh)), pa.array([np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in fresh.values()], pa.binary())], ["node", "grams"])

    return sets


def wide_fingerprint(grams: np.ndarray, words: int) -> np.ndarray:
    """So many 64-bit words; each bit is the majority of all shingles, each shingle's hash being mixed anew for each word."""
    votes = np.zeros(64 * words, np.int64)
    for low in range(0, len(grams), 1 << 13):
        mixed = mix(grams[low : low + (1 << 13), None] + np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        votes += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return np.packbits(2 * votes > len(grams), bitorder="little").view(np.uint64)


def _keyed(bits: int, segments: int):
    """From (fp, wide): part, fp for each segment and wildcard."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        number = (np.arange(segments, dtype=np.uint64)[:, None] * np.uint64(64) + np.arange(bits, dtype=np.uint64)) << np.uint64(32)
        for batch in small_batches(batches, 256):
            if not batch.num_rows:
                continue
            wide = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            flat = np.unpackbits(wide, axis=1, bitorder="little")[:, : bits * segments].reshape(-1, segments, bits)
            keys = ((flat @ weights)[:, :, None] & ~weights | number).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], ["part", "fp"])

    return keyed


def _alike(similarity: float):
    """Pairs (src, dst, a, b: shingle sets) of at least that Jaccard similarity."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one, two = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(two) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return alike


def _compared(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """src, dst: those of the written pairs whose sets (node, grams) are alike."""
    many = pairs.count()
    wanted = written(pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct(), "wanted", rows=many)
    few = wanted.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    held = sets.join(F.broadcast(wanted) if few else wanted, "node", "left_semi")
    side = lambda c, d: held.select(F.col("node").alias(c), F.col("grams").alias(d))
    out = pairs.join(side("src", "a"), "src").join(side("dst", "b"), "dst").select("src", "dst", "a", "b").mapInArrow(_alike(similarity), "src long, dst long")
    out = written(out, "alike", rows=many, work=True)
    discard(sets.sparkSession, wanted)
    return out


def _common(sets: DataFrame, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a share of the sets repeats, sorted, and how often. Only the order of shingles follows from it, and any order gives the same links."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32).astype(np.int64))], ["gram"])

    share = sets.where(F.pmod(F.xxhash64("node"), F.lit(max(1, nodes // ORDER_SETS))) == 0)
    counts = share.select("grams").mapInArrow(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "gram").limit(ORDER_GRAMS).collect()  # bounded
    found.sort(key=lambda r: r.gram)
    return np.array([r.gram for r in found], np.uint32), np.array([r.n for r in found], np.int64)


def _prefixed(similarity: float, common: np.ndarray, counts: np.ndarray):
    """From (node, grams): node, size, prefix (the set's shingles that come first, packed).

    Sets of at least that similarity share a shingle among the first of both, in any order that is the same for all sets; here rare ones come first.
    """

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            heads, sizes = [], []
            for packed in batch.column(1).to_pylist():
                grams = np.frombuffer(packed, np.uint32)
                n, often = len(grams), np.zeros(len(grams), np.int64)
                if n and len(common):
                    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
                    often = np.where(common[at] == grams, counts[at], 0)
                first = min(n, n - math.ceil(similarity * n - 1e-9) + 1)
                heads.append(grams[np.lexsort((grams, often))[:first]].tobytes())
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(heads, pa.binary())], ["node", "size", "prefix"])

    return prefixed


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (node, root, size, prefix): part (a shingle), node, root, place (the set's size, and where the shingle stands)."""
    for batch in small_batches(batches):
        heads = [np.frombuffer(x, np.uint32) for x in batch.column(3).to_pylist()]
        sizes = [len(x) for x in heads]
        if sum(sizes):
            node, root, size = (np.repeat(batch.column(k).to_numpy(), sizes) for k in range(3))
            place = (size << 32) + np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(heads).astype(np.int64), node, root, place)], ["part", "node", "root", "place"])


def _parts(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Columns of rows that are sorted by the first one: whole parts of equal values, or (True) rows of parts over ``limit``."""
    held, over = None, None
    for batch in batches:
        columns = [x.to_numpy() for x in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if over is not None:  # the part goes on
            n = int(np.searchsorted(columns[0], over, "right"))
            yield True, [x[:n] for x in columns]
            columns = [x[n:] for x in columns]
        held, keys = columns, columns[0]
        if not len(keys):
            continue
        over = None
        begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[begins, len(keys)])
        large = np.repeat(sizes > limit, sizes) if limit else np.zeros(len(keys), bool)
        last = begins[-1]
        if large[-1]:
            over, last = keys[-1], len(keys)
        if large.any():
            yield True, [x[large] for x in columns]
        held = [x[last:].copy() for x in columns]
        whole = ~large
        whole[last:] = False
        yield False, [x[whole] for x in columns]
    if held is not None:
        yield False, held


_MET = "kind int, a long, b long, c long, d long"


def _meeting(similarity: float, limit: int | None):
    """Over (part, node, root, place) sorted by part: kind 0 rows are nodes a, b of different roots c, d, whose sizes and places allow that similarity; kind 1 rows belong to a part of over ``limit`` rows."""

    def rows(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *(pa.array(x) for x in columns)], ["kind", "a", "b", "c", "d"])

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for crowded, columns in _parts(batches, limit):
            if crowded:
                yield rows(1, columns)
                continue
            keys, node, root, place = columns
            size, left = place >> 32, (place >> 32) - (place & 0xFFFFFFFF)
            at, gap, found, held = np.arange(len(keys)), 1, [], 0
            while len(at := at[at + gap < len(keys)]):
                at = at[keys[at] == keys[at + gap]]
                to = at + gap
                # at the first shingle that two sets share, no more can be common than follow it in both
                may = (root[at] != root[to]) & (np.minimum(left[at], left[to]) >= similarity / (1 + similarity) * (size[at] + size[to]) - 1e-9)
                if may.any():
                    one, two = at[may], to[may]
                    one, two = np.where(node[one] < node[two], one, two), np.where(node[one] < node[two], two, one)
                    found.append(np.stack([node[one], node[two], root[one], root[two]]))
                    held += len(one)
                if held > 200_000:
                    yield rows(0, list(np.unique(np.concatenate(found, 1), axis=1)))
                    found, held = [], 0
                gap += 1
            if held:
                yield rows(0, list(np.unique(np.concatenate(found, 1), axis=1)))

    return meeting


def _completed(sets: DataFrame, roots: DataFrame, nodes: int, similarity: float, bucket_rows: int) -> DataFrame:
    """src, dst: roots that a pair of alike sets joins, of all pairs of sets (node, grams) under different roots (node, root). None is missed."""
    spark = sets.sparkSession
    first = sets.select("node", "grams").mapInArrow(_prefixed(similarity, *_common(sets, nodes)), "node long, size long, prefix binary")
    first = written(first.join(roots, "node").select("node", "root", "size", "prefix"), "prefixes", rows=nodes)
    release(spark)
    head = first.mapInArrow(_spread, "part long, node long, root long, place long")
    met = written(head.repartition("part").sortWithinPartitions("part").mapInArrow(_meeting(similarity, bucket_rows), _MET), "shared", rows=nodes, work=True)
    release(spark)
    pairs = met.where("kind = 0").select("a", "b", "c", "d")
    crowded = met.where("kind = 1").selectExpr("a as part", "b as node", "c as root", "d as place")
    if not crowded.isEmpty():
        half = max(1, bucket_rows // 2)
        sizes = crowded.groupBy("part").agg(F.ceil(F.count("*") / half).cast("int").alias("blocks"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("part", "blocks")
        dealt = crowded.join(sizes, "part").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cell = dealt.select(F.xxhash64("part", F.least("own", "other"), F.greatest("own", "other")).alias("part"), "node", "root", "place")
        more = cell.repartition("part").sortWithinPartitions("part").mapInArrow(_meeting(similarity, None), _MET)
        pairs = pairs.unionByName(more.select("a", "b", "c", "d"))
    pairs = written(pairs.distinct().toDF("src", "dst", "one", "two"), "shared_pairs", rows=met.count())
    alike = _compared(sets, pairs.select("src", "dst"), similarity)
    out = written(pairs.join(alike, ["src", "dst"]).select(F.col("one").alias("src"), F.col("two").alias("dst")).distinct(), "joined", rows=nodes)
    discard(spark, first, met, pairs, alike)
    return out


def similar_groups(documents: DataFrame, shingle: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY, found: float = FOUND, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, component_id: groups of documents joined by all pairs whose sets of shingles have at least that Jaccard similarity.

    Copies are one node. Candidates agree, but for one bit, in a segment of a wide fingerprint, and in a second
    fingerprint of 64 bits differ no more than pairs at the threshold do (``SIGMAS`` standard deviations are
    granted); then the sets themselves are compared. Where many candidates meet under one key, they are joined by the closest first, and only
    a forest of them goes on to that comparison. So links may be lost in three places: by chance, by the second fingerprint, and where the
    comparison refuses a branch of the forest. ``_completed`` finds all that are left, exactly: pairs of different groups that share a shingle of their prefixes.
    """
    spark = documents.sparkSession
    rows = documents.count()
    bits, segments = plan(rows, similarity, found)
    flip = math.acos(2 * similarity / (1 + similarity)) / math.pi
    distance = math.floor(64 * flip + SIGMAS * math.sqrt(64 * flip * (1 - flip)))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = written(texts.mapInArrow(_marked(shingle, -(-bits * segments // 64)), "doc_id long, node long, fp long, wide binary"), "marks", rows=rows)
    nodes = written(marked.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("fp").alias("fp"), F.min("wide").alias("wide")), "nodes", rows=rows)
    classes = written(nodes.groupBy("fp").agg(F.min(F.struct("node", "wide")).alias("one")).select("fp", F.col("one.node").alias("head"), "one.wide"), "classes", rows=rows)
    keys = classes.select("fp", "wide").mapInArrow(_keyed(bits, segments), "part long, fp long")
    kinds = "kind int, a long, b long"
    met = written(keys.repartition("part").sortWithinPartitions("part").mapInArrow(_linker(distance, bucket_rows, True), kinds), "met", rows=rows, work=True)
    release(spark)
    near = _dealt(met, distance, bucket_rows, True).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    near = written(near, "near", rows=met.count())
    # texts with the same fingerprint are compared with the one that stands for it
    same = nodes.select("node", "fp").join(classes.select("fp", "head"), "fp").where("node <> head").select(F.col("node").alias("src"), F.col("head").alias("dst"))
    same = written(same, "same", rows=rows)
    discard(spark, met)
    sets = documents.select(F.col("text").cast("string")).mapInArrow(_sets(shingle), "node long, grams binary")
    sets = written(sets.groupBy("node").agg(F.min("grams").alias("grams")), "sets", rows=rows)
    release(spark)
    named = classes.select("fp", F.col("head").alias("node"))
    heads = sets.join(named, "node").select(F.col("fp").alias("node"), "grams")
    close = _compared(heads, near, similarity)
    side = lambda c: named.select(F.col("fp").alias(c), F.col("node").alias(f"{c}_node"))
    edges = close.join(side("src"), "src").join(side("dst"), "dst").select(F.col("src_node").alias("src"), F.col("dst_node").alias("dst"))
    edges = written(edges.unionByName(_compared(sets, same, similarity)), "links", rows=rows)
    reached = components(edges, few=FEW_EDGES).withColumnRenamed("component", "root")
    grouped = written(nodes.select("node", "least").join(reached, "node", "left").withColumn("root", F.coalesce("root", "node")), "grouped", rows=rows)
    discard(spark, nodes, classes, near, same, close, edges)
    joined = _completed(sets, grouped.select("node", "root"), grouped.count(), similarity, bucket_rows)
    last = components(joined, few=FEW_EDGES).withColumnRenamed("node", "root")
    grouped = grouped.join(last, "root", "left").select("node", "least", F.coalesce("component", "root").alias("root"))
    heads = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(grouped.join(heads, "root").select("node", "component_id"), "named", rows=rows)
    out = written(marked.select("doc_id", "node").join(named, "node").select("doc_id", "component_id"), "groups", rows=rows)
    discard(spark, marked, sets, joined, named)
    return out


def deduplicate(documents: DataFrame, **options) -> DataFrame:
    """One document of each group of ``similar_groups`` stays: that with the smallest doc_id.

    Of rows that repeat a doc_id, one stays. Rows without a doc_id stay, as no group can name them.
    """
    kept = similar_groups(documents.select("doc_id", "text"), **options).where("doc_id = component_id").select("doc_id").distinct()
    named = documents.where("doc_id is not null").dropDuplicates(["doc_id"]).join(kept, "doc_id", "left_semi")
    return gathered(named.select(documents.columns).unionByName(documents.where("doc_id is null")), kept.count())
