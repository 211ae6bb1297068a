"""Embedding near-duplicates by NN-descent.

Distinct vectors of a label are nodes. A first graph comes from cells of random hyperplanes. Then the
graph is refined: around each node its neighbours and those whose neighbour it is meet and are compared,
so neighbours of neighbours become neighbours, and each node keeps the best. Pairs at the threshold or
above are links and are never dropped, whatever the lists hold.

Where a list is saturated (it is full of links), it is enlarged to all nodes that links reach: members of
one linked component are compared in pairs of blocks, which adds the links that no list had room for. That
is exact within components, and only counts and a spanning forest leave a task. A sample of nodes is then
compared with all vectors; while less than ``recall`` of their links are found, more cells and rounds follow.
The sample grows until it holds ``LINKED`` linked nodes; where even ``AUDITED_MOST`` nodes hold fewer, rounds
follow until none adds a link. Sets of cells grow with the cells' hyperplanes. A recall that stays low raises.

Cosines are formed in double precision from the values as stored. Copies are one node with a count, so
they need no pairs. Crowded cells are compared in pairs of parts; centres with many neighbours are dealt
in parts, anew each round; blocks have a bounded size.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows
without a label, link with nothing (component_id is their own vec_id); vectors of unlike length do not
link; very long vectors are compared as any others; rows that repeat a vec_id and vector link as copies do; a null vec_id is carried through and is a
component's id only if it has no other; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import Forest, components, release, small_batches, written

logger = logging.getLogger(__name__)

THRESHOLD = 0.93
#: Neighbours in a list; cells of how many nodes the first graph comes from, and how many sets of cells.
NEIGHBOURS, CELL, TABLES, ROUNDS = 8, 48, 6, 2
#: Rows of a block; neighbours that one task compares around a centre.
BLOCK, CENTRE = 1024, 64
#: Nodes compared with all vectors to measure recall (with their vectors, they are broadcast), and what must be found.
AUDITED, RECALL = 256, 0.98
#: Linked nodes that a sample should hold, for which it grows up to so many nodes.
LINKED, AUDITED_MOST = 64, 1 << 16
#: Times that more cells and rounds may follow an audit.
RETRIES = 4


def unit(rows: list[bytes], kind: str) -> np.ndarray:
    values = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def _packed(kind: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(x, kind).tobytes() for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.binary())], batch.schema.names[:-1] + ["vector"])

    return pack


def nodes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Nodes (node, space, size, least, vector: packed), rows (vec_id, node: null if nothing can link), and the packing."""
    kind = "<f4" if embeddings.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    held = F.array_size("embedding")
    sound = F.col("embedding").isNotNull() & F.col("label").isNotNull() & (held > 0)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    # adding zero makes the two zeros one, so equal vectors are equal arrays
    given = embeddings.select(F.col("vec_id").cast("long"), "label", F.transform("embedding", lambda x: x + F.lit(0).cast("float" if kind == "<f4" else "double")).alias("embedding"), F.coalesce(sound & fine, F.lit(False)).alias("usable"))
    usable = given.where("usable").groupBy("label", "embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    numbered = usable.select(F.monotonically_increasing_id().alias("node"), F.xxhash64("label", F.size("embedding")).alias("space"), "size", "least", "label", "embedding")
    numbered = written(numbered, "nodes")
    rows = given.where("usable").join(numbered.select("node", "label", "embedding"), ["label", "embedding"]).select("vec_id", "node")
    rows = written(rows.unionByName(given.where("not usable").select("vec_id", F.lit(None).cast("long").alias("node"))), "rows")
    packed = numbered.select("node", "space", "size", "least", "embedding").mapInArrow(_packed(kind), "node long, space long, size long, least long, vector binary")
    return written(packed, "vectors"), rows, kind


# ---------------------------------------------------------------------------------------------
# The graph: rows (a, b, similarity), each pair in both directions


EDGE = "a long, b long, s double"


class Kept:
    """The best pairs of each node that a task has met, and all links."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.links, self.size = k, [], [], 0

    def add(self, ids: np.ndarray, similar: np.ndarray, floor: np.ndarray | None, threshold: float) -> None:
        n = len(ids)
        np.fill_diagonal(similar, -2.0)
        upper = np.triu(similar >= threshold, 1)
        if upper.any():
            forest_a, forest_b = np.nonzero(upper)
            self.links.append(_spanning(ids, forest_a, forest_b, similar))
        if n > self.k + 1:
            near = np.argpartition(-similar, self.k, axis=1)[:, : self.k]
        else:
            near = np.tile(np.arange(n), (n, 1))
        a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
        s = similar[a, b]
        good = s > (-1.5 if floor is None else floor[a])
        self.parts.append(np.rec.fromarrays([ids[a[good]], ids[b[good]], s[good]], names="a,b,s"))
        self.size += int(good.sum())

    def take(self) -> pa.RecordBatch:
        parts = self.parts + self.links
        rows = np.concatenate(parts) if parts else np.rec.fromarrays([np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)], names="a,b,s")
        order = np.lexsort((rows["b"], rows["a"]))
        rows = rows[order]
        if len(rows):
            rows = rows[np.r_[True, (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])]]
        self.parts, self.links, self.size = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c])) for c in ("a", "b", "s")], ["a", "b", "s"])


def _spanning(ids: np.ndarray, a: np.ndarray, b: np.ndarray, similar: np.ndarray) -> np.ndarray:
    """Of links within one small matrix, as many as join the same nodes (both directions)."""
    if len(a) > 2 * len(ids):
        forest, kept = Forest(), []
        for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if forest.root(x) != forest.root(y):
                forest.join(x, y)
                kept.append(k)
        a, b = a[kept], b[kept]
    s = similar[a, b]
    return np.rec.fromarrays([np.r_[ids[a], ids[b]], np.r_[ids[b], ids[a]], np.r_[s, s]], names="a,b,s")


def _compare(k: int, limit: int | None, kind: str, threshold: float):
    """Rows sorted by group (group, node, floor, vector): all of a group, or at most ``limit`` of it, are compared at a time."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
        now, ids, floors, rows = None, [], [], []
        for batch in batches:
            for group, node, floor, row in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if group != now or limit and len(ids) >= limit:
                    if len(ids) > 1:
                        yield ids, floors, rows
                    now, ids, floors, rows = group, [], [], []
                ids.append(node)
                floors.append(floor)
                rows.append(row)
        if len(ids) > 1:
            yield ids, floors, rows

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept(k)
        for ids, floors, rows in groups(batches):
            x = unit(rows, kind)
            kept.add(np.array(ids, np.int64), x @ x.T, np.array(floors), threshold)
            if kept.size > 500_000:
                yield kept.take()
        yield kept.take()

    return compare


def _cells(tables: range, kind: str):
    """From (space, bits, node, vector): group, node, floor, vector, once for each table."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            space, bits, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_pylist()
            for size in {len(x) for x in rows}:
                at = np.array([k for k, x in enumerate(rows) if len(x) == size])
                x = unit([rows[k] for k in at], kind)
                for table in tables:
                    planes = np.random.default_rng(1000 + table).standard_normal((x.shape[1], 48))
                    side = (x @ planes > 0) & (np.arange(48) < bits[at][:, None])
                    code = side @ (np.uint64(1) << np.arange(48, dtype=np.uint64))
                    group = (space[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ code.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) + np.uint64(table * 7919)
                    yield pa.RecordBatch.from_arrays([pa.array(group.view(np.int64)), batch.column(2).take(pa.array(at)), pa.array(np.full(len(at), -1.5)), batch.column(3).take(pa.array(at))], ["group", "node", "floor", "vector"])

    return deal


def _together(rows: DataFrame) -> DataFrame:
    """Sorted by group, and by a hash within that differs from group to group, so that what is compared at a time is a fair part of a large group."""
    return rows.repartition("group").withColumn("turn", F.xxhash64("node", "group")).sortWithinPartitions("group", "turn").select("group", "node", "floor", "vector")


def cells(vectors: DataFrame, tables: range, k: int, kind: str, threshold: float) -> DataFrame:
    """Pairs from cells of about ``CELL`` nodes. A crowded cell is cut into parts, and each two of them meet, so all its pairs are compared."""
    sizes = vectors.groupBy("space").agg(F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / CELL))).cast("int").alias("bits"))
    dealt = vectors.join(sizes, "space").select("space", "bits", "node", "vector").mapInArrow(_cells(tables, kind), "group long, node long, floor double, vector binary")
    counted = dealt.groupBy("group").agg(F.ceil(F.count("*") / (10 * CELL)).cast("int").alias("parts"))
    lots = dealt.join(counted, "group")
    crowded = lots.where("parts > 1").withColumn("own", F.pmod(F.xxhash64("node", "group"), F.col("parts")).cast("int"))
    met = crowded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("own <> other")
    pairs = met.select(F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other")).alias("group"), "node", "floor", "vector")
    # two parts by hash have about 20 * CELL nodes, so none needs a limit
    return _together(lots.where("parts = 1").select("group", "node", "floor", "vector").unionByName(pairs)).mapInArrow(_compare(k, None, kind, threshold), EDGE)


def _best(k: int, threshold: float):
    """Rows sorted by a, then b: the k best of each a (kind 0; b, s), and all links (kind 1)."""

    def flush(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        a, b, s = a[fresh], b[fresh], s[fresh]
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        head = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
        rank = np.arange(len(a)) - np.repeat(head, np.diff(np.r_[head, len(a)]))
        for kind, use in ((0, rank < k), (1, (s >= threshold) & (a > b))):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(use.sum()), kind, np.int32)), pa.array(a[use]), pa.array(b[use]), pa.array(s[use])], ["kind", "a", "b", "s"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            now = [np.concatenate([x, batch.column(c).to_numpy()]) for c, x in enumerate(held)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last node may go on
            yield from flush(*(x[:cut] for x in now))
            held = [x[cut:].copy() for x in now]
        yield from flush(*held)

    return best


def merged(pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    return written(pairs.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_best(k, threshold), f"kind int, {EDGE}"), "graph")


def refined(vectors: DataFrame, graph: DataFrame, k: int, kind: str, threshold: float, turn: int = 0) -> DataFrame:
    """One round: around each node, its neighbours (of either direction) meet; each ``turn`` deals those around a hub anew."""
    lists = graph.where("kind = 0")
    around = lists.select(F.col("a").alias("centre"), F.col("b").alias("node")).unionByName(lists.select(F.col("b").alias("centre"), F.col("a").alias("node"))).distinct()
    parts = around.groupBy("centre").agg(F.ceil(F.count("*") / CENTRE).cast("int").alias("parts"))
    floors = lists.groupBy("a").agg(F.min("s").alias("floor"), F.count("*").alias("n"))
    known = vectors.join(floors.select(F.col("a").alias("node"), F.when(F.col("n") < k, -1.5).otherwise(F.col("floor")).alias("floor")), "node").select("node", "floor", "vector")
    dealt = around.join(parts, "centre").select(F.when(F.col("parts") > 1, F.xxhash64("centre", F.pmod(F.xxhash64("node", "centre", F.lit(turn)), F.col("parts")))).otherwise(F.col("centre")).alias("group"), "node").join(known, "node")
    found = _together(dealt).mapInArrow(_compare(k, 2 * CENTRE, kind, threshold), EDGE)
    links = graph.where("kind = 1").select("a", "b", "s")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    return merged(lists.select("a", "b", "s").unionByName(both).unionByName(found), k, threshold)


# ---------------------------------------------------------------------------------------------
# Links within components


def _blocks(kind: str, threshold: float):
    """Rows sorted by cell (cell, node, size, block, diagonal, vector). Partial counts of links: node, n."""

    def count(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        x = unit([r[5] for r in rows], kind)
        ids, size, block = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        sides = [np.flatnonzero(block == b) for b in np.unique(block)]
        if rows[0][4]:
            sides = [sides[0], sides[0]]
        if len(sides) < 2:
            return
        one, two = sides
        hit = x[one] @ x[two].T >= threshold
        if rows[0][4]:
            np.fill_diagonal(hit, False)
        n = hit @ size[two]
        pairs = [(ids[one], n)] if rows[0][4] else [(ids[one], n), (ids[two], size[one] @ hit)]
        for a, b in pairs:
            yield pa.RecordBatch.from_arrays([pa.array(a[b > 0]), pa.array(b[b > 0])], ["node", "n"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                if held and row[0] != held[0][0]:
                    yield from count(held)
                    held = []
                held.append(row)
        if held:
            yield from count(held)

    return blocks


def link_counts(vectors: DataFrame, reached: DataFrame, kind: str, threshold: float, block: int = BLOCK) -> DataFrame:
    """node, n: vectors (copies counted) that each node links with, comparing all members of each component (node, component) in blocks."""
    sizes = reached.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = reached.join(sizes, "component").withColumn("block", own).join(vectors.select("node", "size", "vector"), "node")
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    cell = met.select(F.xxhash64("component", low, high).alias("cell"), "node", "size", "block", (low == high).alias("diagonal"), "vector")
    counts = cell.repartition("cell").sortWithinPartitions("cell").mapInArrow(_blocks(kind, threshold), "node long, n long")
    return counts.groupBy("node").agg(F.sum("n").alias("n"))


def tables_for(bits: int, threshold: float, missed: float = 0.02) -> int:
    """Sets of cells of so many hyperplanes after which a pair at the threshold has met but for a chance of ``missed``."""
    meets = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return 1 if meets >= 1 else math.ceil(math.log(missed) / math.log1p(-meets))


def _audit(vectors: DataFrame, counts: DataFrame, kind: str, threshold: float, audited: int) -> tuple[float | None, int, int]:
    """The mean part of their links that ``counts`` has for the linked nodes in a sample, how many those are, and the sample's size."""
    sample = vectors.orderBy(F.xxhash64("node")).limit(audited).select("node", "space", "vector").toArrow()
    if not sample.num_rows:
        return None, 0, 0
    held = vectors.sparkSession.sparkContext.broadcast((sample["node"].to_numpy(), sample["space"].to_numpy(), sample["vector"].to_pylist()))

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, spaces, rows = held.value
        places = {s: np.flatnonzero(spaces == s) for s in np.unique(spaces)}
        ready = {s: unit([rows[k] for k in at], kind) for s, at in places.items()}
        total = np.zeros(len(ids), np.int64)
        for batch in small_batches(batches, 2048):
            node, space, size, mine = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_pylist()
            for s in np.intersect1d(spaces, space):
                two = np.flatnonzero(space == s)
                other = unit([mine[k] for k in two], kind).T
                for low in range(0, len(places[s]), 2048):
                    one = places[s][low : low + 2048]
                    hit = ready[s][low : low + 2048] @ other >= threshold
                    hit &= ids[one][:, None] != node[two][None, :]
                    total[one] += hit @ size[two]
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], ["node", "n"])

    true = vectors.select("node", "space", "size", "vector").mapInArrow(audit, "node long, n long").groupBy("node").agg(F.sum("n").alias("all_links"))
    part = F.coalesce("n", F.lit(0)).cast("double") / F.col("all_links")
    mean, linked = true.join(counts, "node", "left").agg(F.avg(part), F.count("*")).first()
    held.unpersist()
    return mean, linked, sample.num_rows


def audit(vectors: DataFrame, counts: DataFrame, kind: str, threshold: float, audited: int = AUDITED, most: int = AUDITED_MOST) -> tuple[float | None, bool]:
    """Recall (None: no linked node was met), and whether it rests on ``LINKED`` linked nodes or on the whole table; the sample grows until then."""
    while True:
        mean, linked, taken = _audit(vectors, counts, kind, threshold, audited)
        if linked >= LINKED or taken < audited:
            return mean, True
        if audited >= most:
            return mean, False
        audited = min(most, 4 * audited)


def measured_recall(vectors: DataFrame, counts: DataFrame, kind: str, threshold: float, audited: int = AUDITED) -> float:
    """Of each sampled node's links, found by comparing it with all vectors, the part that ``counts`` (node, n) has; the mean over nodes, so that large groups do not hide small ones."""
    mean, _ = audit(vectors, counts, kind, threshold, audited)
    return 1.0 if mean is None else mean


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, tables: int = TABLES, rounds: int = ROUNDS, recall: float = RECALL) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept. Raises if the recall measured stays below ``recall``."""
    spark = embeddings.sparkSession
    vectors, rows, kind = nodes(embeddings)
    largest = vectors.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    tables = max(tables, tables_for(max(0, math.ceil(math.log2(max(1, largest) / CELL))), threshold))
    graph, done, before = None, 0, None
    for attempt in range(RETRIES + 1):
        pairs = cells(vectors, range(done, done + tables), neighbours, kind, threshold)
        if graph is not None:
            links = graph.select("a", "b", "s")
            pairs = pairs.unionByName(links).unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        done += tables
        graph = merged(pairs, neighbours, threshold)
        for turn in range(rounds):
            graph = refined(vectors, graph, neighbours, kind, threshold, attempt * rounds + turn)
            release(spark)
        reached = written(components(graph.where("kind = 1").select(F.col("a").alias("src"), F.col("b").alias("dst"))), "reached")
        counts = written(link_counts(vectors, reached, kind, threshold), "counts")
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        found, sure = audit(vectors, counts, kind, threshold)
        enough = found is None or found >= recall
        if enough and (sure or total == before):  # where links are too rare to be measured, until no new one appears
            break
        if attempt == RETRIES:
            if not enough:
                raise RuntimeError(f"op10: recall {found:.4f} after {done} sets of cells, below {recall}")
            logger.warning("links were too few to measure recall (%s), and new ones still appeared after %d sets of cells", found, done)
        before = total
        tables *= 2
    joined = vectors.select("node", "size", "least").join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = joined.groupBy("component").agg(F.min("least").alias("head"))
    told = joined.join(heads, "component").join(counts, "node", "left").select("node", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("links"), "head")
    out = rows.join(told, "node", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("head", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
