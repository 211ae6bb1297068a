"""Deduplication of long repeated substrings with suffix arrays built by grouping, in linear time.

``suffix_array`` follows Baier's two phases (2016). First, suffixes are grouped by their Lyndon prefixes:
groups are taken in descending order, each member gets a pointer to the last suffix before it in a smaller
group, and the suffixes pointed at move, by how many pointers they get, into new groups right behind
their old ones. Then the groups' order within is emitted along those pointers. Nothing is renamed or
sorted again.

One array over a corpus would need the whole corpus in one place. Of every 400-byte string, the 16-byte gram
of least hash is its anchor. Equal strings have equal anchors at equal offsets, so they meet under the
anchor's hash, and anchors that occur once take no part. Each anchor owns the strings that chose it; the
bytes these cover are its context. Contexts under repeated anchors, each distinct one once and with its
count, are laid end to end (as 16-byte symbols aligned to the anchor) in texts of bounded size, and those
texts get suffix arrays. Suffixes that share 24 symbols are neighbours there; which of the sixteen
400-byte strings around those 384 bytes are equal is then checked byte for byte.

Anchors with very many distinct contexts (``CONTEXTS``) would make one task's text too long. Their contexts
are cut into runs of strings whose starts lie in one range relative to the anchor; equal strings agree in the
bytes that all strings of a range share, so runs are dealt by those, and each deal gets its suffix arrays. Ranges
shrink where a deal is still too large. So a passage in any number of documents goes the same way.

Defined results: a null text is an empty one; a very long text is cut into overlapping slices, with the same results; texts under 400 bytes lose nothing; matches never cross
documents; a null doc_id is carried through; repeated rows each return a row, and repeat each other's
strings; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import as_bytes, discard, mix, pieces, powers, release, small_batches, text_or_empty, written

LENGTH = 400
GRAM = 16
SYMBOL = 16
#: Distinct contexts under one anchor that one task takes.
CONTEXTS = 16_384
#: Starts in the first range of a crowded anchor's runs.
RUN = 16
#: Symbols of a text that gets a suffix array (one anchor's contexts stay together).
SYMBOLS = 150_000


# ---------------------------------------------------------------------------------------------
# Suffix sorting


def suffix_array(text: list[int]) -> list[int]:
    """Of integers; the last must be smaller than all others."""
    n = len(text)
    values = np.asarray(text)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[first, n])
    start_of, place_of = np.empty(n, np.int64), np.empty(n, np.int64)
    start_of[order], place_of[order] = np.repeat(first, sizes), np.arange(n)
    at, place, group, size, smaller = order.tolist(), place_of.tolist(), start_of.tolist(), [0] * n, [-1] * n
    for k, z in zip(first.tolist(), sizes.tolist(), strict=True):
        size[k] = z

    def split(old: int, moved: list[int]) -> None:
        """Members of the group that begins at ``old`` become the group right behind it."""
        left = size[old] - len(moved)
        if not left:
            return
        end = old + size[old] - 1
        for j in moved:
            other, spot = at[end], place[j]
            at[spot], at[end], place[other], place[j] = other, j, spot, end
            end -= 1
        new = old + left
        size[old], size[new] = left, len(moved)
        for j in moved:
            group[j] = new

    top = n
    while top:
        bottom = group[at[top - 1]]
        if top - bottom == 1:
            i = at[bottom]
            j = i - 1
            while j >= 0 and group[j] >= bottom:
                j = smaller[j]
            smaller[i] = j
            if j >= 0 and size[old := group[j]] > 1:
                split(old, [j])
        else:
            pointed: dict[int, int] = defaultdict(int)
            for i in sorted(at[bottom:top]):
                j = i - 1
                while j >= 0 and group[j] >= bottom:
                    j = smaller[j]
                smaller[i] = j
                if j >= 0:
                    pointed[j] += 1
            by_count: dict[int, list[int]] = defaultdict(list)
            for j, count in pointed.items():
                by_count[count].append(j)
            for count in sorted(by_count, reverse=True):
                by_group: dict[int, list[int]] = defaultdict(list)
                for j in by_count[count]:
                    by_group[group[j]].append(j)
                for old, moved in by_group.items():
                    split(old, moved)
        top = bottom

    out, free, placed = [-1] * n, list(range(n)), [False] * n
    out[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            start = group[j]
            out[free[start]] = j
            free[start] += 1
            placed[j] = True
            j = smaller[j]
    return out


# ---------------------------------------------------------------------------------------------
# Anchors


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(which, len(data))[0][: len(data)], out=out[1:])
    return out


def _span(sums: np.ndarray, low: np.ndarray, high: np.ndarray, which: int) -> np.ndarray:
    return mix((sums[high] - sums[low]) * powers(which, len(sums))[1][low] + (high - low).astype(np.uint64))


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """document, place, first and last string that it owns (all places in the document), anchor hash, context hash."""
    slices = []
    for k, text in enumerate(texts):
        for low in range(0, max(0, len(text) - length + 1), 1 << 19):
            slices.append((k, low, text[low : low + (1 << 19) + length - 1]))
    for first, group in pieces((x[2] for x in slices), 1 << 19):
        data = np.frombuffer(b"".join(group), np.uint8)
        begins = np.cumsum([0] + [len(x) for x in group])
        sums = _sums(data, 0)
        at = np.arange(len(data) - GRAM + 1)
        grams = _span(sums, at, at + GRAM, 0)
        least = (grams & ~np.uint64((1 << 21) - 1)) | at.astype(np.uint64)  # ties: the leftmost
        width, span = length - GRAM + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: len(data) - length + 1], least[width - span : width - span + len(data) - length + 1])
        chosen = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        room = np.repeat(begins[1:], np.diff(begins)) - np.arange(len(data))
        valid = room[: len(chosen)] >= length
        owner = np.where(valid, chosen, -1)
        turns = np.flatnonzero(np.diff(owner, prepend=-2) != 0)
        ends = np.append(turns[1:], len(owner)) - 1
        turns, ends = turns[owner[turns] >= 0], ends[owner[turns] >= 0]
        place = owner[turns]
        context = _span(sums, turns, ends + length, 0) ^ mix((place - turns).astype(np.uint64) * np.uint64(1 << 32) + (ends - turns).astype(np.uint64))
        which = np.searchsorted(begins, turns, "right") - 1
        document = np.array([slices[first + k][0] for k in range(len(group))], np.int64)[which]
        shift = np.array([slices[first + k][1] for k in range(len(group))], np.int64)[which] - begins[which]
        yield document, place + shift, turns + shift, ends + shift, grams[place].view(np.int64), context.view(np.int64)


def _anchored(length: int):
    """From (key, text). A text met for the third time or more in a task says nothing new: its strings are counted twice already."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, int] = {}
        for batch in batches:
            keys, use, names = batch.column(0).to_pylist(), [], []
            for key, text in zip(keys, as_bytes(batch.column(1)), strict=True):
                if len(text) >= length and (times := met.get(key, 0)) < 2:
                    met[key] = times + 1
                    use.append(text)
                    names.append(key)
            for document, place, low, high, anchor, context in anchors(use, length):
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).take(pa.array(document)), pa.array(place), pa.array(low), pa.array(high), pa.array(anchor), pa.array(context)], ["key", "place", "low", "high", "h", "c"])

    return find


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops (key, text) rows whose key the task has met."""
    met: set[bytes] = set()
    for batch in batches:
        fresh = [key not in met and not met.add(key) for key in batch.column(0).to_pylist()]
        yield batch.filter(pa.array(fresh, pa.bool_()))


# ---------------------------------------------------------------------------------------------
# Contexts


def _cut(length: int):
    """Rows sorted by key and kind: requests (kind 0), then the text (kind 1). Gives h, c, n, before, after, context, and kinds as it came."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []
        for batch in small_batches(batches):
            out: list[tuple] = []
            for key, kind, place, low, high, h, c, n, kinds, text in zip(*(batch.column(k).to_pylist() for k in range(9)), as_bytes(batch.column(9)), strict=True):
                if key != now:
                    now, asked = key, []
                if kind == 0:
                    asked.append((place, low, high, h, c, n, kinds))
                else:
                    out += [(h, c, n, place - low, high - place, text[low : high + length], kinds) for place, low, high, h, c, n, kinds in asked]
                    asked = []
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(types)], ["h", "c", "n", "before", "after", "context", "kinds"])

    return cut


def repeated_strings(contexts: list[bytes], before: np.ndarray, after: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, place relative to its anchor) of every owned string that stands elsewhere too, by a suffix array over all contexts."""
    shared = (length - SYMBOL + 1) // SYMBOL  # whole symbols in any string of that length
    rest = length - shared * SYMBOL  # and the bytes around them
    lead = before // SYMBOL * SYMBOL  # from the first symbol to the anchor
    skip = before - lead
    pad = b"\0" * rest
    joined = np.frombuffer(b"".join(pad + x + pad for x in contexts), np.uint8)
    lengths = np.array([len(x) for x in contexts], np.int64)
    origin = np.cumsum(np.r_[0, lengths[:-1] + 2 * rest]) + rest  # of each context in joined
    amount = (lengths - skip) // SYMBOL
    owner = np.repeat(np.arange(len(contexts)), amount)
    index = np.arange(amount.sum()) - np.repeat(np.cumsum(amount) - amount, amount)
    byte_at = origin[owner] + skip[owner] + index * SYMBOL
    words = joined[byte_at[:, None] + np.arange(SYMBOL)].view(np.uint64)
    _, symbols = np.unique(words.view("V16").ravel(), return_inverse=True)
    # a separator (1) behind each context, and the least symbol (0) at the end
    text = np.ones(len(symbols) + len(contexts) + 1, np.int64)
    spot = np.arange(len(symbols)) + owner
    text[spot], text[-1] = symbols + 2, 0
    back = np.full(len(text), -1, np.int64)
    back[spot] = np.arange(len(symbols))
    array = back[np.array(suffix_array(text.tolist()), np.int64)]
    array = array[array >= 0]
    array = array[amount[owner[array]] - index[array] >= shared]  # as many symbols of the same context follow
    if not len(array):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(array), bool)
    near = np.arange(1, len(array))
    for k in range(shared):
        near = near[symbols[array[near] + k] == symbols[array[near - 1] + k]]
    same[near] = True
    group = np.cumsum(~same) - 1
    weight = np.bincount(group, count[owner[array]])
    crowded = weight[group] > 1
    array, group = array[crowded], group[crowded]
    place = index[array] * SYMBOL - lead[owner[array]]  # of the shared symbols, relative to the anchor
    left = joined[byte_at[array][:, None] + np.arange(-rest, 0)]
    right = joined[(byte_at[array] + shared * SYMBOL)[:, None] + np.arange(rest)]
    found_context, found_place = [], []
    for shift in range(SYMBOL):
        fits = (place - shift >= -before[owner[array]]) & (place - shift <= after[owner[array]])
        if not fits.any():
            continue
        edge = np.concatenate([left[fits][:, rest - shift :], right[fits][:, : rest - shift]], axis=1)
        edge = np.concatenate([edge, np.zeros((len(edge), -rest % 8), np.uint8)], axis=1)
        columns = np.ascontiguousarray(edge).view(np.uint64)
        order = np.lexsort((*columns.T, group[fits]))
        key = np.c_[group[fits].astype(np.uint64), columns][order]
        head = np.r_[True, (key[1:] != key[:-1]).any(1)]
        runs = np.cumsum(head) - 1
        total = np.bincount(runs, count[owner[array]][fits][order])
        hit = order[total[runs] > 1]
        found_context.append(owner[array][fits][hit])
        found_place.append(place[fits][hit] - shift)
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_context, found_place))


def _ranges(context: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs of consecutive places in each context: context, first, last."""
    order = np.lexsort((place, context))
    context, place = context[order], place[order]
    head = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (place[1:] != place[:-1] + 1)]) if len(context) else np.zeros(0, np.int64)
    last = np.r_[head[1:], len(context)] - 1 if len(context) else head
    return context[head], place[head], place[last]


_FOUND = "h long, c long, first long, last long"


def _sorted_contexts(length: int, symbols: int):
    """Rows sorted by h. Gives h, c, first, last: places (relative to the anchor) of strings that stand elsewhere too."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        numbers = [np.array([r[k] for r in rows], np.int64) for k in ("before", "after", "n", "h", "c")]
        context, first, last = _ranges(*repeated_strings([r["context"] for r in rows], *numbers[:3], length))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (numbers[3][context], numbers[4][context], first, last)], ["h", "c", "first", "last"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in small_batches(batches):
            for row in batch.to_pylist():
                if size >= symbols and row["h"] != held[-1]["h"]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["context"]) // SYMBOL + 1
        if held:
            yield solve(held)

    return search


_RUN = "g long, d long, h long, c long, n long, before long, after long, context binary"


def _split(width: int, length: int):
    """Contexts (h, c, n, before, after, context) cut into runs of strings whose starts lie in one range of ``width`` places relative to the anchor.

    Equal strings lie in the same range and agree from its last start to its first end, so a run goes (g) where
    all runs with the same bytes there go. d tells unlike runs apart.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = lambda *parts: int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)
        for batch in small_batches(batches, 128):
            out: list[tuple] = []
            for h, c, n, before, after, context in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for number in range(-before // width, after // width + 1):
                    first, last = number * width, number * width + width - 1
                    low, high = max(-before, first), min(after, last)
                    own = context[before + low : before + high + length]
                    group = short(b"%d %d" % (h, number), context[before + last : before + first + length])
                    out.append((group, short(b"%d %d" % (low, high), own), h, c, n, -low, high, own))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], [x.split()[0] for x in _RUN.split(", ")])

    return split


def _in_runs(contexts: DataFrame, length: int, most: int, symbols: int, width: int = RUN) -> DataFrame:
    """The same as _sorted_contexts, for anchors with too many contexts for one task: their runs are sorted, by ranges that shrink until no more than ``most`` unlike runs meet (of one string each, only equal ones do)."""
    runs = written(contexts.select("h", "c", "n", "before", "after", "context").mapInArrow(_split(width, length), _RUN), "runs")
    one = [F.first(x).alias(x) for x in ("before", "after", "context")]
    distinct = written(runs.groupBy("g", "d").agg(F.least(F.sum("n"), F.lit(2).cast("long")).alias("n"), *one), "distinct")
    groups = distinct.groupBy("g").agg(F.sum("n").alias("times"), F.count("*").alias("kinds")).where("times > 1").select("g", "kinds")
    met = written(distinct.join(groups, "g").select(F.col("g").alias("h"), F.col("d").alias("c"), "n", "before", "after", "context", "kinds"), "met")
    discard(contexts.sparkSession, distinct)
    if width == 1:
        marks = met.where("n > 1").select("h", "c", (-F.col("before")).alias("first"), F.col("after").alias("last"))
    else:
        marks = _solved(met.where(F.col("kinds") <= most), length, symbols)
        crowded = met.where(F.col("kinds") > most)
        if not crowded.isEmpty():
            marks = marks.unionByName(_in_runs(crowded, length, most, symbols, width // 4))
    of = runs.select(F.col("g").alias("run_h"), F.col("d").alias("run_c"), "h", "c")
    found = marks.select(F.col("h").alias("run_h"), F.col("c").alias("run_c"), "first", "last")
    return of.join(found, ["run_h", "run_c"]).select("h", "c", "first", "last")


def _solved(contexts: DataFrame, length: int, symbols: int) -> DataFrame:
    """Of a written table. Above a join by h, Spark leaves this repartition out, as the join has dealt by h already, and at run time may turn the join into one that reads its input by the task that wrote it (or split what is skewed): an anchor's contexts then lie in several tasks."""
    together = contexts.repartition("h").sortWithinPartitions("h").select("h", "c", "n", "before", "after", "context")
    return together.mapInArrow(_sorted_contexts(length, symbols), _FOUND)


def _cover(length: int):
    """Rows sorted by key and kind: strings to remove (kind 0), then the text. One row for each key: n_bytes, n_removed, n_spans, kept."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, spans, over = None, [], False
        for batch in small_batches(batches):
            out: list[tuple] = []
            for key, kind, low, high, text in zip(*(batch.column(k).to_pylist() for k in range(4)), as_bytes(batch.column(4)), strict=True):
                if key != now:
                    now, spans, over = key, [], False
                if kind == 0:
                    spans.append((low, high + length))
                elif not over:
                    over = True
                    kept, at, gone, count, end = [], 0, 0, 0, -1
                    for a, b in sorted(set(spans)):
                        if a > end:
                            kept.append(text[at:a])
                            count += 1
                            gone += b - a
                        elif b > end:
                            gone += b - end
                        end = at = max(end, b)
                    kept.append(text[at:])
                    out.append((key, len(text), gone, count, b"".join(kept)))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return cover


def cleaned_texts(documents: DataFrame, length: int = LENGTH, contexts: int = CONTEXTS, symbols: int = SYMBOLS) -> DataFrame:
    """One row for each distinct text: key (its MD5), n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    if length < 2 * SYMBOL + GRAM:
        raise ValueError("strings must be longer")
    spark = documents.sparkSession
    texts = documents.select(F.unhex(F.md5(text_or_empty().cast("binary"))).alias("key"), text_or_empty().alias("text"))
    found = written(texts.mapInArrow(_anchored(length), "key binary, place long, low long, high long, h long, c long"), "anchors")
    distinct = found.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("key", "place", "low", "high")).alias("one"))
    distinct = written(distinct.select("h", "c", "n", "one.*"), "contexts")
    release(spark)
    often = distinct.groupBy("h").agg(F.sum("n").alias("times"), F.count("*").alias("kinds")).where("times > 1").select("h", "kinds")
    wanted = written(distinct.join(often, "h"), "wanted")
    discard(spark, distinct)
    single = texts.where(F.length(F.col("text").cast("binary")) >= length).mapInArrow(_first_of_each, "key binary, text string")
    null = {c: F.lit(None).cast("long").alias(c) for c in ("place", "low", "high", "h", "c", "n", "kinds")}
    asked = wanted.select("key", F.lit(0).alias("kind"), "place", "low", "high", "h", "c", F.least("n", F.lit(2).cast("long")).alias("n"), "kinds", F.lit(None).cast("string").alias("text"))
    given = single.select("key", F.lit(1).alias("kind"), *null.values(), "text")
    cut = written(asked.unionByName(given).repartition("key").sortWithinPartitions("key", "kind").mapInArrow(_cut(length), "h long, c long, n long, before long, after long, context binary, kinds long"), "cut")
    release(spark)
    marks, crowded = _solved(cut.where(F.col("kinds") <= contexts), length, symbols), cut.where(F.col("kinds") > contexts)
    if not crowded.isEmpty():
        marks = marks.unionByName(_in_runs(crowded, length, contexts, symbols))
    marks = written(marks, "marks")
    discard(spark, wanted, cut)
    spans = found.join(marks, ["h", "c"]).select("key", F.lit(0).alias("kind"), (F.col("place") + F.col("first")).alias("low"), (F.col("place") + F.col("last")).alias("high"), F.lit(None).cast("string").alias("text"))
    single = texts.mapInArrow(_first_of_each, "key binary, text string").select("key", F.lit(1).alias("kind"), null["low"], null["high"], "text")
    return spans.unionByName(single).repartition("key").sortWithinPartitions("key", "kind").mapInArrow(_cover(length), "key binary, n_bytes long, n_removed long, n_spans long, kept binary")


def deduplicate(documents: DataFrame, length: int = LENGTH, contexts: int = CONTEXTS, symbols: int = SYMBOLS, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, and the kept bytes or (``digest``) their SHA-256."""
    cleaned = cleaned_texts(documents, length, contexts, symbols)
    last = F.sha2("kept", 256).alias("kept_sha256") if digest else F.col("kept")
    cleaned = cleaned.select("key", "n_bytes", "n_removed", "n_spans", last)
    keyed = documents.select("doc_id", F.unhex(F.md5(text_or_empty().cast("binary"))).alias("key"))
    return keyed.join(cleaned, "key").drop("key")


