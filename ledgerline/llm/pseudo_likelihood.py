"""Document scores by masked pseudo-likelihood.

A network predicts a masked token from both sides: the embeddings of the two tokens before and the two
after it, each in its own place, and the mean embedding of ``REACH`` tokens on either side; one tanh layer;
a softmax in two levels (a class of tokens, then the token within). A document's score is the sum over all
its tokens of the log-probability of each given its two sides.

Tokens are words between ASCII white space, A-Z lowered. Words are counted over the whole corpus in a
shuffle; the ``VOCABULARY`` - 1 most frequent ones (ties: the smaller hash) are tokens of their own, numbered
by frequency. Any other word is the token ``other`` and is spelled: its probability is that of ``other`` times
that of its bytes, each given the byte before, as counted in the corpus's other words. So all words have
probabilities of their own, which add up to one.

Every token of every document is a target of the fit, once. Documents are cut into segments of up to
``SEGMENT`` tokens (each carries the tokens around it, so no context is lost). A hash of document and segment
deals each segment to a round and to a copy of the network, and copies are as many as the counted
tokens call for. In a round, each copy learns by Adagrad on its segments in the order of their hash, and the copies'
mean, weighted by what each has seen, starts the next round. So the model does not depend on how rows lie in
files or partitions. The mean is formed by chunks of the weights in a shuffle: the driver gets one model.

Defined results: a null or wordless text has no tokens, the score 0 and a null mean; a very long text is cut
into segments in the fit and into strips in scoring, with the same scores as in one piece; a null doc_id is
carried through; repeated rows each count and each return a row; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import SPACED, Words, as_bytes, discard, mix, pieces, release, small_batches, written

#: Classes of the softmax: so many of so many tokens each, frequent tokens first; frequent classes are small, so the mean cost of a token is low.
CLASS_SIZES = ((16, 8), (16, 16), (16, 64), (16, 424))
EDGES = np.cumsum([0] + [size for many, size in CLASS_SIZES for _ in range(many)])
CLASSES, VOCABULARY = len(EDGES) - 1, int(EDGES[-1])
#: Tokens around a place: those with a place of their own on each side, and those in the mean on each side.
NEAR, REACH = 2, 8
EMBEDDING, HIDDEN = 10, 20
#: Tokens of a segment, of a minibatch, and of all that one copy of the network learns from; times that copies are averaged.
SEGMENT, BATCH, COPY_TOKENS, ROUNDS = 2048, 3072, 2_000_000, 2
RATE = 0.3
#: Places that are scored at a time.
STRIP = 4096
_NONE = VOCABULARY  # what stands beyond either end of a document
_SHAPES = {"embed": (VOCABULARY + 1, EMBEDDING), "w1": ((2 * NEAR + 1) * EMBEDDING, HIDDEN), "b1": (HIDDEN,), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "ww": (VOCABULARY, HIDDEN), "bw": (VOCABULARY,)}
_CLASS = np.repeat(np.arange(CLASSES), np.diff(EDGES))
_CHUNK = 16_384
#: Rows of weights that a step takes at a time, so that they stay in the cache.
_ROWS = 1024


# ---------------------------------------------------------------------------------------------
# The network


def _sums(x: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` consecutive rows."""
    total = np.zeros((len(x) + 1, x.shape[1]))
    np.cumsum(x, axis=0, out=total[1:])
    return (total[width:] - total[:-width]).astype(np.float32)


def _by_token(tokens: np.ndarray) -> np.ndarray:
    """A stable order; numpy sorts 16-bit numbers by radix."""
    return np.argsort(tokens.astype(np.uint16), kind="stable")


class Network:
    """Works on strips: token numbers of one or more documents, ``REACH`` times ``_NONE`` around each."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 1) -> Network:
        """Small random weights, and biases that give the corpus's frequencies. counts: of tokens by number."""
        r = np.random.default_rng(seed)
        scale = {"embed": 0.3, "w1": 1 / np.sqrt(_SHAPES["w1"][0]), "wc": 0.1 / np.sqrt(HIDDEN), "ww": 0.1 / np.sqrt(HIDDEN)}
        w = {k: (r.standard_normal(s) * scale.get(k, 0)).astype(np.float32) for k, s in _SHAPES.items()}
        w["embed"][_NONE] = 0
        p = counts + 0.5
        of_class = np.add.reduceat(p, EDGES[:-1])
        w["bc"] = np.log(of_class / p.sum()).astype(np.float32)
        w["bw"] = np.log(p / of_class[_CLASS]).astype(np.float32)
        return cls(w)

    @classmethod
    def unpacked(cls, flat: np.ndarray) -> Network:
        w, at = {}, 0
        for k, s in _SHAPES.items():
            n = int(np.prod(s))
            w[k] = flat[at : at + n].reshape(s).astype(np.float32)
            at += n
        return cls(w)

    def packed(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in _SHAPES])

    def _inputs(self, strip: np.ndarray) -> np.ndarray:
        """For each place but the outer ``REACH`` on either end: near embeddings, and the mean over both sides."""
        e, n = self.w["embed"].take(strip, axis=0), len(strip) - 2 * REACH
        x = np.empty((n, 2 * NEAR + 1, EMBEDDING), np.float32)
        shifts = [s for s in range(-NEAR, NEAR + 1) if s]
        for k, s in enumerate(shifts):
            x[:, k] = e[REACH + s : REACH + s + n]
        x[:, -1] = (_sums(e, 2 * REACH + 1) - e[REACH : REACH + n]) / (2 * REACH)
        return x.reshape(n, -1)

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        h = x @ self.w["w1"]
        h += self.w["b1"]
        return np.tanh(h, out=h)

    def factors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a softmax's sum takes: the words' weights, a column each, and the factors that the biases of classes and words are in their terms."""
        return np.ascontiguousarray(self.w["ww"].T), np.exp(self.w["bc"]), np.exp(self.w["bw"])

    def log_probability(self, strip: np.ndarray, factors: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Of each place but the outer ``REACH`` on either end; 0 for places that hold no token."""
        out = np.zeros(len(strip) - 2 * REACH)
        x, token = self._inputs(strip), strip[REACH:-REACH]
        order = _by_token(token)
        order = order[: np.searchsorted(token, _NONE, sorter=order)]
        w, t = self.w, token[order]
        h = self._hidden(x).take(order, axis=0)
        columns, of_class, of_word = factors or self.factors()
        one, two = np.exp(h @ w["wc"]) @ of_class, np.empty(len(t), np.float32)  # logits are small, as |h| < 1
        cuts = np.searchsorted(t, EDGES)
        for k in np.flatnonzero(np.diff(cuts)):
            a, b, low, high = cuts[k], cuts[k + 1], EDGES[k], EDGES[k + 1]
            e = h[a:b] @ columns[:, low:high]
            two[a:b] = np.exp(e, out=e) @ of_word[low:high]
        logits = np.einsum("ij,ij->i", h, np.ascontiguousarray(w["wc"].T).take(_CLASS[t], axis=0)) + w["bc"][_CLASS[t]], np.einsum("ij,ij->i", h, w["ww"].take(t, axis=0)) + w["bw"][t]
        out[order] = (logits[0] - np.log(one)).astype(np.float64) + (logits[1] - np.log(two))
        return out

    def learn(self, strip: np.ndarray, target: np.ndarray, squares: dict[str, np.ndarray], rate: float) -> None:
        """One step of Adagrad. target: places of the strip to predict."""
        token, w = strip[target], self.w
        order = _by_token(token)
        target, token = target[order], token[order]
        x, n = self._inputs(strip), len(token)
        h = self._hidden(x).take(target - REACH, axis=0)
        with_one = np.concatenate([h, np.ones((n, 1), np.float32)], axis=1)  # the last column is for biases
        columns, of_class, of_word = self.factors()

        def spread(a: int, b: int, columns: np.ndarray, scaled: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of the logarithm of the softmax's sum: the gradient by h; that by weights and bias, over their factor, a column each (a mean over all n)."""
            e = h[a:b] @ columns
            np.exp(e, out=e)
            part = 1 / (e @ factor)[:, None]
            return (e @ scaled) * part, (with_one[a:b] * (part / n)).T @ e

        g = {}
        classes, cuts = _CLASS[token], np.searchsorted(token, EDGES)
        some = np.flatnonzero(np.diff(cuts))
        wc = np.ascontiguousarray(w["wc"].T)
        dh, d = spread(0, n, w["wc"], wc * of_class[:, None], of_class)
        dh -= wc.take(classes, axis=0)
        d *= of_class
        head = np.flatnonzero(np.diff(token, prepend=-1))
        own = np.add.reduceat(with_one, head) / n  # by word
        d[:, some] -= np.add.reduceat(own, np.searchsorted(token[head], EDGES)[some]).T
        g["wc"], g["bc"] = d[:-1], d[-1]
        scaled, d = w["ww"] * of_word[:, None], np.zeros((HIDDEN + 1, VOCABULARY), np.float32)
        for k in some:
            a, b, at = cuts[k], cuts[k + 1], slice(EDGES[k], EDGES[k + 1])
            part, d[:, at] = spread(a, b, columns[:, at], scaled[at], of_word[at])
            dh[a:b] += part
        d *= of_word
        dh -= w["ww"].take(token, axis=0)
        words = {"ww": np.ascontiguousarray(d[:-1].T), "bw": d[-1]}
        words["ww"][token[head]] -= own[:, :-1]
        words["bw"][token[head]] -= own[:, -1]
        for name, v in words.items():
            for low in range(0, VOCABULARY, _ROWS):
                at = slice(low, low + _ROWS)
                self._step(name, v[at], squares, rate, at)
        dz = np.zeros((len(x), HIDDEN), np.float32)  # by place, and 0 where there is no target
        dz[target - REACH] = dh * (1 - h * h)
        dx = (dz @ w["w1"].T).reshape(-1, 2 * NEAR + 1, EMBEDDING)
        g["w1"], g["b1"] = x.T @ dz / n, dz.sum(0) / n
        for k, v in g.items():
            self._step(k, v, squares, rate)
        de, m = np.zeros((len(strip), EMBEDDING), np.float32), len(dx)
        for k, s in enumerate(s for s in range(-NEAR, NEAR + 1) if s):
            de[REACH + s : REACH + s + m] += dx[:, k]
        mean = dx[:, -1] / (2 * REACH)
        de += _sums(np.concatenate([around := np.zeros((2 * REACH, EMBEDDING), np.float32), mean, around]), 2 * REACH + 1)
        de[REACH : REACH + m] -= mean
        order = _by_token(strip)
        order = order[: np.searchsorted(strip, _NONE, sorter=order)]
        held = strip[order]
        head = np.flatnonzero(np.diff(held, prepend=-1))
        self._step("embed", np.add.reduceat(de.take(order, axis=0), head) / n, squares, rate, held[head])

    def _step(self, name: str, gradient: np.ndarray, squares: dict[str, np.ndarray], rate: float, at=slice(None)) -> None:
        move = gradient * gradient
        squares[name][at] += move
        np.sqrt(squares[name][at], out=move)
        move += 1e-6
        np.divide(rate * gradient, move, out=move)
        self.w[name][at] -= move


# ---------------------------------------------------------------------------------------------
# Words


def count_words(documents: DataFrame) -> DataFrame:
    """h (a word's hash), n: how often it stands in the corpus. Tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_n, waiting = [], [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            h, at = np.unique(np.concatenate(held_h), return_inverse=True)
            return h, np.bincount(at, np.concatenate(held_n)).astype(np.int64)

        for batch in small_batches(batches):
            for _, texts in pieces(x or b"" for x in as_bytes(batch.column(0))):
                h, n = np.unique(Words(texts, SPACED, lower=True).hashes(), return_counts=True)
                held_h.append(h)
                held_n.append(n)
                waiting += len(h)
                if waiting > 2_000_000:
                    h, n = added()
                    held_h, held_n, waiting = [h], [n], len(h)
                    if waiting > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])
                        held_h, held_n, waiting = [], [], 0
        if held_h:
            h, n = added()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return documents.select(F.col("text").cast("string")).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Numbers of words by hash; 0 is ``other``. A table by a hash's first ``BITS`` bits tells where to look."""

    BITS = 17

    def __init__(self, hashes: np.ndarray) -> None:
        """hashes: of the words 1, 2, ... by falling frequency."""
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.numbers = hashes[order], (order + 1).astype(np.int64)
        place = np.searchsorted(self.hashes, np.arange(1 << self.BITS, dtype=np.uint64) << np.uint64(64 - self.BITS))
        many = np.diff(place, append=len(hashes))
        self.first, self.crowded, self.most = np.minimum(place, max(len(hashes) - 1, 0)).astype(np.int32), many > 1, int(many.max())

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int32)
        at = self.first[slot]
        out = np.where(self.hashes[at] == hashes, self.numbers[at], 0)
        rest = np.flatnonzero(self.crowded[slot] & (out == 0))
        for step in range(1, self.most):  # words whose hashes begin alike
            more = np.minimum(at[rest] + step, len(self.hashes) - 1)
            out[rest] += np.where(self.hashes[more] == hashes[rest], self.numbers[more], 0) * (out[rest] == 0)
        return out


def vocabulary(documents: DataFrame, size: int = VOCABULARY) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and how often each number stands in the corpus."""
    counted = written(count_words(documents), "words")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counted.orderBy(F.desc("n"), "h").limit(size - 1).toArrow()  # a bounded number of rows
    counts = np.zeros(size, np.int64)
    counts[1 : top.num_rows + 1] = top["n"].to_numpy()
    counts[0] = total - counts.sum()
    discard(documents.sparkSession, counted)
    return Vocabulary(top["h"].to_numpy().view(np.uint64)), counts


def spelling(found: Words, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the bytes and the end of each word in ``other``: the byte before, the byte (256: begin, end), the word's place in ``other``."""
    length = found.ends[other] - found.starts[other] + 1
    word = np.repeat(np.arange(len(other), dtype=np.int32), length)
    last = np.cumsum(length)
    begin = last - length
    at = np.arange(len(word)) + np.repeat(found.starts[other] - begin, length)
    data = np.append(found.data, np.uint8(0)).astype(np.int32)
    before, byte = data[at - 1], data[at]
    before[begin], byte[last - 1] = 256, 256
    return before, byte, word


# ---------------------------------------------------------------------------------------------
# The fit


def segments(tokens: np.ndarray, segment: int = SEGMENT) -> Iterator[np.ndarray]:
    """Pieces of one document, with ``REACH`` places around each."""
    padded = np.concatenate([np.full(REACH, _NONE), tokens, np.full(REACH, _NONE)])
    for low in range(0, len(tokens), segment):
        yield padded[low : min(low + segment, len(tokens)) + 2 * REACH]


def dealt(documents: DataFrame, words: Vocabulary) -> DataFrame:
    """kind 0: key (a hash of document and segment), part (the segment's tokens); kind 1: partial counts of byte pairs in other words (key, part: eight bytes)."""
    held = documents.sparkSession.sparkContext.broadcast(words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of, pairs = held.value, np.zeros(257 * 257, np.int64)
        for batch in small_batches(batches):
            ids = batch.column(0).to_numpy().view(np.uint64)
            keys, parts = [], []
            for first, texts in pieces(x or b"" for x in as_bytes(batch.column(1))):
                found = Words(texts, SPACED, lower=True)
                numbers = number_of(found.hashes())
                before, byte, _ = spelling(found, np.flatnonzero(numbers == 0))
                pairs += np.bincount(before * 257 + byte, minlength=257 * 257)
                for k, (low, high) in enumerate(zip(found.first, found.first[1:], strict=False)):
                    for turn, part in enumerate(segments(numbers[low:high])):
                        keys.append((int(ids[first + k]) + turn * 0x9E3779B97F4A7C15) % 2**64)
                        parts.append(part.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), pa.array(mix(np.array(keys, np.uint64)).view(np.int64)), pa.array(parts, pa.binary())], ["kind", "key", "part"])
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(some), np.int32)), pa.array(some), pa.array([pairs[k].tobytes() for k in some], pa.binary())], ["kind", "key", "part"])

    return documents.select(F.xxhash64("doc_id", "text"), F.col("text").cast("string")).mapInArrow(cut, "kind int, key long, part binary")


def byte_chances(parts: DataFrame) -> np.ndarray:
    """Log-probability of each byte (256: the end) given the one before (256: the beginning)."""
    rows = parts.where("kind = 1").select("key", "part").mapInArrow(_numbers, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # 257 squared rows at most
    counts = np.full(257 * 257, 0.1)
    counts[rows["key"].to_numpy()] += rows["n"].to_numpy()
    counts = counts.reshape(257, 257)
    return np.log(counts / counts.sum(1, keepdims=True))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int.from_bytes(x, "little") for x in batch.column(1).to_pylist()], pa.int64())], ["key", "n"])


def _train(held, batch_size: int, rate: float):
    """From (copy, key, part), sorted: chunks (chunk, weight, packed sums) of the weights of the copies that a task has trained."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = held.value
        total, seen_by_all = np.zeros(len(start)), 0
        now, net, squares, seen, strips, waiting = None, None, {}, 0, [], 0

        def step() -> None:
            nonlocal strips, waiting, seen
            strip = np.concatenate(strips)
            # a segment's outer places belong to its neighbours
            inner, at = np.ones(len(strip), bool), 0
            for x in strips:
                inner[at : at + REACH] = inner[at + len(x) - REACH : at + len(x)] = False
                at += len(x)
            net.learn(strip, np.flatnonzero(inner), squares, rate)
            seen += waiting
            strips, waiting = [], 0

        def close() -> None:
            nonlocal total, seen_by_all, seen
            if waiting:
                step()
            if seen:
                total += net.packed().astype(np.float64) * seen
                seen_by_all += seen
            seen = 0

        for batch in batches:
            for copy, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if copy != now:
                    if now is not None:
                        close()
                    now, net = copy, Network.unpacked(start)
                    squares = {k: np.full(v.shape, 1e-4, np.float32) for k, v in net.w.items()}
                strip = np.frombuffer(part, "<u2").astype(np.int64)
                strips.append(strip)
                waiting += len(strip) - 2 * REACH
                if waiting >= batch_size:
                    step()
        if now is not None:
            close()
        if seen_by_all:
            parts = [total[k : k + _CHUNK].tobytes() for k in range(0, len(total), _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), pa.array(np.full(len(parts), seen_by_all, np.int64)), pa.array(parts, pa.binary())], ["chunk", "weight", "part"])

    return train


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each chunk."""
    sums: dict[int, np.ndarray] = {}
    weights: dict[int, int] = {}
    for batch in batches:
        for chunk, weight, part in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            values = np.frombuffer(part, np.float64)
            sums[chunk] = sums[chunk] + values if chunk in sums else values
            weights[chunk] = weights.get(chunk, 0) + weight
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(weights.values()), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "weight", "part"])


_PART = "chunk int, weight long, part binary"


def fit(parts: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, copy_tokens: int = COPY_TOKENS, batch_size: int = BATCH, rate: float = RATE) -> Network:
    """From the segments of all documents (``dealt``); each is learned from in one of the rounds."""
    net, spark = Network.start(counts), parts.sparkSession
    copies = max(1, -(-int(counts.sum()) // copy_tokens))
    turn = F.pmod(F.shiftrightunsigned("key", 32), F.lit(rounds))
    for k in range(rounds):
        held = spark.sparkContext.broadcast(net.packed())
        mine = parts.where("kind = 0").where(turn == k).select(F.pmod("key", F.lit(copies)).alias("copy"), "key", "part")
        sums = mine.repartition("copy").sortWithinPartitions("copy", "key", "part").mapInArrow(_train(held, batch_size, rate), _PART)
        # square root of the number of tasks in each sum, so neither step has many rows for one chunk
        near = sums.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(32))).repartition("chunk", "lane").select("chunk", "weight", "part").mapInArrow(_added, _PART)
        rows = near.repartition("chunk").mapInArrow(_added, _PART).toArrow().sort_by("chunk")
        if rows.num_rows:
            net = Network.unpacked(np.concatenate([np.frombuffer(x, np.float64) / w for x, w in zip(rows["part"].to_pylist(), rows["weight"].to_pylist(), strict=True)]))
        held.unpersist()
        release(spark)
    return net


# ---------------------------------------------------------------------------------------------
# Scores


def score(documents: DataFrame, net: Network, words: Vocabulary, chances: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, log_probability (summed), mean_log_probability."""
    held = documents.sparkSession.sparkContext.broadcast((net.packed(), words, chances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, number_of, of_byte = held.value
        own = Network.unpacked(flat)
        factors = own.factors()
        for batch in small_batches(batches):
            sums, sizes = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, texts in pieces((x or b"" for x in as_bytes(batch.column(1))), 1 << 17):
                found = Words(texts, SPACED, lower=True)
                numbers, owner = number_of(found.hashes()), found.document_of()
                sizes[first : first + len(texts)] = np.diff(found.first)
                other = np.flatnonzero(numbers == 0)
                before, byte, word = spelling(found, other)
                sums[first : first + len(texts)] += np.bincount(owner[other][word], of_byte.ravel()[before * 257 + byte], len(texts))
                # a strip of all documents, with places between them
                spot = np.arange(len(numbers)) + REACH * (owner + 1)
                strip = np.full(len(numbers) + REACH * (len(texts) + 1), _NONE)
                strip[spot] = numbers
                values = np.concatenate([np.zeros(0), *(own.log_probability(strip[low : low + STRIP + 2 * REACH], factors) for low in range(0, len(strip) - 2 * REACH, STRIP))])
                sums[first : first + len(texts)] += np.bincount(owner, values[spot - REACH], len(texts))
            means = [x / k if k else None for x, k in zip(sums.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(sums), pa.array(means, pa.float64())], ["doc_id", "n_tokens", "log_probability", "mean_log_probability"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n_tokens long, log_probability double, mean_log_probability double")


def trained(documents: DataFrame, **options) -> tuple[Network, Vocabulary, np.ndarray]:
    """What ``score`` needs, from all documents."""
    words, counts = vocabulary(documents)
    parts = written(dealt(documents, words), "segments")
    out = fit(parts, counts, **options), words, byte_chances(parts)
    discard(documents.sparkSession, parts)
    return out


def pseudo_likelihood(documents: DataFrame, **options) -> DataFrame:
    return score(documents, *trained(documents, **options))
