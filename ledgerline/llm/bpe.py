"""Byte-level BPE: encoding with numpy matrices, and decoding.

A text is cut into pieces by the tokenizer's pattern. Distinct pieces that have not been met lately are
padded to the width of their length bucket and stacked. Each round finds every row's leftmost pair of least rank
(by a hash table of token pairs), merges it and closes the gap, so every row that is not done loses one
column. A piece longer than the widest bucket is a matrix of its own: its rows are stretches of the piece, each
with the least of its ranks, so that a round takes a row's work and not the whole piece's. Long texts are taken piece by piece.

Defined results: a null text is an empty one, which has no tokens; a null doc_id is carried through;
repeated rows each return a row; an empty table returns none; other columns are ignored (``encode``) or
kept (``with_tokens``).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import pieces as chunks
from .support import small_batches

WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128)
#: Cells of a row in the matrix of a long piece.
BLOCK = 512
#: Cells of a matrix; pieces kept with their ids by each worker.
MATRIX_CELLS, KEPT_PIECES = 1 << 18, 200_000
#: Characters from which on a text is encoded in parts.
LONG_TEXT = 1 << 20
NONE = np.iinfo(np.int32).max


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Tables:
    """A vocabulary's ranks as arrays: tokens' bytes, ids of single bytes, and a hash table of pairs that merge."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        size = max(ranks.values(), default=0) + 1
        self.vocabulary: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.single = np.full(256, -1, np.int32)
        for byte in range(256):
            self.single[byte] = ranks.get(bytes([byte]), -1)
        if (self.single < 0).any():
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        keys, values = np.array([k for k, _ in pairs], np.uint64), np.array([v for _, v in pairs], np.int32)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys, self.values = np.full((1 << self.bits) + 64, np.uint64(0xFFFFFFFFFFFFFFFF)), np.full((1 << self.bits) + 64, NONE, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):  # all that find their slot free move in (one for each slot); the rest try the next
            slot_free = self.keys[slot[left]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(slot[left], return_index=True)
            settles = np.zeros(len(left), bool)
            settles[first] = True
            settles &= slot_free
            at = left[settles]
            self.keys[slot[at]], self.values[slot[at]] = keys[at], values[at]
            left = left[~settles]
            slot[left] += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to; NONE where it does not merge (padding is negative and never does)."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] += 1
            found = self.keys[slot[open_]]
            out[open_] = np.where(found == keys[open_], self.values[slot[open_]], NONE)
            open_ = open_[(found != keys[open_]) & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out

    def matrix(self, rows: list[bytes], width: int) -> list[bytes]:
        """The ids (little-endian, 32 bits) of pieces of at most ``width`` bytes."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in rows), np.uint8).reshape(len(rows), width)
        ids = self.single[flat]
        ids[np.arange(width) >= lengths[:, None]] = -1
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        out, place = [b""] * len(rows), np.arange(len(rows))
        while len(place):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(place), np.int64)  # the leftmost of the least
            best = ranks[np.arange(len(place)), at] if ranks.shape[1] else np.full(len(place), NONE)
            done = best == NONE
            if done.any():
                kept = ids[done]
                full = (kept >= 0).sum(1)
                packed = kept.astype("<u4").tobytes()
                step = kept.shape[1] * 4
                for k, (row, n) in enumerate(zip(place[done].tolist(), full.tolist(), strict=True)):
                    out[row] = packed[k * step : k * step + n * 4]
                going = ~done
                ids, ranks, place, at, best = ids[going], ranks[going], place[going], at[going], best[going]
                if not len(place):
                    break
            row = np.arange(len(place))
            ids[row, at] = best
            stay = np.ones(ids.shape, bool)
            stay[row, at + 1] = False
            ids = ids[stay].reshape(len(place), -1)
            stay = np.ones(ranks.shape, bool)
            stay[row, at] = False
            ranks = ranks[stay].reshape(len(place), -1)
            if ranks.shape[1]:
                has = at > 0
                ranks[row[has], at[has] - 1] = self.pair_ranks(ids[row[has], at[has] - 1], ids[row[has], at[has]])
                has = at < ranks.shape[1]
                ranks[row[has], at[has]] = self.pair_ranks(ids[row[has], at[has]], ids[row[has], at[has] + 1])
        return out

    def long_piece(self, piece: bytes) -> bytes:
        """The same rounds for one piece that is a matrix itself: ``BLOCK`` cells a row, each row with the least of its ranks, so a round looks at the rows' least and at one row."""
        n, blocks = len(piece), -(-len(piece) // BLOCK)
        ids = np.full((blocks, BLOCK), -1, np.int32)
        ids.ravel()[:n] = self.single[np.frombuffer(piece, np.uint8)]
        flat = ids.ravel()[:n]
        ranks = np.full((blocks, BLOCK), NONE, np.int32)
        ranks.ravel()[: n - 1] = self.pair_ranks(flat[:-1], flat[1:])
        size = np.full(blocks, BLOCK)
        size[-1] = n - (blocks - 1) * BLOCK
        least, words, found = ranks.min(1), self.vocabulary, self.ranks.get
        # rows that have run empty are passed over
        after, before = list(range(1, blocks + 1)), list(range(-1, blocks - 1))

        def drop(row: int, cell: int) -> None:
            last = size[row] - 1
            ids[row, cell:last], ranks[row, cell:last] = ids[row, cell + 1 : last + 1].copy(), ranks[row, cell + 1 : last + 1].copy()
            ids[row, last], ranks[row, last] = -1, NONE
            size[row] = last
            if not last:
                up, down = before[row], after[row]
                if up >= 0:
                    after[up] = down
                if down < blocks:
                    before[down] = up

        def rank(one: int, two: int) -> int:
            return found(words[one] + words[two], NONE)

        while (best := least[row := int(least.argmin())]) != NONE:
            cell = int(ranks[row].argmin())  # the leftmost of the least
            ids[row, cell] = best
            if cell + 1 < size[row]:
                drop(row, cell + 1)
            else:
                drop(other := after[row], 0)
                least[other] = ranks[other].min()
            if cell + 1 < size[row]:
                ranks[row, cell] = rank(best, ids[row, cell + 1])
            else:
                ranks[row, cell] = rank(best, ids[after[row], 0]) if after[row] < blocks else NONE
            if cell:
                ranks[row, cell - 1] = rank(ids[row, cell - 1], best)
            elif (up := before[row]) >= 0:
                ranks[up, size[up] - 1] = rank(ids[up, size[up] - 1], best)
                least[up] = ranks[up].min()
            least[row] = ranks[row].min()
        return ids[ids >= 0].astype("<u4").tobytes()

    def pieces(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each piece."""
        out: list[bytes] = [b""] * len(distinct)
        held: dict[int, list[int]] = {}
        for k, piece in enumerate(distinct):
            if (rank := self.ranks.get(piece)) is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(piece) > WIDTHS[-1]:
                out[k] = self.long_piece(piece)
            else:
                held.setdefault(WIDTHS[np.searchsorted(WIDTHS, len(piece))], []).append(k)
        for width, at in held.items():
            rows = MATRIX_CELLS // width
            for low in range(0, len(at), rows):
                part = at[low : low + rows]
                for k, ids in zip(part, self.matrix([distinct[k] for k in part], width), strict=True):
                    out[k] = ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


class Encoder:
    """Encodes texts with a bounded memory of pieces it has met."""

    def __init__(self, tables: Tables) -> None:
        pattern = regex.compile(tables.pattern)
        self.tables, self.find, self.each, self.known = tables, pattern.findall, pattern.finditer, {}

    def _ids(self, cut: list[list[str]]) -> list[bytes]:
        fresh = list({piece for one in cut for piece in one if piece not in self.known})
        self.known.update(zip(fresh, self.tables.pieces([x.encode() for x in fresh]), strict=True))
        out = [b"".join(map(self.known.__getitem__, one)) for one in cut]
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a long text's pieces are taken some at a time."""
        if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
            found, parts = self.each(texts[0]), []
            while block := [m[0] for m in islice(found, LONG_TEXT >> 2)]:
                parts += self._ids([block])
            return [b"".join(parts)]
        return self._ids([self.find(text) for text in texts])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _tables(df: DataFrame, ranks_path: str | None, pattern: str | None):
    """Broadcast; a vocabulary's size does not follow the data."""
    return df.sparkSession.sparkContext.broadcast(Tables(read_ranks(ranks_path or default_ranks()), pattern or default_pattern()))


def encode(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit words), decoded_sha256 (of the bytes decoded from them)."""
    held = _tables(documents, ranks_path, pattern)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.value
        encoder = Encoder(tables)
        for batch in small_batches(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n, one, two = [], [], []
            for low, group in chunks(texts):
                for ids in encoder.encode(group):
                    n.append(len(ids) // 4)
                    one.append(hashlib.sha256(ids).hexdigest())
                    decoded, numbers = hashlib.sha256(), np.frombuffer(ids, "<u4")
                    for k in range(0, len(numbers), LONG_TEXT):
                        decoded.update(tables.decode(numbers[k : k + LONG_TEXT]))
                    two.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(coded, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_tokens(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None, column: str = "token_ids", verify: bool = False) -> DataFrame:
    """All columns, and the ids of ``text`` as an array of int (a column of that name is replaced). With ``verify``, the ids are decoded, and a difference from the text raises."""
    held = _tables(documents, ranks_path, pattern)
    columns = [c for c in documents.columns if c != column]
    rows = documents.select(F.struct(*columns).alias("row"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for batch in small_batches(batches):
            done = 0
            for _, group in chunks([x or "" for x in batch.column(0).field("text").to_pylist()]):
                ids = encoder.encode(group)
                if verify and (wrong := sum(encoder.tables.decode(np.frombuffer(x, "<u4")) != text.encode() for x, text in zip(ids, group, strict=True))):
                    raise ValueError(f"{wrong} texts do not come back from their ids")
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(group)), pa.ListArray.from_arrays(pa.array(offsets), values)], ["row", "ids"])
                done += len(group)

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(coded, f"row {kind}, ids array<int>").select("row.*", F.col("ids").alias(column))


def decode(rows: DataFrame, ranks_path: str | None = None, column: str = "token_ids", into: str = "decoded") -> DataFrame:
    """All columns, and the bytes that an array of ids stands for (null where it is null); an unknown id raises."""
    held = _tables(rows, ranks_path, None)
    packed = rows.select(F.struct(*rows.columns).alias("row"))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.value
        for batch in small_batches(batches):
            ids = batch.column(0).field(column).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else tables.decode(np.array(x, np.int64)) for x in ids], pa.binary())], ["row", "bytes"])

    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(back, f"row {kind}, bytes binary").select("row.*", F.col("bytes").alias(into))
