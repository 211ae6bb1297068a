import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe

from . import brute

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "  a", "a  \n\n b", "\x1c\x1d x\x85y z ", "don't I'LL we've", "x" * 3000, "ab" * 700 + " " * 300, "١٢٣ ４５", "漢字かな🙂🙂👨‍👩‍👧", "<|endoftext|>", "​﻿é é", "a\x00b", "\r\n\t\v\f", "ǅǈ ªº ⅷ²"]


@pytest.fixture(scope="module")
def tables():
    return bpe.Tables(RANKS, public_tokenizers.PATTERN)


def test_pieces_equal_the_library(tables):
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("abcdefé \n1漢'!") for _ in range(r.randint(1, 90))) for _ in range(2000)]
    got = bpe.Encoder(tables).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(text), text
        assert tables.decode(np.frombuffer(ids, "<u4")) == text.encode()


def test_long_text_in_parts(tables, monkeypatch):
    text = "".join(ODD) * 3
    monkeypatch.setattr(bpe, "LONG_TEXT", 64)
    assert np.frombuffer(bpe.Encoder(tables).encode([text])[0], "<u4").tolist() == REFERENCE.encode_ordinary(text)


def test_long_pieces_equal_the_matrix(tables):
    r = random.Random(2)
    for n in (1, 2, 3, 60, 128):
        for _ in range(60):
            piece = bytes(r.choice(b"abertion\xc3\xa9") for _ in range(n))
            if piece not in RANKS:
                assert tables.matrix([piece], 128 if n > 1 else 2)[0] == tables.long_piece(piece)


def test_query(spark):
    rows = brute.documents(60) + [(None, x, None, None, None, "", "") for x in ODD]
    frame = spark.createDataFrame(rows, brute.SCHEMA)
    want = []
    for r in rows:
        ids = REFERENCE.encode_ordinary(r[1] or "")
        want.append((r[0] or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(r[1] or "")))
    got = [(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(frame).collect()]
    assert sorted(got) == sorted(want)
    back = bpe.decode(bpe.with_tokens(frame))
    assert back.columns == [*frame.columns, "token_ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back.collect())
    assert bpe.encode(frame.limit(0)).count() == 0 and bpe.with_tokens(frame.limit(0)).count() == 0
