import random

import numpy as np
import pytest

from ledgerline.llm import support as su

from . import brute


@pytest.mark.parametrize("kind", ["random", "chain", "hub"])
def test_components(spark, kind):
    r = random.Random(kind)
    n = 120
    if kind == "chain":
        ids = r.sample(range(10_000), n)
        pairs = list(zip(ids, ids[1:], strict=False))
    elif kind == "hub":
        pairs = [(5000, k) for k in range(n)] + [(9000, 9001)]
    else:
        pairs = [(r.randrange(n), r.randrange(n)) for _ in range(90)]
    names = sorted({x for p in pairs if p[0] != p[1] for x in p})
    place = {x: i for i, x in enumerate(names)}
    want = {x: names[g] for x, g in zip(names, brute.roots(len(names), [(place[a], place[b]) for a, b in pairs if a != b]), strict=True)}
    edges = spark.createDataFrame(pairs, "src long, dst long").repartition(4)
    assert {r.node: r.component for r in su.components(edges).collect()} == want


    before = su.new_path
    names = []
    try:
        su.new_path = lambda session, name: names.append(name) or before(session, name)
        assert {r.node: r.component for r in su.components(edges, few=len(pairs)).collect()} == want
    finally:
        su.new_path = before
    assert len(names) == 2  # the forests, and all of them joined


def test_short_tables_have_few_files(spark):
    frame = spark.range(5000).repartition(40)
    files = lambda df: len(df.inputFiles())
    assert files(su.written(frame, "wide")) == 40
    for work in (False, True):
        out = su.written(frame, "few", rows=5000, work=work)
        assert files(out) == 2 and sorted(r.id for r in out.collect()) == list(range(5000))
    assert files(su.written(frame, "long", rows=10**9)) == files(su.written(frame, "long", rows=10**9, work=True)) == 40


def test_no_edges(spark):
    assert su.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_words_and_hashes():
    texts = [b"", b"One two  one", b"\tx", "é漢 ONE".encode()]
    found = su.Words(texts, su.SPACED, lower=True)
    words = [found.joined[a:b] for a, b in zip(found.starts, found.ends, strict=True)]
    assert words == [w for t in texts for w in t.lower().split()]
    assert found.first.tolist() == [0, 0, 3, 4, 6] and found.document_of().tolist() == [1, 1, 1, 2, 3, 3] and found.room().tolist() == [3, 2, 1, 1, 2, 1]
    hashes = found.hashes()
    assert hashes[0] == hashes[2] == hashes[5] and len(set(hashes.tolist())) == 4


def test_long_buffers_hash_alike():
    words = [f"w{i % 5000}".encode() for i in range(500_000)]
    found = su.Words([b" ".join(words)], su.SPACED, lower=False)
    assert len(found.data) > 1 << 21
    hashes = found.hashes(1)
    assert (hashes[:5000] == hashes[-5000:]).all() and len(np.unique(hashes)) == 5000


def test_pieces():
    assert list(su.pieces([b"aa", b"b", b"cccc", b"d"], 3)) == [(0, [b"aa", b"b"]), (2, [b"cccc"]), (3, [b"d"])]
