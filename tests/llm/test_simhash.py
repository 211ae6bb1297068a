import random

import numpy as np
from itertools import combinations

import pytest
import xxhash

from ledgerline.llm import simhash

from . import brute


def plain(text):
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", brute.lowered(text))]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_long_text_in_blocks():
    text = " ".join(f"w{i % 977}\t" for i in range(3000))
    blocks = list(simhash.word_blocks(text.encode(), 50))
    assert len(blocks) > 50 and [w for b in blocks for w in b] == text.encode().split()
    whole = simhash.fingerprint(text.encode())
    before, simhash.word_blocks.__defaults__ = simhash.word_blocks.__defaults__, (50,)
    try:
        assert simhash.fingerprint(text.encode()) == whole == plain(text)
    finally:
        simhash.word_blocks.__defaults__ = before


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_equals_brute_force(spark, bucket_rows):
    rows = brute.documents()
    prints = [plain(r[1]) for r in rows]
    roots = brute.roots(len(rows), [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    expected = sorted((rows[i][0], f"{prints[i]:016x}", min(rows[j][0] for j in range(len(rows)) if roots[j] == roots[i])) for i in range(len(rows)))
    out = simhash.near_duplicates(spark.createDataFrame(rows, brute.SCHEMA).repartition(5), bucket_rows=bucket_rows)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()) == expected


def test_empty_and_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    rows = [(None, "same words in both of them", None, None, None, "", ""), (7, "same words in both of them", None, None, None, "", "")]
    frame = spark.createDataFrame(rows, brute.SCHEMA)
    assert {r.component_id for r in simhash.near_duplicates(frame).collect()} == {7}
    assert simhash.deduplicate(frame).count() == 2


def test_one_stays_of_each_group(spark):
    frame = spark.createDataFrame(brute.documents(), brute.SCHEMA)
    kept = simhash.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in simhash.similar_groups(frame).collect()})


def near_copies(seed=4):
    """Texts and copies of them with words changed here and there, or a stretch replaced; some are just below the threshold."""
    r = random.Random(seed)
    words = lambda k: ["".join(r.choice("abcdefghijk") for _ in range(5)) for _ in range(k)]
    texts = [None, "", " \t", "one two", "One TWO", "one two three"]
    for _ in range(40):
        base = words(r.randint(60, 300))
        texts.append(" ".join(base))
        for k in range(r.randint(0, 3)):
            copy = list(base)
            if k % 2:
                at = r.randrange(len(copy) - 20)
                copy[at : at + len(copy) // r.choice([12, 20, 40])] = words(4)
            else:
                for _ in range(max(1, len(copy) // r.choice([25, 50, 80, 120]))):
                    copy[r.randrange(len(copy))] = r.choice(words(1))
            texts.append(" ".join(copy))
    return [(i, t) for i, t in enumerate(texts)] + [(5000 + i, t) for i, t in enumerate(texts[10:20])] + [(None, texts[12])]


def test_similar_groups_equal_brute_force(spark):
    rows = near_copies()
    sets = [brute.shingles(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if brute.jaccard(sets[a], sets[b]) >= 0.8]
    assert any(0.8 <= brute.jaccard(sets[a], sets[b]) < 0.9 for a, b in pairs)
    groups = brute.roots(len(rows), pairs)
    least = [min((rows[j][0] for j in range(len(rows)) if groups[j] == g and rows[j][0] is not None), default=None) for g in groups]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for bucket_rows in (simhash.BUCKET_ROWS, 4):
        got = sorted(((r.doc_id, r.component_id) for r in simhash.similar_groups(frame, found=0.9999, bucket_rows=bucket_rows).collect()), key=str)
        assert got == sorted(zip([r[0] for r in rows], least, strict=True), key=str)
    kept = [r.doc_id for r in simhash.deduplicate(frame, found=0.9999).collect()]
    assert sorted(map(str, kept)) == sorted(str(r[0]) for r, x in zip(rows, least, strict=True) if r[0] is None or r[0] == x)
    assert simhash.similar_groups(frame.limit(0)).count() == 0


def test_chance_of_a_meeting():
    """Fingerprints of sets at the threshold meet as often as the plan reckons."""
    r = np.random.default_rng(1)
    bits, segments = 20, 200
    near = []
    for _ in range(40):
        grams = r.integers(0, 1 << 63, 900).astype(np.uint64)
        a, b = (simhash.wide_fingerprint(x, bits * segments // 64 + 1) for x in (grams[:810], grams[90:]))  # Jaccard 0.8
        differ = np.unpackbits((a ^ b).view(np.uint8))[: bits * segments].reshape(segments, bits).sum(1)
        near.append(np.mean(differ <= 1))
    assert abs(np.mean(near) - simhash.chance(bits, 0.8)) < 0.02


def expected_groups(rows):
    sets = [brute.shingles(t) for _, t in rows]
    groups = brute.roots(len(rows), [(a, b) for a, b in combinations(range(len(rows)), 2) if brute.jaccard(sets[a], sets[b]) >= 0.8])
    return [min(rows[j][0] for j in range(len(rows)) if groups[j] == g) for g in groups]


@pytest.mark.parametrize("bucket_rows", [4096, 4])
def test_no_link_is_lost_that_fingerprints_miss(spark, bucket_rows):
    """One segment finds few pairs; texts around the threshold also make the comparison refuse branches of a forest."""
    r = random.Random(8)
    rows = [x for x in near_copies(11) if x[0] is not None]
    shared = " ".join(f"line{i}" for i in range(40))
    for k in range(12):
        base = [f"{k}w{r.randrange(50)}" for _ in range(80)]
        for j in range(5):
            copy = list(base)
            for _ in range(j):
                copy[r.randrange(80)] = f"new{r.random()}"
            rows.append((9000 + 10 * k + j, shared + " " + " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame, found=0.05, bucket_rows=bucket_rows).collect()}
    assert got == dict(zip([x[0] for x in rows], expected_groups(rows), strict=True))
    assert len(set(got.values())) < len({t for _, t in rows}) - 20


def test_links_behind_one_fingerprint(spark, monkeypatch):
    """Texts of one fingerprint are compared with each other too, not only with the one that stands for it."""
    monkeypatch.setattr(simhash, "wide_fingerprint", lambda grams, words: np.zeros(words, np.uint64))
    rows = [x for x in near_copies(12) if x[0] is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    assert got == dict(zip([x[0] for x in rows], expected_groups(rows), strict=True))


def test_near_dedup_of_few_rows_writes_few_files(spark, monkeypatch):
    """However wide the shuffle is, a table of some rows is a file or two; 60 partitions made up to 60 files of each table."""
    rows = [x for x in near_copies(13) if x[0] is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(60)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, files = {k: spark.conf.get(k) for k in held}, {}

    def counted(df, name, *args, **more):
        out = written(df, name, *args, **more)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    written = simhash.written
    monkeypatch.setattr(simhash, "written", counted)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = simhash.deduplicate(frame)
        assert out.rdd.getNumPartitions() == 1
        got = sorted(r.doc_id for r in out.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(set(expected_groups(rows)))
    assert len(files) >= 15 and max(files.values()) == 1
