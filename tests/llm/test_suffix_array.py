import random
import time

import pytest

from ledgerline.llm import suffix_array as sa

from . import brute


def test_order_of_suffixes():
    r = random.Random(4)
    for n in range(1, 400):
        text = [r.randrange(1, r.choice([2, 3, 9, 90])) if n % 7 else 1 for _ in range(n)] + [0]
        text = [max(1, x) for x in text[:-1]] + [0]
        assert sa.suffix_array(text) == sorted(range(n + 1), key=lambda i: text[i:])


def test_time_is_linear():
    r = random.Random(1)
    took = []
    for n in (20_000, 80_000):
        text = [r.randrange(1, 5000) for _ in range(n)] + [0]
        began = time.time()
        sa.suffix_array(text)
        took.append(time.time() - began)
    assert took[1] < 10 * took[0] + 0.5


def rows():
    r = random.Random(9)
    line = lambda n: "".join(r.choice("ab é漢\n") for _ in range(n))
    passage = [line(500), line(390), line(700)]
    texts = [None, "", line(399), "a" * 1500, line(3000), passage[0], passage[0] + line(5)]
    for k in range(60):
        texts.append(line(r.randrange(300)) + passage[k % 3] + line(r.randrange(300)) + (passage[0][:450] if k % 5 == 0 else ""))
    texts += texts[-6:] + [line(50) + texts[4][100:900] + texts[4][1000:1800], line(600) * 3]
    out = [(i, t, None, None, None, "", "") for i, t in enumerate(texts)]
    return out + [out[20], (None, texts[30], None, None, None, "", "")]


def plain(data, length=400):
    texts, seen = [(r[1] or "").encode() for r in data], {}
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((k, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + length))
    return sorted((str(r[0]), len(t), len(g), sum(i - 1 not in g for i in g), brute.sha(bytes(x for i, x in enumerate(t) if i not in g))) for r, t, g in zip(data, texts, gone, strict=True))


@pytest.mark.parametrize(("contexts", "symbols"), [(16_384, 150_000), (5, 10), (1, 10), (0, 10)])
def test_equals_brute_force(spark, contexts, symbols):
    data = rows()
    out = sa.deduplicate(spark.createDataFrame(data, brute.SCHEMA).repartition(3), contexts=contexts, symbols=symbols, digest=True)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    assert got == plain(data)
    assert 10 < sum(x[2] > 0 for x in got) < len(got)


@pytest.mark.parametrize("contexts", [20, 5, 1])
def test_equals_brute_force_where_joins_become_broadcasts_at_run_time(spark, contexts):
    """Spark then reads join inputs by the task that wrote them, and no longer by key."""
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.files.openCostInBytes": "1g"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        data = rows()
        out = sa.deduplicate(spark.createDataFrame(data, brute.SCHEMA).repartition(3), contexts=contexts, digest=True)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == plain(data)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_text_in_slices(spark):
    r = random.Random(2)
    text = bytes(r.randrange(97, 123) for _ in range(600_000)).decode()
    data = [(1, text + text[200_000:201_000], None, None, None, "", ""), (2, "x" + text[523_900:525_000], None, None, None, "", "")]
    out = {x.doc_id: x for x in sa.deduplicate(spark.createDataFrame(data, brute.SCHEMA)).collect()}
    assert (out[1].n_removed, out[2].n_removed) == (2000 + 1100, 1100) and bytes(out[2].kept) == b"x"


def test_empty(spark):
    assert sa.deduplicate(spark.createDataFrame([], brute.SCHEMA)).count() == 0
