import math

import numpy as np
import pytest

from ledgerline.llm import quality

from . import brute

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed=5, n=400):
    r = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(60)]
        bad, toxic = r.random() < 0.2, r.random() < 0.2
        if bad:
            words = [w.upper() + "!!$$" for w in words]
        if toxic:
            words[::9] = ["vileword"] * len(words[::9])
        rows.append((i, " ".join(words), "en", f"host{i % 3}/part{i % 5}", 1, "x", "y"))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    seen = [x for x in labels if x[0] % 2]
    out = quality.assess(spark.createDataFrame(rows, brute.SCHEMA), spark.createDataFrame(seen, LABELS))
    good = {i: bool(q and not t) for i, q, t in labels}
    held = [(r.keep, good[r.doc_id]) for r in out.collect() if r.doc_id % 2 == 0]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_posteriors_equal_brute_force(spark):
    rows, labels = corpus(n=200)
    rows = rows + rows[:3] + [(None, "some plain words", None, None, None, "", ""), (900, None, "en", "host0/part0", 0, "", "")]
    frame = spark.createDataFrame(rows, brute.SCHEMA)
    out = quality.assess(frame, spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows)
    p = np.array([r.p for r in out])
    overall = p.mean()
    host, path = [r.host for r in out], [(r.host, r.section) for r in out]
    assert set(host) == {"host0", "host1", "host2", ""}

    def strength(keys, values, centres):
        n = {k: keys.count(k) for k in set(keys)}
        mean = {k: np.mean([v for a, v in zip(keys, values) if a == k]) for k in n}
        total, m = sum(n.values()), len(n)
        within = overall * (1 - overall)
        between = (sum(n[k] * (mean[k] - centres[k]) ** 2 for k in n) - (m - 1) * within) / (total - sum(x * x for x in n.values()) / total)
        return n, mean, min(1e4, max(1.0, within / between)) if between > 1e-9 else 1e4

    n, mean, s = strength(host, p, dict.fromkeys(host, overall))
    hosts = {k: (n[k] * mean[k] + s * overall) / (n[k] + s) for k in n}
    n, mean, s = strength(path, p, {k: hosts[k[0]] for k in path})
    paths = {k: (n[k] * mean[k] + s * hosts[k[0]]) / (n[k] + s) for k in n}
    odds = lambda x: x / (1 - x)
    for r in out:
        assert math.isclose(r.host_posterior, hosts[r.host], rel_tol=1e-6) and math.isclose(r.path_posterior, paths[r.host, r.section] if r.section else hosts[r.host], rel_tol=1e-6)
        after = odds(min(1 - 1e-9, max(1e-9, r.p))) / odds(overall) * odds(r.path_posterior)
        assert math.isclose(r.posterior, after / (1 + after) if r.p else 0, rel_tol=1e-6)
    kept = quality.keep_good(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.keep)


def test_sparse_sites_shrink(spark):
    scored = spark.createDataFrame([("a", "x", 0.9)] * 500 + [("b", "y", 0.1)] * 500 + [("c", "z", 0.1)], "host string, section string, p double")
    sites, overall = quality.site_posteriors(scored)
    got = {r.host: r.path_posterior for r in sites.collect()}
    assert got["a"] == pytest.approx(0.9, abs=0.02) and got["b"] < got["c"] < overall


def test_very_long_text_is_measured_whole():
    """A word at the end of two million counts as one at the start does."""
    dense, buckets = quality.features(b"plain words " * 1_000_000 + b"END")
    assert dense[8] == pytest.approx(np.log1p(2_000_001)) and len(buckets) == 3


def test_awkward_inputs(spark):
    frame = spark.createDataFrame(brute.documents(20), brute.SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert quality.assess(frame, none).where("p = 0").count() == quality.assess(frame, none).where("not keep").count()
    assert quality.assess(frame.limit(0), none).count() == 0 and quality.keep_good(frame.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 0), (1, 1, 0), (1, 1, 0)], LABELS)
    assert quality.assess(frame, odd).count() == frame.count()
