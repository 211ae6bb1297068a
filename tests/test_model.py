import json

import numpy as np
import pytest

from ledgerline.functions import ranks, scores
from ledgerline.operators import default_model as dm

SCHEMA = "SK_ID_CURR long, signal double, noise double, segment string, TARGET int"


def frame(spark, n=3000, seed=0):
    r = np.random.default_rng(seed)
    signal, noise, segment = r.normal(size=n), r.normal(size=n), r.choice(list("abc"), n)
    p = 1 / (1 + np.exp(2.5 - 1.4 * signal - (segment == "c")))
    target = (r.random(n) < p).astype(int)
    rows = [(100_000 + i, None if r.random() < 0.1 else float(signal[i]), float(noise[i]), str(segment[i]), int(target[i])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return path, dm.train_model(spark, frame(spark), path, path, trees=15, importance_sample=300)


def test_quality(trained):
    path, m = trained
    assert m["auc"] > 0.7 and m["gini"] == pytest.approx(2 * m["auc"] - 1) and 0 < m["ks"] < 1
    assert m["top_features"][0]["feature"] == "signal" and m["n_train"] + m["n_holdout"] == 3000
    assert abs(m["mean_predicted"] / m["base_rate"] - 1) < 0.25
    assert sum(r["accounts"] for r in m["calibration"]) == m["n_holdout"]
    with open(f"{path}/model_metrics.json") as f:
        assert json.load(f)["auc"] == m["auc"]


def test_split_is_stratified_and_stable(spark):
    df = frame(spark, 1000)
    held = {r.SK_ID_CURR: r.TARGET for r in dm.stratified_split(df)[1].collect()}
    again = {r.SK_ID_CURR for r in dm.stratified_split(df.orderBy("noise"))[1].collect()}
    bad = df.where("TARGET = 1").count()
    assert set(held) == again and sum(held.values()) == round(0.2 * bad) and len(held) == pytest.approx(200, abs=1)


def test_scoring(spark, trained):
    path, _ = trained
    new = spark.createDataFrame([(1, None, None, "never seen", "x"), (2, 0.5, 0.1, None, "x"), (3, 3.0, float("inf"), "c", "x")], "SK_ID_CURR long, signal double, noise double, segment string, other string")
    out = {r.SK_ID_CURR: r.score for r in dm.score_frame(new, path).collect()}
    assert len(out) == 3 and all(0 < s < 1 for s in out.values()) and out[3] > out[1]
    with pytest.raises(ValueError, match="not there: signal"):
        dm.score_frame(new.drop("signal"), path)


def measured(spark, y, s):
    return scores.discrimination(spark.createDataFrame(list(zip(map(float, s), y, strict=True)), "score double, TARGET int")).first()


def test_known_discrimination(spark):
    assert tuple(measured(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])) == (1, 1, 1)
    assert tuple(measured(spark, [0, 1, 0, 1], [0.5] * 4)) == (0.5, 0, 0)
    assert measured(spark, [0, 1, 0, 1], [0.1, 0.2, 0.3, 0.4]).ks == 0.5
    assert measured(spark, [1, 1], [0.1, 0.2]).auc is None


@pytest.mark.parametrize("bucket_values", [1, 20_000])
def test_against_brute_force(spark, monkeypatch, bucket_values):
    monkeypatch.setattr(ranks, "BUCKET_VALUES", bucket_values)
    r = np.random.default_rng(1)
    y, s = r.integers(0, 2, 500), np.round(r.random(500), 2)
    auc = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in s[y == 1] for b in s[y == 0]])
    ks = max(np.mean(s[y == 1] >= t) - np.mean(s[y == 0] >= t) for t in s)
    out = measured(spark, y.tolist(), s.tolist())
    assert out.auc == pytest.approx(auc, abs=1e-12) and out.ks == pytest.approx(ks, abs=1e-12)


@pytest.mark.parametrize("bucket_values", [1, 20_000])
def test_calibration_groups(spark, monkeypatch, bucket_values):
    monkeypatch.setattr(ranks, "BUCKET_VALUES", bucket_values)
    r = np.random.default_rng(2)
    s = np.round(r.random(1003), 3)
    df = spark.createDataFrame([(i, float(x), int(i % 3 == 0)) for i, x in enumerate(s)], "SK_ID_CURR long, score double, TARGET int")
    got = scores.calibration(df).orderBy("bin").collect()
    parts = np.array_split(np.lexsort((np.arange(1003), s)), 10)
    assert [g.accounts for g in got] == [len(p) for p in parts]
    assert [g.mean_score for g in got] == pytest.approx([s[p].mean() for p in parts])
