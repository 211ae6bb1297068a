"""Order statistics where each evaluation of the sketch cuts elsewhere, as happens where tasks' results arrive in another order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import ranks, scores
from ledgerline.operators import stability as st


@pytest.fixture
def shaky(monkeypatch):
    cut = F.udf(lambda n: sorted(random.SystemRandom().random() for _ in range(n and 5)), "array<double>").asNondeterministic()
    for module in (ranks, scores):
        monkeypatch.setattr(module, "cut_marks", lambda value: cut(F.count(value)))


def test_quantiles(spark, shaky):
    values = np.random.default_rng(5).random(3001)
    counts = spark.createDataFrame([("x", float(v), 1) for v in values], "feature string, value double, n long").repartition(4)
    for _ in range(3):
        assert ranks.quantiles(counts, {"x": 3001}, [0.1, 0.5, 0.9])["x"] == np.quantile(values, [0.1, 0.5, 0.9]).tolist()
    assert ranks.quantiles(counts.limit(0), {}, [0.5]) == {}


def test_discrimination_and_calibration(spark, shaky):
    r = np.random.default_rng(6)
    y, s = r.integers(0, 2, 400), np.round(r.random(400), 2)
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(s, y, strict=True))], "SK_ID_CURR long, score double, TARGET int")
    auc = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in s[y == 1] for b in s[y == 0]])
    for _ in range(3):
        assert scores.discrimination(df).first().auc == pytest.approx(auc, abs=1e-12)
        assert [g.accounts for g in scores.calibration(df).orderBy("bin").collect()] == [40] * 10


def test_no_rows(spark):
    none = spark.createDataFrame([], "SK_ID_CURR long, score double, TARGET int")
    assert scores.discrimination(none).first().auc is None
    assert scores.calibration(none).count() == 0


def test_driver_among_bins_of_one_name(spark):
    """Edges that agree in four digits give several bins the same name; the driver is still one place."""
    base = spark.range(1000).selectExpr("100000 + id / 1000 as x")
    moved = spark.range(1000).selectExpr("100000 + id / 4000 as x")
    top = st.drivers(st.csi(st.Cohorts.of(base, moved, ["x"]), ["x"])).collect()
    assert [(r.feature_name, r.position) for r in top] == [("x", 3)] and top[0].top_driver == "(1e+05, 1e+05]"
