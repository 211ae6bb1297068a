"""Facts, rules and what they come to."""

import json

import pytest
import yaml

from ledgerline.operators import diagnose as dg

PSI = "analysis string, feature_name string, psi_score double, drift_status string, top_driver string, alerting boolean"
ROLL = "source string, from_bucket string, to_bucket string, roll_rate double, balance_roll_rate double"
CURVES = "source string, cohort_start_month int, mob int, accounts_observed long, accounts_bad long, cumulative_bad_rate double"
DRIFT = "table string, kind string, column string, baseline string, observed string, severity string"
MODEL = {"auc": 0.8, "gini": 0.6, "ks": 0.45, "mean_predicted": 0.1, "base_rate": 0.1, "n_holdout": 500}


def judged(facts, rules=dg.RULES):
    return {(r.scope, r.item, r.measure): r for r in dg.judged(facts, rules).collect()}


def levels(facts, rules=dg.RULES):
    return {k[:2]: r.level for k, r in judged(facts, rules).items()}


def psi(spark, *rows):
    return dg.stability_facts(spark.createDataFrame(list(rows), PSI))


def test_features(spark):
    """Either limit is a breach itself; quiet analyses, identifiers and undefined features break no rule."""
    values = {"a": 0.0, "b": 0.0999, "c": 0.1, "d": 0.2499, "e": 0.25, "f": 7.0}
    rows = [("x", k, v, "label", "bin 3", True) for k, v in values.items()] + [("y", "g", 9.0, "label", None, False), ("x", "SK_ID_1", 9.0, "", None, True), ("x", "h", float("nan"), "", None, True), ("x", "i", None, "", None, True)]
    found = levels(psi(spark, *rows))
    assert found == {("x", k): "critical" if v >= 0.25 else "warning" if v >= 0.1 else "ok" for k, v in values.items()} | {("y", "g"): "ok"}
    out = dg.verdict(psi(spark, *rows), top=2)
    assert out.status == "critical" and [b["item"] for b in out.breaches] == ["f", "e"]
    assert "critical: [x] f: PSI 7.0000, label, most of it in bin bin 3 at a limit of 0.25" in out.findings
    assert [a for a in dg.ADVICE.values() if a in out.recommendations] == [dg.ADVICE["trace"], dg.ADVICE["refit"]]


def test_older_layouts(spark):
    one = dg.stability_facts(spark.createDataFrame([("z", 0.3, "label")], "feature_name string, psi_score double, drift_status string"))
    assert levels(one) == {("portfolio", "z"): "critical"}
    rates = spark.createDataFrame([("CURRENT", "DPD_1_30", 0.2)], "from_bucket string, to_bucket string, roll_rate double")
    assert {(r.scope, r.measure) for r in dg.roll_facts(rates).collect()} == {("bureau", m) for m in ("roll_in_max", "forward_max", "cure")}


@pytest.mark.parametrize(("change", "broken"), [({}, set()), ({"auc": 0.69}, {"min_auc"}), ({"auc": 0.7, "ks": 0.3}, set()), ({"ks": 0.1}, {"min_ks"}), ({"mean_predicted": 0.12}, {"max_calibration_error"}), ({"mean_predicted": 0.08}, {"max_calibration_error"}), ({"base_rate": 0.0}, {"max_calibration_error"})])
def test_model(spark, change, broken):
    found = judged(dg.model_facts(spark, MODEL | change))
    assert {k[2] for k, r in found.items() if r.level != "ok"} == broken and len(found) == 4


def test_contracts(spark):
    kinds = [("t", "nulls_absent", "c", "p", "q", "info"), ("t", "column_added", "d", "p", "q", "warning"), ("u", "primary_key_changed", "", "p", "q", "breaking")]
    facts = dg.contract_facts(spark.createDataFrame(kinds, DRIFT))
    assert sorted(levels(facts).items()) == [(("t", "column_added t.d"), "warning"), (("t", "nulls_absent t.c"), "ok"), (("u", "primary_key_changed u"), "critical")]
    told = dg.verdict(facts).findings
    assert told[0] == "contracts: 1 critical, 1 to watch, 1 in order" and "critical: [u] primary_key_changed u: p -> q" in told


def test_limits_of_a_file(spark, tmp_path):
    path = tmp_path / "limits.yaml"
    path.write_text(yaml.safe_dump({"roll_rates": {"default": {"roll_in_max": 0.3}, "sources": {"two": {"roll_in_max": 0.02, "balance_forward_max": 0.9}}}, "model": {"min_ks": 0.5}}))
    limits = {(r.scope, r.measure): r.limit for r in dg.rules_of(path)}
    assert limits[None, "roll_in_max"] == limits[None, "balance_roll_in_max"] == 0.3
    assert limits["two", "roll_in_max"] == limits["two", "balance_roll_in_max"] == 0.02
    assert limits["two", "balance_forward_max"] == 0.9 and ("two", "forward_max") not in limits
    assert limits[None, "min_ks"] == 0.5 and limits[None, "min_auc"] == 0.7
    rows = [(s, "CURRENT", "DPD_31_60", 0.1, 0.1) for s in ("one", "two")] + [(s, "DPD_1_30", "DPD_91_120", 0.2, 0.8) for s in ("one", "two")]
    found = judged(dg.roll_facts(spark.createDataFrame(rows, ROLL)), dg.rules_of(path))
    assert {(k[0], k[2]) for k, r in found.items() if r.level != "ok"} == {("two", "roll_in_max"), ("two", "balance_roll_in_max"), ("one", "forward_max"), ("two", "forward_max"), ("one", "balance_forward_max")}
    assert {r.limit for r in dg.rules_of(tmp_path / "absent.yaml")} == {r.limit for r in dg.RULES}


def test_rolls_add_up(spark):
    rows = [("s", f, t, 0.01 * k, None) for k, (f, t) in enumerate([("CURRENT", "CURRENT"), ("CURRENT", "DPD_1_30"), ("CURRENT", "DPD_120_PLUS"), ("DPD_1_30", "CURRENT"), ("DPD_1_30", "DPD_1_30"), ("DPD_1_30", "DPD_31_60"), ("DPD_1_30", "DPD_61_90"), ("DPD_31_60", "DPD_61_90")])]
    one = dg.roll_summary(spark.createDataFrame(rows, ROLL)).first()
    assert (round(one.roll_in, 6), round(one.cure, 6), round(one.forward, 6), one.has_balance) == (0.03, 0.03, 0.11, False)


def curves(spark, rate, bad, cohorts=6):
    rows = [("s", -3 * k, 12, 4000, bad if k == 1 else 90, rate if k == 1 else 0.04) for k in range(1, cohorts + 1)]
    return dg.vintage_facts(spark.createDataFrame(rows, CURVES))


def test_vintages(spark):
    case = lambda *x: next(iter(judged(curves(spark, *x)).values()))
    assert case(0.05, 400).level == "ok" and case(0.05, 400).value == pytest.approx(1.25)
    assert case(0.06, 400).level == "warning" and case(0.06, 29).level == "ok" and case(0.06, 30).level == "warning"
    few = case(0.06, 400, 5)
    assert few.level == "ok" and few.value is None and "too few cohorts" in few.note


def test_whole_run(spark, tmp_path):
    folder = f"{tmp_path}/processed"
    assert dg.DiagnosticAgent(spark, folder).run().status == "error"
    spark.createDataFrame([("a", "x", 0.05, "STABLE", None, True)], PSI).write.parquet(f"{folder}/portfolio_stability_report.parquet")
    out = dg.DiagnosticAgent(spark, folder).run()
    assert out.status == "ok" and len(out.recommendations) == 1 and sum("left out" in x for x in out.findings) == 4
    rows = [("s", -3 * k, 12, 4000, 100 * (9 - k), 0.2 if k == 1 else 0.05) for k in range(1, 8)]
    spark.createDataFrame(rows, CURVES).write.parquet(f"{folder}/vintage_curves.parquet")
    (tmp_path / "models").mkdir()
    (tmp_path / "models/model_metrics.json").write_text(json.dumps(MODEL))
    told = dg.DiagnosticAgent(spark, folder, narrator=lambda findings: f"{len(findings)} findings").run()
    assert told.status == "warning" and told.narrative.endswith("findings") and "## Summary" in told.to_markdown()
    assert told.recommendations == [dg.ADVICE["lend"]]

    def broken(_):
        raise RuntimeError("no prose")

    assert dg.DiagnosticAgent(spark, folder, narrator=broken).run().narrative is None
