import numpy as np
import pytest

from ledgerline import cli
from ledgerline.operators import home_credit
from ledgerline.plans.pipeline import RETRIES, STEPS, execution_order


def test_order():
    order = execution_order()
    assert order == ["ingest", "drift", "validate", "aggregate", "train", "score", "stability", "vintage", "diagnose"]
    assert RETRIES["diagnose"] == 0 and set(RETRIES) == set(STEPS)
    with pytest.raises(ValueError, match="wait for each other"):
        execution_order({"a": ("b",), "b": ("a",)})
    with pytest.raises(ValueError, match="no one defines"):
        execution_order({"a": ("x",)})


def table(name, n, seed):
    """Rows that keep to a contract; about 12 applications in 100 default where the income is low."""
    r, spec = np.random.default_rng(seed), home_credit.contract(name)["strict_schema"]["columns"]
    make = {"int": lambda: r.integers(0, 5, n).tolist(), "float": lambda: np.round(r.random(n) * 100 + 0.5, 2).tolist(), "string": lambda: r.choice(["A", "B"], n).tolist()}
    columns = {c: make[s["type"]]() for c, s in spec.items()}
    columns |= {c: list(range(n)) for c in columns if c.startswith("SK_ID")}
    for c, s in spec.items():
        if s["nullable"]:
            columns[c][0] = None
    return columns


def csv(path, columns):
    lines = [",".join(columns)] + [",".join("" if v is None else str(v) for v in row) for row in zip(*columns.values(), strict=True)]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    (root / "raw").mkdir()
    for k, name in enumerate(home_credit.TABLES):
        columns = table(name, 400, k)
        if name == "application_train":
            low = [x is not None and x < 40 for x in columns["AMT_INCOME_TOTAL"]]
            columns["TARGET"] = [int(a and i % 2 == 0) for i, a in enumerate(low)]
            for c in list(columns)[8:]:
                if c.endswith(("_AVG", "_MODE", "_MEDI")) or c.startswith("FLAG_DOC"):
                    columns[c] = [columns[c][0]] + [columns[c][1]] * 399
        if name.endswith("balance"):
            columns["MONTHS_BALANCE"] = [-(i % 3) for i in range(400)]
        if name == "bureau_balance":
            columns["STATUS"] = ["C" if i % 9 == 0 else str(i % 4) for i in range(400)]
        csv(root / "raw" / f"{name}.csv", columns)
    return root


def test_steps(spark, data, capsys):
    run = lambda *a: cli.main([*a, "--data-dir", str(data)], spark)
    for step in ("ingest", "drift", "validate", "aggregate", "vintage"):
        run(step)
    assert (data / "processed/master_analytical_record_test.parquet").exists() and (data / "processed/schema_drift_report.csv").exists()
    run("stability")
    capsys.readouterr()
    run("diagnose", "--no-narrative")
    assert capsys.readouterr().out.startswith("# Portfolio brief")
    with pytest.raises(SystemExit, match="fail-on"):
        run("diagnose", "--fail-on", "warning")
    run("draft-schema", "--table", "bureau", "--key", "SK_ID_BUREAU")
    with pytest.raises(FileExistsError):
        run("draft-schema", "--table", "bureau")
    run("draft-schema", "--table", "bureau", "--bump")
    assert "0 difference(s)" in capsys.readouterr().out


def test_missing_report_fails_too(spark, tmp_path):
    with pytest.raises(SystemExit):
        cli.main(["diagnose", "--data-dir", str(tmp_path), "--fail-on", "critical"], spark)


def test_validation_failure(spark, tmp_path):
    spark.createDataFrame([(1, 0, "C"), (1, 0, "C")], "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string").write.parquet(f"{tmp_path}/processed/bureau_balance.parquet")
    with pytest.raises(SystemExit, match="validation failed"):
        cli.main(["validate", "--data-dir", str(tmp_path)], spark)


def test_arguments(spark):
    for bad in (["schema-diff"], ["schema-diff", "--table", "bureau"], ["nonsense"]):
        with pytest.raises(SystemExit):
            cli.main(bad, spark)
