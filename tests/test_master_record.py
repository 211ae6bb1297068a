"""The record against a plain loop over made-up histories."""

import random
from collections import defaultdict

import pytest

from ledgerline.operators import master_record as mr
from ledgerline.sources.tables import read_table

APPLICANTS = 25
SCHEMAS = {
    "application_train": "SK_ID_CURR long, TARGET long",
    "application_test": "SK_ID_CURR long",
    "bureau": "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_OVERDUE double",
    "bureau_balance": "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string",
    "installments_payments": "SK_ID_CURR long, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    "previous_application": "SK_ID_CURR long, NAME_CONTRACT_STATUS string, AMT_APPLICATION double",
}
HISTORY = [t for t in SCHEMAS if not t.startswith("application")]


def made(seed=11):
    """Whole amounts, so sums are exact; about one value in five is missing."""
    r = random.Random(seed)
    amount = lambda: None if r.random() < 0.2 else float(r.randrange(1, 5000))
    someone = lambda: r.randrange(APPLICANTS + 4)  # noqa: E731  some without an application
    accounts = [(someone(), 100 + k, r.choice(["Active", "Closed", "Sold"]), amount(), amount(), amount()) for k in range(60)]
    return {
        "application_train": [(k, k % 3 % 2) for k in range(APPLICANTS)],
        "application_test": [(k,) for k in range(0, 2 * APPLICANTS, 7)],
        "bureau": accounts,
        "bureau_balance": [(a[1], -m, r.choice("CX012345")) for a in accounts[::2] for m in range(r.randrange(1, 6))],
        "installments_payments": [(someone(), -float(r.randrange(50)), None if r.random() < 0.2 else -float(r.randrange(50)), float(r.randrange(900)), amount()) for _ in range(90)],
        "previous_application": [(someone(), r.choice(["Approved", "Refused", "Canceled"]), amount()) for _ in range(70)],
    }


TABLES = made()


def looped(applicants):
    """What the record must hold, row by row."""
    late = defaultdict(int)
    for account, _, status in TABLES["bureau_balance"]:
        late[account] += status.isdigit() and int(status) > 0
    out = {}
    for who in applicants:
        b = [x for x in TABLES["bureau"] if x[0] == who]
        i = [x for x in TABLES["installments_payments"] if x[0] == who]
        p = [x for x in TABLES["previous_application"] if x[0] == who]
        delays = [x[2] - x[1] for x in i if x[2] is not None]
        total = lambda rows, k: sum(x[k] or 0 for x in rows)
        out[who] = (
            len(b), sum(x[2] == "Active" for x in b), sum(x[2] == "Closed" for x in b), total(b, 3), total(b, 4), total(b, 5), sum(late[x[1]] for x in b),
            max(delays, default=0), sum(x[3] - x[4] for x in i if x[4] is not None), len(i), sum(d > 0 for d in delays),
            len(p), sum(x[1] == "Approved" for x in p), sum(x[1] == "Refused" for x in p), total(p, 2) / len(p) if p else 0,
        )
    return out


def frame(spark, name):
    return spark.createDataFrame(TABLES[name], SCHEMAS[name])


def frames(spark, *leave_out):
    return [None if n in leave_out else frame(spark, n) for n in ("application_train", "bureau", "bureau_balance", "installments_payments", "previous_application")]


def test_equals_the_loop(spark):
    rows = mr.master_record(*frames(spark)).collect()
    assert {r.SK_ID_CURR: tuple(r)[2:] for r in rows} == looped(range(APPLICANTS)) and len(rows) == APPLICANTS


def test_months_by_account(spark):
    found = {r.SK_ID_BUREAU: r for r in mr.balance_by_account(frame(spark, "bureau_balance")).collect()}
    for account, r in found.items():
        codes = [s for a, _, s in TABLES["bureau_balance"] if a == account]
        worst = max(int(s) if s.isdigit() else 0 for s in codes)
        assert (r.bb_snapshot_months, r.bb_max_status, r.bb_delinquent_months) == (len(codes), worst, sum(s in "12345" for s in codes))


@pytest.mark.parametrize("gone", HISTORY)
def test_missing_table(spark, gone):
    out = mr.master_record(*frames(spark, gone))
    assert out.count() == APPLICANTS
    prefix = {"bureau": "bureau_", "installments_payments": "ip_", "previous_application": "prev_"}.get(gone)
    assert not prefix or not any(c.startswith(prefix) for c in out.columns)
    if gone == "bureau_balance":
        assert out.where("bureau_total_delinquent_months <> 0").isEmpty()


def test_files(spark, tmp_path):
    folder = str(tmp_path / "processed")
    for name in TABLES:
        frame(spark, name).write.parquet(f"{folder}/{name}.parquet")
    assert mr.build_master_record(spark, folder).endswith("/master_analytical_record.parquet")
    mr.build_master_record(spark, folder, "application_test")
    train, test = read_table(spark, folder, "master_analytical_record"), read_table(spark, folder, "master_analytical_record_test")
    assert [c for c in train.columns if c != "TARGET"] == test.columns
    assert {r.SK_ID_CURR: tuple(r)[1:] for r in test.collect()} == looped(x for x, in TABLES["application_test"])
    assert mr.build_master_record(spark, str(tmp_path)) is None


def test_who_has_no_history(spark):
    known = {x[0] for t in ("bureau", "previous_application") for x in TABLES[t]}
    out = mr.without_history(frame(spark, "application_train"), frame(spark, "bureau"), frame(spark, "previous_application"))
    assert {r.SK_ID_CURR for r in out.collect()} == set(range(APPLICANTS)) - known
