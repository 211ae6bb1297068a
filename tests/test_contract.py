"""Registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from ledgerline.plans import contract, reports

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        out.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return out


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", list(contract.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    out = contract.QUERIES[name](spark, str(DATA))
    want = con.sql(contract.ORACLE_SQL[name])
    assert sorted(out.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in out.collect()], out.columns) == rows(want.fetchall(), want.columns)


def test_every_query_is_registered():
    assert reports.diagnose_status is contract.QUERIES["diagnose_status"]
    assert set(contract.QUERIES) - set(contract.ORACLE_SQL) == {"score_population"}
