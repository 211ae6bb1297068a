"""The credit tables as views of the test tables, in SQL that Spark and DuckDB both read.

DAYS(x) stands for days since 1970. Amounts are decimals, so sums do not depend on row order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_PRICE = "cast(o_totalprice as decimal(18,2))"
_V = "select user_id, DAYS(ts) as d, max(value) as v, sum(cast(value as decimal(18,2))) as s from {events} group by user_id, DAYS(ts)"
_DPD = "case when v < 3 then null when v < 60 then 0 when v < 100 then 15 when v < 150 then 45 when v < 250 then 75 else 100 end"
_ORIGIN = "19753"  # 2024-01-31

VIEWS = {
    "application": "select c_custkey as SK_ID_CURR, case when c_acctbal < 0 then 1 else 0 end as TARGET, c_mktsegment as SEGMENT, cast(c_nationkey as bigint) as NATION from {customer}",
    "bureau": f"select o_custkey as SK_ID_CURR, o_orderkey as SK_ID_BUREAU, case o_orderstatus when 'O' then 'Active' when 'F' then 'Closed' else 'Sold' end as CREDIT_ACTIVE, case when o_orderstatus = 'O' then {_PRICE} end as AMT_CREDIT_SUM_DEBT, {_PRICE} as AMT_CREDIT_SUM, case when o_orderstatus = 'P' then {_PRICE} end as AMT_CREDIT_SUM_OVERDUE, DAYS(o_orderdate) as DAYS_CREDIT from {{orders}}",
    "bureau_balance": "select l_orderkey as SK_ID_BUREAU, -l_linenumber as MONTHS_BALANCE, case when l_returnflag = 'A' then 'C' when l_returnflag = 'N' and l_linestatus = 'F' then 'X' else cast(l_linenumber % 6 as varchar(2)) end as STATUS from {lineitem}",
    "installments_payments": "select o_custkey as SK_ID_CURR, cast(DAYS(o_orderdate) + 30 as double) as DAYS_INSTALMENT, cast(DAYS(l_shipdate) as double) as DAYS_ENTRY_PAYMENT, cast(l_extendedprice as decimal(18,2)) as AMT_INSTALMENT, case when l_returnflag = 'R' and l_linenumber >= 6 then null else cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,4)) end as AMT_PAYMENT from {lineitem} join {orders} on l_orderkey = o_orderkey",
    "previous_application": f"select o_custkey as SK_ID_CURR, case o_orderstatus when 'F' then 'Approved' when 'P' then 'Refused' else 'Canceled' end as NAME_CONTRACT_STATUS, case when o_orderstatus <> 'O' then {_PRICE} end as AMT_APPLICATION from {{orders}}",
    "snapshot_bureau": f"select user_id as SK_ID_BUREAU, d - {_ORIGIN} as MONTHS_BALANCE, case when v < 3 then 'X' when v >= 400 then 'C' when v < 60 then '0' when v < 100 then '1' when v < 150 then '2' when v < 250 then '3' else '4' end as STATUS from ({_V}) e",
    "snapshot_card": f"select user_id as SK_ID_PREV, d - {_ORIGIN} as MONTHS_BALANCE, {_DPD} as SK_DPD, case when v >= 400 then 'Completed' else 'Active' end as NAME_CONTRACT_STATUS, cast(floor(s) - 60 as double) as AMT_BALANCE from ({_V}) e",
    "snapshot_orders": "select o_custkey as SK_ID_PREV, (year(o_orderdate) - 2001) * 12 + month(o_orderdate) - 12 as MONTHS_BALANCE, max(case when o_orderstatus = 'P' and o_totalprice > 150000 then 75 else 0 end) as SK_DPD, 'Active' as NAME_CONTRACT_STATUS from {orders} group by o_custkey, year(o_orderdate), month(o_orderdate)",
    "cohort_rows": "select month(o_orderdate) > 6 as is_target, o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, cast(day(o_orderdate) % 7 as int) as weekish, case when month(o_orderdate) > 6 and o_orderkey % 3 = 0 then null else o_totalprice end as price_with_nulls, concat('c', cast(o_custkey % 97 as varchar(4))) as many, DAYS(o_orderdate) as day from {orders}",
    "scored": "select c_custkey as SK_ID_CURR, case when c_acctbal < 0 then 1 else 0 end as TARGET, cast((coalesce(n, 0) * 37 + c_nationkey * 11 + c_custkey % 5) % 101 as double) / 128 as score from {customer} left join (select o_custkey, count(*) as n from {orders} group by o_custkey) o on o_custkey = c_custkey",
}
TABLES = ("customer", "orders", "lineitem", "events")


def _days(sql: str, engine: str) -> str:
    form = r"cast(unix_date(cast(\1 as date)) as bigint)" if engine == "spark" else r"cast(cast(\1 as date) - date '1970-01-01' as bigint)"
    return re.sub(r"DAYS\((\w+)\)", form, sql)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(_days(sql, "spark").replace("varchar(2)", "string").replace("varchar(4)", "string"), **frames)


def sql_view(name: str) -> str:
    """For DuckDB, in brackets."""
    return "(" + _days(VIEWS[name].format(**{t: t for t in TABLES}), "duckdb") + ")"
