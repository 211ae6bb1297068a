"""Queries over the test tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import brier, calibration, discrimination
from ..operators import contracts, diagnose, home_credit, master_record, migration, stability
from ..operators.stability import Cohorts
from .mapping import sql_view, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double."""
    return df.select(*(F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.col(c) for c, k in df.dtypes))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Logarithms and means differ by an ulp between engines."""
    return df.withColumns({c: F.round(c, 8) for c in columns})


# ---------------------------------------------------------------------------------------------
# Master record

_BALANCE = f"select SK_ID_BUREAU, count(*) as bb_snapshot_months, max(coalesce(try_cast(STATUS as integer), 0)) as bb_max_status, cast(sum(case when try_cast(STATUS as integer) > 0 then 1 else 0 end) as bigint) as bb_delinquent_months from {sql_view('bureau_balance')} v group by SK_ID_BUREAU"
_BUREAU = f"""select b.SK_ID_CURR, count(distinct b.SK_ID_BUREAU) as bureau_total_accounts,
  cast(sum(case when CREDIT_ACTIVE = 'Active' then 1 else 0 end) as bigint) as bureau_active_accounts,
  cast(sum(case when CREDIT_ACTIVE = 'Closed' then 1 else 0 end) as bigint) as bureau_closed_accounts,
  cast(sum(coalesce(AMT_CREDIT_SUM_DEBT, 0)) as double) as bureau_sum_credit_sum_debt,
  cast(sum(coalesce(AMT_CREDIT_SUM, 0)) as double) as bureau_sum_credit_sum,
  cast(sum(coalesce(AMT_CREDIT_SUM_OVERDUE, 0)) as double) as bureau_total_overdue_balance,
  cast(sum(coalesce(bb_delinquent_months, 0)) as bigint) as bureau_total_delinquent_months
from {sql_view('bureau')} b left join ({_BALANCE}) bb on b.SK_ID_BUREAU = bb.SK_ID_BUREAU group by b.SK_ID_CURR"""
_INSTALMENTS = f"""select SK_ID_CURR, max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) as ip_max_payment_delay_days,
  cast(sum(coalesce(AMT_INSTALMENT - AMT_PAYMENT, 0)) as double) as ip_total_payment_deficit, count(*) as ip_total_payments,
  cast(sum(case when DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT then 1 else 0 end) as bigint) as ip_late_payments from {sql_view('installments_payments')} v group by SK_ID_CURR"""
_PREVIOUS = f"""select SK_ID_CURR, count(*) as prev_total_applications, cast(sum(case when NAME_CONTRACT_STATUS = 'Approved' then 1 else 0 end) as bigint) as prev_approved_applications,
  cast(sum(case when NAME_CONTRACT_STATUS = 'Refused' then 1 else 0 end) as bigint) as prev_refused_applications,
  cast(sum(coalesce(AMT_APPLICATION, 0)) as double) / count(*) as prev_mean_amt_application from {sql_view('previous_application')} v group by SK_ID_CURR"""
_ADDED = {
    "bu": ["bureau_total_accounts", "bureau_active_accounts", "bureau_closed_accounts", "bureau_sum_credit_sum_debt", "bureau_sum_credit_sum", "bureau_total_overdue_balance", "bureau_total_delinquent_months"],
    "ip": ["ip_max_payment_delay_days", "ip_total_payment_deficit", "ip_total_payments", "ip_late_payments"],
    "pr": ["prev_total_applications", "prev_approved_applications", "prev_refused_applications", "prev_mean_amt_application"],
}
_MAR = f"select a.SK_ID_CURR, a.TARGET, a.SEGMENT, a.NATION, {', '.join(f'coalesce({t}.{c}, 0) as {c}' for t, cs in _ADDED.items() for c in cs)} from {sql_view('application')} a left join ({_BUREAU}) bu on a.SK_ID_CURR = bu.SK_ID_CURR left join ({_INSTALMENTS}) ip on a.SK_ID_CURR = ip.SK_ID_CURR left join ({_PREVIOUS}) pr on a.SK_ID_CURR = pr.SK_ID_CURR"


@query(_BALANCE)
def mar_bureau_balance_lv2(spark: SparkSession, sf: str) -> DataFrame:
    return master_record.balance_by_account(view(spark, sf, "bureau_balance"))


@query(_BUREAU)
def mar_bureau_lv1(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(master_record.bureau_by_applicant(view(spark, sf, "bureau"), view(spark, sf, "bureau_balance")))


@query(_INSTALMENTS)
def mar_installments_lv2(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(master_record.instalments_by_applicant(view(spark, sf, "installments_payments")))


@query(_PREVIOUS)
def mar_previous_lv1(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(master_record.previous_by_applicant(view(spark, sf, "previous_application")))


@query(_MAR)
def mar_full(spark: SparkSession, sf: str) -> DataFrame:
    parts = (view(spark, sf, n) for n in ("bureau", "bureau_balance", "installments_payments", "previous_application"))
    return _plain(master_record.master_record(view(spark, sf, "application"), *parts))


@query(f"select * exclude (TARGET) from ({_MAR}) m")
def mar_scoring_population(spark: SparkSession, sf: str) -> DataFrame:
    """An application without a target, as the scoring population is."""
    parts = (view(spark, sf, n) for n in ("bureau", "bureau_balance", "installments_payments", "previous_application"))
    return _plain(master_record.master_record(view(spark, sf, "application").drop("TARGET"), *parts))


@query(f"select SK_ID_CURR, TARGET, SEGMENT, NATION, 0::bigint as bureau_total_delinquent_months from {sql_view('application')} a")
def mar_without_history_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables that are missing add no columns; accounts without monthly statuses have no months in arrears."""
    bare = master_record.master_record(view(spark, sf, "application"))
    late = master_record.bureau_by_applicant(view(spark, sf, "bureau").limit(0)).select("SK_ID_CURR", "bureau_total_delinquent_months")
    return bare.join(late, "SK_ID_CURR", "left").select(*bare.columns, F.coalesce("bureau_total_delinquent_months", F.lit(0).cast("long")).alias("bureau_total_delinquent_months"))


@query(f"select SK_ID_CURR, TARGET, SEGMENT, NATION from {sql_view('application')} a where not exists (select 1 from {sql_view('bureau')} b where b.SK_ID_CURR = a.SK_ID_CURR and CREDIT_ACTIVE = 'Sold') and not exists (select 1 from {sql_view('previous_application')} p where p.SK_ID_CURR = a.SK_ID_CURR and AMT_APPLICATION > 300000)")
def no_history_applicants(spark: SparkSession, sf: str) -> DataFrame:
    """No sold account, and no large application before."""
    sold, large = view(spark, sf, "bureau").where("CREDIT_ACTIVE = 'Sold'"), view(spark, sf, "previous_application").where("AMT_APPLICATION > 300000")
    return master_record.without_history(view(spark, sf, "application"), sold, large)


# ---------------------------------------------------------------------------------------------
# Migration

_DAYS_BUCKET = "case when NAME_CONTRACT_STATUS = 'Completed' then 'CLOSED' when SK_DPD = 0 then 'CURRENT' when SK_DPD <= 30 then 'DPD_1_30' when SK_DPD <= 60 then 'DPD_31_60' when SK_DPD <= 90 then 'DPD_61_90' when SK_DPD <= 120 then 'DPD_91_120' else 'DPD_120_PLUS' end"
_STATUS_BUCKET = "case STATUS when 'C' then 'CLOSED' when '0' then 'CURRENT' when '1' then 'DPD_1_30' when '2' then 'DPD_31_60' when '3' then 'DPD_61_90' when '4' then 'DPD_91_120' when '5' then 'DPD_120_PLUS' end"
_SNAPSHOTS = {
    "bureau": ("snapshot_bureau", f"select SK_ID_BUREAU as acct, MONTHS_BALANCE as m, {_STATUS_BUCKET} as bucket, STATUS in ('3','4','5') as bad, cast(null as double) as balance from {sql_view('snapshot_bureau')} v where STATUS <> 'X'"),
    "credit_card": ("snapshot_card", f"select SK_ID_PREV as acct, MONTHS_BALANCE as m, {_DAYS_BUCKET} as bucket, SK_DPD > 60 as bad, greatest(coalesce(AMT_BALANCE, 0), 0) as balance from {sql_view('snapshot_card')} v where SK_DPD is not null"),
    "pos_cash": ("snapshot_card", f"select SK_ID_PREV as acct, MONTHS_BALANCE as m, {_DAYS_BUCKET} as bucket, SK_DPD > 60 as bad, cast(null as double) as balance from {sql_view('snapshot_card')} v where SK_DPD is not null"),
    "orders": ("snapshot_orders", f"select SK_ID_PREV as acct, MONTHS_BALANCE as m, {_DAYS_BUCKET} as bucket, SK_DPD > 60 as bad, cast(null as double) as balance from {sql_view('snapshot_orders')} v where SK_DPD is not null"),
}


def _snapshot(spark: SparkSession, sf: str, source: str) -> DataFrame:
    return migration.SOURCES[source if source in migration.SOURCES else "pos_cash"].snapshot(view(spark, sf, _SNAPSHOTS[source][0]))


def _roll_sql(source: str) -> str:
    return f"select '{source}' as source, from_bucket, to_bucket, n as accounts, cast(n as double) / sum(n) over (partition by from_bucket) as roll_rate, balance, balance / nullif(sum(balance) over (partition by from_bucket), 0) as balance_roll_rate from (select c.bucket as from_bucket, x.bucket as to_bucket, count(*) as n, sum(c.balance) as balance from ({_SNAPSHOTS[source][1]}) c join ({_SNAPSHOTS[source][1]}) x on x.acct = c.acct and x.m = c.m + 1 group by 1, 2) t"


def _vintage_sql(source: str, width: int, name: str) -> str:
    return f"select '{name}' as source, cohort_start_month, cast(mob as integer) as mob, count(*) as accounts_observed, cast(sum(case when first_bad <= mob then 1 else 0 end) as bigint) as accounts_bad, cast(sum(case when first_bad <= mob then 1 else 0 end) as double) / count(*) as cumulative_bad_rate from (select acct, cast(floor(min(m) / {width}.0) * {width} as integer) as cohort_start_month, max(m) - min(m) as max_mob, min(case when bad then m end) - min(m) as first_bad from ({_SNAPSHOTS[source][1]}) s group by acct) a join range(0, 97) r(mob) on max_mob >= mob group by cohort_start_month, mob"


@query(f"select source, from_bucket, to_bucket, accounts, roll_rate from ({_roll_sql('bureau')}) r")
def roll_rate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return migration.roll_rates(_snapshot(spark, sf, "bureau"), "bureau").select("source", "from_bucket", "to_bucket", "accounts", "roll_rate")


@query(f"select source, from_bucket, to_bucket, accounts, roll_rate from ({_roll_sql('bureau')}) r")
def roll_rate_by_window(spark: SparkSession, sf: str) -> DataFrame:
    """(account, month) is unique here, so a window does instead of the join."""
    return migration.roll_rates(_snapshot(spark, sf, "bureau"), "bureau", unique_months=True).select("source", "from_bucket", "to_bucket", "accounts", "roll_rate")


@query(_roll_sql("credit_card"))
def roll_rate_balance(spark: SparkSession, sf: str) -> DataFrame:
    return migration.roll_rates(_snapshot(spark, sf, "credit_card"), "credit_card")


@query(_roll_sql("pos_cash"))
def roll_rate_null_balance_source(spark: SparkSession, sf: str) -> DataFrame:
    return migration.roll_rates(_snapshot(spark, sf, "pos_cash"), "pos_cash")


@query(" union all ".join(f"select * from ({_roll_sql(s)}) {s}" for s in ("bureau", "credit_card", "pos_cash")))
def roll_rate_stacked_sources(spark: SparkSession, sf: str) -> DataFrame:
    one, two, three = (migration.roll_rates(_snapshot(spark, sf, s), s) for s in ("bureau", "credit_card", "pos_cash"))
    return one.unionByName(two).unionByName(three)


_BUCKETS = ("CLOSED", "CURRENT", "DPD_1_30", "DPD_31_60", "DPD_61_90", "DPD_91_120", "DPD_120_PLUS")


@query(f"select source, from_bucket, {', '.join(f'''max(case when to_bucket = '{b}' then roll_rate end) as {b}''' for b in _BUCKETS)} from ({_roll_sql('credit_card')}) r group by source, from_bucket")
def roll_rate_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return migration.roll_rate_matrix(migration.roll_rates(_snapshot(spark, sf, "credit_card"), "credit_card"))


@query(_vintage_sql("orders", 3, "orders"))
def vintage_curves(spark: SparkSession, sf: str) -> DataFrame:
    return migration.vintage_curves(_snapshot(spark, sf, "orders"), "orders")


@query(_vintage_sql("orders", 12, "orders"))
def vintage_by_cohort_width(spark: SparkSession, sf: str) -> DataFrame:
    return migration.vintage_curves(_snapshot(spark, sf, "orders"), "orders", 12)


@query(f"""with c as ({_vintage_sql('orders', 3, 'orders')}), f as (select *, row_number() over (order by cohort_start_month desc) as k, avg(cumulative_bad_rate) over (order by cohort_start_month rows between 4 preceding and 1 preceding) as before,
count(*) over (order by cohort_start_month rows between 4 preceding and 1 preceding) as n from c where mob = 12 and accounts_observed >= 20 and cohort_start_month > (select min(cohort_start_month) from c))
select source, cohort_start_month, accounts_observed, accounts_bad, cumulative_bad_rate, round(before, 8) as trailing_bad_rate from f where k = 1 and n = 4""")
def vintage_latest_vs_trailing(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(migration.latest_against_trailing(migration.vintage_curves(_snapshot(spark, sf, "orders"), "orders"), least=20), "trailing_bad_rate")


@query(f"""select source, {', '.join(f"round(coalesce(sum(case when {c} then {v} end), 0), 8) as {p}{n}" for v, p in (('roll_rate', ''), ('balance_roll_rate', 'balance_')) for n, c in (('roll_in', "from_bucket = 'CURRENT' and to_bucket like 'DPD%'"), ('forward', "from_bucket = 'DPD_1_30' and to_bucket like 'DPD%' and to_bucket <> 'DPD_1_30'"), ('cure', "from_bucket = 'DPD_1_30' and to_bucket = 'CURRENT'")))}, count(balance_roll_rate) > 0 as has_balance from ({_roll_sql('credit_card')}) r group by source""")
def roll_check_breaches(spark: SparkSession, sf: str) -> DataFrame:
    out = diagnose.roll_summary(migration.roll_rates(_snapshot(spark, sf, "credit_card"), "credit_card"))
    return _rounded(out, *(c for c, k in out.dtypes if k == "double"))


# ---------------------------------------------------------------------------------------------
# Stability

_SHARES = np.linspace(0, 1, 11)[1:-1].tolist()
_ROWS = f"select * from {sql_view('cohort_rows')} v"


def _csi_sql(column: str, kind: str) -> str:
    """One feature's bins: position, shares, contribution."""
    clean = f"select is_target, {column} as x from ({_ROWS}) r"
    if kind == "numeric":
        bins = f"select is_target, case when x is null then 1000 else len([z for z in e if z < x]) end as position from ({clean}) c, (select list_sort(list_distinct(quantile_cont(x, {_SHARES}))) as e from ({clean}) c where not is_target) q"
        every = "select unnest(range(0, 10)) as position union all select 1000"
    else:
        bins = f"select is_target, case when x is null then 1000 else coalesce(k, 50) end as position from ({clean}) c left join (select x as y, row_number() over (order by count(*) desc, x) - 1 as k from ({clean}) c where not is_target and x is not null group by x qualify k < 50) t on x = y"
        every = f"select distinct position from ({bins}) b union select 50"
    return f"""select '{column}' as feature_name, '{kind}' as feature_type, cast(p.position as integer) as position,
      coalesce(b, 0) / cast(sum(b) over () as double) as baseline_pct, coalesce(t, 0) / cast(sum(t) over () as double) as target_pct
      from ({every}) p left join (select position, count(*) filter (not is_target) as b, count(*) filter (is_target) as t from ({bins}) x group by position) s on p.position = s.position where p.position < 1000 or coalesce(b, 0) + coalesce(t, 0) > 0"""


def _contribution_sql(shares: str) -> str:
    return f"select feature_name, feature_type, position, baseline_pct, target_pct, round((greatest(target_pct, 0.0001) - greatest(baseline_pct, 0.0001)) * ln(greatest(target_pct, 0.0001) / greatest(baseline_pct, 0.0001)), 8) as contribution from ({shares}) s"


def _bins(spark: SparkSession, sf: str, *features: str) -> DataFrame:
    rows = view(spark, sf, "cohort_rows")
    return stability.csi(Cohorts.of(rows.where("not is_target"), rows.where("is_target"), list(features)), list(features))


def _csi(spark: SparkSession, sf: str, *features: str) -> DataFrame:
    return _rounded(_bins(spark, sf, *features), "contribution").drop("bin")


_EDGES = f"(select list_sort(list_distinct(quantile_cont(o_totalprice, {_SHARES}))) as e from ({_ROWS}) r where not is_target)"
_LABEL = "case when i = 0 then '<= ' || printf('%.4g', e[1]) when i = len(e) then '> ' || printf('%.4g', e[i]) else '(' || printf('%.4g', e[i]) || ', ' || printf('%.4g', e[i + 1]) || ']' end"


@query(f"select cast(i as integer) as position, {_LABEL} as bin from (select e, unnest(range(0, len(e) + 1)) as i from {_EDGES} q) x union all select cast(k as integer), x from (select o_orderpriority as x, row_number() over (order by count(*) desc, o_orderpriority) - 1 as k from ({_ROWS}) r where not is_target group by 1) t union all select 50, '__OTHER__'")
def bin_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The names of a numeric feature's bins, to four digits, and of a categorical one's."""
    return _bins(spark, sf, "o_totalprice", "o_orderpriority").select("position", "bin")


@query(_contribution_sql(_csi_sql("o_totalprice", "numeric")))
def psi_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, "o_totalprice")


@query(_contribution_sql(_csi_sql("o_orderpriority", "categorical")))
def psi_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, "o_orderpriority")


@query(_contribution_sql(_csi_sql("weekish", "discrete")))
def psi_discrete(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, "weekish")


@query(_contribution_sql(_csi_sql("price_with_nulls", "numeric")))
def psi_null_bin(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, "price_with_nulls")


@query(_contribution_sql(_csi_sql("many", "categorical")))
def psi_other_bin(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, "many")


_FEATURES = {"o_totalprice": "numeric", "o_orderstatus": "categorical", "o_orderpriority": "categorical", "weekish": "discrete", "price_with_nulls": "numeric", "many": "categorical"}
_ALL = " union all ".join(_contribution_sql(_csi_sql(c, k)) for c, k in _FEATURES.items())


@query(_ALL)
def csi_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return _csi(spark, sf, *_FEATURES)


_COUNTS = f"(select count(*) filter (not is_target) as baseline_rows, count(*) filter (is_target) as target_rows from ({_ROWS}) r)"
_UNROUNDED = _ALL.replace("round((greatest", "((greatest").replace(", 8) as contribution", ") as contribution")


def _report(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "cohort_rows")
    return stability.psi_report("orders_by_half", Cohorts.of(rows.where("not is_target"), rows.where("is_target"), list(_FEATURES)), list(_FEATURES), scores=frozenset(["o_totalprice"]))


@query(f"select 'orders_by_half' as analysis, feature_name, max(feature_type) as feature_type, case when feature_name = 'o_totalprice' then 'score' else 'characteristic' end as role, round(sum(contribution), 8) as psi_score, case when sum(contribution) < 0.1 then 'STABLE' when sum(contribution) < 0.25 then 'MODERATE_SHIFT' else 'SIGNIFICANT_DRIFT' end as drift_status, any_value(baseline_rows) as baseline_rows, any_value(target_rows) as target_rows, true as alerting from ({_UNROUNDED}) a, {_COUNTS} n group by feature_name")
def psi_report_multi_feature(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_report(spark, sf).drop("top_driver"), "psi_score")


_FIRST = f"select feature_name, position, contribution, row_number() over (partition by feature_name order by contribution desc, position) as k from ({_UNROUNDED}) a"


@query(f"select feature_name, cast(position as integer) as position from ({_FIRST}) f where k = 1")
def psi_top_driver(spark: SparkSession, sf: str) -> DataFrame:
    """The place of the bin that contributes most, of every feature; of bins alike, the first."""
    return stability.drivers(_bins(spark, sf, *_FEATURES)).select("feature_name", "position")


@query("select o_orderkey, l_discount * 4 as psi, case when l_discount is null or isnan(l_discount) then 'UNKNOWN' when l_discount * 4 < 0.1 then 'STABLE' when l_discount * 4 < 0.25 then 'MODERATE_SHIFT' else 'SIGNIFICANT_DRIFT' end as drift_status from (select l_orderkey as o_orderkey, cast(l_discount as double) as l_discount from lineitem) l")
def drift_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Of figures on either side of both limits."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_discount").cast("double") * 4).alias("psi"))
    return lines.withColumn("drift_status", stability.drift_label(F.col("psi")))


_LINES = "select DAYS(l_shipdate) as day from lineitem".replace("DAYS(l_shipdate)", "cast(cast(l_shipdate as date) - date '1970-01-01' as bigint)")


@query(f"with t as ({_LINES}), c as (select day as cut from t order by day limit 1 offset (select cast(floor((count(*) - 1) * 0.7) as bigint) from t)) select cast(cut as bigint) as cut, count(*) filter (day <= cut) as baseline_rows, count(*) filter (day > cut) as target_rows from t, c group by cut")
def time_split_lower_quantile(spark: SparkSession, sf: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.unix_date(F.col("l_shipdate").cast("date")).cast("long").alias("day"))
    cut = stability.time_cut(df, "day", 0.7)
    cohorts = Cohorts.by_time(df, "day", ["day"], 0.7)
    return spark.createDataFrame([(cut, cohorts.baseline_rows, cohorts.target_rows)], "cut long, baseline_rows long, target_rows long")


# ---------------------------------------------------------------------------------------------
# Contracts

@query("select * from (values ('price_with_nulls', (select count(*) from orders where month(o_orderdate) > 6 and o_orderkey % 3 = 0)), ('o_orderkey', 0::bigint), ('o_totalprice', 0::bigint)) t(column_name, nulls)")
def schema_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    names = ["price_with_nulls", "o_orderkey", "o_totalprice"]
    return spark.createDataFrame(list(contracts.null_counts(view(spark, sf, "cohort_rows"), names).items()), "column_name string, nulls long")


@query("select 'lineitem' as table_name, count(*) - count(distinct (l_orderkey, l_linenumber)) as surplus from lineitem union all select 'orders', count(*) - count(distinct o_orderkey) from orders")
def schema_pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]}
    return spark.createDataFrame([(t, contracts.surplus_rows(spark.read.parquet(f"{sf}/{t}.parquet"), k)) for t, k in keys.items()], "table_name string, surplus long")


def _profile_sql(table: str, columns: dict[str, str], rows: str) -> str:
    """What DuckDB finds: type by its own name, and whether there are nulls."""
    kind = "case when typeof(any_value({c})) in ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') then 'int' when typeof(any_value({c})) in ('FLOAT', 'DOUBLE') then 'float' else 'string' end"
    return " union all ".join(f"select '{table}' as \"table\", '{name}' as \"column\", {kind.format(c=c)} as s_type, count(*) filter ({c} is null) > 0 as s_nullable from {rows}" for name, c in columns.items())


_APPLICATION = {c: c for c in ("SK_ID_CURR", "TARGET", "SEGMENT", "NATION")}


@query(f"select \"column\" as column_name, s_type as kind, s_nullable as nullable from ({_profile_sql('application', _APPLICATION, sql_view('application') + ' v')}) p")
def schema_infer_profile(spark: SparkSession, sf: str) -> DataFrame:
    found = contracts.infer_contract("application", view(spark, sf, "application"), ["SK_ID_CURR"])
    return spark.createDataFrame([(c, s["type"], s["nullable"]) for c, s in found.columns.items()], "column_name string, kind string, nullable boolean")


def _agreed_sql(*tables: str) -> str:
    """Built-in contracts as rows."""
    rows = [f"('{t}', '{c}', '{s['type']}', {str(s['nullable']).lower()})" for t in tables for c, s in home_credit.contract(t)["strict_schema"]["columns"].items()]
    return f"(values {', '.join(rows)}) a(\"table\", \"column\", a_type, a_nullable)"


def _drift_sql(agreed: str, seen: str) -> str:
    """In a contract here, a column is required if it holds no nulls."""
    return f"""select * from (select "table", "column",
      case when s_type is null then 'column_removed' when a_type is null then 'column_added' when a_type <> s_type then 'type_changed' end as kind,
      case when s_type is null then 'present' when a_type is null then 'absent' else a_type end as baseline, coalesce(s_type, 'absent') as observed,
      case when s_type is null and not a_nullable then 'breaking' when s_type is null or a_type is null or (a_type = 'int' and s_type = 'float') then 'warning' else 'breaking' end as severity
      from {agreed} full join ({seen}) s using ("table", "column")) x where kind is not null
    union all select "table", "column", case when s_nullable then 'nulls_introduced' else 'nulls_absent' end, case when s_nullable then 'non-nullable' else 'nullable' end,
      case when s_nullable then 'nullable' else 'no nulls observed' end, case when s_nullable then 'breaking' else 'info' end
      from {agreed} join ({seen}) s using ("table", "column") where a_nullable <> s_nullable"""


_SEEN = {
    "bureau_balance": ({"SK_ID_BUREAU": "SK_ID_BUREAU", "MONTHS_BALANCE": "cast(MONTHS_BALANCE as double)", "CHANNEL": "STATUS"}, f"{sql_view('bureau_balance')} v"),
    "installments_payments": ({c: c for c in ("SK_ID_CURR", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")}, f"(select * replace (cast(AMT_INSTALMENT as double) as AMT_INSTALMENT, cast(AMT_PAYMENT as double) as AMT_PAYMENT) from {sql_view('installments_payments')} i) v"),
}
_SEEN_SQL = " union all ".join(_profile_sql(t, c, rows) for t, (c, rows) in _SEEN.items())
_REPEATED = f"select 'bureau_balance' as \"table\", 'SK_ID_BUREAU,MONTHS_BALANCE' as \"column\", 'primary_key_duplicates' as kind, 'unique' as baseline, n || ' duplicate rows' as observed, 'breaking' as severity from (select count(*) - count(distinct (SK_ID_BUREAU, MONTHS_BALANCE)) as n from {sql_view('bureau_balance')} v) x where n > 0"


def _drifted(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Monthly rows with one column lost, one gained and one widened, and payments as they are."""
    months = view(spark, sf, "bureau_balance").select("SK_ID_BUREAU", F.col("MONTHS_BALANCE").cast("double").alias("MONTHS_BALANCE"), F.col("STATUS").alias("CHANNEL"))
    return {"bureau_balance": months, "installments_payments": _plain(view(spark, sf, "installments_payments"))}


_DRIFT_SQL = f"select * from ({_drift_sql(_agreed_sql(*_SEEN), _SEEN_SQL)}) d union all {_REPEATED}"


@query(f"select *, 1::bigint as schema_version from ({_DRIFT_SQL}) d")
def drift_findings(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.drift_report(spark, _drifted(spark, sf))


@query(_drift_sql(_agreed_sql("application_train").replace("'application_train'", "'application'"), f"select 'application' as \"table\", c as \"column\", k as s_type, n as s_nullable from (values {', '.join(f"('{c}', '{s['type']}', {str(s['nullable']).lower()})" for c, s in home_credit.contract('application_test')['strict_schema']['columns'].items())}) t(c, k, n)"))
def schema_versions_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored versions, through the registry's files: the training table's contract, then the scoring population's."""
    folder = tempfile.mkdtemp()  # configuration on the driver, no data
    try:
        registry = contracts.Registry(folder)
        for table in ("application_train", "application_test"):
            registry.write_version(contracts.Contract.from_dict(home_credit.contract(table) | {"table_name": "application"}), bump=table != "application_train")
        return contracts.compare_versions(spark, "application", folder=folder)
    finally:
        shutil.rmtree(folder)


@query(f"select 1 + (count(*) filter (STATUS is null) > 0)::int as violations, count(*) - count(distinct (SK_ID_BUREAU, MONTHS_BALANCE)) as repeated from {sql_view('bureau_balance')} v where exists (select 1 from {sql_view('bureau_balance')} w group by SK_ID_BUREAU, MONTHS_BALANCE having count(*) > 1)")
def validate_frame_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly rows keep to the contract but for the key, whose repeated rows are told."""
    df = view(spark, sf, "bureau_balance").select("SK_ID_BUREAU", F.col("MONTHS_BALANCE").cast("long").alias("MONTHS_BALANCE"), "STATUS")
    found = contracts.SchemaValidator.for_table("bureau_balance").validate_frame(df)
    repeated = [int(re.search(r"has (\d+) duplicate", x)[1]) for x in found if "duplicate" in x]
    return spark.createDataFrame([(len(found), sum(repeated))], "violations int, repeated long").where("repeated > 0")


@query("select t as \"table\", (t = 'bureau_balance') as accepted from (values ('bureau_balance'), ('bureau'), ('installments_payments')) v(t)")
def validate_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which views of the test tables have the columns that their contract asks for, and no others."""
    names = ("bureau_balance", "bureau", "installments_payments")
    told = [(t, contracts.SchemaValidator.for_table(t).validate_columns(view(spark, sf, t).columns)) for t in names]
    return spark.createDataFrame(told, "table string, accepted boolean")


# ---------------------------------------------------------------------------------------------
# Exploration


@query(f"select SEGMENT, count(*) as accounts, avg(TARGET) as default_rate from {sql_view('application')} a group by SEGMENT having count(*) >= 10")
def default_rate_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "application").groupBy("SEGMENT").agg(F.count("*").alias("accounts"), F.avg("TARGET").alias("default_rate")).where("accounts >= 10")


@query("select 'price_with_nulls' as column_name, cast((select count(*) from orders where month(o_orderdate) > 6 and o_orderkey % 3 = 0) as double) / count(*) as null_share from orders")
def missingness_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "cohort_rows")
    wide = rows.agg(*((F.count_if(F.col(c).isNull()).cast("double") / F.count("*")).alias(c) for c in rows.columns if c != "is_target"))
    return wide.unpivot([], wide.columns, "column_name", "null_share").orderBy(F.desc("null_share"), "column_name").limit(1)


@query(f"select count(*) as applications, avg(TARGET) as default_rate, cast(sum(TARGET) as bigint) as defaults from {sql_view('application')} a")
def target_balance(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "application").agg(F.count("*").alias("applications"), F.avg("TARGET").alias("default_rate"), F.sum("TARGET").alias("defaults"))


@query(f"select least(greatest(ip_late_payments, 0), 10) as late_payments_capped, count(*) as accounts, avg(TARGET) as default_rate from ({_MAR}) m group by 1")
def capped_late_payments(spark: SparkSession, sf: str) -> DataFrame:
    capped = F.least(F.greatest("ip_late_payments", F.lit(0)), F.lit(10)).cast("long")
    return mar_full(spark, sf).groupBy(capped.alias("late_payments_capped")).agg(F.count("*").alias("accounts"), F.avg("TARGET").alias("default_rate"))


@query(f"select bureau_total_delinquent_months > 0 as any_bureau_delinquency, count(*) as accounts, avg(TARGET) as default_rate from ({_MAR}) m group by 1")
def any_bureau_delinquency(spark: SparkSession, sf: str) -> DataFrame:
    return mar_full(spark, sf).groupBy((F.col("bureau_total_delinquent_months") > 0).alias("any_bureau_delinquency")).agg(F.count("*").alias("accounts"), F.avg("TARGET").alias("default_rate"))


# ---------------------------------------------------------------------------------------------
# Scores

_STEPS = f"(select score, sum(TARGET) as b, sum(1 - TARGET) as g from {sql_view('scored')} s group by score)"
_ABOVE = f"(select score, b, g, sum(b) over (order by score desc) as cb, sum(g) over (order by score desc) as cg, sum(b) over () as tb, sum(g) over () as tg from {_STEPS} s)"


@query(f"select round(sum((2.0 * (cb - b) + b) * g) / any_value(2.0 * tb * tg), 8) as auc, round(2 * sum((2.0 * (cb - b) + b) * g) / any_value(2.0 * tb * tg) - 1, 8) as gini from {_ABOVE} t")
def auc_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(discrimination(view(spark, sf, "scored")).select("auc", "gini"), "auc", "gini")


@query(f"select round(greatest(max(cast(cb as double) / tb - cast(cg as double) / tg), 0), 8) as ks from {_ABOVE} t")
def ks_statistic(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(discrimination(view(spark, sf, "scored")).select("ks"), "ks")


@query(f"select round(avg((score - TARGET) * (score - TARGET)), 8) as brier, round(avg(score), 8) as mean_predicted, round(avg(TARGET), 8) as base_rate from {sql_view('scored')} s")
def brier_score(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(brier(view(spark, sf, "scored")), "brier", "mean_predicted", "base_rate")


@query(f"select cast(bin as integer) as bin, count(*) as accounts, round(avg(score), 8) as mean_score, round(avg(TARGET), 8) as observed_rate from (select *, ntile(10) over (order by score, SK_ID_CURR) as bin from {sql_view('scored')} s) t group by bin")
def calibration_deciles(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibration(view(spark, sf, "scored")), "mean_score", "observed_rate")
