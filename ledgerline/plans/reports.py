"""Queries over verdicts, files, exploration and models, registered beside those of ``contract``."""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import brier, discrimination
from ..operators import default_model, diagnose, master_record, migration, stability
from ..sources.csv_ingest import CsvToParquet, read_csv
from ..sources.engine import Engine
from ..sources.tables import read_table, read_text, write_bytes, write_report, write_table, write_text
from .contract import _ABOVE, _BUCKETS, _COUNTS, _DRIFT_SQL, _MAR, _ROWS, _UNROUNDED, _plain, _report, _roll_sql, _rounded, _snapshot, _vintage_sql, drift_findings, mar_full, query, roll_rate_stacked_sources
from .mapping import sql_view, view

# ---------------------------------------------------------------------------------------------
# Exploration


@query(f"select NATION, count(*) as accounts, round(avg(TARGET), 8) as default_rate from {sql_view('application')} a group by NATION having count(*) >= 5 order by round(avg(TARGET), 8) desc, NATION limit 10")
def default_rate_top_nations(spark: SparkSession, sf: str) -> DataFrame:
    """A report of ten rows."""
    rates = view(spark, sf, "application").groupBy("NATION").agg(F.count("*").alias("accounts"), F.round(F.avg("TARGET"), 8).alias("default_rate"))
    return rates.where("accounts >= 5").orderBy(F.desc("default_rate"), "NATION").limit(10)


@query(f"select source, cohort_start_month, accounts_observed, cumulative_bad_rate from ({_vintage_sql('orders', 3, 'orders')}) c where mob = 12 and accounts_observed >= 20")
def vintage_at_twelve(spark: SparkSession, sf: str) -> DataFrame:
    curves = migration.vintage_curves(_snapshot(spark, sf, "orders"), "orders")
    return curves.where("mob = 12 and accounts_observed >= 20").select("source", "cohort_start_month", "accounts_observed", "cumulative_bad_rate")


_LATE = "['DPD_1_30', 'DPD_31_60', 'DPD_61_90', 'DPD_91_120', 'DPD_120_PLUS']"


def _moved(value: str) -> str:
    return f"round(coalesce(sum(case when f = from_bucket and list_contains(t, to_bucket) then {value} end), 0), 4)"


@query(f"select transition, {_moved('roll_rate')} as by_account_count, {_moved('balance_roll_rate')} as by_balance from ({_roll_sql('credit_card')}) r, (values ('forward', 'DPD_1_30', {_LATE}[2:]), ('cure', 'DPD_1_30', ['CURRENT']), ('roll_in', 'CURRENT', {_LATE})) m(transition, f, t) group by transition")
def roll_rates_by_count_and_balance(spark: SparkSession, sf: str) -> DataFrame:
    """All numbers rounded, whatever their names."""
    one = diagnose.roll_summary(migration.roll_rates(_snapshot(spark, sf, "credit_card"), "credit_card"))
    pairs = F.array(*(F.struct(F.lit(m).alias("transition"), F.col(m).alias("by_account_count"), F.col(f"balance_{m}").alias("by_balance")) for m in ("roll_in", "forward", "cure")))
    return _rounded_numbers(one.select(F.inline(pairs)), 4)


def _rounded_numbers(df: DataFrame, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, k in df.dtypes if k == "double"})


_PIVOTED = ", ".join(f"round(max(case when to_bucket = '{b}' then roll_rate end), 3) as {b}" for b in _BUCKETS)


@query(f"select source, from_bucket, {_PIVOTED} from ({_roll_sql('bureau')}) r group by source, from_bucket")
def roll_rate_pivot_rounded(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_numbers(migration.roll_rate_matrix(migration.roll_rates(_snapshot(spark, sf, "bureau"), "bureau")), 3)


# ---------------------------------------------------------------------------------------------
# Verdict: facts beside rules, from each report


def _judged(facts: DataFrame) -> DataFrame:
    return _rounded(diagnose.judged(facts, diagnose.rules_of()).drop("note"), "value")


_STACKED = " union all ".join(f"select * from ({_roll_sql(s)}) {s}" for s in ("bureau", "credit_card", "pos_cash"))
_MOVES = (
    ("roll_in_max", "current accounts that turn delinquent", "CURRENT", "to_bucket like 'DPD%'", "0.05", "grant"),
    ("forward_max", "1-30 days late that get later", "DPD_1_30", "to_bucket like 'DPD%' and to_bucket <> 'DPD_1_30'", "case when source = 'bureau' then 0.15 else 0.1 end", "collect"),
    ("cure", "1-30 days late that cure", "DPD_1_30", "to_bucket = 'CURRENT'", "null", ""),
)
_MOVED = " union all ".join(
    f"""select 'rolls' as topic, source as scope, '{words}{item}' as item, '{mark}{measure}' as measure, coalesce(sum(case when from_bucket = '{start}' and {ends} then {column} end), 0) as value,
    cast(null as double) as support, {limit} as "limit", '{advice}' as advice, count(balance_roll_rate) as balances from ({_STACKED}) r group by source"""
    for mark, words, column in (("", "", "roll_rate"), ("balance_", "by balance, ", "balance_roll_rate"))
    for measure, item, start, ends, limit, advice in _MOVES
)
_ROLL_FACTS = f"""select topic, scope, item, measure, round(value, 8) as value, support, case when value > "limit" then 'warning' else 'ok' end as level, cast(case when value > "limit" then "limit" end as double) as "limit",
  case when value > "limit" then advice end as advice from ({_MOVED}) f where balances > 0 or measure not like 'balance%'"""


@query(_ROLL_FACTS)
def verdict_rolls(spark: SparkSession, sf: str) -> DataFrame:
    """Limits of the thresholds file, some for one source only."""
    return _judged(diagnose.roll_facts(roll_rate_stacked_sources(spark, sf)))


_VINTAGE_FACTS = f"""with c as ({_vintage_sql('orders', 3, 'orders')}), f as (select *, row_number() over (order by cohort_start_month desc) as k, avg(cumulative_bad_rate) over (order by cohort_start_month rows between 4 preceding and 1 preceding) as before,
count(*) over (order by cohort_start_month rows between 4 preceding and 1 preceding) as n from c where mob = 12 and accounts_observed >= 20 and cohort_start_month > (select min(cohort_start_month) from c)),
v as (select s.source, case when before <> 0 then cumulative_bad_rate / before when cumulative_bad_rate > 0 then 'inf'::double when cumulative_bad_rate is not null then 1.0 end as value, cast(accounts_bad as double) as support
from (select distinct source from c) s left join (select * from f where k = 1 and n = 4) l on l.source = s.source)
select 'vintages' as topic, source as scope, 'newest cohort' as item, 'vintage_ratio' as measure, round(value, 8) as value, support, case when value > 1.25 and support >= 30 then 'warning' else 'ok' end as level,
case when value > 1.25 and support >= 30 then 1.25::double end as "limit", case when value > 1.25 and support >= 30 then 'lend' end as advice from v"""


@query(_VINTAGE_FACTS)
def verdict_vintages(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(diagnose.vintage_facts(migration.vintage_curves(_snapshot(spark, sf, "orders"), "orders"), least=20))


_PSI_FACTS = f"""select 'stability' as topic, 'orders_by_half' as scope, feature_name as item, 'psi' as measure, round(psi, 8) as value, cast(null as double) as support, case when psi >= 0.25 then 'critical' when psi >= 0.1 then 'warning' else 'ok' end as level,
case when psi >= 0.25 then 0.25::double when psi >= 0.1 then 0.1::double end as "limit", case when psi >= 0.25 then 'refit' when psi >= 0.1 then 'trace' end as advice
from (select feature_name, sum(contribution) as psi from ({_UNROUNDED}) a group by feature_name) p where not starts_with(feature_name, 'SK_ID')"""


@query(_PSI_FACTS)
def verdict_stability(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(diagnose.stability_facts(_report(spark, sf)))


_CONTRACT_FACTS = f"""select 'contracts' as topic, "table" as scope, kind || ' ' || "table" || case when "column" <> '' then '.' || "column" else '' end as item, 'contract_' || severity as measure, 1.0::double as value, cast(null as double) as support,
case severity when 'breaking' then 'critical' when 'warning' then 'warning' else 'ok' end as level, case when severity <> 'info' then 0.0::double end as "limit", case severity when 'breaking' then 'mend' when 'warning' then 'revise' end as advice from ({_DRIFT_SQL}) d"""


@query(_CONTRACT_FACTS)
def verdict_contracts(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(diagnose.contract_facts(drift_findings(spark, sf)))


_MEASURES = f"select count(*) as n, avg(score) as predicted, avg(TARGET) as rate from {sql_view('scored')} s"
_POWER = f"select sum((2.0 * (cb - b) + b) * g) / any_value(2.0 * tb * tg) as auc, greatest(max(cast(cb as double) / tb - cast(cg as double) / tg), 0) as ks from {_ABOVE} t"
_TOLD = (("AUC", "min_auc", "auc", "0.7", "auc < 0.7", "separate"), ("KS", "min_ks", "ks", "0.3", "ks < 0.3", "separate"), ("Gini", "gini", "2 * auc - 1", "0", "false", ""), ("Distance from the observed level", "max_calibration_error", "abs(predicted / rate - 1)", "0.1", "abs(predicted / rate - 1) > 0.1", "calibrate"))
_MODEL_FACTS = " union all ".join(
    f"""select 'model' as topic, 'default model' as scope, '{item}' as item, '{measure}' as measure, round({value}, 8) as value, cast(n as double) as support, case when {bad} then 'warning' else 'ok' end as level,
    case when {bad} then {at}::double end as "limit", case when {bad} then '{advice}' end as advice from ({_MEASURES}) m, ({_POWER}) p"""
    for item, measure, value, at, bad, advice in _TOLD
)


@query(_MODEL_FACTS)
def verdict_model(spark: SparkSession, sf: str) -> DataFrame:
    """Through the metrics file, as the verdict reads it."""
    scored, path = view(spark, sf, "scored"), _scratch(spark, "metrics") + "/model_metrics.json"
    power, level = discrimination(scored).first(), brier(scored).first()
    write_text(spark, json.dumps({**power.asDict(), **level.asDict(), "n_holdout": scored.count()}), path)
    return _judged(diagnose.model_facts(spark, json.loads(read_text(spark, path))))


_WORST = " union all ".join(f"select topic, level from ({x}) {n}" for n, x in (("r", _ROLL_FACTS), ("v", _VINTAGE_FACTS), ("p", _PSI_FACTS), ("c", _CONTRACT_FACTS), ("m", _MODEL_FACTS)))


@query(f"select topic, max(case level when 'critical' then 2 when 'warning' then 1 else 0 end)::int as rank, count(*) filter (level <> 'ok') as breaches, count(*) as facts from ({_WORST}) w group by topic")
def diagnose_status(spark: SparkSession, sf: str) -> DataFrame:
    """What the brief opens with: each topic's worst level, breaches and facts."""
    told = functools.reduce(DataFrame.unionByName, (q(spark, sf).select("topic", "level") for q in (verdict_rolls, verdict_vintages, verdict_stability, verdict_contracts, verdict_model)))
    rank = F.when(F.col("level") == "critical", 2).when(F.col("level") == "warning", 1).otherwise(0)
    return told.groupBy("topic").agg(F.max(rank).alias("rank"), F.count_if(F.col("level") != "ok").alias("breaches"), F.count("*").alias("facts"))


# ---------------------------------------------------------------------------------------------
# Files and models


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, under the shared one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file:///tmp/checkpoints/ledgerline"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("select o_orderkey, o_totalprice, o_orderstatus from orders")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "csv_roundtrip")
    spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus").write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path)


def _csv_text(df: DataFrame, mark: str = "") -> str:
    """Of a small table; ``mark`` ends each line."""
    return "\n".join([",".join(df.columns), *(",".join(map(str, r)) + mark for r in df.collect()), ""])


@query("select 'nested/region' as name, count(*) as n, count(r_name) as named, max(length(r_name)) as longest from region union all select 'nation', count(*), count(n_name), max(length(n_name)) + 1 from nation")
def ingest_folder(spark: SparkSession, sf: str) -> DataFrame:
    """A tree of CSV files: one in a folder below, one in Latin-1, one without a byte, and one file of another kind."""
    raw, out = _scratch(spark, "raw"), _scratch(spark, "ingested")
    nation = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_name")
    region = spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey", "r_name")
    write_bytes(spark, _csv_text(nation, "é").encode("latin-1"), f"{raw}/nation.csv")
    for name, text in (("nested/region.csv", _csv_text(region)), ("empty.csv", ""), ("notes.txt", "a,b\n1,2\n")):
        write_bytes(spark, text.encode(), f"{raw}/{name}")
    parts = []
    for path in CsvToParquet(spark, raw, out).convert_all():
        name = path.removeprefix(f"{out}/").removesuffix(".parquet")
        column = "n_name" if name == "nation" else "r_name"
        # the last letter of each name in the Latin-1 file is whole
        whole = spark.read.parquet(path).where(F.lit(name != "nation") | F.col(column).endswith("é"))
        parts.append(whole.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.count(column).alias("named"), F.max(F.length(column)).alias("longest")))
    return functools.reduce(DataFrame.unionByName, parts)


@query(_STACKED)
def report_pair(spark: SparkSession, sf: str) -> DataFrame:
    """A report as Parquet and as one CSV file: the rows of the latter, if the former has as many."""
    folder = _scratch(spark, "report")
    write_report(roll_rate_stacked_sources(spark, sf), folder, "roll_rate_matrix")
    kept = spark.read.parquet(f"{folder}/roll_rate_matrix.parquet")
    told = spark.read.schema(kept.schema).option("header", True).csv(f"{folder}/roll_rate_matrix.csv")
    return told.where(F.lit(told.count() == kept.count()))


def _processed(spark: SparkSession, sf: str, tables: dict[str, str]) -> str:
    folder = _scratch(spark, "processed")
    for name, source in tables.items():
        write_table(_plain(view(spark, sf, source)), folder, name)
    return folder


_HISTORY = ("bureau", "bureau_balance", "installments_payments", "previous_application")


@query(f"select * exclude (TARGET), 'master_analytical_record_test' as record from ({_MAR}) m")
def record_files(spark: SparkSession, sf: str) -> DataFrame:
    """From the files of a folder to the scoring population's record, under its own name."""
    folder = _scratch(spark, "processed")
    for name in _HISTORY:
        write_table(view(spark, sf, name), folder, name)
    write_table(view(spark, sf, "application").drop("TARGET"), folder, "application_test")
    path = master_record.build_master_record(spark, folder, "application_test")
    return _plain(spark.read.parquet(path)).withColumn("record", F.lit(path.rsplit("/", 1)[-1].removesuffix(".parquet")))


@query(" union all ".join(f"select * from ({_vintage_sql(s, 3, s)}) {s}" for s in ("bureau", "credit_card")))
def vintage_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Every source whose table is in the folder, stacked and written."""
    folder = _processed(spark, sf, {"bureau_balance": "snapshot_bureau", "credit_card_balance": "snapshot_card"})
    migration.build_vintage_reports(spark, folder)
    return spark.read.parquet(f"{folder}/vintage_curves.parquet")


@query(f"select 'first_against_second' as analysis, feature_name, max(feature_type) as feature_type, case when feature_name = 'o_totalprice' then 'score' else 'characteristic' end as role, round(sum(contribution), 8) as psi_score, any_value(baseline_rows) as baseline_rows, any_value(target_rows) as target_rows, true as alerting from ({_UNROUNDED}) a, {_COUNTS} n where feature_name <> 'weekish' group by feature_name")
def stability_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole configured run over files: columns that both tables have, less those excluded by name or prefix; one analysis lacks its table."""
    folder, rows = _scratch(spark, "processed"), view(spark, sf, "cohort_rows").withColumn("SK_ID_CURR", F.col("o_orderkey"))
    write_table(rows.where("not is_target").drop("is_target").withColumn("only_here", F.lit(1)), folder, "first")
    write_table(rows.where("is_target").drop("is_target"), folder, "second")
    analyses = [{"name": "first_against_second", "baseline": "first", "target": "second", "score_columns": ["o_totalprice"], "exclude_prefixes": ["week"]}, {"name": "absent", "table": "nowhere", "time_column": "day", "alert": False}]
    config = {"bins": 10, "exclude_prefixes": ["SK_ID"], "exclude_columns": ["TARGET", "o_orderkey", "day"], "analyses": analyses}
    return _rounded(stability.run_stability(spark, folder, config).drop("top_driver", "drift_status"), "psi_score")


@query(f"with s as (select day from ({_ROWS}) r where day is not null), c as (select day as cut from s order by day limit 1 offset (select cast(floor((count(*) - 1) * 0.7) as bigint) from s)) select 'orders_by_recency' as analysis, f as feature_name, count(*) filter (day <= cut) as baseline_rows, count(*) filter (day > cut) as target_rows, false as alerting from s, c, (values ('o_orderstatus'), ('o_orderpriority'), ('weekish')) v(f) group by f")
def stability_by_recency(spark: SparkSession, sf: str) -> DataFrame:
    """One table, split by time, without alerts."""
    folder = _scratch(spark, "processed")
    write_table(view(spark, sf, "cohort_rows").select("day", "o_orderstatus", "o_orderpriority", "weekish"), folder, "orders")
    config = {"analyses": [{"name": "orders_by_recency", "table": "orders", "time_column": "day", "alert": False}]}
    return stability.run_stability(spark, folder, config).select("analysis", "feature_name", "baseline_rows", "target_rows", "alerting")


@query(f"select SEGMENT, (row_number() over (order by count(*) desc, SEGMENT) - 1)::double as code from {sql_view('application')} a group by SEGMENT")
def ordinal_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """The model's codes of a text feature: the most frequent value is 0."""
    rows = view(spark, sf, "application")
    return default_model.encoder(["SEGMENT"]).fit(rows).transform(rows).select("SEGMENT", F.col("SEGMENT__index").alias("code")).distinct()


@query(f"select column_name as feature from (describe select * from ({_MAR}) m) d where column_name not in ('SK_ID_CURR', 'TARGET')")
def model_features(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(c,) for c in default_model.feature_columns(mar_full(spark, sf).columns)], "feature string")


@query(f"select SEGMENT, count(*) as n, sum(TARGET)::bigint as bad from {sql_view('application')} a group by SEGMENT")
def sql_connection(spark: SparkSession, sf: str) -> DataFrame:
    """SQL through the engine, over a frame that it keeps in a folder."""
    with Engine(_scratch(spark, "warehouse"), spark) as engine:
        engine.save("application", view(spark, sf, "application"))
        return engine.query("select SEGMENT, count(*) as n, sum(TARGET) as bad from {application} group by SEGMENT", application=engine.table("application"))


_SOME = ("SK_ID_CURR", "TARGET", "bureau_total_accounts", "prev_mean_amt_application")


@query(f"select {', '.join(f'count({c}) as {c}' for c in _SOME)} from ({_MAR}) m")
def record_column_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A read of some columns of the written record."""
    folder = _scratch(spark, "record")
    write_table(mar_full(spark, sf), folder, "record")
    return read_table(spark, folder, "record").agg(*(F.count(c).alias(c) for c in _SOME))


@query()
def score_population(spark: SparkSession, sf: str) -> DataFrame:
    """Every applicant, without the target, by a model of the default number of trees, with its importances."""
    path, record = _scratch(spark, "model"), mar_full(spark, sf)
    default_model.train_model(spark, record, path, path)
    return default_model.score_frame(record.drop("TARGET"), path)


@query("select TARGET, cast(round(0.2 * count(*)) as bigint) as held_out from (select case when c_acctbal < 0 then 1 else 0 end as TARGET from customer) c group by TARGET")
def stratified_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return default_model.stratified_split(view(spark, sf, "application"))[1].groupBy("TARGET").agg(F.count("*").alias("held_out"))
