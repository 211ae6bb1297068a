"""Roll rates and vintage curves from monthly account snapshots."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.delinquency import BAD_DAYS, days_bucket, exposure, floor_to, status_bucket
from ..sources.tables import exists, read_table, table_path, write_report

MONTH = "MONTHS_BALANCE"
MONTHS_PER_COHORT = 3
LAST_MONTH_ON_BOOK = 96


@dataclass(frozen=True)
class Source:
    """How a table's rows become (acct, month, bucket, is_bad, balance)."""

    table: str
    account: str
    usable: Callable[[], Column]
    bucket: Callable[[], Column]
    bad: Callable[[], Column]
    balance: Callable[[], Column] | None = None

    def snapshot(self, df: DataFrame) -> DataFrame:
        balance = self.balance() if self.balance else F.lit(None)
        return df.where(self.usable()).select(
            F.col(self.account).alias("acct"),
            F.col(MONTH).alias("month"),
            self.bucket().alias("bucket"),
            self.bad().alias("is_bad"),
            balance.cast("double").alias("balance"),
        )


def _by_days(table: str, balance: Callable[[], Column] | None = None) -> Source:
    days = lambda: F.col("SK_DPD")
    return Source(table, "SK_ID_PREV", lambda: days().isNotNull(), lambda: days_bucket(days(), F.col("NAME_CONTRACT_STATUS")), lambda: days() > BAD_DAYS, balance)


SOURCES = {
    "bureau": Source("bureau_balance", "SK_ID_BUREAU", lambda: F.col("STATUS") != "X", lambda: status_bucket(F.col("STATUS")), lambda: F.col("STATUS").isin("3", "4", "5")),
    "credit_card": _by_days("credit_card_balance", lambda: exposure(F.col("AMT_BALANCE"))),
    "pos_cash": _by_days("POS_CASH_balance"),
}


def transitions(snapshot: DataFrame, unique_months: bool = False) -> DataFrame:
    """from_bucket, to_bucket, balance (of the month rolled from), for consecutive months only.

    The join is an equi-join on account and month. Where (acct, month) is known to be unique, a window
    does with one shuffle and one pass.
    """
    if unique_months:
        next_month = Window.partitionBy("acct").orderBy("month")
        ahead = snapshot.select("*", F.lead("bucket").over(next_month).alias("to_bucket"), F.lead("month").over(next_month).alias("next"))
        return ahead.where(F.col("next") == F.col("month") + 1).select(F.col("bucket").alias("from_bucket"), "to_bucket", "balance")
    later = snapshot.select("acct", (F.col("month") - 1).alias("month"), F.col("bucket").alias("to_bucket"))
    return snapshot.join(later, ["acct", "month"]).select(F.col("bucket").alias("from_bucket"), "to_bucket", "balance")


def roll_rates(snapshot: DataFrame, source: str, unique_months: bool = False) -> DataFrame:
    """Shares of each from_bucket's transitions, by accounts and by opening balance (null without balances)."""
    counted = transitions(snapshot, unique_months).groupBy("from_bucket", "to_bucket").agg(F.count("*").alias("accounts"), F.sum("balance").alias("balance"))
    of = Window.partitionBy("from_bucket")
    return counted.select(
        F.lit(source).alias("source"),
        "from_bucket",
        "to_bucket",
        "accounts",
        (F.col("accounts").cast("double") / F.sum("accounts").over(of)).alias("roll_rate"),
        "balance",
        F.try_divide("balance", F.sum("balance").over(of)).alias("balance_roll_rate"),
    )


def roll_rate_matrix(rates: DataFrame, value: str = "roll_rate") -> DataFrame:
    """One row per from_bucket, one column per bucket."""
    names = ["CLOSED", "CURRENT", "DPD_1_30", "DPD_31_60", "DPD_61_90", "DPD_91_120", "DPD_120_PLUS"]
    return rates.groupBy("source", "from_bucket").pivot("to_bucket", names).agg(F.first(value))


def accounts(snapshot: DataFrame) -> DataFrame:
    """Of each account: first month, months observed since, months until first bad (null if never)."""
    first = F.min("month")
    return snapshot.groupBy("acct").agg(
        first.alias("open_month"),
        (F.max("month") - first).alias("max_mob"),
        (F.min(F.when(F.col("is_bad"), F.col("month"))) - first).alias("first_bad_mob"),
    )


def vintage_curves(snapshot: DataFrame, source: str, months_per_cohort: int = MONTHS_PER_COHORT) -> DataFrame:
    """Share of a cohort's accounts that have gone bad by each month on book, of those observed that long.

    Accounts are first counted by (cohort, months observed, first bad month), at most a few thousand
    groups; only those are spread over the months on book.
    """
    cohort = floor_to(F.col("open_month"), months_per_cohort)
    groups = accounts(snapshot).groupBy(cohort.alias("cohort_start_month"), F.least("max_mob", F.lit(LAST_MONTH_ON_BOOK)).cast("int").alias("max_mob"), F.col("first_bad_mob").cast("int").alias("first_bad_mob")).agg(F.count("*").alias("n"))
    spread = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("max_mob"))).alias("mob"))
    counts = spread.groupBy("cohort_start_month", "mob").agg(F.sum("n").alias("accounts_observed"), F.coalesce(F.sum(F.when(F.col("first_bad_mob") <= F.col("mob"), F.col("n"))), F.lit(0)).alias("accounts_bad"))
    rate = F.col("accounts_bad").cast("double") / F.col("accounts_observed")
    return counts.select(F.lit(source).alias("source"), "cohort_start_month", "mob", "accounts_observed", "accounts_bad", rate.alias("cumulative_bad_rate"))


def latest_against_trailing(curves: DataFrame, mob: int = 12, least: int = 1000, trailing: int = 4) -> DataFrame:
    """Per source, the newest cohort at a month on book beside the mean of those just before it; the oldest cohort of all stays out."""
    oldest = Window.partitionBy("source")
    fit = curves.withColumn("oldest", F.min("cohort_start_month").over(oldest)).where((F.col("mob") == mob) & (F.col("accounts_observed") >= least) & (F.col("cohort_start_month") > F.col("oldest")))
    order = Window.partitionBy("source").orderBy("cohort_start_month")
    before = order.rowsBetween(-trailing, -1)
    ranked = fit.select("*", F.avg("cumulative_bad_rate").over(before).alias("trailing_bad_rate"), F.count("*").over(before).alias("n_before"), F.lead("cohort_start_month").over(order).alias("newer"))
    return ranked.where(F.col("newer").isNull() & (F.col("n_before") == trailing)).select("source", "cohort_start_month", "accounts_observed", "accounts_bad", "cumulative_bad_rate", "trailing_bad_rate")


def compute_roll_rates(spark: SparkSession, folder: str, source: str = "bureau") -> DataFrame:
    spec = SOURCES[source]
    return roll_rates(spec.snapshot(read_table(spark, folder, spec.table)), source).orderBy("from_bucket", "to_bucket")


def compute_vintage(spark: SparkSession, folder: str, source: str = "bureau", months_per_cohort: int = MONTHS_PER_COHORT) -> DataFrame:
    spec = SOURCES[source]
    return vintage_curves(spec.snapshot(read_table(spark, folder, spec.table)), source, months_per_cohort).orderBy("cohort_start_month", "mob")


def build_vintage_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Both analyses of every source that is there, stacked, as Parquet and CSV. Raises FileNotFoundError if there is none."""
    present = [n for n, s in SOURCES.items() if exists(spark, table_path(folder, s.table))]
    if not present:
        raise FileNotFoundError(f"no snapshot tables in {folder}")
    stacked = lambda frames: functools.reduce(DataFrame.unionByName, frames)
    reports = {
        "roll_rate_matrix": stacked([compute_roll_rates(spark, folder, n) for n in present]),
        "vintage_curves": stacked([compute_vintage(spark, folder, n) for n in present]),
    }
    for name, report in reports.items():
        write_report(report, folder, name)
    return reports


class VintageMetrics:
    """The two analyses under the names of a class."""

    roll_rate = staticmethod(compute_roll_rates)
    vintage_analysis = staticmethod(compute_vintage)
