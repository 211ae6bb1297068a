"""The master analytical record: one row per application, with its credit history rolled up.

Every history table is aggregated to its key before it is joined (monthly rows to accounts, accounts to
applicants), so no join multiplies rows and all joins to the application share one key.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.delinquency import numeric_status
from ..sources.tables import read_if_present, write_table

logger = logging.getLogger(__name__)

APPLICANT, ACCOUNT = "SK_ID_CURR", "SK_ID_BUREAU"


def record_name(application: str) -> str:
    """Of the table that is written for an application table."""
    suffix = application.removeprefix("application_")
    return "master_analytical_record" + ("" if suffix == "train" else f"_{suffix}")


def balance_by_account(balance: DataFrame) -> DataFrame:
    """Monthly statuses by account: months seen, worst status, months in arrears."""
    status = numeric_status(F.col("STATUS"))
    return balance.groupBy(ACCOUNT).agg(
        F.count("*").alias("bb_snapshot_months"),
        F.max(F.coalesce(status, F.lit(0))).alias("bb_max_status"),
        F.count_if(status > 0).alias("bb_delinquent_months"),
    )


def bureau_by_applicant(bureau: DataFrame, balance: DataFrame | None = None) -> DataFrame:
    """Accounts by applicant; months in arrears are 0 where there are no monthly statuses."""
    late = F.lit(0).cast("long")
    if balance is not None:
        bureau = bureau.join(balance_by_account(balance).select(ACCOUNT, "bb_delinquent_months"), ACCOUNT, "left")
        late = F.sum(F.coalesce("bb_delinquent_months", F.lit(0)))
    total = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    return bureau.groupBy(APPLICANT).agg(
        F.countDistinct(ACCOUNT).alias("bureau_total_accounts"),
        F.count_if(F.col("CREDIT_ACTIVE") == "Active").alias("bureau_active_accounts"),
        F.count_if(F.col("CREDIT_ACTIVE") == "Closed").alias("bureau_closed_accounts"),
        total("AMT_CREDIT_SUM_DEBT").alias("bureau_sum_credit_sum_debt"),
        total("AMT_CREDIT_SUM").alias("bureau_sum_credit_sum"),
        total("AMT_CREDIT_SUM_OVERDUE").alias("bureau_total_overdue_balance"),
        late.alias("bureau_total_delinquent_months"),
    )


def instalments_by_applicant(instalments: DataFrame) -> DataFrame:
    """A deficit is signed; an unknown amount or date counts as neither deficit nor delay."""
    delay = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return instalments.groupBy(APPLICANT).agg(
        F.max(delay).alias("ip_max_payment_delay_days"),
        F.sum(F.coalesce(F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"), F.lit(0))).alias("ip_total_payment_deficit"),
        F.count("*").alias("ip_total_payments"),
        F.count_if(delay > 0).alias("ip_late_payments"),
    )


def previous_by_applicant(previous: DataFrame) -> DataFrame:
    """An unknown amount counts as 0 in the mean."""
    return previous.groupBy(APPLICANT).agg(
        F.count("*").alias("prev_total_applications"),
        F.count_if(F.col("NAME_CONTRACT_STATUS") == "Approved").alias("prev_approved_applications"),
        F.count_if(F.col("NAME_CONTRACT_STATUS") == "Refused").alias("prev_refused_applications"),
        (F.sum(F.coalesce("AMT_APPLICATION", F.lit(0))).cast("double") / F.count("*")).alias("prev_mean_amt_application"),
    )


def master_record(application: DataFrame, bureau: DataFrame | None = None, balance: DataFrame | None = None, instalments: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """All columns of the application, then those of each history table that there is; no history is 0, not null."""
    histories = []
    if bureau is not None:
        histories.append(bureau_by_applicant(bureau, balance))
    if instalments is not None:
        histories.append(instalments_by_applicant(instalments))
    if previous is not None:
        histories.append(previous_by_applicant(previous))
    out = application
    for history in histories:
        out = out.join(history, APPLICANT, "left")
    added = [F.coalesce(c, F.lit(0).cast(kind)).alias(c) for h in histories for c, kind in h.dtypes if c != APPLICANT]
    return out.select(*application.columns, *added)


def without_history(application: DataFrame, *histories: DataFrame) -> DataFrame:
    """Applications that no history table knows."""
    for history in histories:
        application = application.join(history.select(APPLICANT), APPLICANT, "left_anti")
    return application


def build_master_record(spark: SparkSession, folder: str, application: str = "application_train") -> str | None:
    """Reads the tables of a folder, writes the record beside them. None, with an error logged, without the application."""
    app = read_if_present(spark, folder, application)
    if app is None:
        logger.error("%s not found in %s; no master record", application, folder)
        return None
    names = ("bureau", "bureau_balance", "installments_payments", "previous_application")
    out = master_record(app, *(read_if_present(spark, folder, n) for n in names))
    path = write_table(out, folder, record_name(application))
    logger.info("wrote %s (%d columns)", path, len(out.columns))
    return path
