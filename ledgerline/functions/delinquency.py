"""Column expressions for monthly account snapshots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Status codes of a credit bureau's months, and what they stand for.
STATUS_BUCKETS = {
    "C": "CLOSED",
    "0": "CURRENT",
    "1": "DPD_1_30",
    "2": "DPD_31_60",
    "3": "DPD_61_90",
    "4": "DPD_91_120",
    "5": "DPD_120_PLUS",
}
#: The most days past due of each bucket.
DAYS_BUCKETS = ((30, "DPD_1_30"), (60, "DPD_31_60"), (90, "DPD_61_90"), (120, "DPD_91_120"))
WORST = "DPD_120_PLUS"
DELINQUENT = (*(name for _, name in DAYS_BUCKETS), WORST)
BAD_DAYS = 60


def status_bucket(status: Column) -> Column:
    """Null for a code that is not known."""
    out = F.lit(None).cast("string")
    for code, name in STATUS_BUCKETS.items():
        out = F.when(status == code, name).otherwise(out)
    return out


def days_bucket(days: Column, contract: Column) -> Column:
    """A completed contract is closed whatever its days; negative days count as the first bucket."""
    out = F.when(contract == "Completed", "CLOSED").when(days == 0, "CURRENT")
    for most, name in DAYS_BUCKETS:
        out = out.when(days <= most, name)
    return out.otherwise(WORST)


def numeric_status(status: Column) -> Column:
    """The code as a number, null for letters."""
    return status.try_cast("int")


def exposure(amount: Column) -> Column:
    """Credits and unknown amounts are no exposure."""
    return F.greatest(F.coalesce(amount, F.lit(0.0)), F.lit(0.0))


def floor_to(value: Column, width: int) -> Column:
    """The multiple of ``width`` at or below the value, also for negative ones."""
    return (F.floor(value / F.lit(width)) * width).cast("int")
