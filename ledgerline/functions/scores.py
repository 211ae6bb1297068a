"""Exact measures of a score against a 0/1 outcome, over distinct scores.

Rows are first counted by score. The range is cut at approximate quantiles, and windows run within the
buckets, so none spans all scores; what lies above a bucket comes from the buckets' totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ranks import bucket, cut_marks


def running(df: DataFrame, score: str, outcome: str) -> DataFrame:
    """score, bad, good, and how many of either have a higher score (bad_above, good_above); no window spans all scores."""
    counts = df.groupBy(F.col(score).alias("score")).agg(F.sum(F.col(outcome).cast("long")).alias("bad"), F.sum((1 - F.col(outcome)).cast("long")).alias("good"))
    marks = counts.agg(cut_marks(F.col("score")).alias("marks")).first().marks
    dealt = counts.withColumn("bucket", bucket(marks, F.col("score")))
    totals = dealt.groupBy("bucket").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    up = Window.orderBy(F.desc("bucket"))  # over the buckets
    above = totals.select("bucket", (F.sum("b").over(up) - F.col("b")).alias("b_above"), (F.sum("g").over(up) - F.col("g")).alias("g_above"))
    within = Window.partitionBy("bucket").orderBy(F.desc("score"))
    out = dealt.join(F.broadcast(above), "bucket")
    return out.select(
        "score",
        "bad",
        "good",
        (F.col("b_above") + F.sum("bad").over(within) - F.col("bad")).alias("bad_above"),
        (F.col("g_above") + F.sum("good").over(within) - F.col("good")).alias("good_above"),
    )


def discrimination(df: DataFrame, score: str = "score", outcome: str = "TARGET") -> DataFrame:
    """One row: auc (ties count half), gini, ks. Null where an outcome is missing."""
    steps = running(df, score, outcome)
    sums = steps.agg(
        F.sum("bad").alias("b"),
        F.sum("good").alias("g"),
        # twice the number of (bad, good) pairs that the score puts right, in whole numbers
        F.sum((F.lit(2) * F.col("bad_above") + F.col("bad")) * F.col("good")).alias("pairs"),
    )
    ends = sums
    auc = F.try_divide(F.col("pairs").cast("double"), F.lit(2.0) * F.col("b") * F.col("g"))
    gaps = steps.join(F.broadcast(ends)).agg(F.max(F.try_divide((F.col("bad_above") + F.col("bad")).cast("double"), F.col("b")) - F.try_divide((F.col("good_above") + F.col("good")).cast("double"), F.col("g"))).alias("ks"))
    return ends.select(auc.alias("auc"), (F.lit(2.0) * auc - F.lit(1.0)).alias("gini")).join(F.broadcast(gaps)).select("auc", "gini", F.greatest("ks", F.lit(0.0)).alias("ks"))


def brier(df: DataFrame, score: str = "score", outcome: str = "TARGET") -> DataFrame:
    """One row: brier, mean_predicted, base_rate."""
    gap = F.col(score) - F.col(outcome)
    return df.agg(F.avg(gap * gap).alias("brier"), F.avg(score).alias("mean_predicted"), F.avg(F.col(outcome).cast("double")).alias("base_rate"))


def calibration(df: DataFrame, score: str = "score", outcome: str = "TARGET", key: str = "SK_ID_CURR", bins: int = 10) -> DataFrame:
    """Predicted against observed by score group, lowest first; sizes differ by one at most, and ties break by key.

    Groups follow from each row's rank: rows are counted by bucket first, so no window spans all rows.
    """
    cut = df.agg(cut_marks(F.col(score)).alias("marks"), F.count("*").alias("n")).first()
    dealt = df.withColumn("n", F.lit(cut.n)).withColumn("bucket", bucket(cut.marks, F.col(score)))
    totals = dealt.groupBy("bucket").agg(F.count("*").alias("size"))
    starts = totals.select("bucket", (F.sum("size").over(Window.orderBy("bucket")) - F.col("size")).alias("start"))
    rank = F.col("start") + F.row_number().over(Window.partitionBy("bucket").orderBy(score, key)) - 1
    small, large = F.floor(F.col("n") / bins), F.pmod(F.col("n"), F.lit(bins))
    edge = large * (small + 1)
    group = F.when(F.col("rank") < edge, F.floor(F.col("rank") / (small + 1))).otherwise(large + F.floor(F.try_divide(F.col("rank") - edge, small)))
    ranked = dealt.join(F.broadcast(starts), "bucket").withColumn("rank", rank)
    return ranked.groupBy((group + 1).cast("int").alias("bin")).agg(F.count("*").alias("accounts"), F.avg(score).alias("mean_score"), F.avg(F.col(outcome).cast("double")).alias("observed_rate"))
