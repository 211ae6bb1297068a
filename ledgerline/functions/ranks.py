"""Exact order statistics from frequency tables, without sorting a feature's values in one task.

Approximate quantiles (a small sketch per feature, evaluated once) cut each feature's range into buckets; running counts
are taken within buckets, and a window over the buckets' totals, which are few, gives where each starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Buckets of a feature at most, and values that a bucket should have at least.
BUCKETS, BUCKET_VALUES = 128, 20_000


def cut_marks(value: Column) -> Column:
    """An aggregate: values that cut the range into buckets, the fewer the fewer rows there are."""
    marks = F.array_distinct(F.percentile_approx(value, [k / BUCKETS for k in range(1, BUCKETS)], 10_000))
    step = F.greatest(F.lit(1), F.ceil(F.lit(BUCKETS * BUCKET_VALUES) / F.count(value)))
    return F.filter(marks, lambda _, k: F.pmod(k + 1, step) == 0)


def bucket(marks: list | None, value: Column) -> Column:
    """How many marks a value exceeds. Marks are constants here: a sketch depends on the order in which tasks' results arrive, so one that a plan evaluates twice may cut differently."""
    return F.size(F.filter(F.lit(list(marks)), lambda m: m < value)) if marks else F.lit(0)


def values_at_ranks(counts: DataFrame, ranks: dict[str, list[int]]) -> dict[str, dict[int, object]]:
    """counts: (feature, value, n), each value once. For each feature, the values at 0-based ranks of its sorted rows."""
    spark = counts.sparkSession
    wanted = {f: sorted(set(r)) for f, r in ranks.items() if r}
    if not wanted:
        return {}
    number = F.col("value").cast("double")
    marks = {r.feature: r.marks for r in counts.groupBy("feature").agg(cut_marks(number).alias("marks")).collect()}  # see bucket
    asked = spark.createDataFrame([(f, r, marks[f] or []) for f, r in wanted.items() if f in marks], "feature string, ranks array<long>, marks array<double>")  # a row per feature
    dealt = counts.join(F.broadcast(asked), "feature").withColumn("bucket", F.size(F.filter("marks", lambda m: m < number)))
    totals = dealt.groupBy("feature", "bucket").agg(F.sum("n").alias("total"))
    starts = totals.select("feature", "bucket", (F.sum("total").over(Window.partitionBy("feature").orderBy("bucket")) - F.col("total")).alias("start"))
    within = Window.partitionBy("feature", "bucket").orderBy("value")
    running = dealt.withColumn("within", F.sum("n").over(within)).join(F.broadcast(starts), ["feature", "bucket"])
    after = F.col("start") + F.col("within")
    hit = running.withColumn("hits", F.filter("ranks", lambda r: (r < after) & (r >= after - F.col("n")))).where(F.size("hits") > 0)
    out: dict[str, dict[int, object]] = {}
    for row in hit.select("feature", F.explode("hits").alias("rank"), "value").collect():  # a row per rank asked for
        out.setdefault(row.feature, {})[row.rank] = row.value
    return out


def interpolated(low: float, high: float, part: float) -> float:
    """Between two neighbouring values, from the nearer end (as numpy does, so edges agree to the last bit)."""
    return low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part)


def quantiles(counts: DataFrame, sizes: dict[str, int], shares: list[float]) -> dict[str, list[float]]:
    """Linear-interpolated quantiles of each feature; ``sizes`` are the features' row counts."""
    spots = {f: [(int((n - 1) * q), (n - 1) * q - int((n - 1) * q)) for q in shares] for f, n in sizes.items() if n}
    found = values_at_ranks(counts, {f: [r for low, _ in s for r in (low, min(low + 1, sizes[f] - 1))] for f, s in spots.items()})
    return {f: [interpolated(float(found[f][low]), float(found[f][min(low + 1, sizes[f] - 1)]), part) for low, part in s] for f, s in spots.items()}
