"""Probability of default: training on a stratified split, evaluation on the hold-out, and scoring, with Spark ML."""

from __future__ import annotations

import json
import logging
import posixpath
import time
from datetime import UTC, datetime
from typing import Any

import pyspark
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scores import brier, calibration, discrimination
from ..sources.tables import read_table, read_text, write_table, write_text

logger = logging.getLogger(__name__)

ID, TARGET, SEED = "SK_ID_CURR", "TARGET", 42
#: Parts of a class that are ordered on their own in the split.
SPLIT_BUCKETS = 4096
MODEL, METRICS = "pd_model", "model_metrics.json"
DEVELOPMENT_SCORES, TEST_SCORES = "model_scores_development", "model_scores_test"


def feature_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in (ID, TARGET)]


def _shuffled(seed: int):
    return F.xxhash64(F.lit(seed), F.col(ID))


def stratified_split(df: DataFrame, fraction: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rest, hold-out): of each class, the rounded share with the least hashes of the id, so row order does not matter."""
    marked = df.withColumn("__turn", _shuffled(seed))
    # hashes are even, so ranges of them are buckets of like size; a window runs within a bucket, never over a class
    marked = marked.withColumn("__bucket", F.pmod(F.shiftright("__turn", 48), F.lit(SPLIT_BUCKETS)))
    counted = marked.groupBy(TARGET, "__bucket").agg(F.count("*").alias("__n"))
    up = Window.partitionBy(TARGET).orderBy("__bucket")  # over the buckets
    starts = counted.select(TARGET, "__bucket", (F.sum("__n").over(up) - F.col("__n")).alias("__before"), F.round(F.sum("__n").over(Window.partitionBy(TARGET)) * fraction).cast("long").alias("__take"))
    within = Window.partitionBy(TARGET, "__bucket").orderBy("__turn", ID)
    ranked = marked.withColumn("__rank", F.row_number().over(within)).join(F.broadcast(starts), [TARGET, "__bucket"])  # a row per class and bucket
    held = F.col("__before") + F.col("__rank") <= F.col("__take")
    return ranked.where(~held).select(df.columns), ranked.where(held).select(df.columns)


def _prepared(df: DataFrame, features: list[str], strings: set[str]) -> DataFrame:
    """Numbers as double (infinite ones and NaN are missing), and a flag for each missing number."""
    out = [F.col(f"`{c}`") for c in (ID, TARGET) if c in df.columns]
    for c in features:
        if c in strings:
            out.append(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("__missing__")).alias(c))
        else:
            value = F.col(f"`{c}`").cast("double")
            known = F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)
            out += [known.alias(c), known.isNull().cast("double").alias(f"{c}__missing")]
    return df.select(*out)


def encoder(texts: list[str]) -> StringIndexer:
    """Codes by falling frequency (ties: the smaller string); a value not seen in the fit gets a code of its own."""
    return StringIndexer(inputCols=texts, outputCols=[f"{c}__index" for c in texts], handleInvalid="keep")


def build_pipeline(train: DataFrame, features: list[str], strings: set[str], seed: int, trees: int) -> Pipeline:
    """Strings become ordinals (unseen ones a value of their own), missing numbers the median beside their flag."""
    numbers, texts = [c for c in features if c not in strings], [c for c in features if c in strings]
    present = train.agg(*(F.count(f"`{c}`").alias(c) for c in numbers)).first() if numbers else {}
    usable = [c for c in numbers if present[c]]
    stages: list[Any] = []
    most = 0
    if texts:
        stages.append(encoder(texts))
        row = train.agg(*(F.approx_count_distinct(f"`{c}`").alias(c) for c in texts)).first()
        most = max(row) * 12 // 10
    if usable:
        stages.append(Imputer(strategy="median", inputCols=usable, outputCols=[f"{c}__filled" for c in usable]))
    inputs = [f"{c}__filled" for c in usable] + [f"{c}__missing" for c in usable] + [f"{c}__index" for c in texts]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__features", handleInvalid="error"))
    stages.append(GBTClassifier(featuresCol="__features", labelCol=TARGET, maxIter=trees, maxDepth=4, stepSize=0.15, minInstancesPerNode=40, subsamplingRate=0.8, seed=seed, maxBins=max(32, most + 3), validationIndicatorCol="__validation", validationTol=0.001))
    return Pipeline(stages=stages)


def _scores(model: PipelineModel, df: DataFrame) -> DataFrame:
    keep = [c for c in (ID, TARGET) if c in df.columns]
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def permutation_importance(model: PipelineModel, sample: DataFrame, features: list[str], strings: set[str], seed: int, repeats: int = 2, top: int = 15) -> list[dict[str, Any]]:
    """How far the AUC drops when a feature's values are dealt to other rows of a bounded sample; all features and repeats in one job."""
    turn = F.row_number().over(Window.orderBy(_shuffled(seed), ID))  # the sample's size is bounded
    rows = sample.withColumn("__turn", turn).persist()
    # trial 0 of the feature '' is the sample as it is
    trials = F.explode(F.array(F.struct(F.lit("").alias("feature"), F.lit(0).alias("trial")), *(F.struct(F.lit(c).alias("feature"), F.lit(k).alias("trial")) for c in features for k in range(repeats))))
    dealt = rows.select("__turn", F.col(ID).alias("__id"), trials.alias("x")).select("__turn", "__id", "x.*")
    order = Window.partitionBy("feature", "trial").orderBy(F.xxhash64(F.lit(seed + 1), "feature", "trial", "__id"), "__id")
    dealt = dealt.select("feature", "trial", "__turn", F.row_number().over(order).alias("__other"))
    given = rows.select(F.col("__turn").alias("__other"), *(F.col(f"`{c}`").alias(f"{c}__moved") for c in rows.columns if c not in (ID, TARGET, "__turn")))
    both = dealt.join(rows, "__turn").join(given, "__other")
    moved = {c: F.when(F.col("feature") == c.removesuffix("__missing"), F.col(f"`{c}__moved`")).otherwise(F.col(f"`{c}`")) for c in rows.columns if c not in (ID, TARGET, "__turn")}
    scored = model.transform(both.select("feature", "trial", ID, TARGET, *(v.alias(c) for c, v in moved.items())))
    steps = scored.groupBy("feature", "trial", vector_to_array("probability")[1].alias("score")).agg(F.sum(TARGET).cast("double").alias("bad"), F.sum(1 - F.col(TARGET)).cast("double").alias("good"))
    up = Window.partitionBy("feature", "trial").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    pairs = steps.withColumn("below", F.coalesce(F.sum("good").over(up), F.lit(0.0)))
    auc = F.try_divide(F.sum(F.col("bad") * (F.col("below") + F.col("good") / 2)), F.sum("bad") * F.sum("good"))
    found = {(r.feature, r.trial): r.auc for r in pairs.groupBy("feature", "trial").agg(auc.alias("auc")).collect()}  # a row per feature and repeat
    rows.unpersist()
    base = found.get(("", 0))
    if base is None:
        return []
    drops = [{"feature": c, "auc_drop": float(sum(base - found[c, k] for k in range(repeats)) / repeats)} for c in features]
    return sorted(drops, key=lambda x: (-x["auc_drop"], x["feature"]))[:top]


def train_model(spark: SparkSession, record: DataFrame, processed: str, models: str, holdout: float = 0.2, seed: int = SEED, importance_sample: int = 10_000, trees: int = 40, importances: bool = True) -> dict[str, Any]:
    """Fits, evaluates and writes the model, its metrics and the hold-out's scores."""
    began = time.perf_counter()
    features = feature_columns(record.columns)
    strings = {f.name for f in record.schema if isinstance(f.dataType, T.StringType)}
    rest, held = (_prepared(x, features, strings).persist() for x in stratified_split(record, holdout, seed))
    marked = rest.withColumn("__validation", F.pmod(_shuffled(seed + 1), F.lit(10)) == 0)
    model = build_pipeline(rest, features, strings, seed, trees).fit(marked)
    model.write().overwrite().save(posixpath.join(models, MODEL))
    write_text(spark, json.dumps({"features": features, "strings": sorted(strings & set(features))}), posixpath.join(models, MODEL + ".json"))
    write_table(_scores(model, held), processed, DEVELOPMENT_SCORES)
    scores = read_table(spark, processed, DEVELOPMENT_SCORES).persist()
    power, fit = discrimination(scores).first(), brier(scores).first()
    sample = held.orderBy(_shuffled(seed + 2), ID).limit(importance_sample)
    metrics = {
        "auc": power.auc,
        "gini": power.gini,
        "ks": power.ks,
        "brier": fit.brier,
        "base_rate": fit.base_rate,
        "mean_predicted": fit.mean_predicted,
        "calibration": [{k: r[k] for k in ("accounts", "mean_score", "observed_rate")} for r in calibration(scores).orderBy("bin").collect()],
        "top_features": permutation_importance(model, sample, features, strings, seed) if importances else [],
        "n_train": rest.count(),
        "n_holdout": scores.count(),
        "n_features": len(features),
        "boosting_iterations": model.stages[-1].getNumTrees,
        "validation": "stratified random hold-out (no dates available; not out-of-time)",
        "seed": seed,
        "spark": pyspark.__version__,
        "trained_at": datetime.now(UTC).isoformat(timespec="seconds"),
        "train_seconds": round(time.perf_counter() - began, 1),
    }
    write_text(spark, json.dumps(metrics, indent=2), posixpath.join(models, METRICS))
    for df in (rest, held, scores):
        df.unpersist()
    return metrics


def score_frame(df: DataFrame, models: str) -> DataFrame:
    """SK_ID_CURR, score. Raises ValueError if the model's features are missing; other columns are ignored."""
    kept = json.loads(read_text(df.sparkSession, posixpath.join(models, MODEL + ".json")))
    if missing := [c for c in kept["features"] if c not in df.columns]:
        raise ValueError(f"the model was fitted on columns that are not there: {', '.join(missing)}")
    model = PipelineModel.load(posixpath.join(models, MODEL))
    return _scores(model, _prepared(df.drop(TARGET), kept["features"], set(kept["strings"])))


def score_test(spark: SparkSession, processed: str, models: str, record: str = "master_analytical_record_test") -> DataFrame:
    write_table(score_frame(read_table(spark, processed, record), models), processed, TEST_SCORES)
    return read_table(spark, processed, TEST_SCORES)
