from datetime import datetime

import numpy as np
from pyspark.sql import types as T

from ledgerline.streaming import monitor as mo


def test_drops_are_taken_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    run = lambda: mo.ingest_drops(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    (tmp_path / "in/a.csv").write_text("id,v\n1,1.5\n")
    run()
    (tmp_path / "in/b.csv").write_text("id,v\n2,\n")
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 1.5), (2, None)]


def test_monitor(spark, tmp_path):
    r = np.random.default_rng(0)
    frame = lambda m: spark.createDataFrame([(float(x),) for x in r.normal(m, 1, 800)], "x double")
    frame(2).write.parquet(f"{tmp_path}/s")
    seen = []
    stream = spark.readStream.schema("x double").parquet(f"{tmp_path}/s")
    mo.monitor(stream, frame(0), ["x"], lambda df, k: seen.extend(df.collect()), f"{tmp_path}/cp").awaitTermination()
    assert seen[0].drift_status == "SIGNIFICANT_DRIFT" and seen[0].target_rows == 800


def test_windows(spark, tmp_path):
    spark.createDataFrame([(datetime(2024, 1, 1, h), "a", 1.0) for h in range(3)], "ts timestamp, k string, v double").write.parquet(f"{tmp_path}/s")
    stream = spark.readStream.schema("ts timestamp, k string, v double").parquet(f"{tmp_path}/s")
    mo.late_payments_by_window(stream, "ts", "v", "k").writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert [(r.n, r.total) for r in spark.table("late").collect()] == [(3, 3.0)]
