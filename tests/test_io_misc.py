"""Sinks, run tracking, flattening, random search, encoding guard."""
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from retention_engine.operators import monitor as MO
from retention_engine.operators import selection as SE
from retention_engine.sources import sinks


def test_write_and_track(spark):
    root = tempfile.mkdtemp(prefix="re-sink-")
    d = spark.createDataFrame([(1, 0.5)], "a long, b double")
    sinks.write_results(d, os.path.join(root, "res_csv"), fmt="csv")
    assert spark.read.option("header", "true").csv(os.path.join(root, "res_csv")).count() == 1
    rid = sinks.log_run(spark, root, "gate", "fp", {"commit": "x"}, {"C": 1.0}, {"ap": 0.5, "brier": 0.1})
    m = spark.read.parquet(os.path.join(root, "run_metrics")).where(F.col("run_id") == rid)
    assert m.count() == 2
    calls = []
    reg = os.path.join(root, "registry")
    a = sinks.read_or_compute(spark, reg, lambda: calls.append(1) or d)
    b = sinks.read_or_compute(spark, reg, lambda: calls.append(1) or d)
    assert calls == [1] and a.count() == b.count() == 1


def test_flatten_features_absent_is_not_measured(spark):
    d = spark.createDataFrame([(1, [0.1, 0.2])], "request_id long, scores array<double>")
    assert MO.flatten_features(d).count() == 0
    assert MO.flatten_scores(d).count() == 2


def test_random_search_log_uniform(spark):
    c = SE.random_search_configs(spark, 40, {"C": (1e-3, 1e2, True), "l1": (0.0, 1.0, False)}).collect()
    assert len(c) == 40 and all(1e-3 <= r["C"] <= 1e2 and 0 <= r["l1"] <= 1 for r in c)
    again = SE.random_search_configs(spark, 40, {"C": (1e-3, 1e2, True), "l1": (0.0, 1.0, False)}).collect()
    assert c == again


def test_holdout_share(spark):
    from retention_engine.operators.split import holdout_split
    d = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "customer_id long, y int")
    h = {(r["part"], r["y"]): r["count"] for r in holdout_split(d, 0.15).groupBy("part", "y").count().collect()}
    assert h[("inner_holdout", 1)] == 15 and h[("inner_holdout", 0)] == 45


def test_poisson_bootstrap_weights_mean_one(spark):
    from retention_engine.operators.split import poisson_bootstrap_weights
    d = spark.createDataFrame([(i,) for i in range(2000)], "customer_id long")
    w = poisson_bootstrap_weights(d, 5)
    tot = w.groupBy("replicate").agg(F.sum("weight").alias("s")).collect()
    assert len(tot) == 5 and all(1800 < r["s"] < 2200 for r in tot)


def test_materialize_leaves_no_shuffle_files(spark):
    import time

    from retention_engine.session import SHUFFLE_CLEANUP, materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    made = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"), "shuffled")
    end = time.time() + 10
    while shuffled() - before and time.time() < end:  # they go in the background
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert sorted(map(tuple, made.collect())) == [(k, len(range(k, 1000, 7))) for k in range(7)]
