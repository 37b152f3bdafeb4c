"""Cases behind the exact ranking core, the assembler, the samplers and the artefact checks."""
import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from retention_engine.operators import bootstrap as B
from retention_engine.operators import metrics as M
from retention_engine.operators import models as MD
from retention_engine.operators import prep as P
from retention_engine.operators import ranking as R
from retention_engine.operators.quantiles import exact_quantiles


def test_scores_closer_than_a_millionth_are_told_apart(spark):
    df = spark.createDataFrame([(1, 0.5000001, 0), (2, 0.5000003, 1), (3, 0.50000045, 0)], "customer_id long, score double, y int")
    assert M.average_precision(df).first()["ap"] == 0.5
    assert M.roc_auc(df).first()["roc_auc"] == 0.5
    assert [r["recall_at_k"] for r in M.recall_at_k(df, ks=[0.5]).collect()] == [1.0]


def test_null_group_is_a_group(spark):
    rows = [("a", i, i / 10, i % 2) for i in range(6)] + [(None, 10 + i, i / 10, i % 2) for i in range(4)]
    df = spark.createDataFrame(rows, "g string, customer_id long, score double, y int")
    assert {r["g"]: r["quantile"] for r in exact_quantiles(df, "score", [0.5], ["g"]).collect()} == {"a": 0.25, None: pytest.approx(0.15)}
    out = {r["g"]: r for r in M.evaluate(df, by=["g"]).collect()}
    assert set(out) == {"a", None} and out[None]["n"] == 4 and out[None]["ap"] is not None and out[None]["recall_at_10"] is not None
    got = R.running_totals(df, "score", ["y"], ["g"]).collect()
    assert sorted(r["_rn"] for r in got if r["g"] is None) == [1, 2, 3, 4] and len(got) == 10


def test_plan_is_built_fast_with_many_partitions_and_groups(spark):
    import time
    old = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(300).select(F.col("id").alias("customer_id"), (F.col("id") % 40).alias("g"), (F.col("id") % 7 / 7).alias("score"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        t = time.time()
        out = R.running_totals(df, "customer_id", [], ["g"])
        assert out.groupBy("g").agg(F.max("_rn").alias("n")).where("n < 7").count() == 0
        assert time.time() - t < 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_assembler_takes_the_made_columns_only(spark):
    rows = [(i, float(i % 9), "ab"[i % 2], "12345", 3.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double, c string, zip_code string, `a=b` double, y int").withColumn("raw_z", F.lit(9.0))
    m = P.build_pipeline(LogisticRegression(labelCol="y", maxIter=5), [], ["x"], ["c"]).fit(df)
    assert m.stages[0].feature_names() == ["x_z", "c=a", "c=b"] == m.stages[1].getInputCols()
    assert m.transform(df).first()["features"].size == len(MD.odds_ratios(m)) == 3
    tree = P.build_pipeline(DecisionTreeClassifier(labelCol="y"), [], ["x"], ["c"], encoding="ordinal").fit(df)
    made = tree.transform(df)
    attrs = made.schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attrs["nominal"]] == ["c_code"] and attrs["nominal"][0]["vals"] == ["a", "b"]
    assert P.output_is_categorical(tree.stages[0].fitted, "ordinal") == [False, True]
    with pytest.raises(ValueError, match="x_z"):
        m.stages[0].transform(df.withColumn("x_z", F.lit(1.0)))


def test_poisson_inversion_is_exact_for_any_mean():
    u = np.array([1e-9, 0.1, 0.5, 0.9, 1 - 1e-9])
    for lam in (0.5, 1.0, 49.0, 51.0, 400.0):
        got = B.poisson_inverse(u, np.full(5, lam))
        for x, k in zip(u, got, strict=True):
            cdf = lambda n: math.fsum(math.exp(j * math.log(lam) - lam - math.lgamma(j + 1)) for j in range(n + 1))
            assert cdf(int(k)) >= x - 1e-12 and (k == 0 or cdf(int(k) - 1) < x + 1e-12)
    big = B.poisson_inverse(np.random.default_rng(0).random(20000), np.full(20000, 1e6))
    assert abs(big.mean() - 1e6) < 50 and abs(big.std() - 1000) < 30


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert sorted(r["weight"] for r in MD.balanced_weights(df).collect()) == [pytest.approx(2 / 3)] * 3 + [2.0]


def test_missing_path_is_not_any_error(spark, tmp_path):
    from retention_engine.sources.sinks import read_or_compute
    path = str(tmp_path / "r")
    assert read_or_compute(spark, path, lambda: spark.range(3)).count() == 3
    assert read_or_compute(spark, path, lambda: spark.range(9)).count() == 3
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_or_compute(spark, str(bad), lambda: spark.range(9))
    assert (bad / "part-0.parquet").read_text() == "no parquet"
