"""Drift baseline / PSI semantics (cases mirroring the reference's tests)."""
import pytest
from pyspark.sql import functions as F

from retention_engine.operators import drift as D


def _num(spark, vals, name="x"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in vals], f"{name} double")


def test_edges_dedup_and_first_bin(spark):
    vals = [0.0] * 70 + list(range(1, 31))
    b = D.numeric_baseline(_num(spark, vals), ["x"]).first()
    edges = b["edges"]
    assert edges == sorted(set(edges)) and edges[0] == 0.0
    assert b["props"][0] == 0.0 and all(p > 0 for p in b["props"][1:])
    # half the window below the baseline minimum: finite PSI beyond the action threshold
    w = _num(spark, [-5.0] * 50 + list(range(1, 51)))
    r = D.compare_numeric(D.numeric_baseline(_num(spark, vals), ["x"]), w, ["x"]).first()
    assert r["psi"] is not None and r["psi"] > 0.25 and r["class"] == "act"


def test_constant_column_all_in_last_bin(spark):
    b = D.numeric_baseline(_num(spark, [500.0] * 500), ["x"]).first()
    assert b["props"][-1] == 1.0


def test_psi_zero_against_itself(spark):
    d = _num(spark, list(range(1000)))
    r = D.compare_numeric(D.numeric_baseline(d, ["x"]), d, ["x"]).first()
    assert r["psi"] == 0.0 and r["class"] == "stable"


def test_missing_column_omitted_and_empty_is_no_data(spark):
    base = D.numeric_baseline(_num(spark, list(range(100))), ["x"])
    other = spark.createDataFrame([(1.0,)], "y double")
    assert D.compare_numeric(base, other).count() == 0
    empty = _num(spark, [None, None])
    r = D.compare_numeric(base, empty, ["x"]).first()
    assert r["psi"] is None and r["class"] == "no-data"


def test_empty_score_window(spark):
    s = spark.createDataFrame([(i / 100,) for i in range(100)], "score double")
    b = D.score_baseline(s, threshold=0.5)
    r = D.compare_scores(b, s.where(F.col("score") > 5)).first()
    assert r["n"] == 0 and r["psi"] is None and r["class"] == "no-data"
    r2 = D.compare_scores(b, s).first()
    assert r2["psi"] == 0.0 and r2["queue_x"] == 1.0


def test_unseen_categories(spark):
    base = D.category_baseline(spark.createDataFrame([("a",), ("b",)] * 10, "c string"), ["c"])
    w = spark.createDataFrame([("a",), ("z",), ("z",)], "c string")
    r = D.compare_categorical(base, w, ["c"]).first()
    assert r["unseen"] == "z" and r["psi"] > 0.25
    u = D.unseen_levels(base, w, ["c"]).collect()
    assert [(x["level"], x["n"]) for x in u] == [("z", 2)]
