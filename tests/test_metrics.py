"""Ranking / cost metrics on hand-made cases with known answers, plus invariances."""
import math

import pytest
from pyspark.sql import functions as F

from retention_engine.operators import metrics as M
from retention_engine.operators.ranking import running_totals


def _df(spark, scores, ys, groups=None):
    rows = [(i, float(s), int(y), (groups[i] if groups else "g")) for i, (s, y) in enumerate(zip(scores, ys))]
    return spark.createDataFrame(rows, "customer_id long, score double, y int, grp string")


def test_ap_and_auc_with_ties(spark):
    d = _df(spark, [.9, .8, .7, .6, .6, .1], [1, 0, 1, 0, 1, 0])
    assert M.average_precision(d).first()["ap"] == pytest.approx(0.755556, abs=1e-6)
    assert M.roc_auc(d).first()["roc_auc"] == pytest.approx(0.722222, abs=1e-6)


def test_ap_undefined_without_positives(spark):
    d = _df(spark, [.9, .1], [0, 0])
    assert M.average_precision(d).first()["ap"] is None
    assert M.roc_auc(d).first()["roc_auc"] is None


def test_trivial_costs(spark):
    d = _df(spark, [0.5] * 5, [1, 1, 1, 0, 0])
    r = M.trivial_costs(d).first()
    assert (r["cost_do_nothing"], r["cost_contact_all"]) == (582.0, 124.0)


def test_threshold_is_inclusive(spark):
    d = _df(spark, [.49, .50, .51], [1, 1, 1])
    r = M.point_metrics(d, threshold=0.5).first()
    assert (r["tp"], r["fn"]) == (2, 1)


def test_cost_curve_matches_brute_force(spark):
    import random
    random.seed(1)
    s = [round(random.random(), 2) for _ in range(300)]
    y = [int(random.random() < x) for x in s]
    d = _df(spark, s, y)
    curve = {r["threshold"]: r["cost"] for r in M.cost_curve(d).collect()}
    for i in range(1, 100):
        t = round(i / 100, 2)
        fn = sum(1 for a, b in zip(s, y) if b == 1 and a < t)
        fp = sum(1 for a, b in zip(s, y) if b == 0 and a >= t)
        assert curve[t] == fn * 194 + fp * 62
    best = M.cost_optimum(M.cost_curve(d)).first()
    costs = [(curve[round(i / 100, 2)], round(i / 100, 2)) for i in range(1, 100)]
    assert best["best_threshold"] == min(costs)[1]


def test_recall_at_k_tie_break_by_id(spark):
    d = _df(spark, [.5, .5, .5, .5, .1], [0, 1, 1, 0, 1])
    r = {x["k"]: x["recall_at_k"] for x in M.recall_at_k(d, ks=(0.2, 0.4, 0.6)).collect()}
    # top 1 = id 0 (y 0); top 2 = ids 0,1 (one positive of three); top 3 = ids 0..2
    assert r[0.2] == 0.0 and r[0.4] == pytest.approx(1 / 3, abs=1e-6) and r[0.6] == pytest.approx(2 / 3, abs=1e-6)


def test_partitioning_invariance(spark):
    import random
    random.seed(7)
    rows = [(i, round(random.random(), 3), int(random.random() < 0.3), random.choice("abc")) for i in range(2000)]
    d = spark.createDataFrame(rows, "customer_id long, score double, y int, grp string")
    a = sorted(M.evaluate(d.repartition(1), by=["grp"]).collect())
    b = sorted(M.evaluate(d.repartition(17), by=["grp"]).collect())
    assert a == b


def test_running_totals_matches_window(spark):
    import random
    random.seed(3)
    rows = [(i, random.randint(0, 50), random.choice(["x", "y"]), random.randint(0, 3)) for i in range(3000)]
    d = spark.createDataFrame(rows, "id long, k long, g string, v long")
    r = running_totals(d, "k", ["v"], by=["g"], tiebreak=["id"], chunks=16)
    got = {(x["g"], x["id"]): (x["_rn"], x["cum_v"]) for x in r.collect()}
    for g in ("x", "y"):
        sub = sorted([x for x in rows if x[2] == g], key=lambda t: (t[1], t[0]))
        cum = 0
        for i, x in enumerate(sub, 1):
            cum += x[3]
            assert got[(g, x[0])] == (i, cum)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from retention_engine.operators.quantiles import exact_quantiles
    vals = [float(v) for v in np.random.default_rng(0).integers(0, 40, 777)]
    d = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.01, 0.1, 0.25, 0.5, 0.9, 0.99]
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(d, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)


def test_gain_curve_ends_at_one(spark):
    d = _df(spark, [.9, .8, .7, .6, .5], [1, 0, 1, 0, 0])
    g = {round(r["fraction"], 2): r["captured"] for r in M.gain_curve(d, points=5).collect()}
    assert g[1.0] == 1.0 and g[0.2] == 0.5
