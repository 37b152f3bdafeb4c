"""Selection rules, fairness intervals, contract validation and gates."""
import pytest
from pyspark.sql import functions as F

from retention_engine.functions.stats import clopper_pearson, wilcoxon_zsplit
from retention_engine.operators import fairness as FA
from retention_engine.operators import prep as PR
from retention_engine.operators import quality as QU
from retention_engine.operators import selection as SE


def _summ(spark, rows):
    return spark.createDataFrame(rows, "candidate long, mean double, std double, k long, C double, l1 double")


def ORDER():
    return [F.col("C").asc(), F.col("l1").desc(), F.col("candidate").asc()]


def test_one_se_picks_simplest(spark):
    s = _summ(spark, [(0, .700, .02, 15, 100.0, 0.0), (1, .695, .02, 15, .01, 0.0), (2, .698, .02, 15, 1.0, 0.0)])
    assert SE.one_se(s, ORDER()).first()["C"] == 0.01


def test_one_se_keeps_best_when_far(spark):
    s = _summ(spark, [(0, .700, .02, 15, 100.0, 0.0), (1, .600, .02, 15, .01, 0.0)])
    assert SE.one_se(s, ORDER()).first()["C"] == 100.0


def test_one_se_prefers_l1(spark):
    s = _summ(spark, [(0, .700, .02, 15, 1.0, 0.0), (1, .700, .02, 15, 1.0, 1.0)])
    assert SE.one_se(s, ORDER()).first()["l1"] == 1.0


def test_envelopes_nested(spark):
    s = _summ(spark, [(i, .70 - i * 0.004, .03, 15, 1.0, 0.0) for i in range(10)])
    e = SE.envelopes(s).first()
    assert e["inside_se"] <= e["inside_conservative"] <= e["inside_full_std"]
    assert e["cut_se"] > e["cut_conservative"] > e["cut_full_std"]


def test_paired_wilcoxon():
    import numpy as np
    d = np.array([0.008, 0.012, 0.010, 0.011, 0.010])
    _, p = wilcoxon_zsplit(d)
    assert (d > 0).sum() == 5 and round(d.mean(), 4) == 0.0102 and p < 0.10


def test_clopper_pearson():
    lo, hi = clopper_pearson(5, 23)
    assert lo == pytest.approx(0.075, abs=1e-3) and hi == pytest.approx(0.437, abs=1e-3)
    assert clopper_pearson(0, 10)[0] == 0.0 and clopper_pearson(10, 10)[1] == 1.0


def test_fairness_rates_and_reliability(spark):
    rows = [("g1", 0.9, 1)] * 5 + [("g1", 0.1, 1)] * 18 + [("g2", 0.9, 1)] * 40
    d = spark.createDataFrame(rows, "grp string, score double, y int")
    r = {x["group"]: x for x in FA.group_rates(d, ["grp"], 0.5).collect()}
    assert r["g1"]["recall"] == pytest.approx(5 / 23, abs=1e-6) and not r["g1"]["reliable"]
    dis = FA.disparity(FA.group_rates(d, ["grp"], 0.5)).first()
    assert dis["worst_group"] == "g1" and not dis["within_limit"]
    ci = {x["group"]: x for x in FA.recall_ci(FA.group_rates(d, ["grp"], 0.5)).collect()}
    assert ci["g1"]["ci_low"] == pytest.approx(0.075, abs=1e-3)


def test_gate_needs_both_axes(spark):
    g = SE.gate(spark.createDataFrame([(0.70, 0.15), (0.70, 0.13)], "ap double, brier double")).collect()
    assert [r["approved"] for r in g] == [False, True] and g[0]["reason"] == "brier above ceiling"


def test_validation_never_carries_values(spark):
    c = QU.TableContract((QU.FieldRule("seg", "categorical", allowed=("a", "b")),
                          QU.FieldRule("x", "numeric", 0.0, 10.0), QU.FieldRule("z", "numeric", 0.0, 10.0, nullable=True)))
    d = spark.createDataFrame([(1, "a", 5.0, None), (2, "q", 50.0, 1.0), (3, None, float("nan"), -1.0)],
                              "request_id long, seg string, x double, z double")
    v = {r["request_id"]: sorted((e["type"], e["field"]) for e in r["errors"]) for r in QU.validate(d, c).collect()}
    assert v[1] == []
    assert v[2] == [("out_of_range", "x"), ("unknown_category", "seg")]
    assert v[3] == [("missing", "seg"), ("not_finite", "x"), ("out_of_range", "z")]


def test_unknown_category_encodings(spark):
    tr = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", None)], "c string, x double")
    te = spark.createDataFrame([("zzz", None)], "c string, x double")
    m = PR.Preprocessor(numCols=["x"], catCols=["c"]).fit(tr)
    r = m.transform(te).first()
    assert r["c=a"] == 0.0 and r["c=b"] == 0.0 and r["x_z"] == pytest.approx((1.5 - 1.5) / 0.5)
    o = PR.Preprocessor(numCols=["x"], catCols=["c"], encoding="ordinal").fit(tr).transform(te).first()
    assert o["c_code"] == -1.0
    with pytest.raises(ValueError):
        PR.Preprocessor(catCols=["c"], encoding="target")


def test_contract_roles():
    c = QU.TableContract((QU.FieldRule("y", "numeric"),), target="y")
    with pytest.raises(ValueError):
        c.check_roles()


def test_fingerprint_permutation_invariant(spark):
    d = spark.createDataFrame([(i, f"n{i}") for i in range(100)], "a long, b string")
    assert QU.fingerprint(d).first() == QU.fingerprint(d.orderBy(F.desc("a")).repartition(7)).first()
