import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors


from retention_engine.operators import ensembles as EN
from retention_engine.operators import models as MD


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        x = rng.normal(size=4)
        rows.append((i, float(rng.random() < 1 / (1 + math.exp(-2 * x[0] + x[1] * x[2]))), Vectors.dense(x)))
    return spark.createDataFrame(rows, ["customer_id", "label", "features"])


def test_stages_are_the_sums_of_the_first_trees(spark, data):
    model = EN.boosting("regularised", rounds=6).fit(data)
    got = EN.staged_margins(model, data).select("customer_id", "margins").collect()
    whole = {r["customer_id"]: r["probability"][1] for r in model.transform(data).collect()}
    assert all(len(r["margins"]) == 6 and abs(1 / (1 + math.exp(-2 * r["margins"][-1])) - whole[r["customer_id"]]) < 1e-9 for r in got)
    short = {r["customer_id"]: r["probability"][1] for r in EN.boosting("regularised", rounds=2).fit(data).transform(data).collect()}
    assert all(abs(1 / (1 + math.exp(-2 * r["margins"][1])) - short[r["customer_id"]]) < 1e-9 for r in got)


def test_stopping_rule():
    assert EN.stop_at([0.1, 0.2, 0.3], 2) == 3 and EN.stop_at([0.3, 0.2, 0.1, 0.9], 2) == 1
    assert EN.stop_at([0.3, 0.2, 0.4, 0.4, 0.4], 5) == 3 and EN.stop_at([None, 0.1, None], 1) == 2 and EN.stop_at([0.1, 0.3, 0.2, 0.9], 0) == 4


def test_early_stop_keeps_the_best_stage(spark, data, monkeypatch):
    monkeypatch.setitem(EN.BOOSTING, "t", (0.5, 8, 5, 12, 3))
    fit, hold = data.where("customer_id % 4 > 0"), data.where("customer_id % 4 = 0")
    got = EN.fit_boosting("t", fit, hold)
    assert len(got.scores) == 12 and got.rounds == EN.stop_at(got.scores, 3) and len(got.model.trees) == got.rounds
    best = EN.staged_precision(got.model, hold)
    assert best == got.scores[:got.rounds] and max(best) == best[-1]


def test_depth_for_leaves():
    assert [EN.depth_for(n) for n in (2, 3, 4, 7, 15, 31)] == [1, 2, 2, 3, 4, 5]


def test_spread_over_models(spark, data):
    same = [MD.classifier("lr", 600, label="label").fit(data) for _ in range(2)]
    still = EN.spread(EN.score_all(same, data), 0.5).first()
    assert still["n"] == 600 and still["max_sd"] == 0 and still["decided_both_ways"] == 0
    drawn = [MD.classifier("lr", 600, label="label", weight_col="w").fit(data.withColumn("w", EN.bootstrap_weight("customer_id", b)).where("w > 0")) for b in range(3)]
    scored = EN.score_all(drawn, data)
    p = np.array([r["p"] for r in scored.collect()])
    row = EN.spread(scored, 0.5).first()
    assert row["mean_sd"] == pytest.approx(p.std(axis=1).mean(), abs=1e-6) and row["max_sd"] == pytest.approx(p.std(axis=1).max(), abs=1e-6) and row["max_sd"] > 0
    assert row["decided_both_ways"] == pytest.approx(((p.min(1) < 0.5) & (p.max(1) >= 0.5)).mean(), abs=1e-6)
    alone = [r["probability"][1] for r in drawn[1].transform(data).orderBy("customer_id").collect()]
    assert [r["p"][1] for r in scored.orderBy("customer_id").collect()] == alone


def test_bootstrap_weights_are_poisson(spark):
    w = [r["w"] for r in spark.range(20000).select(EN.bootstrap_weight("id", 3).alias("w")).collect()]
    assert abs(np.mean(w) - 1) < 0.03 and abs(np.var(w) - 1) < 0.05 and abs(np.mean(np.array(w) == 0) - math.exp(-1)) < 0.02
    again = spark.range(20000).repartition(7).select("id", EN.bootstrap_weight("id", 3).alias("w")).orderBy("id")
    assert [r["w"] for r in again.collect()] == w and spark.range(50).where(EN.bootstrap_weight("id", 3) != EN.bootstrap_weight("id", 4)).count() > 5


def test_deep_trees_keep_the_rows_nodes(spark, data):
    one = data.coalesce(1).persist()
    for kind, kw in (("tree", {}), ("rf", {"numTrees": 4})):
        grower = MD.classifier(kind, 600, label="label", **kw)
        assert grower.getCacheNodeIds()
        walked = grower.copy().setCacheNodeIds(False).fit(one)
        names = lambda m: m.toDebugString.split("\n", 1)[1]  # noqa: E731  (the first line has the model's uid)
        assert names(grower.fit(one)) == names(walked)


def test_settings_fitted_at_the_same_time_leave_the_rows_kept(spark):
    """Before, the first setting that ended dropped the rows from the memory of those still at work."""
    from pyspark.ml.linalg import Vectors
    rows = [(float(i % 3 == 0), Vectors.dense([float(i % 7), float(i % 3) + (i % 5) / 10])) for i in range(400)]
    fit = spark.createDataFrame(rows, ["label", "features"]).persist()
    EN.fit_boosting("tuned, early stop", fit, fit)
    assert fit.storageLevel.useMemory
    fit.unpersist()
