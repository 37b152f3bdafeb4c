import hashlib

import numpy as np
from pyspark.sql import functions as F

from retention_engine.operators import models as MD

ZERO, NUMS, CATS = ["total"], ["months"], ["plan"]


def customers(spark, n=90):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        months = float(rng.integers(0, 40))
        rows.append((i, None if i % 11 == 0 else months * 3 + float(rng.normal()), None if i % 13 == 0 else months,
                     None if i % 17 == 0 else "abc"[i % 3], int(rng.random() < months / 40)))
    return spark.createDataFrame(rows, "customer_id long, total double, months double, plan string, y int")


def _ap(p, y):
    order = sorted(set(p), reverse=True)
    above = [(sum(a >= s for a in p), sum(b for a, b in zip(p, y, strict=True) if a >= s), sum(b for a, b in zip(p, y, strict=True) if a == s)) for s in order]
    return round(sum(pos * cum / n for n, cum, pos in above) / sum(y), 6)


def test_shuffles_of_all_columns_in_one_ranking_and_without_a_broadcast(spark, monkeypatch):
    rows = customers(spark)
    model = MD.fit_pipeline(rows, "lr", ZERO, NUMS, CATS)
    ranked, scored = [], []
    totals, score = MD.running_totals, MD.score
    monkeypatch.setattr(MD, "running_totals", lambda *a, **kw: ranked.append(1) or totals(*a, **kw))
    monkeypatch.setattr(MD, "score", lambda m, d, *a: scored.append(d) or score(m, d, *a))
    got = {r["feature"]: r for r in MD.permutation_importance(model, rows, ZERO + NUMS + CATS, repeats=2).collect()}
    assert len(ranked) == 2                             # ids, and all (column, repeat) shuffles; not one a column
    plan = scored[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan and "Union" not in plan
    # brute force: the k-th row in id order takes the value of the k-th row in hash order
    data = {r["customer_id"]: r.asDict() for r in rows.collect()}
    ids = sorted(data)
    p = {r["customer_id"]: r["probability"] for r in score(model, rows).collect()}
    base = _ap([p[i] for i in ids], [data[i]["y"] for i in ids])
    for f in ZERO + NUMS + CATS:
        drops = []
        for rep in range(2):
            by = sorted(ids, key=lambda i: (int(hashlib.md5(f"{i}|perm:{f}|{rep}".encode()).hexdigest()[:15], 16), i))  # noqa: B023
            mixed = spark.createDataFrame([dict(data[i], **{f: data[j][f]}) for i, j in zip(ids, by, strict=True)], rows.schema)
            q = score(model, mixed.orderBy(F.col("customer_id"))).collect()
            drops.append(base - _ap([r["probability"] for r in q], [r["y"] for r in q]))
        assert abs(got[f]["ap_drop_mean"] - np.mean(drops)) < 2e-6 and abs(got[f]["ap_drop_std"] - np.std(drops)) < 2e-6
