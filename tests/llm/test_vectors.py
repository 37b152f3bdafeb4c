import numpy as np
import pytest

from retention_engine.llm import vectors


def brute(rows, threshold):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / np.abs(v).max()
        return x / np.sqrt(x @ x)
    u = [unit(v) for _, v in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and u[i] is not None and u[j] is not None and len(u[i]) == len(u[j])
             and u[i] @ u[j] >= threshold] for i in range(n)]
    out = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := [j for j in link[todo.pop()] if j not in seen])
            seen.update(new)
        out[rows[i][0]] = (len(link[i]), min(rows[j][0] for j in seen))
    return out


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 10))
    rows = [(i, (base[i % 12] * rng.uniform(0.1, 9) + rng.normal(size=10) * rng.choice([0.05, 0.2, 0.5])).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(20)] + [(300, None), (301, []), (302, [0.0] * 10), (303, [1.0, None] * 5),
             (304, [float("nan")] * 10), (305, [float("inf")] * 10), (306, [1e-200] * 10), (307, [1e200] * 10),
             (308, [1.0, 2.0]), (309, [2.0, 4.0]), (310, [-0.0, 1.0]), (311, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links int, key string")
    got = vectors.near_duplicates(df, block_rows=block_rows, tile_rows=8, lead_dims=4).collect()
    want = brute(rows, 0.95)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_repeated_null_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(((r["vec_id"] or -1, r["n_links"]) for r in vectors.near_duplicates(df).collect()))
    assert got == [(-1, 0), (1, 1), (1, 1)]
    assert vectors.near_duplicates(df.where("vec_id > 5")).count() == 0
