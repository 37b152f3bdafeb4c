import zlib

import numpy as np
import pytest

from retention_engine.llm import sharding


def plain_differencing(sizes, k):
    """The textbook rule, with the members of each sum carried along."""
    parts = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0][0] - p[-1][0])
        a, b = parts.pop(), parts.pop()
        parts.append(sorted(((x + y, m + n) for (x, m), (y, n) in zip(a, reversed(b), strict=True)), key=lambda p: -p[0]))
    return parts[0]


@pytest.mark.parametrize("seed", range(5))
def test_difference_sums_and_members(seed):
    rng = np.random.default_rng(seed)
    sizes, k = rng.integers(1, 1000, 60), 7
    sums, place = sharding.difference(sharding._singles(sizes, k))
    got = np.bincount(place[:, 0], weights=sizes, minlength=k)
    assert (got - got.min() == sums).all()
    want = [s for s, _ in plain_differencing(sizes.tolist(), k)]
    assert got.max() - got.min() <= 3 * (max(want) - min(want)) + 5


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 3, 9) for d, t in rows], "doc_id long, text string, shard int, size int")


def test_levels_groups_and_slots(spark):
    rows = [(i, f"text {i} " + "y" * (i * 7919 % 900)) for i in range(600)] + [(1000 + i, "copy " * 40) for i in range(30)]
    rows += [(2000, None), (2001, ""), (2002, "é"), (2002, "é"), (None, "z")]
    out = sharding.assign(frame(spark, rows), shards=10).toPandas()
    assert len(out) == len(rows) and out.groupby("digest")["shard"].nunique().max() == 1
    sums = out.groupby("shard")["size"].sum()
    assert len(sums) == 10 and sums.max() - sums.min() < 30
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    e = out[out["doc_id"] == 2002].iloc[0]
    assert (e["size"], e["text_crc32"]) == (18, zlib.crc32("é".encode()))
    assert set(out[out["doc_id"].isin([2000, 2001])]["size"]) == {16}


def test_many_buckets_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_GROUPS", 100)
    monkeypatch.setattr(sharding, "LARGE", 2)
    rows = [(i, f"{i} " + "w" * (i * 31 % 50)) for i in range(800)] + [(5000 + i, "hot text") for i in range(900)]
    out = sharding.assign(frame(spark, rows), shards=8).toPandas()
    sums = out.groupby("shard")["size"].sum().sort_values()
    assert out.groupby("digest")["shard"].nunique().max() == 1
    assert sums.iloc[-1] == 900 * 24 and sums.iloc[-2] - sums.iloc[0] < 100


def test_empty(spark):
    assert sharding.assign(frame(spark, [])).count() == 0
