import random
import re

import numpy as np
import pytest

from retention_engine.llm import jaccard


def brute(rows, n, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                comp[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted((d is None, d or 0, len(s), low[root(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ß", "Ab"]
    passage = " ".join(rnd.choice(vocab) for _ in range(25))
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 120))) for _ in range(n // 5)]
    rows = []
    for i in range(n):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
            k = rnd.randrange(len(w))
            w[k:k + rnd.randint(0, 2)] = [rnd.choice(vocab)]
        t = " ".join(w)
        if rnd.random() < 0.2:
            t = passage + "\n\t" + t
        rows.append((i * 3 + 1, t.upper() if rnd.random() < 0.1 else t))
    return rows


@pytest.mark.parametrize(("ngram", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_against_brute_force(spark, ngram, percent):
    rows = corpus(ngram, 150) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "a b"), (9004, "A  b"), (9005, "a c"), (9006, "x"),
                                 (9007, "a b c d e"), (1, "the same id again"), (1, "the same id again"), (None, "a b"), (9010, "a b")]
    df = spark.createDataFrame([(d, t, 1, 2, "z") for d, t in rows], "doc_id long, text string, node int, size int, part string").repartition(5)
    got = jaccard.near_duplicates(df, ngram=ngram, percent=percent).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got) == brute(rows, ngram, percent)


def test_group_of_near_copies_and_long_text(spark):
    rnd = random.Random(4)
    w = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(120):
        x = list(w)
        for _ in range(rnd.randint(0, 6)):
            x[rnd.randrange(200)] = f"q{rnd.randrange(50)}"
        rows.append((i, " ".join(x)))
    long = " ".join(f"l{i % 7919}x{i % 31}" for i in range(60000))
    rows += [(1000, long), (1001, long + " tail"), (1002, long[:len(long) // 2])]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, 4, 85)


def test_prefix_and_filters_lose_nothing():
    rng = np.random.default_rng(0)
    rank = rng.integers(0, 50, 1 << jaccard.SKETCH_BITS).astype(np.uint32)
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**64, 40, dtype=np.uint64))
        s, t = (np.sort(rng.choice(pool, rng.integers(1, len(pool)), replace=False)) for _ in "ab")
        both = len(np.intersect1d(s, t))
        real = 100 * both >= 60 * (len(s) + len(t) - both)
        assert jaccard.similar(s, t, 60) == real
        if real:
            assert len(np.intersect1d(jaccard.prefix_of(s, rank, 60), jaccard.prefix_of(t, rank, 60)))


def test_empty(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
