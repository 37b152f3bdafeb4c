import random

import numpy as np
import pytest

from retention_engine.llm import passages as P


def plain_chain_score(pos, opos, k, gap):
    best = []
    for i in range(len(pos)):
        top = max((best[j] - gap * (pos[i] - pos[j] + opos[i] - opos[j]) for j in range(i) if pos[j] < pos[i] and opos[j] < opos[i]), default=0)
        best.append(k + max(0, top))
    return max(best)


@pytest.mark.parametrize("seed", range(30))
def test_chain_is_the_best_one(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 40)
    m = sorted((rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(n)) if seed % 3 else [(i * 3, i * 3 + 7) for i in range(n)]
    pos, opos = np.array([a for a, _ in m]), np.array([b for _, b in m])
    runs = P.chain(pos, opos, 5, 0.1)
    first = runs[0]
    score = 5.0
    for a, b in zip(first, first[1:], strict=False):
        assert pos[a] < pos[b] and opos[a] < opos[b]
        score += 5 - 0.1 * (pos[b] - pos[a] + opos[b] - opos[a])
    assert abs(score - plain_chain_score(pos.tolist(), opos.tolist(), 5, 0.1)) < 1e-9
    assert sorted(x for r in runs for x in r) == list(range(n))


def test_every_k_runs_hold_a_seed():
    rng = np.random.default_rng(1)
    for n in (9, 12, 200):
        w = rng.integers(0, 2**64, n, dtype=np.uint64)
        some = P.is_seed(w, np.arange(n - 4), 5)
        assert all(some[i:i + 5].any() for i in range(n - 8)) and some.any()
        # The run alone decides.
        assert all(P.is_seed(w[i:i + 5].copy(), np.array([0]), 5)[0] == some[i] for i in range(n - 4))


def test_shared_seeds_do_not_depend_on_batches():
    import pyarrow as pa
    rnd = random.Random(7)
    for _ in range(60):
        rows = sorted({(rnd.randrange(6), rnd.randrange(5), rnd.randrange(4)) for _ in range(40)})
        want = []
        for h in range(6):
            of = [r for r in rows if r[0] == h]
            if len({d for _, d, _ in of}) > 1:
                want += [(*r, of[0][1], of[0][2]) for r in of]
        cuts = sorted(rnd.sample(range(1, len(rows)), 6))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["h", "doc", "pos"])
                   for p in parts]
        got = [tuple(r.values()) for b in P._shared(iter(batches)) for r in b.to_pylist()]
        assert got == want


def text(rnd, n, v=4000):
    return [f"w{rnd.randrange(v)}" for _ in range(n)]


def test_align_finds_gapped_passages():
    rnd = random.Random(3)
    for _ in range(40):
        ids = {}
        code = lambda ws: np.array([ids.setdefault(w, len(ids)) for w in ws], np.uint32)
        a, b = text(rnd, 60), text(rnd, 60)
        common = text(rnd, 70)
        other = list(common)
        cut = rnd.randint(30, 40)
        other[cut:cut + 2] = []
        x, y = rnd.randint(0, 20), rnd.randint(0, 20)
        one = a[:x] + common + a[x:x + 20]
        two = b[:y] + other + b[y:y + 20]
        runs = np.array([[x + 5, x + 25, y - x], [x + 45, x + 65, y - x - 2]])
        (s, e, os, oe, n), = P.align(code(one), code(two), runs)
        assert (s, e, os, oe, n) == (x, x + 70, y, y + 68, 68)


def corpus():
    rnd = random.Random(9)
    shared = [text(rnd, n) for n in (51, 60, 90, 200)]
    docs = {}
    for i in range(60):
        w = text(rnd, rnd.randint(20, 80))
        where = None
        if i % 2:
            p = list(shared[i % 4])
            for _ in range(rnd.choice([0, 0, 1, 3])):
                p[rnd.randrange(len(p))] = "edit"
            at = rnd.randint(0, len(w))
            where = (at, at + len(p))
            w = w[:at] + p + w[at:]
        docs[i] = (w, where)
    return docs


def test_finds_planted_passages_and_nothing_else(spark):
    docs = corpus()
    rows = [(i, "\n ".join(w) if i % 3 else " ".join(w).upper(), 7, "c") for i, (w, _) in docs.items()]
    rows += [(500, None, 7, "c"), (501, "", 7, "c"), (None, " ".join(docs[1][0]), 7, "c"), (3, " ".join(docs[3][0]), 7, "c"), (502, "the same " * 300, 7, "c"),
             (503, " ".join(docs[1][0]), 7, "c"), (504, " ".join(f"z{i}" for i in range(40000)), 7, "c"), (505, " ".join(f"z{i}" for i in range(20000, 40000)), 7, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, owner int, h string").repartition(4)
    found = P.repeats(df)
    got = {}
    for r in found.collect():
        assert r["source_id"] < r["doc_id"] and r["agreeing"] >= 0.8 * (r["end_word"] - r["start_word"])
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    seen = set()
    for i, (w, where) in docs.items():
        if where is None or i % 4 not in seen:
            assert i not in got or where is None and not got[i]
            seen |= {i % 4} if where else set()
        else:
            a, b = where
            assert len(got[i] & set(range(a, b))) >= b - a - 15 and len(got[i] - set(range(a, b))) <= 3, i
    assert got[503] == set(range(len(docs[1][0]))) and got[505] == set(range(20000))
    assert not {500, 501, 502, 504, None} & set(got)
    left = {r["doc_id"]: r["text"] for r in P.remove(df, found).collect() if r["doc_id"] is not None}
    for i, (w, _) in docs.items():
        want = [x for k, x in enumerate(w) if k not in got.get(i, ())]
        assert left[i].lower().split() == want
    assert left[505] == "" and left[500] is None and set(P.remove(df, found).columns) == set(df.columns)


def test_group_of_copies_is_linear(spark):
    rnd = random.Random(1)
    p = " ".join(text(rnd, 120))
    df = spark.createDataFrame([(i, f"{p} x{i}") for i in range(150)], "doc_id long, text string")
    got = P.repeats(df).collect()
    assert {r["doc_id"] for r in got} == set(range(1, 150)) and len(got) == 149 and {r["source_id"] for r in got} == {0}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.repeats(df).count() == 0 and P.remove(df, P.repeats(df)).count() == 0


def test_passage_whose_pieces_stand_in_smaller_ids(spark):
    rnd = random.Random(4)
    p, own = text(rnd, 64, 10**6), lambda n=30: text(rnd, n, 10**6)
    q, r = own(64), own(64)
    docs = {1: p[:24], 2: p[20:44], 3: p[40:], 10: own() + p, 11: own() + p + own()}
    # The pieces in earlier places of the same document.
    docs |= {20: q[:24] + own(50) + q[20:44] + own(50) + q[40:] + own(50) + q, 21: own() + q}
    # Documents whose pieces stand in wide stretches: only the pair (35, 34) has the passage.
    s = [own(40) for _ in range(3)]
    docs |= {31: r[:24] + s[0], 32: r[20:44] + s[1], 33: r[40:] + s[2], 34: own() + r, 35: own() + r, 36: s[0] + s[1] + s[2]}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {(x["doc_id"], x["source_id"]): (x["start_word"], x["end_word"]) for x in P.repeats(df).collect()}
    assert got[11, 10] == (30, 94) and got[21, 20] == (30, 94) and got[35, 34] == (30, 94)
    assert {a for a, _ in got} == {11, 21, 35, 36}


def test_recall_of_edited_passages(spark):
    """Every passage here aligns word by word at 0.8 or more, so a plain comparison on its diagonal finds it."""
    rnd = random.Random(11)
    own = lambda n: text(rnd, n, 10**6)
    docs, kinds = {}, {}
    for length, every in [(45, 10), (50, 10), (50, 8), (60, 7), (100, 8), (100, 6), (200, 6)]:
        for _ in range(40):
            p = own(length)
            q = [f"e{rnd.random()}" if i % every == every // 2 else x for i, x in enumerate(p)]
            i = len(docs)
            docs[i], docs[i + 1] = own(30) + p + own(30), own(20) + q + own(20)
            kinds[i + 1] = (length, every)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.repeats(df).collect()}
    assert all(r["source_id"] == d - 1 for d, r in got.items())
    hits = {kind: sum(d in got for d, x in kinds.items() if x == kind) / 40 for kind in kinds.values()}
    print(hits)
    assert min(hits.values()) >= 0.9 and sum(hits.values()) / len(hits) >= 0.95, hits


def test_passages_behind_a_seed_of_many_documents(spark, monkeypatch):
    """Pairs whose one common run of five words or more is a phrase of 300 documents, owned by none of them."""
    rnd = random.Random(21)
    own = lambda n: text(rnd, n, 10**6)

    def five():
        """Five words that are no seed."""
        while True:
            w = own(5)
            data = np.frombuffer(" ".join(w).encode(), np.uint8)
            if not P.is_seed(P.split_words(data, np.array([0, len(data)]), P.whitespace_mask(), lower=True).hash, np.array([0]), 5)[0]:
                return w

    phrase = own(9)
    docs = {i: own(30) + phrase + own(30) for i in range(240)}
    for i in range(1000, 1060, 2):
        before, after = [five() for _ in range(4)], [five() for _ in range(4)]
        for j in (i, i + 1):
            docs[j] = own(20) + [x for w in before for x in w + own(1)] + phrase + [x for w in after for x in own(1) + w] + own(20)
    # The same with a word more in one of them, in the phrase.
    twice = own(10)
    docs |= {i: own(30) + twice + own(5) + phrase + own(30) for i in range(240, 260)}
    x, y = own(14), own(14)
    docs |= {2000: own(9) + x + twice + phrase + y, 2001: own(7) + x + twice + ["more"] + phrase + y}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(P, "BLOCK", 40)  # the phrase takes several blocks
    got = {(r["doc_id"], r["source_id"]) for r in P.repeats(df).collect()}
    assert got == {(i + 1, i) for i in (*range(1000, 1060, 2), 2000)}


def test_alike_places_against_plain_counts():
    from collections import Counter
    rng = np.random.default_rng(5)
    windows = [rng.integers(0, 3, rng.integers(0, 40)).astype("<u2").tobytes() for _ in range(120)]
    unit = np.sort(rng.integers(0, 30, 120))
    runs = [Counter(w[2 * i:2 * i + 8] for i in range(len(w) // 2 - 3)) for w in windows]
    alike = {(x, y) for x in range(120) for y in range(120) if (runs[x] & runs[y]).total() >= P.LEAST_RUNS}
    row, value = P.run_tokens(windows)
    codes = P.alike_in_units(unit, row, value)
    assert {(int(c // 120), int(c % 120)) for c in codes} == {(x, y) for x, y in alike if x < y and unit[x] == unit[y]}
    left = np.arange(0, 120, 3)
    got = {(int(x), int(y)) for a, b in P.alike_in_unit(left, np.arange(120), row, value) for x, y in zip(a, b, strict=True)}
    assert {(x, y) for x, y in alike if x % 3 == 0 and y < x} <= got <= alike


def test_stretch_around_a_seed():
    rng = np.random.default_rng(6)
    for _ in range(300):
        same = rng.random(95) < rng.choice([0.6, 0.8, 0.9])
        same[45:50] = True
        v = np.where(same, 1, -4)
        sums = [(int(v[s:e].sum()), s, e) for s in range(46) for e in range(50, 96)]
        top = max(sums)[0]
        assert P.around_seed(same[None], 5)[0] == (min(e - s for t, s, e in sums if t == top) >= P.LEAST_WORDS)


def test_agreeing_words_of_frames():
    rng = np.random.default_rng(5)
    for all_values in (False, True):
        words = [rng.integers(0, 40, int(n)).astype("<u2") for n in rng.integers(5, 60, 30)]
        pos = np.array([rng.integers(0, len(w) - 4) for w in words])
        if all_values:  # no value of 16 bits is left to stand for no word
            words, pos = [*words, np.arange(1 << 16).astype("<u2")[:95]], np.append(pos, 45)
        frame, none = P.frames([w.tobytes() for w in words], pos, 5)
        if all_values:
            frame, none = frame.astype(np.uint32), 1 << 16
            frame[frame == P.frames([w.tobytes() for w in words], pos, 5)[1]] = none
        at = [{int(p - min(q, P.BEYOND)): int(x) for p, x in enumerate(w)} for w, q in zip(words, pos.tolist(), strict=True)]
        x, y = np.divmod(np.arange(len(words) ** 2), len(words))
        for skips in (0, P.MOST_SKIPS):
            got = P.agrees(frame[x], frame[y], none, skips)
            for i, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
                want = [j in at[a] and any(at[b].get(j + d) == at[a][j] for d in range(-skips, skips + 1)) for j in range(-P.BEYOND, P.BEYOND + 5)]
                assert got[i].tolist() == want


def test_only_the_passages_are_left_on_disk(spark):
    """Every table between the steps is removed when the next ones stand, so what is kept does not add up."""
    import os

    from retention_engine.session import checkpoint_dir
    rnd = random.Random(11)
    common = text(rnd, 90)
    docs = spark.createDataFrame([(i, " ".join(text(rnd, 30) + common[i:60 + i] + text(rnd, 30))) for i in range(12)], "doc_id long, text string")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = P.repeats(docs)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert found.count() >= 11
    assert left == {"owners-found", "rest-found"}


def test_only_written_tables_are_discarded(spark, tmp_path):
    from retention_engine.session import discard, materialize
    table = materialize(spark.range(3), "some")
    assert table.count() == 3
    path = table.inputFiles()[0].removeprefix("file://")
    discard(table)
    import os
    assert not os.path.exists(path) and not os.path.exists(os.path.dirname(path))
    with pytest.raises(ValueError):
        discard(spark.range(3))
