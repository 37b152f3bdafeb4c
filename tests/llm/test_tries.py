import hashlib
import random
import zlib

import pytest

from retention_engine.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, head string, depth int, size int"


def originals(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        todo, leaves, saved = [p], 0, 0
        while todo:
            q = todo.pop()
            leaves += q not in children
            saved += (len(members[q]) - 1) * (len(q[-1][1].encode()) if q else 0)
            todo += children.get(q, [])
        return leaves, saved
    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *below(p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, 2) for r in rows], SCHEMA).repartition(5)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def corpus(seed, n=60):
    rnd = random.Random(seed)
    said = ["hello", "Grüße", "", "what now", "ok", "a longer answer than the others"]
    rows = []
    for c in range(0, n * 2, 2):
        k = rnd.choice([0, 1, 2, 3, 5, 9, 12])
        rows += [(c, rnd.choice([t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice([*said, None])) for t in range(k)]
    copy = [(t, "user", f"turn {t % 3}") for t in range(7)]
    for c in [*range(1, 60, 2), -3, -12]:
        rows += [(c, *x) for x in copy]
    rows += [(c, t, "user", "comb" if t < c - 300 else f"tooth {c}") for c in range(301, 310) for t in range(12)]
    rows += [(None, 0, "user", "of no conversation"), (7, 3, "user", "turn 0"), (7, 3, "user", "turn 0"), (9, None, None, None)]
    return rows


@pytest.mark.parametrize(("seed", "container"), [(1, 20_000), (2, 40), (3, 1)])
def test_against_brute_force(spark, seed, container):
    """One container, containers that burst in some rounds, and containers that hold one turn at most."""
    rows = corpus(seed)
    convs = originals(rows)
    assert nodes(tries.rebuilt_trie(frame(spark, rows), container)) == brute(rebuilt(convs))
    if seed == 2:
        assert nodes(tries.prefix_trie(frame(spark, rows), container)) == brute(convs)


def test_long_conversation_and_many_copies(spark, monkeypatch):
    """A conversation with most of the turns is one path; many copies are one path with one digest, read in parts."""
    monkeypatch.setattr(tries, "DIGEST_PART", 7)
    rows = [(5000, t, "user", f"t{t}") for t in range(400)] + [(c, t, "user", f"s{t}") for c in range(200) for t in range(3)]
    assert nodes(tries.prefix_trie(frame(spark, rows), 50)) == brute(originals(rows))


def test_empty_and_null_only(spark):
    assert tries.rebuilt_trie(frame(spark, [])).count() == 0
    assert tries.rebuilt_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    # 6 is rebuilt from 5, which is absent: only its own turns after the first h are left, maybe none
    rows = [(c, t, "u", f"{c} {t}") for c in (6, 7, 8, 9, 11) for t in range(2)]
    got = nodes(tries.rebuilt_trie(frame(spark, rows)))
    assert got == brute(rebuilt(originals(rows)))
    assert got[0][:4] == (6, 0, None, 5)
