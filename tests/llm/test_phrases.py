import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from retention_engine.llm import phrases


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_counts(rows, words):
    f = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f[lang, 0, ""] += len(w)
            for k in range(1, words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, k, " ".join(w[i:i + k])] += 1
    return f


def brute(rows, least=10, words=3, top=2000, percent=50):
    f = brute_counts(rows, words)
    cands = {(g, p): n for (g, k, p), n in f.items() if k >= 2 and n >= least}
    out = []
    for (g, p), a in cands.items():
        w = p.split(" ")
        cuts = []
        for k in range(1, len(w)):
            l, r = f[g, k, " ".join(w[:k])], f[g, len(w) - k, " ".join(w[k:])]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        held = any(h == g and len(q.split(" ")) > len(w) and f" {p} " in f" {q} " and 100 * b >= percent * a for (h, q), b in cands.items())
        if not held:
            s, _, l, r = min(cuts)
            out.append((g, p, a, l, r, f[g, 0, ""], s))
    ranked = []
    for g in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == g), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        ranked += [(g, i + 1, *o[1:]) for i, o in enumerate(own)]
    return sorted(ranked)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "ß", "Ab", "new", "york", "city", "x-ray"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    fixed = ["new york city", "New York", "once upon a time", "x-ray\tmachine", "É ß"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.15 else rnd.choices(vocab, weights)[0] for _ in range(rnd.randint(0, 40))]
        text = "".join(p + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " !? "]) for p in parts)
        rows.append((rnd.choice(["en", "en", "en", "de", None]), text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(g, t, 1, "p") for g, t in rows], "lang string, text string, n int, phrase string").repartition(4)


@pytest.mark.parametrize(("words", "share", "bits"), [(3, 0.25, 26), (3, 0.0, 26), (3, 0.25, 6), (4, 0.1, 16), (2, 0.25, 26)])
def test_against_brute_force(spark, words, share, bits):
    """Whatever the sample (none with a share of 0) and however small the bitmap, the result is that of counting all."""
    rows = corpus(words) + [(None, None), ("en", ""), ("en", " .\t"), ("und", "new york city " * 30), ("fr", "seul"), ("", "a b " * 12)]
    got = phrases.collocations(frame(spark, rows), words=words, share=share, bits=bits).collect()
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got) == brute(rows, words=words)


def test_counts_and_top(spark):
    rows = corpus(9) + [("a\tb", "of a language with a tab " * 4)]
    got = {(r["lang"], r["words"], r["phrase"]): r["n"] for r in phrases.frequent_phrases(frame(spark, rows), least=3).collect()}
    assert got == {k: n for k, n in brute_counts(rows, 3).items() if n >= 3 or k[1] == 0}
    assert len(got) > 100
    best = phrases.collocations(frame(spark, rows), least=3, top=5).collect()
    assert sorted(tuple(r) for r in best) == brute(rows, least=3, top=5)


def test_empty_and_long(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [("en", None), (None, "one two")])).count() == 0
    rows = [("en", "the same pair, " * 200_000 + "end " * 50 + "q" * 3_000_000), ("en", "Same Pair")]
    got = phrases.collocations(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_long_rows_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 16)
    texts = ["aa bb cc, dd ee ff gg hh ii jj kk ll. mm nn", "x" * 50, "", "y z. " * 20]
    got = Counter()
    for b in phrases._count(pa.array(["en"] * 4), pa.array(texts), 2, lambda k, valid, hashes: valid[k]):
        for r in b.to_pylist():
            lang, phrase = r["key"].split("\t")
            got[lang, len(phrase.split()), phrase] += r["n"]
    assert got == brute_counts([("en", t) for t in texts], 2)


def test_scores_beyond_64_bits(spark):
    score = "(cast(a AS decimal(19, 0)) * a * 1000000) div (cast(l AS decimal(19, 0)) * r)"
    a, l, r = 7_000_000_000_001, 9_100_000_000_007, 8_200_000_000_003
    got = spark.sql(f"SELECT {score} AS s FROM (SELECT {a} AS a, {l} AS l, {r} AS r)").first()["s"]
    assert got == 1000000 * a * a // (l * r)
