import random
import re

from retention_engine.llm import licenses

RULES = licenses.rules()
COMPILED = [(re.compile(f"(?:{r[2]})(?= |$)"), r) for r in RULES]


def brute(text):
    """Every rule at every word, without gates or keywords; suppression by comparing all pairs."""
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    hits = []
    for i in range(len(words)):
        ahead = " ".join(words[i:i + licenses.SPAN])
        for pattern, (rule, _, _, label, priority, confidence, base) in COMPILED:
            if m := pattern.match(ahead):
                hits.append((i, i + len(m[0].split()), -priority, rule, label, confidence, base))
    kept = []
    for h in hits:
        over = [g for g in hits if g[0] <= h[0] and g[1] >= h[1] and g[2] <= h[2] and g is not h
                and ((g[0], g[1]) != (h[0], h[1]) or (g[2], g[3]) < (h[2], h[3]))]
        same = [g for g in hits if (g[0], g[1]) == (h[0], h[1]) and (g[2], g[3]) < (h[2], h[3])]
        if not over and not same:
            kept.append(h)
    at = [h[0] for h in hits if h[6]]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({h[4] for h in hits if h[6]})),
            ",".join(sorted({h[4] for h in hits if h[6]} | {h[4] for h in kept})), max((h[5] for h in kept), default=0.0), len(kept))


def test_rules_are_many_and_begin_with_their_keyword():
    assert len(RULES) > 300
    for _, keyword, pattern, *_ in RULES:
        assert re.match(rf"\(\?:{keyword} |{keyword}|\(\?:cc .*\|{keyword} ", pattern)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    names = ["MIT License", "the Apache License, Version 2.0", "GNU General Public License, version 3", "CC BY-NC 4.0", "BSD 3-Clause",
             "SPDX-License-Identifier: GPL-2.0", "gplv3", "GNU Lesser General Public License v2.1", "Creative Commons Attribution 4.0",
             "Mozilla Public Licence", "all rights reserved", "cc0", "LICENSE", "WTFPL", "Unlicense", "cc by", "cc by-sa 3.0 license"]
    fill = ["the", "of", "é", "licensed under the terms of the", "Licensed under", "released under", "12", "---", "\n", "mit", "gnu", "public"]
    texts = [" ".join(rnd.choice(names if rnd.random() < 0.4 else fill) for _ in range(rnd.randint(0, 25))) for _ in range(40)]
    texts += [None, "", "-", "MIT-LICENSE", "İMIT License", "mit license " * 40, "x mit license", "A" * 100000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "cc by")]
    df = spark.createDataFrame([(i, t, 4, "x", 1) for i, t in rows], "doc_id long, text string, word int, label string, rule int")
    got = licenses.scan(df).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
