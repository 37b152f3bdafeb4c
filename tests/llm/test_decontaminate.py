import random

import numpy as np
import pytest

from retention_engine.llm import decontaminate as D


def edits_in(item, text):
    """Fewest edits of item at any place of text (plain dynamic program)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def noisy(rnd, s, n):
    s = list(s)
    for _ in range(n):
        i = rnd.randrange(len(s))
        kind = rnd.random()
        if kind < 0.4:
            s[i] = rnd.choice("xyz")
        elif kind < 0.7:
            s.insert(i, rnd.choice("xyz"))
        else:
            del s[i]
    return "".join(s)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_finds_what_brute_force_finds(seed):
    rnd = random.Random(seed)
    bench = [D.normal(words(rnd, rnd.randint(12, 40))) for _ in range(6)]
    bench = [b for b in bench if len(b) >= D.LEAST_CHARS]
    items = D.Items(list(enumerate(bench)), D.RATE)
    for _ in range(25):
        text = words(rnd, 30)
        for b in rnd.sample(bench, rnd.randint(0, 2)):
            text += " " + noisy(rnd, b, rnd.randint(0, int(len(b) * 0.14))) + " " + words(rnd, rnd.randint(0, 20))
        text = D.normal(text)
        want = {i: e for i, b in enumerate(bench) if (e := edits_in(b, text)) <= items.edits[i]}
        got = {}
        for i, start, end, e, n in D.find(items, text):
            got[i] = min(e, got.get(i, 99))
            assert n == len(bench[i]) and edits_in(bench[i], text[start:end]) == e
        assert got == want


def test_banded_at_the_ends():
    code = D._codes
    assert D.banded(code("hello"), code("hello"), -2, 2, 2)[:1] == (0,)
    assert D.banded(code("hello"), code("ello"), -2, 2, 2)[0] == 1
    assert D.banded(code("hello"), code(""), -2, 2, 2) is None
    assert D.banded(code("abcdef"), code("zzabXcdefzz"), 0, 6, 2) == (1, 2, 9)


def test_query_rows(spark):
    item = "The quick brown fox jumps over the lazy dog, again and again, until it rests."
    rows = [(1, f"x {item} y"), (2, item.upper().replace(",", " --")), (3, item[:40]), (4, None), (5, ""), (6, "fox " * 30000 + item),
            (7, "nothing here"), (7, f"{item} {item}"), (None, item), (8, item.replace("fox", "fix"))]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, item_id int, edits int")
    bench = spark.createDataFrame([(9, item, 0), (10, None, 0), (11, "short", 0), (12, item, 0), (None, "?" * 90, 0)],
                                  "item_id long, text string, doc_id int")
    for block in (D.BLOCK_CHARS, 10):
        got = D.matches(docs, bench, block_chars=block).collect()
        want = [(d, i) for d in (1, 2, 6, None, 8) for i in (9, 12)]
        assert {(r["doc_id"], r["item_id"]) for r in got} == {*want, (7, 9), (7, 12)}
        assert {r["edits"] for r in got if r["doc_id"] == 8} == {1}
    flags = docs.select("doc_id", D.contaminated(docs["text"], bench).alias("c")).collect()
    assert np.mean([r["c"] for r in flags]) == 0.6
    assert D.matches(docs, bench.where("item_id > 50")).count() == 0 and D.matches(docs.where("doc_id > 50"), bench).count() == 0


def places(item, text):
    """All exact places of item (whole words if it is shorter than a q-gram)."""
    at = [i for i in range(len(text)) if text.startswith(item, i)]
    return at if len(item) >= D.Q else [i for i in at if f" {text} "[i] == " " and f" {text} "[i + len(item) + 1] == " "]


@pytest.mark.parametrize("seed", range(3))
def test_short_items_at_all_their_places(seed):
    rnd = random.Random(seed)
    bench = ["a", "b c", "abcdefg", "aaaaaaaa", *(D.normal(words(rnd, rnd.randint(1, 4)))[:20].strip() for _ in range(20))]
    for held in (bench, [b for b in bench if len(b) < D.Q]):
        items = D.Items(list(enumerate(held)), D.RATE)
        for _ in range(20):
            text = D.normal(" ".join(rnd.choice([*held, words(rnd, 2), "aaaaaaaaaaa", "b c b c", "xabcdefg"]) for _ in range(30)))
            want = {(i, at, at + len(b), 0, len(b)) for i, b in enumerate(held) for at in places(b, text)}
            got = D.find(items, text)
            assert set(got) == want and len(got) == len(want)


def test_query_finds_short_items(spark):
    docs = spark.createDataFrame([(1, "Q: what is the capital of Australia?  Sydney"), (2, "nothing; 42!"), (3, "x42"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is the capital of Australia?"), (2, "42"), (3, "?")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"], r["edits"]) for r in D.matches(docs, bench).collect()}
    assert got == {(1, 1, 2, 34, 0), (2, 2, 8, 10, 0)}
    assert [r["c"] for r in docs.orderBy("doc_id").select("doc_id", D.contaminated(docs["text"], bench).alias("c")).collect()] == [True, True, False, False]
    assert D.matches(docs, bench, least_chars=40).count() == 0
