import random
from collections import Counter, defaultdict

import pytest

from retention_engine.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, least_chars=40, least_docs=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        stays = []
        for line in all_lines:
            h = holders.get(key(line), ())
            if len(h) < least_docs or d == max(h, key=lambda x: (x is not None, x or 0)):
                stays.append(line)
        out.append((d, len(all_lines), len(all_lines) - len(stays), "\n".join(stays)))
    return Counter(out)


def got(df, **kw):
    return Counter((r["doc_id"], r["line_count"], r["lines_dropped"], r["text"]) for r in lines.drop_common_lines(df, **kw).collect())


COMMON = ["Share this page with your friends and family now", "ÄÖÜ cookies help us deliver our services to you ok", "x" * 40, "y" * 39]


def corpus(seed):
    rnd = random.Random(seed)
    rows = []
    for d in range(60):
        ls = []
        for _ in range(rnd.randrange(8)):
            c = rnd.choice([*COMMON, f"own line {d} {rnd.random()} that nobody else has at all", "", "short"])
            if rnd.random() < 0.3:
                c = rnd.choice([" ", "\t", "\x0b \r", ""]) + (c.upper() if c.isascii() else c) + rnd.choice([" ", "\x0c", "\r"])
            ls.append(c)
        rows.append((d, "\n".join(ls)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    rows += [(100, None), (101, ""), (102, "\n"), (103, "\n\n"), (None, COMMON[0] + "\nnull id"), (None, COMMON[0]), (None, None),
             (7, COMMON[1]), (7, COMMON[1]), (7, COMMON[1] + "\nanother text under the same id"), (104, f"{COMMON[2]}\n{COMMON[2]}\nend"),
             (105, "\n".join([COMMON[0]] * 3000 + ["x" * 200000] + [f"line {i} of a very long document, forty characters" for i in range(5000)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(df) == brute(rows)
    assert got(df, least_chars=1, least_docs=2) == brute(rows, 1, 2)


def test_threshold_keeper_and_unicode_spaces(spark):
    line, nbsp = "a line of the footer that has forty characters", " " + "a line of the footer that has forty characters"
    four = [(i, line) for i in range(4)]
    assert all(n == 0 for _, _, n, _ in got(spark.createDataFrame(four, "doc_id long, text string")))
    five = [*four, (4, f" {line.upper()}\t\n{line}")]
    assert got(spark.createDataFrame(five, "doc_id long, text string")) == brute(five)
    other = [*four, (4, nbsp)]  # not one of the blanks that are stripped
    assert all(n == 0 for _, _, n, _ in got(spark.createDataFrame(other, "doc_id long, text string")))
    nulls = [*[(None, line)] * 9, *four[:3]]  # null ids count as one document
    assert all(n == 0 for _, _, n, _ in got(spark.createDataFrame(nulls, "doc_id long, text string")))


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, id long, pos int, key string, _gone int, _row int, line_count string, `a.b` int"
    empty = lines.drop_common_lines(spark.createDataFrame([], schema))
    assert empty.count() == 0
    rows = [(i, COMMON[0], i, 1, "k", 2, 3, "replaced", 4) for i in range(6)]
    out = lines.drop_common_lines(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "id", "pos", "key", "_gone", "_row", "a.b", "line_count", "lines_dropped"]
    assert sorted((r["doc_id"], r["id"], r["_row"], r["a.b"], r["line_count"], r["lines_dropped"]) for r in out.collect()) == [
        (i, i, 3, 4, 1, int(i < 5)) for i in range(6)]
