import numpy as np
import pytest

import corpus_pipeline
from retention_engine.llm import decontaminate
from retention_engine.sources.tables import load

from .test_jaccard import brute
from .test_packing import whole

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage was given and what it made, written and read again."""
    out, docs = [], load(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs.toPandas().set_index("doc_id"), made.toPandas()))
        docs = made
    return out


def test_columns(steps):
    for before, after in steps[:-1]:
        assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
        assert set(after["doc_id"]) <= set(before.index)


def test_language_keeps_texts(steps):
    before, after = steps[0]
    assert len(after) >= 0.95 * len(before)
    assert (after.set_index("doc_id")["lang"] == before["lang"].loc[after["doc_id"]]).mean() > 0.95


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    want = {d for _, d, _, c in brute(list(before["text"].items()), 5, 80) if d == c}
    assert set(after["doc_id"]) == want


def test_passages_are_cut_once(steps):
    before, after = steps[2]

    def runs(texts):
        return [{tuple(w[i:i + 45]) for i in range(len(w) - 44)} for w in (t.lower().split() for t in texts)]
    sets = runs(after["text"])
    assert not any(a & b for i, a in enumerate(sets) for b in sets[:i])
    alone = runs(before["text"])
    clean = [d for d, s in zip(before.index, alone, strict=True) if not any(s & t for t in alone if t is not s)]
    cut = after.set_index("doc_id")
    changed = [d for d in clean if cut["text"].get(d) != before["text"][d]]
    # Fuzzy passages have no long run in common; they are few here.
    assert len(changed) <= 0.1 * len(clean)


def test_contaminated_documents_go(spark, steps):
    before, after = steps[3]
    items = [decontaminate.normal(t) for t in load(spark, SF, "benchmark").toPandas()["text"]]
    hit = {d for d, t in before["text"].items() if any(i in decontaminate.normal(t) for i in items)}
    gone = set(before.index) - set(after["doc_id"])
    assert hit <= gone and len(gone) <= len(hit) + 2


def test_packing(steps):
    before, after = steps[4]
    sizes = dict(zip(before.index, map(len, whole(list(before["text"]))), strict=True))
    assert after.groupby("doc_id")["length"].sum().to_dict() == sizes
    for _, g in after.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["length"].sum() <= 1024 and (g["offset"] == np.cumsum(g["length"]) - g["length"]).all()


def test_rows_with_one_id_or_none_are_grouped_by_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, a), (None, a), (None, "only here"), (9, None), (9, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted(
        [(1, a), (5, b), (7, c), (None, "only here"), (9, None), (9, ""), (None, None)], key=key)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.where("doc_id > 99"), SF).count() == 0
