import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retention_engine.llm import grammar

from .test_packing import whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=80), min_size=1, max_size=8))
def test_compress_expands_back(docs):
    arrays = [np.array(d, np.uint32) for d in docs]
    ids = np.concatenate(arrays)
    sizes = np.array([len(d) for d in docs])
    sym, rules, starts, first = grammar.compress(ids, np.cumsum(sizes) - sizes, least=2, most=3)
    block = grammar.Block(grammar.pack_block(arrays))
    assert block.all().tolist() == ids.tolist()
    assert len(starts) == len(docs) and len(sym) <= len(ids)
    lengths = grammar.expansion_lengths(rules, first)
    assert sum(lengths[s - first] if s >= first else 1 for s in sym.tolist()) == len(ids)
    for i, d in enumerate(docs):
        assert block.doc(i).tolist() == d


def test_random_access_and_smaller_files():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 50000, rng.integers(2, 6)) for _ in range(60)]
    docs = [np.concatenate([words[i] for i in rng.integers(0, 60, 200)]).astype(np.uint32) for _ in range(40)]
    data = grammar.pack_block(docs)
    block = grammar.Block(data)
    assert len(data) < sum(d.nbytes for d in docs) / 5 and len(block.rules) > 20
    for i in (0, 7, 39):
        for at, n in ((0, 5), (100, 37), (len(docs[i]) - 3, 3), (50, 0)):
            assert block.piece(i, at, n).tolist() == docs[i][at:at + n].tolist()


@pytest.mark.parametrize("block_ids", [50, 1 << 20])
def test_files_against_brute_force(spark, tmp_path, block_ids):
    rows = [(i * 37 % 200, f"doc {i} of some words " * (i % 7)) for i in range(200)]
    rows += [(300, None), (301, ""), (5, "again"), (5, "again"), (None, "no id"), (302, "long " * 3000)]
    df = spark.createDataFrame([(d, t, 1, b"x") for d, t in rows], "doc_id long, text string, shard int, data binary")
    grammar.write(df, str(tmp_path / "w"), block_ids=block_ids)
    got = grammar.read(spark, str(tmp_path / "w")).collect()
    ids = whole([t for _, t in rows])
    want = sorted((-1 if d is None else d, x) for (d, _), x in zip(rows, ids, strict=True))
    out = sorted(got, key=lambda r: r["start"])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], list(r["ids"])) for r in out) == want
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in out] == [d for d, _ in want]
    at = 0
    for r in out:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert grammar.write_and_read(df).count() == 0
