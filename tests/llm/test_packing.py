import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retention_engine.llm import packing, tokens

END = 2


def whole(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokens.vocabulary_path())
    return [tok.encode(t or "", add_special_tokens=False).ids + [END] for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'stéß 1 2,.\n\t\r\xa0 #|<>endoftxt"), max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    got = tokens.encoder(tokens.vocabulary_path(), 20)(texts)
    assert [g.tolist() + [END] for g in got] == whole(texts)


def test_added_tokens_have_their_own_ids():
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b c", "x <|endoftext| > y", "plain words here"]
    got = tokens.encoder(tokens.vocabulary_path(), 20)(texts)
    assert [g.tolist() + [END] for g in got] == whole(texts)
    assert got[0].tolist() == [31373, 220, 50256, 995] and [(g == 50256).sum() for g in got] == [1, 1, 1, 0, 0]


def test_new_pieces_go_to_the_library_many_at_a_time():
    class Counting:
        calls = 0

        def __getattr__(self, name):
            return getattr(tok, name)

        def encode_batch_fast(self, texts, **kw):
            Counting.calls += len(texts)
            return tok.encode_batch_fast(texts, **kw)

    texts = [" ".join(f"w{chr(97 + i % 26)}{i}x{j}," for j in range(50)) + f"\né{i} 'tis -5 #a" for i in range(20)]
    enc = tokens.Encoder(tokens.vocabulary_path())
    tok, enc.tok = enc.tok, Counting()
    got = enc([None, *texts, ""])
    assert [g.tolist() + [END] for g in got] == whole([None, *texts, ""])
    assert Counting.calls < 100  # 1020 different pieces


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1), st.integers(40, 60))
def test_fullest_is_the_best_subset_sum(counts, room):
    c = np.zeros(61, np.int64)
    for k, v in counts.items():
        c[k] = v
    use = packing.fullest(c, room)
    assert all(0 < v <= c[k] for k, v in use)
    sums = {0}
    for k, v in counts.items():
        sums = {s + k * m for s in sums for m in range(v + 1) if s + k * m <= room}
    assert sum(k * v for k, v in use) == max(sums)
    plan = packing.minimum_bin_slack(c, 60)
    back = np.zeros(61, np.int64)
    for times, u in plan:
        assert sum(k * v for k, v in u) <= 60
        for k, v in u:
            back[k] += times * v
    assert (back == c).all()


@pytest.mark.parametrize("seq_len", [64, 1024])
def test_pack_against_brute_force(spark, seq_len):
    rows = [(1, "one two three"), (2, None), (3, ""), (4, "word " * 900 + "end"), (5, "a\n\nb"), (5, "a\n\nb"),
            (6, "x" * 5000), (None, "no id"), *[(i, "same text here") for i in range(10, 60)]]
    df = spark.createDataFrame([(d, t, 7, "clash") for d, t in rows], "doc_id long, text string, length int, piece string")
    out = packing.best_fit(df, seq_len=seq_len).toPandas()
    ids = dict(zip([r[0] for r in rows], whole([r[1] for r in rows]), strict=True))
    assert out["length"].sum() == sum(len(x) for x in whole([r[1] for r in rows]))
    for r in out.itertuples():
        doc = ids[None if np.isnan(r.doc_id) else r.doc_id]
        part = doc[r.start:r.start + r.length]
        assert list(r.ids) == part
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r.piece == 0 or r.length == seq_len
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["length"].sum() <= seq_len
        assert (g["offset"].to_numpy() == g["length"].cumsum().to_numpy() - g["length"].to_numpy()).all()
    assert out["sequence_id"].nunique() <= out["length"].sum() / seq_len * 1.2 + 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.best_fit(df).count() == 0
