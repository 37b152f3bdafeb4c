import math
import random

import numpy as np
from pyspark.sql import functions as F

from retention_engine.llm import language
from retention_engine.sources.tables import load

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_keeps(spark):
    docs = load(spark, SF, "documents")
    wrong = F.when(F.col("doc_id") % 13 == 0, F.lit("de")).otherwise(F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("lang")))
    rows = docs.withColumn("li_lang_clash", F.lit(1)).withColumn("said", wrong)
    out = language.judge(rows, "text", F.col("said"), None, F.col("source"), F.col("doc_id")).toPandas()
    assert set(rows.columns) < set(out.columns) and len(out) == rows.count()
    held = out[out["said"].isna() | (out["said"] != out["lang"])]
    clean = held[held["n_chars"] > 200]
    assert (clean["li_lang"] == clean["lang"]).mean() > 0.95
    assert out[out["n_chars"] > 60]["li_kept"].mean() > 0.9


def test_evidence_fuses(spark):
    rnd = random.Random(2)
    en, de = "the of and that was with this from".split(), "der die und nicht mit auch einer wird".split()
    rows = []
    for i in range(200):
        lang, words = (("en", en), ("de", de))[i % 2]
        rows.append((i, " ".join(rnd.choice(words) for _ in range(30)), lang, lang.replace("en", "uk"), f"h{i % 2}"))
    rows += [(500, "am in so", "de", None, None), (501, "am in so", None, "de", "h1"), (502, "am in so", None, None, None),
             (503, "am in so", None, "uk", "h0"), (504, None, "en", "uk", "h0"), (505, "", "en", None, None), (506, "§§%%&&$$##" * 20, "en", "uk", "h0"),
             (507, " ".join(de), "en", "uk", "h0"), (507, " ".join(de), "en", "uk", "h0"), (None, " ".join(en), "", " ", "h0"),
             (508, "und der " * 50000, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, tld string, host string")
    got = language.judge(df, "text", F.col("lang"), F.col("tld"), F.col("host"), F.col("doc_id")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[500]["li_lang"] == "de" and by[501]["li_lang"] == "de" and by[503]["li_lang"] == "en"
    p = [by[501]["li_posterior"], by[501]["li_text_posterior"]]
    assert p[0] > p[1]
    assert not any(by[i]["li_kept"] for i in (504, 505, 506))
    assert by[507]["li_lang"] == "de" and by[508]["li_lang"] == "de" and by[None]["li_lang"] == "en"


def test_text_scores_against_brute_force():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    table = rng.normal(size=(3, language.CELLS)).astype(np.float32)
    texts = ["abc", "", None, "ab", "the quick brown é fox", "x" * 500, "AbC", "q"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    out = next(language._likelihoods(["a", "b"], table)(iter([batch])))
    for t, n, ll in zip(texts, out["_li_n"].to_pylist(), out["_li_ll"].to_pylist(), strict=True):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        cells = language._cells(raw) if len(raw) > 2 else np.zeros(0, int)
        want = table[:, cells].astype(float).sum(axis=1) * (min(len(cells), language.EVIDENCE_TRIGRAMS) / max(len(cells), 1))
        assert n == len(cells) and np.allclose(ll, want - want.max(), atol=1e-3) and not any(map(math.isnan, ll))


def test_nothing_declared_and_empty(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["li_kept"] for r in language.judge(df, "text", F.col("lang")).collect()] == [False]
    assert language.judge(df.where("doc_id > 9"), "text", F.col("lang")).count() == 0


def test_one_rows_trigrams_are_not_its_language(spark):
    """The text model leaves out what only one sampled row has, so a declared language is not counted again as text."""
    rows = [(i, "the cat sat on the mat again", "en") for i in range(20)] + [(100, "qzx jvw kkq", "en")] + [(200 + i, "der hund und die katze", "de") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, table = language.fit(df, F.col("text"), F.col("lang"), F.col("doc_id"))
    seen = language._cells(np.frombuffer(b"the cat sat", np.uint8))
    own = np.setdiff1d(language._cells(np.frombuffer(b"qzx jvw kkq", np.uint8)), language._cells(np.frombuffer(rows[0][1].encode(), np.uint8)))
    assert names == ["de", "en"] and len(own) > 5
    assert np.allclose(table[1][own], table[1].min()) and (table[1][seen] > table[1].min() + 1).all()
    few, small = language.fit(df.where("doc_id IN (1, 2, 100)"), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert few == ["en"] and (small[0][own] > small[0].min()).all()


def test_tags_count_by_their_first_subtag(spark):
    rows = [(i, "the cat sat on the mat", ("en-us", "en_GB", "EN")[i % 3]) for i in range(30)] + [(50 + i, "der hund und die katze", "de-AT") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.judge(df, "text", F.col("lang"), None, None, F.col("doc_id")).collect()
    assert {(r["lang"], r["li_lang"]) for r in out} == {("en-us", "en"), ("en_GB", "en"), ("EN", "en"), ("de-AT", "de")}


def test_fused_posterior_against_brute_force(spark):
    """Counts, priors, declared evidence and the posterior recomputed row by row with the fitted text model."""
    rnd = random.Random(4)
    words = {"en": "the of and that was with".split(), "de": "der die und nicht mit auch".split()}
    rows = []
    for i in range(120):
        lang = rnd.choice(["en", "de"])
        text = " ".join(rnd.choice(words[lang]) for _ in range(rnd.choice([2, 3, 20])))
        rows.append((i, text, rnd.choice([lang, lang, None, "de"]), rnd.choice(["uk", "de", None]), rnd.choice(["h0", "h1", "h2", None])))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, tld string, host string")
    got = {r["doc_id"]: r for r in language.judge(df, "text", F.col("lang"), F.col("tld"), F.col("host"), F.col("doc_id")).collect()}
    names, table = language.fit(df, F.col("text"), F.col("lang"), F.col("doc_id"))
    k = len(names) + 1
    like = {}
    for i, text, *_ in rows:
        cells = language._cells(np.frombuffer(text.encode(), np.uint8))
        like[i] = table[:, cells].astype(float).sum(axis=1) * min(len(cells), language.EVIDENCE_TRIGRAMS) / len(cells)
    noise = np.array([1.0] * (k - 1) + [language.NOISE_PRIOR])
    text_p = {i: (w := np.exp(v - v.max()) * noise) / w.sum() for i, v in like.items()}
    total = sum(text_p.values())
    base = (total + 0.5) / (total.sum() + 0.5 * k)
    add = lambda ids: sum((text_p[i] for i in ids), np.zeros(k))
    shrink = lambda c, parent: (c + language.PRIOR_ROWS * parent) / (c.sum() + language.PRIOR_ROWS)
    for i, _, lang, tld, host in rows:
        prior = base
        if tld is not None:
            prior = shrink(add(r[0] for r in rows if r[3] == tld), base)
        if host is not None:
            prior = shrink(add(r[0] for r in rows if r[4] == host and r[3] == tld), prior)
        score = like[i] - like[i].max() + np.log(prior)
        if lang is not None:
            c = add(r[0] for r in rows if r[2] == lang)
            score += np.log((c + language.PRIOR_ROWS * c.sum() / total.sum()) / (total.sum() * base + language.PRIOR_ROWS))
        post = np.exp(score - score.max())
        post /= post.sum()
        best = int(np.argmax(post[:-1]))
        assert got[i]["li_lang"] == names[best] and abs(got[i]["li_posterior"] - post[best]) < 1e-4
