"""Language identification by Bayesian fusion of text, declared markup, address suffix and host evidence.

Text: a naive Bayes model over byte trigrams (hashed to ``CELLS`` cells), fitted on a bounded sample of rows with a
declared language (about ``SAMPLE_ROWS`` rows a language, drawn by a hash of their id, at most ``SAMPLE_BYTES`` of
each language in a task), applied to every trigram of every text. A trigram that only one sampled row of a language has
tells about that row, not about the language, and would count the row's declared language a second time as text; such
trigrams are left out (of languages with ``ROWS_FOR_TWICE`` sampled rows or more). Declared tags count by their first
subtag (``en-us`` is ``en``). Trigrams of one text are not independent, so its log-likelihood is tempered to at most
``EVIDENCE_TRIGRAMS`` of them. A class for noise (all bytes alike) stands beside the languages.

Everything else is counted over all rows by grouped aggregation: the text posteriors, summed by declared language, by
address suffix, by host and in total. A declared language and a suffix enter by their conditional probability given
the language (smoothed by the total). A host's prior is smoothed towards its suffix's, and that towards the total,
each with a weight of ``PRIOR_ROWS`` rows: a host with few rows says little beyond its suffix. Hosts meet only in
sums made before the shuffle; rows get their host's sums by a join that Spark can split.

A row is rejected when it has no text, when noise is its most probable class, or when the posterior of its best
language is below ``least``. Rows that carry the marks of a language are kept, whatever was declared.

Nulls and edge cases: a missing declared language, suffix or host is no evidence; a null, empty or very short text
(under three bytes) has no text evidence and is rejected; a null id is a row like any other; repeated rows are
judged each for itself; without any declared language in the table no language is known and all rows are rejected;
an empty table gives an empty result; other columns of the input are kept in ``judge`` and never clash (all working
columns begin with ``_li_``).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import batch_rows, leave_memos, slices

CELLS = 1 << 15
SAMPLE_BYTES = 1_500_000
SAMPLE_ROWS = 1_000
EVIDENCE_TRIGRAMS = 60
PRIOR_ROWS = 20.0
LEAST = 0.5
#: Bound of the model: the most frequent declared languages that are fitted.
MOST_LANGUAGES = 200
ROWS_FOR_TWICE = 10
SHARES, FIT_TASKS = 1 << 30, 16
#: Hosts whose sums are broadcast; more are joined by a shuffle that Spark can split.
BROADCAST_HOSTS = 100_000
#: Prior weight of the noise class against each language's 1.
NOISE_PRIOR = 0.01

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _cells(data: np.ndarray) -> np.ndarray:
    """Cell of the trigram at each byte (two fewer than bytes). Letters A-Z count as a-z."""
    x = _LOWER[data]
    t = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((t * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64) & (CELLS - 1)


def fit(docs: DataFrame, text: Column, declared: Column, seed: Column, sample_rows: int = SAMPLE_ROWS,
        sample_bytes: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities per cell, from about ``sample_rows`` rows a language.

    The languages are the ``MOST_LANGUAGES`` most frequent declared ones; rows are drawn by a hash of ``seed``.
    """
    rows = docs.select(text.alias("t"), declared.alias("l"), F.pmod(F.xxhash64(seed), F.lit(SHARES)).alias("h")).where(
        "l IS NOT NULL AND t IS NOT NULL")
    counts = rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MOST_LANGUAGES).collect()
    if not counts:
        return [], np.zeros((0, CELLS), np.float32)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["l"], min(SHARES, -(-SHARES * sample_rows // r["count"])))])
    picked = rows.where(F.col("h") < share[F.col("l")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}  # counts of the cells, and rows that have them
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = np.frombuffer(t.encode()[:sample_bytes], np.uint8)
                if len(raw) > 2 and (lang not in sums or sums[lang][0].sum() < sample_bytes):
                    n = np.bincount(_cells(raw), minlength=CELLS)
                    sums[lang] = sums.get(lang, 0) + np.stack([n, n > 0, np.full(CELLS, 1)])
        names = list(sums)
        counts = [sums[n].astype("<i8").tobytes() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.binary())], ["l", "n"])

    total: dict[str, np.ndarray] = {}
    # One row per task and language: for each cell its count, the rows that have it, and all rows.
    for r in picked.select("l", "t").coalesce(FIT_TASKS).mapInArrow(count, "l string, n binary").toLocalIterator():
        total[r["l"]] = total.get(r["l"], 0) + np.frombuffer(r["n"], "<i8").reshape(3, CELLS)
    names = sorted(total)
    table = np.zeros((len(names) + 1, CELLS), np.float32)
    table[-1] = -np.log(CELLS)  # noise
    for i, n in enumerate(names):
        count, having, rows_of = total[n]
        c = np.where((having > 1) | (rows_of < ROWS_FOR_TWICE), count, 0) + 0.2
        table[i] = np.log(c / c.sum())
    return names, table


def _likelihoods(names: list[str], table: np.ndarray):
    k = len(names) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_memos()
        for b in batches:
            n, ll = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, k))
            for a, z, data, off in slices(b.column(b.num_columns - 1)):
                if len(data) < 3:
                    continue
                cell = _cells(data)
                # Trigrams that reach over the end of a text are left out by summing up to two before it.
                first = off[:-1]
                count = np.maximum(np.diff(off) - 2, 0)
                n[a:z] = count
                some = np.flatnonzero(count)
                if len(some):
                    bounds = np.stack([first[some], first[some] + count[some]], axis=1).ravel()
                    bounds = bounds[:-1] if bounds[-1] >= len(cell) else bounds
                    for i in range(k):
                        ll[a + some, i] = np.add.reduceat(table[i][cell], bounds, dtype=np.float64)[::2]
            ll *= (np.minimum(n, EVIDENCE_TRIGRAMS) / np.maximum(n, 1))[:, None]
            ll -= ll.max(axis=1, keepdims=True)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(ll.ravel()), k).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n), lists], [*b.schema.names[:-1], "_li_n", "_li_ll"])
    return score


def _normal(name: str) -> Column:
    return F.transform(name, lambda x: x / F.aggregate(name, F.lit(0.0), lambda a, y: a + y))


def _vector(f, k: int) -> Column:
    return F.array(*[f(i) for i in range(k)])


def judge(docs: DataFrame, text_col: str = "text", declared: Column | None = None, suffix: Column | None = None,
          host: Column | None = None, seed: Column | None = None, least: float = LEAST,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, when not given) with ``li_lang``, ``li_posterior``, ``li_text_posterior``
    and ``li_kept``. Texts are scored twice, once for the counts and once for the result, instead of being written."""
    spark = docs.sparkSession
    batch_rows(spark)
    none = F.lit(None).cast("string")
    declared, suffix, host = (F.lower(F.trim(c.cast("string"))) if c is not None else none for c in (declared, suffix, host))
    declared = F.element_at(F.split(declared, "[-_]"), 1)
    declared = F.when(declared != "", declared)
    seed = seed if seed is not None else F.col(text_col)
    names, table = fit(docs, F.col(text_col).cast("string"), declared, seed)
    if not names:
        return docs.select(*(docs.columns if keep is None else keep), none.alias("li_lang"), F.lit(0.0).alias("li_posterior"), F.lit(0.0).alias("li_text_posterior"),
                           F.lit(False).alias("li_kept"))
    k = len(names) + 1
    kept = docs.columns if keep is None else keep
    score = _likelihoods(names, table)

    def scored(columns: list[str]) -> DataFrame:
        """Those columns, the evidence columns, and the text's likelihoods and posterior (equal priors)."""
        rows = docs.select(*columns, F.when(declared.isin(names), declared).alias("_li_d"), suffix.alias("_li_s"),
                           host.alias("_li_h"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_li_t"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
        out = rows.mapInArrow(score, f"{schema}, _li_n long, _li_ll array<double>")
        out = out.withColumn("_li_w", _vector(lambda i: F.exp(F.col("_li_ll")[i]) * (NOISE_PRIOR if i == k - 1 else 1.0), k))
        return out.withColumn("_li_p", _normal("_li_w")).drop("_li_w")

    # All counts: one row per (host, suffix, declared) before they are summed up further.
    cube = scored([]).where("_li_n > 0").groupBy("_li_h", "_li_s", "_li_d").agg(
        *[F.sum(F.col("_li_p")[i]).alias(f"c{i}") for i in range(k)])
    cube = materialize(cube, "language-counts")
    again = [F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]
    everything = cube.agg(*again).first()
    mass = sum(float(c or 0.0) for c in everything) or 1.0
    base = [(float(c or 0.0) + 0.5) / (mass + 0.5 * k) for c in everything]

    def shrunk(name: str, parent) -> Column:
        n = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
        return _vector(lambda i: (F.col(f"c{i}") + PRIOR_ROWS * parent(i)) / (n + PRIOR_ROWS), k).alias(name)

    by_suffix = cube.where("_li_s IS NOT NULL").groupBy("_li_s").agg(*again).select(
        "_li_s", shrunk("_li_ps", lambda i: F.lit(base[i])))
    by_host = cube.where("_li_h IS NOT NULL OR _li_s IS NOT NULL").groupBy("_li_h", "_li_s").agg(*again).join(
        by_suffix, "_li_s", "left")
    # A host's prior shrinks to its suffix's; a row with a suffix alone has the suffix's.
    hosts = by_host.select(
        F.xxhash64("_li_h", "_li_s").alias("_li_k"),
        F.when(F.col("_li_h").isNull(), F.col("_li_ps")).otherwise(
            shrunk("x", lambda i: F.coalesce(F.col("_li_ps")[i], F.lit(base[i])))).alias("_li_ph"))
    hosts = materialize(hosts, "language-hosts")
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    # P(declared | language): expected rows of both over expected rows of the language, smoothed by P(declared).
    said: dict[str, list[float]] = {}
    for r in cube.where("_li_d IS NOT NULL").groupBy("_li_d").agg(*again).collect():  # a row per language
        c = [float(r[f"c{i}"]) for i in range(k)]
        said[r["_li_d"]] = [(c[i] + PRIOR_ROWS * sum(c) / mass) / (mass * base[i] + PRIOR_ROWS) for i in range(k)]

    out = scored(kept)
    # Rows without any address evidence do not gather at one key.
    key = F.when(F.col("_li_h").isNotNull() | F.col("_li_s").isNotNull(), F.xxhash64("_li_h", "_li_s")).otherwise(
        -1 - F.monotonically_increasing_id())
    out = out.withColumn("_li_k", key).join(hosts, "_li_k", "left")
    declares = lambda i: F.coalesce(*[F.when(F.col("_li_d") == d, F.lit(float(np.log(p[i])))) for d, p in said.items()],
                                    F.lit(0.0))
    out = out.withColumn("_li_l", _vector(
        lambda i: F.col("_li_ll")[i] + F.log(F.coalesce(F.col("_li_ph")[i], F.lit(base[i]))) + declares(i), k))
    out = out.withColumn("_li_e", F.transform("_li_l", lambda x: F.exp(x - F.array_max("_li_l"))))
    out = out.withColumn("_li_post", _normal("_li_e"))
    spoken = F.slice("_li_post", 1, k - 1)
    best = F.array_position(spoken, F.array_max(spoken)).cast("int")
    has = F.col("_li_n") > 0
    out = out.withColumn("_li_best", best)
    return out.select(
        *kept, F.when(has, F.element_at(F.array(*[F.lit(x) for x in names]), F.col("_li_best"))).alias("li_lang"),
        F.when(has, F.element_at("_li_post", F.col("_li_best"))).otherwise(0.0).alias("li_posterior"),
        F.when(has, F.element_at("_li_p", F.col("_li_best"))).otherwise(0.0).alias("li_text_posterior"),
        (has & (F.element_at("_li_post", F.col("_li_best")) >= least)).alias("li_kept"))
