"""Near-duplicate vectors by PCA-ordered tiled comparison, exact for a cosine threshold.

Equal vectors are collapsed to their smallest id first. The others are scaled to length one and turned into the basis
of their principal components (covariances are summed over all rows; a rotation changes no product), largest variance
first. Ordered by the first component they are cut into blocks of about ``BLOCK_ROWS``; two blocks meet in one task
unless the gap between them on that component alone is too wide for the threshold. Inside a task, tiles accumulate the
leading dimensions first; the product over the remaining ones is at most the product of the suffix norms, so a pair
stops where leading product + suffix norms cannot reach the threshold. The few pairs that are left are computed in
full from the original vectors in double precision. A task gives out link counts per vector and the links of a
spanning forest, never all pairs.

Nulls and edge cases: a vector that is null, empty, all zero, or holds a null or non-finite component links with
nothing; vectors of different lengths never link (each length is compared for itself); a null id is dropped from
links but kept as a row; repeated rows are other vectors that equal it; an empty table gives an empty result; other
columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, local_forest

THRESHOLD = 0.95
BLOCK_ROWS = 8192
TILE_ROWS = 1024
LEAD_DIMS = 16
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(col) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in col])


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second moments of the unit vectors of a partition, a row of the matrix at a time, for each vector length."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for d, g in b.groupby("dim"):
            u = _unit(_matrix(g["v"]))
            sums[d] = sums.get(d, 0) + u.T @ u
    for d, s in sums.items():
        yield pd.DataFrame({"dim": d, "i": np.repeat(np.arange(d), d), "j": np.tile(np.arange(d), d), "s": s.ravel()})


def _compare(threshold: float, tile: int, lead: int):
    def links(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> Iterator[tuple[np.ndarray, ...]]:
        """Row numbers of linked pairs, tile by tile."""
        a, b = _matrix(left["u"]), _matrix(right["u"])
        lead_ = min(lead, a.shape[1])
        va, vb = _unit(_matrix(left["v"])), _unit(_matrix(right["v"]))
        rest_a = np.sqrt((a[:, lead_:] ** 2).sum(axis=1))
        rest_b = np.sqrt((b[:, lead_:] ** 2).sum(axis=1))
        reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
        for i in range(0, len(a), tile):
            p = slice(i, i + tile)
            for j in range(i if same else 0, len(b), tile):
                q = slice(j, j + tile)
                # Both sides are in the order of the first component: tiles too far apart on it cannot link.
                if a[p, 0].min() - b[q, 0].max() > reach or b[q, 0].min() - a[p, 0].max() > reach:
                    continue
                bound = a[p, :lead_] @ b[q, :lead_].T
                bound += rest_a[p, None] * rest_b[None, q]
                x, y = np.nonzero(bound >= threshold - SLACK)
                x, y = x + i, y + j
                if same:
                    x, y = x[x < y], y[x < y]
                if len(x):
                    hit = np.concatenate([np.einsum("ij,ij->i", va[x[k:k + 65536]], vb[y[k:k + 65536]]) >= threshold
                                          for k in range(0, len(x), 65536)])
                    yield x[hit], y[hit]

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        k, m = int(pdf["k"].iloc[0]), int(pdf["m"].iloc[0])
        pdf = pdf.sort_values(["block", "p0", "rep"], kind="stable")
        left = pdf[pdf["block"] == k]
        right = left if k == m else pdf[pdf["block"] == m]
        out = []
        if len(left) and len(right):
            ra, rb = left["rep"].to_numpy(), right["rep"].to_numpy()
            ca, cb = left["copies"].to_numpy(), right["copies"].to_numpy()
            na, nb = np.zeros(len(ra), np.int64), np.zeros(len(rb), np.int64)
            ends_a, ends_b = [], []
            for x, y in links(left, right, k == m):
                na += np.bincount(x, weights=cb[y], minlength=len(ra)).astype(np.int64)
                nb += np.bincount(y, weights=ca[x], minlength=len(rb)).astype(np.int64)
                f, g = local_forest(ra[x], rb[y])
                ends_a.append(f)
                ends_b.append(g)
            for r, n in ((ra, na), (rb, nb)):
                out.append(pd.DataFrame({"a": r[n > 0], "b": -1, "n": n[n > 0]}))
            if ends_a:
                f, g = local_forest(np.concatenate(ends_a), np.concatenate(ends_b))
                out.append(pd.DataFrame({"a": f, "b": g, "n": 0}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
    return task


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    block_rows: int = BLOCK_ROWS, tile_rows: int = TILE_ROWS, lead_dims: int = LEAD_DIMS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    good = F.size(v) > 0
    bad_part = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"),
                          (v.isNotNull() & good & ~bad_part & F.exists(v, lambda x: x != 0)).alias("ok"))
    # -0.0 and 0.0 are one component, as in any comparison of numbers.
    rows = rows.withColumn("v", F.when(F.coalesce("ok", F.lit(False)) & F.col("vec_id").isNotNull(),
                                       F.transform("v", lambda x: x + F.lit(0.0))))
    rows = rows.select("vec_id", "v", F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256).alias("key"))
    rows = materialize(rows, "vectors")
    reps = (rows.where("v IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
                                                           F.first("v").alias("v")).withColumn("dim", F.size("v")))
    reps = materialize(reps, "vector-reps")
    sums = reps.select("dim", "v").mapInPandas(_moments, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(
        F.sum("s").alias("s"))
    bases: dict[int, np.ndarray] = {}
    for r in sums.collect():  # dim * dim rows per vector length
        bases.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"], r["j"]] = r["s"]
    bases = {d: np.linalg.eigh((s + s.T) / 2)[1][:, ::-1] for d, s in bases.items()}

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, g in b.groupby("dim"):
                u = _unit(_matrix(g["v"])) @ bases[d]
                yield g.assign(u=list(u), p0=u[:, 0])

    turned = materialize(reps.select("rep", "copies", "dim", "v").mapInPandas(
        rotate, "rep long, copies long, dim int, v array<double>, u array<double>, p0 double"), "vector-turned")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    parts = []
    for r in turned.groupBy("dim").count().collect():  # one row per vector length
        some = turned.where(F.col("dim") == r["dim"])
        n = -(-r["count"] // block_rows)
        edges = some.approxQuantile("p0", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
        lows = [-2.0, *edges]
        highs = [*edges, 2.0]
        block = F.lit(0)
        for e in edges:
            block = block + (F.col("p0") >= e).cast("int")
        meets = [sorted(m for m in range(n) if lows[max(k, m)] - highs[min(k, m)] <= reach) for k in range(n)]
        pairs = F.array(*[F.array(*[F.struct(F.lit(min(k, m)).alias("k"), F.lit(max(k, m)).alias("m")) for m in ms])
                          for k, ms in enumerate(meets)])
        parts.append(some.withColumn("block", block).withColumn("km", F.explode(F.element_at(pairs, F.col("block") + 1)))
                     .select("rep", "copies", "dim", "v", "u", "p0", "block", "km.k", "km.m")
                     .groupBy("dim", "k", "m").applyInPandas(_compare(threshold, tile_rows, lead_dims), "a long, b long, n long"))
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = materialize(found, "vector-links")
    linked = found.where("b < 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    comp = components(found.where("b >= 0"), "a", "b", "vectors")
    per_key = (reps.select("key", "rep", "copies").join(linked, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
               .select("key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    # Rows without a vector have no key; each gets a key of its own, so that they do not gather.
    keyed = rows.select("vec_id", F.coalesce("key", F.concat(F.lit("#"), F.xxhash64("vec_id").cast("string"))).alias("key"))
    return keyed.join(per_key, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
