"""Splits, folds and samples (S1–S10): deterministic, hash-ordered, stratified.

Rows are ordered inside each stratum by a portable 60-bit hash of (id, seed) with the id as tie-break;
ranks come from :func:`ranking.running_totals`, so a stratum holding most of the table is still ranked
by many tasks. Proportions are exact per stratum (not "about 20 %").
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_key, hash_uniform
from ..session import materialize
from .ranking import checked_broadcast, group_struct, running_totals

TEST_SHARE = 0.20
VAL_SHARE_OF_REST = 0.25     # 0.2 / 0.8 of what is left after the test cut
SEED = "42"


def _stratum_rank(df: DataFrame, label: str, id_col: str, seed: str) -> DataFrame:
    d = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_one", F.lit(1))
    r = running_totals(d, "_h", ["_one"], [label], tiebreak=[id_col])
    n = d.groupBy(group_struct([label]).alias("_gs")).agg(F.count(F.lit(1)).alias("_n"))     # one row per stratum
    return r.withColumn("_gs", group_struct([label])).join(checked_broadcast(n, "strata"), "_gs").drop("_one", "cum__one", "_h", "_gs")


def stratified_split(df: DataFrame, label: str = "y", id_col: str = "customer_id", seed: str = SEED,
                     test_share: float = TEST_SHARE, val_share_of_rest: float = VAL_SHARE_OF_REST) -> DataFrame:
    """Adds ``split`` ∈ {train, val, test}: per stratum n_test = ceil(test·n), n_val = ceil(v·(n − n_test))."""
    r = _stratum_rank(df, label, id_col, seed)
    n_test = F.ceil(F.round(F.col("_n") * test_share, 9))
    n_val = F.ceil(F.round((F.col("_n") - n_test) * val_share_of_rest, 9))
    split = (F.when(F.col("_rn") <= n_test, "test")
              .when(F.col("_rn") <= n_test + n_val, "val").otherwise("train"))
    return materialize(r.withColumn("split", split).drop("_rn", "_n"), "split")


def stratified_folds(df: DataFrame, k: int = 5, label: str = "y", id_col: str = "customer_id",
                     seed: str = SEED) -> DataFrame:
    """Adds ``fold`` = (rank in stratum − 1) mod k: fold sizes per stratum differ by at most one."""
    r = _stratum_rank(df, label, id_col, seed)
    return materialize(r.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn", "_n"), "folds")


def repeated_folds(df: DataFrame, k: int = 5, reps: int = 3, label: str = "y",
                   id_col: str = "customer_id", seed: str = SEED) -> DataFrame:
    """(rep, fold) per row for ``reps`` repetitions; the same assignment for every candidate.

    All repetitions are ranked in one pass (rows × reps, grouped by (label, rep)); repetition r uses
    the hash salt ``{seed}-{r}``.
    """
    d = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
    txt = F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}-"), F.col("rep").cast("string"))
    d = d.withColumn("_h", F.conv(F.substring(F.md5(txt), 1, 15), 16, 10).cast("long")).withColumn("_one", F.lit(1))
    r = running_totals(d, "_h", ["_one"], [label, "rep"], tiebreak=[id_col])
    out = r.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn", "_one", "cum__one", "_h")
    return materialize(out, "repeated-folds")


def holdout_flag(df: DataFrame, share: float, id_col: str = "customer_id", salt: str = "holdout") -> DataFrame:
    """Control group: a fixed hash slice of customers excluded from treatment."""
    return df.withColumn("control", hash_uniform(id_col, salt) < F.lit(share))


def sample_n(df: DataFrame, n: int, id_col: str = "customer_id", seed: str = SEED) -> DataFrame:
    """n rows without replacement: the n smallest hash keys (TakeOrderedAndProject, bounded heap)."""
    return df.withColumn("_h", hash_key(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")


def poisson_bootstrap_weights(df: DataFrame, replicates: int, id_col: str = "customer_id",
                              seed: str = SEED) -> DataFrame:
    """(row, replicate, weight) with weight ~ Poisson(1) by inverse CDF of a hash uniform (0 weights dropped).

    Resampling with replacement of a large table ≈ independent Poisson(1) multiplicities per row.
    """
    reps = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    u = hash_uniform(F.concat_ws("#", F.col(id_col).cast("string"), F.col("replicate").cast("string")), seed)
    # Poisson(1) distribution function until it is one in double precision
    cdf = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(18)]
    w = F.lit(len(cdf))
    for i in reversed(range(len(cdf))):
        w = F.when(u < F.lit(cdf[i]), F.lit(i)).otherwise(w)
    return reps.withColumn("weight", w).where(F.col("weight") > 0)


def holdout_split(df: DataFrame, share: float = 0.15, label: str = "y", id_col: str = "customer_id",
                  seed: str = SEED) -> DataFrame:
    """Inner stratified holdout: ``inner`` = first ceil(share·n) rows of each stratum in hash order."""
    r = _stratum_rank(df, label, id_col, seed)
    cut = F.ceil(F.round(F.col("_n") * share, 9))
    return materialize(r.withColumn("part", F.when(F.col("_rn") <= cut, "inner_holdout").otherwise("fit"))
                        .drop("_rn", "_n"), "holdout")
