"""Model selection over cross-validation scores (V1–V17) and promotion gates.

``cv_scores(candidate, rep, fold, score)`` is a long table; everything here is a grouped aggregate or
a join over it (one row per candidate × fold), so it stays small whatever the data size was.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import GATE_MAX_BRIER, GATE_MIN_AP, r6
from ..functions.stats import t_sf_two_sided, wilcoxon_zsplit
from .ranking import with_row


def cv_summary(cv: DataFrame, keys: Sequence[str] = ("candidate",)) -> DataFrame:
    """Mean, population std and number of folds per candidate; per-fold scores kept as a sorted list."""
    return cv.groupBy(*keys).agg(r6(F.avg("score")).alias("mean"), r6(F.stddev_pop("score")).alias("std"),
                                 F.count(F.lit(1)).alias("k"))


def compare_to_base(summary: DataFrame, base: str | int, key: str = "candidate") -> DataFrame:
    """Δ vs the base candidate, Δ in units of the base's std, and rank by mean (1 = best)."""
    b = summary.where(F.col(key) == F.lit(base)).select(F.col("mean").alias("_bm"), F.col("std").alias("_bs"))
    j = with_row(summary, b)
    w = Window.orderBy(F.col("mean").desc(), F.col(key))          # one row per candidate (tiny)
    return j.select(key, "mean", "std", r6(F.col("mean") - F.col("_bm")).alias("delta"),
                    r6((F.col("mean") - F.col("_bm")) / F.col("_bs")).alias("delta_in_base_std"),
                    F.row_number().over(w).cast("long").alias("rank"))


def one_se(summary: DataFrame, complexity: Sequence, key: str = "candidate", k_col: str = "k") -> DataFrame:
    """1-SE rule: among candidates with mean ≥ best − std_best/√K, the simplest by ``complexity``
    (sort expressions, simplest first). Returns the chosen row with the best mean and the cut."""
    best = summary.orderBy(F.col("mean").desc(), F.col(key)).limit(1).select(
        F.col("mean").alias("best_mean"), F.col(key).alias("best_candidate"),
        r6(F.col("mean") - F.col("std") / F.sqrt(F.col(k_col))).alias("cut"))
    j = with_row(summary, best).drop("_g")
    return j.where(F.col("mean") >= F.col("cut")).orderBy(*complexity).limit(1)


def envelopes(summary: DataFrame, k_folds: int = 15, n_splits: int = 5, key: str = "candidate") -> DataFrame:
    """How many candidates sit within best − std/√K, best − std/√5 and best − std (std of the best)."""
    best = summary.orderBy(F.col("mean").desc(), F.col(key)).limit(1).select(
        F.col("mean").alias("_m"), F.col("std").alias("_s"))
    j = with_row(summary, best)
    cuts = {"se": F.col("_m") - F.col("_s") / math.sqrt(k_folds),
            "conservative": F.col("_m") - F.col("_s") / math.sqrt(n_splits),
            "full_std": F.col("_m") - F.col("_s")}
    return j.agg(*[F.count_if(F.col("mean") >= c).alias(f"inside_{n}") for n, c in cuts.items()],
                 *[r6(F.max(c)).alias(f"cut_{n}") for n, c in cuts.items()])


def edge_warnings(chosen: DataFrame, grid: DataFrame) -> DataFrame:
    """Chosen value at the edge of the declared grid. A listed axis is at its edge at its exact ends, a continuous one
    strictly within 10 % of its range (of the logarithms on log axes); natural limits are exempt.
    ``grid``: (param, lo, hi, continuous, log_scale, natural_lo, natural_hi)."""
    long = chosen.unpivot([], [r for r in chosen.columns], "param", "value")
    j = long.join(grid, "param")
    span = F.when(F.col("log_scale"), F.log10("hi") - F.log10("lo")).otherwise(F.col("hi") - F.col("lo"))
    pos = F.when(F.col("log_scale"), F.log10("value") - F.log10("lo")).otherwise(F.col("value") - F.col("lo"))
    rel = pos / span
    low = F.when(F.col("continuous"), rel < 0.1).otherwise(F.col("value") == F.col("lo")) & ~F.col("natural_lo")
    high = F.when(F.col("continuous"), rel > 0.9).otherwise(F.col("value") == F.col("hi")) & ~F.col("natural_hi")
    return j.select("param", "value", "lo", "hi", (low | high).alias("at_edge"),
                    F.when(low, "low").when(high, "high").alias("side"))


def paired(cv: DataFrame, a, b, key: str = "candidate") -> DataFrame:
    """Paired comparison on identical folds: mean Δ, wins of a, t statistic, Wilcoxon signed-rank W
    (zero differences split, average ranks for ties)."""
    x = cv.where(F.col(key) == F.lit(a)).select("rep", "fold", F.col("score").alias("sa"))
    y = cv.where(F.col(key) == F.lit(b)).select("rep", "fold", F.col("score").alias("sb"))
    d = x.join(y, ["rep", "fold"]).select((F.col("sa") - F.col("sb")).alias("d"))
    d = d.withColumn("ad", F.abs("d"))
    w = Window.orderBy("ad")                                   # ≤ reps × folds rows
    d = d.withColumn("_r", F.rank().over(w)).withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy("ad")))
    d = d.withColumn("rank", F.col("_r") + (F.col("_c") - 1) / 2.0)
    agg = d.agg(F.count(F.lit(1)).alias("n"), r6(F.avg("d")).alias("mean_delta"),
                F.count_if(F.col("d") > 0).alias("wins"),
                r6(F.try_divide(F.avg("d"), F.stddev_samp("d") / F.sqrt(F.count(F.lit(1))))).alias("t_stat"),
                F.sum(F.when(F.col("d") > 0, F.col("rank")).when(F.col("d") == 0, F.col("rank") / 2)).alias("_rp"),
                F.sum(F.when(F.col("d") < 0, F.col("rank")).when(F.col("d") == 0, F.col("rank") / 2)).alias("_rm"))
    return agg.select("n", "mean_delta", "wins", "t_stat",
                      r6(F.least(F.coalesce("_rp", F.lit(0.0)), F.coalesce("_rm", F.lit(0.0)))).alias("wilcoxon_w"))


_PV = T.StructType([T.StructField("p_t", T.DoubleType()), T.StructField("p_wilcoxon", T.DoubleType())])


def paired_pvalues(cv: DataFrame, pairs: DataFrame, key: str = "candidate") -> DataFrame:
    """p-values of the paired t and Wilcoxon (zsplit, normal approximation) for each (a, b) pair:
    one small pandas group per pair (≤ reps × folds rows)."""
    x = cv.select(F.col(key).alias("a"), "rep", "fold", F.col("score").alias("sa"))
    y = cv.select(F.col(key).alias("b"), "rep", "fold", F.col("score").alias("sb"))
    d = pairs.join(x, "a").join(y, ["b", "rep", "fold"]).select("a", "b", (F.col("sa") - F.col("sb")).alias("d"))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        dd = pdf["d"].to_numpy(dtype=float)
        n = dd.size
        sd = dd.std(ddof=1) if n > 1 else float("nan")
        t = dd.mean() / (sd / math.sqrt(n)) if n > 1 and sd > 0 else float("nan")
        _, pw = wilcoxon_zsplit(dd)
        return pd.DataFrame({"a": [pdf["a"].iloc[0]], "b": [pdf["b"].iloc[0]],
                             "p_t": [t_sf_two_sided(t, n - 1) if not np.isnan(t) else float("nan")],
                             "p_wilcoxon": [pw]})
    return d.groupBy("a", "b").applyInPandas(fn, "a long, b long, p_t double, p_wilcoxon double")


def seed_vs_fold(cv: DataFrame, key: str = "candidate") -> DataFrame:
    """Variance of the mean across repetitions (seed effect) vs the average within-repetition fold std."""
    per = cv.groupBy(key, "rep").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s"))
    return per.groupBy(key).agg(r6(F.stddev_samp("m")).alias("seed_std"), r6(F.avg("s")).alias("fold_std"))


def gate(metrics: DataFrame, ap: str = "ap", brier: str = "brier", min_ap: float = GATE_MIN_AP,
         max_brier: float = GATE_MAX_BRIER) -> DataFrame:
    """Two-axis promotion gate (both must hold) with the reason for a failure."""
    ok_ap = F.col(ap) >= min_ap
    ok_b = F.col(brier) <= max_brier
    reason = (F.when(ok_ap & ok_b, "approved").when(~ok_ap & ~ok_b, "ap and brier")
               .when(~ok_ap, "ap below floor").otherwise("brier above ceiling"))
    return metrics.withColumn("approved", ok_ap & ok_b).withColumn("reason", reason)


def characterise(current: DataFrame, reference: DataFrame, keys: Sequence[str], tol: float = 1e-4) -> DataFrame:
    """|metric − reference| ≤ tol, two-sided, per (keys, metric); a missing side fails."""
    j = current.select(*keys, "metric", F.col("value").alias("v")).join(
        reference.select(*keys, "metric", F.col("value").alias("ref")), list(keys) + ["metric"], "full")
    return j.withColumn("ok", F.coalesce(F.abs(F.col("v") - F.col("ref")) <= tol, F.lit(False)))


def identity_check(a: DataFrame, b: DataFrame, key: str, score: str = "score", threshold: float = 0.5,
                   tol: float = 1e-9) -> DataFrame:
    """Two score tables for the same rows: max |Δ|, decisions swapped at the threshold, unmatched rows.
    Joined on the row key — never on the score value."""
    j = a.select(key, F.col(score).alias("s1")).join(b.select(key, F.col(score).alias("s2")), key, "full")
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_abs_diff"),
                 F.count_if((F.col("s1") >= threshold) != (F.col("s2") >= threshold)).alias("decisions_swapped"),
                 F.count_if(F.col("s1").isNull() | F.col("s2").isNull()).alias("unmatched")) \
            .withColumn("identical", (F.col("max_abs_diff") <= tol) & (F.col("decisions_swapped") == 0)
                        & (F.col("unmatched") == 0))


def random_search_configs(spark, n: int, axes: dict[str, tuple[float, float, bool]], seed: str = "42") -> DataFrame:
    """``n`` random configurations: per axis a hash uniform mapped to [lo, hi], log-uniform when asked."""
    from ..functions.columns import hash_uniform
    d = spark.range(n).withColumnRenamed("id", "draw")
    for name, (lo, hi, log) in axes.items():
        u = hash_uniform(F.col("draw"), f"{seed}:{name}")
        v = F.pow(F.lit(10.0), F.lit(math.log10(lo)) + u * (math.log10(hi) - math.log10(lo))) if log \
            else F.lit(lo) + u * (hi - lo)
        d = d.withColumn(name, v)
    return d
