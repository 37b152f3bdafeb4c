"""Bootstrap confidence interval of average precision.

Resampling rows with replacement is replaced by its large-sample equivalent on the score histogram:
a cell holding ``c`` rows receives a Poisson(c) multiplicity per replicate. Draws come from a
deterministic hash-seeded generator inside an Arrow pandas UDF, the (replicate × cell) rows are
spread over tasks, and AP per replicate is an ordinary grouped histogram computation.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import r6
from .metrics import score_histogram
from .quantiles import exact_quantiles


def poisson_inverse(u: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """Poisson(λ) draws by inversion of uniforms, the same rule for every λ: the distribution function is summed over
    all counts within 12 standard deviations (what lies beyond is below the resolution of a double)."""
    out = np.zeros(len(u), np.int64)
    values, of = np.unique(lam, return_inverse=True)
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(len(values) + 1))
    for i, x in enumerate(values.tolist()):
        if x <= 0:
            continue
        rows = order[ends[i]:ends[i + 1]]
        wide = 12 * math.sqrt(x) + 40
        lo = max(0, math.floor(x - wide))
        k = np.arange(lo, math.ceil(x + wide) + 1)
        steps = np.concatenate([[lo * math.log(x) - x - math.lgamma(lo + 1)], math.log(x) - np.log(np.maximum(k[1:], 1))])
        cdf = np.cumsum(np.exp(np.cumsum(steps)))
        out[rows] = lo + np.minimum(np.searchsorted(cdf, u[rows]), len(k) - 1)
    return out


@F.pandas_udf(T.LongType())
def _poisson(u: pd.Series, lam: pd.Series) -> pd.Series:
    return pd.Series(poisson_inverse(u.to_numpy(dtype=float), lam.to_numpy(dtype=float)))


def bootstrap_ap(df: DataFrame, score: str = "score", label: str = "y", replicates: int = 2000,
                 alpha: float = 0.05, seed: int = 42) -> DataFrame:
    h = score_histogram(df, score, label).select("score", "pos", "neg")
    cells = h.select("score", F.posexplode(F.array("neg", "pos")).alias("y", "c")).where(F.col("c") > 0)
    reps = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    reps = reps.repartition("replicate")
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("replicate"), F.col("score"), F.col("y")), F.lit(1 << 53))
         .cast("double") + 0.5) / float(1 << 53)
    reps = reps.withColumn("w", _poisson(u, F.col("c"))).where(F.col("w") > 0)
    g = reps.groupBy("replicate", "score").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("pos"))
    w = Window.partitionBy("replicate").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("cn", F.sum("n").over(w)).withColumn("cp", F.sum("pos").over(w))
    ap = g.groupBy("replicate").agg((F.sum(F.col("pos") * F.col("cp") / F.col("cn")) / F.sum("pos")).alias("ap"),
                                    F.sum("pos").alias("p"), F.sum("n").alias("n"))
    ap = ap.where((F.col("p") > 0) & (F.col("p") < F.col("n")))        # single-class replicates skipped
    q = exact_quantiles(ap, "ap", [alpha / 2, 1 - alpha / 2])
    return q.agg(r6(F.max(F.when(F.col("prob") == alpha / 2, F.col("quantile")))).alias("ci_low"),
                 r6(F.max(F.when(F.col("prob") == 1 - alpha / 2, F.col("quantile")))).alias("ci_high"))
