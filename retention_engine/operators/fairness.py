"""Group fairness audit at the operating threshold (Q1–Q7).

Sensitive attributes are unpivoted to (attr, group) so one grouped aggregation covers all of them;
map-side partial aggregation keeps a dominant group cheap. Confidence intervals run in an Arrow
pandas UDF over the aggregated rows only (one row per group).
"""
from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FAIRNESS_MAX_DISPARITY, FAIRNESS_MIN_POSITIVES, r6, safe_div
from ..functions.stats import clopper_pearson
from .metrics import cost_curve, cost_optimum


def _long(df: DataFrame, attrs: Sequence[str], keep: Sequence[str]) -> DataFrame:
    cols = [F.col(a).cast("string").alias(a) for a in attrs]
    return df.select(*keep, *cols).unpivot(list(keep), list(attrs), "attr", "group")


def group_rates(df: DataFrame, attrs: Sequence[str], threshold=0.5, score: str = "score", label: str = "y",
                threshold_col: str | None = None) -> DataFrame:
    """(attr, group): n, positives, recall (null without positives), FNR, selection rate, prevalence,
    reliable (positives ≥ 30). ``threshold_col`` takes a per-row threshold (group-specific cut)."""
    keep = [score, label] + ([threshold_col] if threshold_col else [])
    long = _long(df, attrs, keep)
    t = F.col(threshold_col) if threshold_col else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label)
    a = long.groupBy("attr", "group").agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).cast("long").alias("positives"),
        F.count_if(pred & (y == 1)).alias("tp"), F.avg(pred.cast("double")).alias("_sel"),
        F.avg(y.cast("double")).alias("_prev"))
    rec = safe_div(F.col("tp"), F.col("positives"))
    return a.select("attr", "group", "n", "positives", "tp", r6(rec).alias("recall"), r6(1 - rec).alias("fnr"),
                    r6("_sel").alias("selection_rate"), r6("_prev").alias("prevalence"),
                    (F.col("positives") >= FAIRNESS_MIN_POSITIVES).alias("reliable"))


def disparity(rates: DataFrame, limit: float = FAIRNESS_MAX_DISPARITY) -> DataFrame:
    """Per attribute: max − min recall over groups with a defined recall, within-limit flag, worst group
    (lowest recall; ties by name)."""
    d = rates.where(F.col("recall").isNotNull())
    out = d.groupBy("attr").agg(
        r6(F.max("recall") - F.min("recall")).alias("disparity"),
        F.min_by("group", F.struct("recall", "group")).alias("worst_group"),
        F.min("recall").alias("worst_recall"))
    return out.withColumn("within_limit", F.col("disparity") <= F.lit(limit))


@F.pandas_udf(T.StructType([T.StructField("ci_low", T.DoubleType()), T.StructField("ci_high", T.DoubleType())]))
def _cp_udf(k: pd.Series, n: pd.Series) -> pd.DataFrame:
    lo, hi = zip(*[clopper_pearson(int(a), int(b)) for a, b in zip(k, n)]) if len(k) else ((), ())
    return pd.DataFrame({"ci_low": list(lo), "ci_high": list(hi)})


def recall_ci(rates: DataFrame) -> DataFrame:
    """Clopper-Pearson 95 % interval of each group's recall (k = tp, n = positives)."""
    return rates.withColumn("_ci", _cp_udf(F.col("tp"), F.col("positives"))).select(
        "*", r6(F.nanvl("_ci.ci_low", F.lit(None))).alias("ci_low"),
        r6(F.nanvl("_ci.ci_high", F.lit(None))).alias("ci_high")).drop("_ci")


def group_thresholds(df: DataFrame, attr: str, score: str = "score", label: str = "y") -> DataFrame:
    """Cheapest threshold per group of one attribute (mitigation priced in cost)."""
    curve = cost_curve(df, score, label, by=[attr])
    return cost_optimum(curve, by=[attr])
