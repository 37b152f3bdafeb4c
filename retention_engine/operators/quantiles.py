"""Exact, linearly interpolated quantiles (numpy ``linear`` / SQL ``quantile_cont``) that scale.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation buffer, so one
large feature becomes one huge task. Here values are first reduced to a histogram (value, count) with
map-side partial aggregation, ranked with :func:`ranking.running_totals` (chunked, no single-partition
window), and each requested quantile reads the one or two histogram rows whose rank range covers its
interpolation points. The only thing joined to the data is the (group × probs) target list, broadcast after its rows
were counted, so a feature that holds most rows does not meet in one task. Null groups are groups like any other.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import _drop_g, _group_keys, checked_broadcast, group_struct, running_totals


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, prob): ``quantile`` = x[lo] + (h − lo)·(x[lo+1] − x[lo]), h = (n−1)·prob.

    Null values are ignored; groups without values yield no rows.
    """
    d, gk = _group_keys(df.where(F.col(value).isNotNull()), by)
    hist = materialize(d.groupBy(*gk, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "histogram")
    ranked = running_totals(hist, "_v", ["_c"], gk).withColumn("_gs", group_struct(gk))
    # per target: interpolation point h, and the two ranks needed (1-based, capped at n)
    target = lambda p: F.struct(F.lit(float(p)).alias("prob"), ((F.col("_n") - 1) * F.lit(float(p))).alias("h"))
    want = hist.groupBy(*gk).agg(F.sum("_c").alias("_n")).select(
        group_struct(gk).alias("_gs"), F.transform(F.array(*[target(p) for p in probs]), lambda t: F.struct(
            t["prob"].alias("prob"), (t["h"] - F.floor(t["h"])).alias("frac"), (F.floor(t["h"]) + 1).alias("lo"),
            F.least(F.floor(t["h"]) + 2, F.col("_n")).alias("hi"))).alias("_want"))
    start = F.col("cum__c") - F.col("_c") + 1
    covers = lambda rank: (rank >= start) & (rank <= F.col("cum__c"))
    hit = (ranked.join(checked_broadcast(want, "quantile-targets"), "_gs")
                 .select(*gk, "_v", start.alias("_start"), "cum__c",
                         F.explode(F.filter("_want", lambda w: covers(w["lo"]) | covers(w["hi"]))).alias("w"))
                 .withColumn("_at", (F.col("w.lo") >= F.col("_start")) & (F.col("w.lo") <= F.col("cum__c")))
                 .withColumn("_bt", (F.col("w.hi") >= F.col("_start")) & (F.col("w.hi") <= F.col("cum__c"))))
    out = hit.groupBy(*gk, F.col("w.prob").alias("prob")).agg(
        F.max(F.when(F.col("_at"), F.col("_v"))).alias("_a"), F.max(F.when(F.col("_bt"), F.col("_v"))).alias("_b"),
        F.max("w.frac").alias("_t"))
    q = F.when(F.col("_t") >= 0.5, F.col("_b") - (F.col("_b") - F.col("_a")) * (1 - F.col("_t"))) \
         .otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t"))
    return _drop_g(out.select(*gk, "prob", q.alias("quantile")), by)
