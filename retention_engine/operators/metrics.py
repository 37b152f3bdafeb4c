"""Ranking, calibration and cost metrics (M1–M21), all as grouped aggregations.

Every function takes ``by`` so one job measures many models × folds × segments. Ranking metrics run
over a cumulative *score histogram* (one row per distinct raw score per group) so ties are grouped exactly like the
definitions require. It may be as long as the data, so it is cumulated in chunks (:func:`ranking.running_totals`); one
histogram, written once, feeds AP, ROC-AUC, recall@k and gain.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import COST_FN, COST_FP, OPERATIONAL_KS, r6, safe_div
from ..session import materialize
from .ranking import _drop_g, _group_keys, checked_broadcast, group_struct, running_totals, with_row

THRESHOLDS = [round(i / 100, 2) for i in range(1, 100)]   # 0.01 .. 0.99


def score_histogram(df: DataFrame, score: str = "score", label: str = "y",
                    by: Sequence[str] = ()) -> DataFrame:
    """(by…, score, n, pos, neg) per distinct raw score: partial aggregation happens before the shuffle."""
    return (df.groupBy(*by, F.col(score).cast("double").alias("score"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
              .withColumn("neg", F.col("n") - F.col("pos")))


def cumulative_histogram(df: DataFrame, score: str, label: str, gk: Sequence[str]) -> DataFrame:
    """The histogram with ``cum_n`` and ``cum_pos`` by falling score, written once for all metrics that read it."""
    h = running_totals(score_histogram(df, score, label, gk), "score", ["n", "pos"], gk, descending=True)
    return materialize(h.drop("_rn"), "cumulative-histogram")


def _ap_auc(h: DataFrame, gk: Sequence[str]) -> DataFrame:
    """AP = Σ pos · precision / P. ROC-AUC from Σ pos · (negatives below + half of those tied): with all negatives N,
    those below a score are N − cum_neg."""
    cum_neg = F.col("cum_n") - F.col("cum_pos")
    p, n = F.sum("pos"), F.sum("neg")
    below = p * n - F.sum(F.col("pos") * cum_neg) + 0.5 * F.sum(F.col("pos") * F.col("neg"))
    return h.groupBy(*gk).agg(r6(safe_div(F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")), p)).alias("ap"),
                              r6(safe_div(below, p * n)).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "y",
                      by: Sequence[str] = ()) -> DataFrame:
    """AP = Σ (R_n − R_{n−1}) P_n over distinct scores, descending (ties grouped). Null without positives."""
    d, gk = _group_keys(df, by)
    return _drop_g(_ap_auc(cumulative_histogram(d, score, label, gk), gk).drop("roc_auc"), by)


#: Scores that one task of :func:`many_average_precisions` orders.
CURVE_ROWS = 1_000_000
_CURVE = "grp long, chunk int, n long, pos long, at_pos array<int>, at_cum array<int>, at_n array<int>"


def _curves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of one chunk: rows, positives, and for its scores with positives (falling, ties as one) the positives
    there, and positives and rows down to there."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    g, p, y, chunk = (table[c].to_numpy() for c in ("grp", "p", "y", "chunk"))
    order = np.lexsort((-p, g))
    g, p, y = g[order], p[order], y[order].astype(np.int64)
    new_group = np.r_[True, g[1:] != g[:-1]]
    last = np.flatnonzero(np.r_[new_group[1:] | (p[1:] != p[:-1]), True])             # last row of each distinct score
    first = np.flatnonzero(new_group)
    cum = np.cumsum(y)
    before = (cum - y)[first]                                                          # positives above each group
    which = np.searchsorted(first, last, "right") - 1
    at_pos = np.diff(cum[last], prepend=0)
    at_cum, at_n = cum[last] - before[which], last + 1 - first[which]
    some = at_pos > 0
    ends = np.r_[first[1:], len(g)]
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(which[some], minlength=len(first)))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[some].astype(np.int32))) for x in (at_pos, at_cum, at_n)]
    yield pa.RecordBatch.from_arrays([pa.array(g[first]), pa.array(chunk[:len(first)]), pa.array(ends - first), pa.array(cum[ends - 1] - before), *lists],
                                     ["grp", "chunk", "n", "pos", "at_pos", "at_cum", "at_n"])


def _curve_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Σ pos · precision of each (group, chunk), given the rows and positives of the chunks above it."""
    for b in batches:
        at_pos, at_cum, at_n = (b.column(c) for c in ("at_pos", "at_cum", "at_n"))
        sizes = at_pos.value_lengths().to_numpy(zero_copy_only=False)
        pos, cum, n = (x.flatten().to_numpy().astype(np.float64) for x in (at_pos, at_cum, at_n))
        each = pos * (cum + np.repeat(b.column("pos_above").to_numpy(), sizes)) / (n + np.repeat(b.column("n_above").to_numpy(), sizes))
        row = np.repeat(np.arange(len(sizes)), sizes)
        yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("pos"), pa.array(np.bincount(row, each, len(sizes)))], ["grp", "pos", "s"])


def many_average_precisions(df: DataFrame, rows: int, group: str, score: str = "score", label: str = "y") -> DataFrame:
    """(group, ap) as :func:`average_precision` gives it, for many models' scores at once: ``group`` is a long, ``rows``
    about how many rows ``df`` has. The scores are shuffled once, by ranges of (group, falling score) of about
    ``CURVE_ROWS`` rows, however large a group is; equal scores meet in one chunk. A chunk becomes a curve over its scores,
    which the exact totals of the chunks above it complete."""
    d = df.select(F.col(group).cast("long").alias("grp"), F.col(score).cast("double").alias("p"),
                  F.coalesce(F.col(label).cast("int"), F.lit(0)).cast("byte").alias("y"))
    chunks = max(8, -(-rows // CURVE_ROWS))
    d = d.repartitionByRange(chunks, F.col("grp"), (-F.col("p")).asc()).withColumn("chunk", F.spark_partition_id())
    curves = materialize(d.mapInArrow(_curves, _CURVE), "curves")
    w = Window.partitionBy("grp").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    above = curves.select("grp", "chunk", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n_above"),
                          F.coalesce(F.sum("pos").over(w), F.lit(0)).alias("pos_above"))
    sums = curves.join(checked_broadcast(above, "above"), ["grp", "chunk"]).mapInArrow(_curve_sums, "grp long, pos long, s double")
    total = F.sum("pos")
    return sums.groupBy("grp").agg(r6(safe_div(F.sum("s"), total)).alias("ap")).withColumnRenamed("grp", group)


def roc_auc(df: DataFrame, score: str = "score", label: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Probability a positive outranks a negative, ties counted half. Null with one class."""
    d, gk = _group_keys(df, by)
    return _drop_g(_ap_auc(cumulative_histogram(d, score, label, gk), gk).drop("ap"), by)


def point_metrics(df: DataFrame, score: str = "score", label: str = "y", threshold: float = 0.5,
                  by: Sequence[str] = (), cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """One scan: Brier, confusion counts at ``score >= threshold``, precision/recall/F1 (zero division → 0),
    error cost and prevalence."""
    y = F.col(label)
    p = F.col(score).cast("double")
    pred = p >= F.lit(threshold)
    a = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow(p - y, 2)).alias("_brier"),
        F.count_if(pred & (y == 1)).alias("tp"),
        F.count_if(pred & (y == 0)).alias("fp"),
        F.count_if(~pred & (y == 1)).alias("fn"),
        F.count_if(~pred & (y == 0)).alias("tn"),
        F.avg(y.cast("double")).alias("_prev"))
    prec = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return a.select(*by, "n", r6("_brier").alias("brier"), "tp", "fp", "fn", "tn",
                    r6(prec).alias("precision"), r6(rec).alias("recall"), r6(f1).alias("f1"),
                    r6(F.col("fn") * cost_fn + F.col("fp") * cost_fp).alias("error_cost"),
                    r6("_prev").alias("prevalence"))


def top_n_hits(df: DataFrame, h: DataFrame, gk: list[str], cuts: Column, score: str = "score", label: str = "y",
               id_col: str = "customer_id") -> DataFrame:
    """(group, _n, _p, point, cut, hits): positives among the first ``cut`` rows by (score desc, id asc).

    ``cuts`` gives an array of (point, cut) from the group's ``_n`` rows. The cumulative histogram ``h`` tells for each
    of its rows which cuts fall inside; rows strictly above are counted from it, and only the rows tied at the score
    where a cut falls are ranked (by id, in chunks). The groups' totals and the tied scores are broadcast after their
    rows were counted: a tied score that holds a third of the table does not meet in one task.
    """
    tot = h.groupBy(*gk).agg(F.sum("n").alias("_n"), F.sum("pos").alias("_p")).withColumn("_cuts", cuts)
    tot = checked_broadcast(tot.withColumn("_gs", group_struct(gk)).drop(*gk), "group-totals")
    first = F.col("cum_n") - F.col("n")
    b = (h.withColumn("_gs", group_struct(gk)).join(tot, "_gs")
          .withColumn("_c", F.explode(F.filter("_cuts", lambda c: (c["cut"] > first) & (c["cut"] <= F.col("cum_n")))))
          .select(*gk, "_gs", "_n", "_p", "_c.point", "_c.cut", "score", "n", "pos", (F.col("_c.cut") - first).alias("m"),
                  (F.col("cum_pos") - F.col("pos")).alias("before")))
    b = materialize(b, "cut-scores")
    whole = b.where(F.col("m") == F.col("n")).select(*gk, "_n", "_p", "point", "cut", (F.col("before") + F.col("pos")).alias("hits"))
    part = b.where(F.col("m") < F.col("n"))
    rows = df.select(*gk, id_col, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("_y"),
                     group_struct(gk).alias("_gs"))
    # each tied block is ranked once, however many cut points fall inside it
    tied = rows.join(checked_broadcast(part.select("_gs", "score").distinct(), "tied-scores"), ["_gs", "score"])
    r = running_totals(tied, id_col, ["_y"], ["_gs", "score"]).select("_gs", "score", F.col("_rn").alias("m"), "cum__y")
    cut_hits = part.join(r, ["_gs", "score", "m"]).select(
        *gk, "_n", "_p", "point", "cut", (F.col("before") + F.col("cum__y")).alias("hits"))
    return whole.unionByName(cut_hits)


def _cuts(points: Sequence[float], share) -> Column:
    """Array of (point, cut = ceil(share of the group's rows))."""
    return F.array(*[F.struct(F.lit(float(p)).alias("point"), F.ceil(F.round(share(p), 9)).cast("long").alias("cut")) for p in points])


def _recall(df: DataFrame, h: DataFrame, gk: list[str], score: str, label: str, id_col: str, ks: Sequence[float]) -> DataFrame:
    hits = top_n_hits(df, h, gk, _cuts(ks, lambda k: F.lit(float(k)) * F.col("_n")), score, label, id_col)
    out = hits.select(*gk, F.col("point").alias("k"), "_n", "_p", r6(safe_div(F.col("hits"), F.col("_p"))).alias("recall_at_k"))
    prev = F.col("_p") / F.col("_n")
    return out.select(
        *gk, "k", "recall_at_k",
        r6(F.col("recall_at_k") / F.col("k")).alias("lift_at_k"),
        r6(safe_div(F.col("recall_at_k"), F.least(safe_div(F.col("k"), prev), F.lit(1.0)))).alias("pct_ceiling"))


def recall_at_k(df: DataFrame, score: str = "score", label: str = "y", id_col: str = "customer_id",
                ks: Sequence[float] = OPERATIONAL_KS, by: Sequence[str] = ()) -> DataFrame:
    """Share of positives in the top ``ceil(k·N)`` rows (ties broken by id), lift = recall/k and the
    share of the structural ceiling ``min(k/prevalence, 1)``. One row per (group, k)."""
    d, gk = _group_keys(df, by)
    return _drop_g(_recall(d, cumulative_histogram(d, score, label, gk), gk, score, label, id_col, ks), by)


def cost_curve(df: DataFrame, score: str = "score", label: str = "y", by: Sequence[str] = (),
               cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """Cost ``FN·cfn + FP·cfp`` at the 99 thresholds 0.01..0.99 from ONE pass over the rows: each row
    falls in bucket b = #thresholds <= score; FN/FP per threshold are running sums over ≤100 buckets."""
    th = F.array(*[F.lit(t) for t in THRESHOLDS])
    d, gk = _group_keys(df, by)
    b = F.size(F.filter(th, lambda t: t <= F.col(score).cast("double")))
    hist = d.groupBy(*gk, b.alias("b")).agg(F.sum(F.col(label).cast("long")).alias("pos"),
                                            F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    skel = hist.select(*gk).distinct().select(*gk, F.explode(F.sequence(F.lit(0), F.lit(99))).alias("b"))
    full = skel.join(hist, gk + ["b"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*gk).orderBy("b")
    fn = F.coalesce(F.sum("pos").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fp = F.sum("neg").over(w.rowsBetween(0, Window.unboundedFollowing))
    out = (full.select(*gk, "b", fn.alias("fn"), fp.alias("fp"))
               .where(F.col("b") >= 1)
               .select(*gk, F.round(F.col("b") / 100.0, 2).alias("threshold"),
                       F.col("fn").cast("long").alias("fn"), F.col("fp").cast("long").alias("fp"),
                       r6(F.col("fn") * cost_fn + F.col("fp") * cost_fp).alias("cost")))
    return _drop_g(out, by)


def cost_optimum(curve: DataFrame, by: Sequence[str] = (), inherited: float | None = None) -> DataFrame:
    """Cheapest threshold (lowest on ties), its cost, cost at 0.5 and, optionally, at an inherited threshold."""
    aggs = [F.min_by("threshold", F.struct("cost", "threshold")).alias("best_threshold"),
            F.min("cost").alias("best_cost"),
            F.max(F.when(F.col("threshold") == 0.5, F.col("cost"))).alias("cost_at_05")]
    if inherited is not None:
        aggs.append(F.max(F.when(F.col("threshold") == F.lit(inherited), F.col("cost"))).alias("cost_inherited"))
    d, gk = _group_keys(curve, by)
    out = d.groupBy(*gk).agg(*aggs)
    if inherited is not None:
        out = out.withColumn("regret", r6(F.col("cost_inherited") - F.col("best_cost")))
    return _drop_g(out, by)


def trivial_costs(df: DataFrame, label: str = "y", by: Sequence[str] = (),
                  cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """Do nothing = P·cfn (every churner missed); contact all = N_neg·cfp (every non-churner contacted)."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        r6(F.sum(y) * cost_fn).alias("cost_do_nothing"),
        r6(F.sum(1 - y) * cost_fp).alias("cost_contact_all"))


def gain_curve(df: DataFrame, score: str = "score", label: str = "y", id_col: str = "customer_id",
               by: Sequence[str] = (), points: int = 100) -> DataFrame:
    """Cumulative gain at ``points`` contact fractions: captured share, ceiling min(f/prev,1), chance f."""
    d, gk = _group_keys(df, by)
    h = cumulative_histogram(d, score, label, gk)
    hits = top_n_hits(d, h, gk, _cuts(range(1, points + 1), lambda i: F.lit(i) * F.col("_n") / points), score, label, id_col)
    share = F.col("point") / points
    out = hits.select(
        *gk, r6(share).alias("fraction"), F.col("cut").alias("contacted"),
        r6(safe_div(F.col("hits"), F.col("_p"))).alias("captured"),
        r6(F.least(safe_div(share, F.col("_p") / F.col("_n")), F.lit(1.0))).alias("ceiling"),
        r6(share).alias("chance"))
    return _drop_g(out, by)


def probability_histogram(df: DataFrame, score: str = "score", label: str = "y", bins: int = 40,
                          by: Sequence[str] = ()) -> DataFrame:
    """Counts per (class, equal-width bin on [0,1]); the last bin is closed."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, F.col(label).alias("y"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def score_summary(df: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    s = F.col(score)
    return df.groupBy(*by).agg(r6(F.min(s)).alias("p_min"), r6(F.max(s)).alias("p_max"),
                               r6(F.stddev_pop(s)).alias("p_std"))


def score_bands(df: DataFrame, score: str = "score", label: str = "y", width: float = 0.1,
                by: Sequence[str] = ()) -> DataFrame:
    """Counts by score band × label (conditional aggregation rather than a pivot: fixed schema)."""
    band = F.least(F.floor(F.col(score) / width), F.lit(int(round(1 / width)) - 1)).cast("int")
    y = F.col(label)
    return df.groupBy(*by, band.alias("band")).agg(F.count_if(y == 0).alias("n_y0"),
                                                    F.count_if(y == 1).alias("n_y1"))


def evaluate(df: DataFrame, score: str = "score", label: str = "y", id_col: str = "customer_id",
             threshold: float = 0.5, by: Sequence[str] = (), ks: Sequence[float] = OPERATIONAL_KS) -> DataFrame:
    """Metric bundle per group: AP, ROC-AUC, point metrics, recall/lift/ceiling share at each k."""
    d, gk = _group_keys(df, by)
    h = cumulative_histogram(d, score, label, gk)
    rk = _recall(d, h, gk, score, label, id_col, ks)
    wide = rk.groupBy(*gk).agg(*[
        F.max(F.when(F.col("k") == float(k), F.col(c))).alias(f"{c.replace('_k', '')}_{int(round(k * 100))}")
        for k in ks for c in ("recall_at_k", "lift_at_k", "pct_ceiling")])
    out = point_metrics(d, score, label, threshold, gk)
    for more in (_ap_auc(h, gk), wide):
        if by:
            out = out.withColumn("_gs", group_struct(gk)).join(more.withColumn("_gs", group_struct(gk)).drop(*gk), "_gs", "left").drop("_gs")
        else:      # one row each: attach as literals (no join of constant keys)
            out = with_row(out, more)
    return _drop_g(out, by)


def metric_gap(bundle: DataFrame, split_col: str, a: str, b: str, metrics: Sequence[str],
               by: Sequence[str] = ()) -> DataFrame:
    """a − b per metric (e.g. train − validation) from a bundle grouped by split (one row per metric)."""
    d, gk = _group_keys(bundle, by)
    long = d.select(*gk, split_col, F.explode(F.map_from_arrays(
        F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics])))
        .alias("metric", "value"))
    out = long.groupBy(*gk, "metric").agg(
        F.max(F.when(F.col(split_col) == a, F.col("value"))).alias(f"value_{a}"),
        F.max(F.when(F.col(split_col) == b, F.col("value"))).alias(f"value_{b}"))
    out = out.withColumn("gap", r6(F.col(f"value_{a}") - F.col(f"value_{b}")))
    return _drop_g(out, by)


def compare_to_registry(current: DataFrame, registry: DataFrame, keys: Sequence[str],
                        tol: float = 1e-9) -> DataFrame:
    """Full outer join on (keys, metric): a metric differs, or exists on one side only, → mismatch."""
    c = current.select(*keys, "metric", F.col("value").alias("value_new"))
    r = registry.select(*keys, "metric", F.col("value").alias("value_old"))
    j = c.join(r, list(keys) + ["metric"], "full")
    return j.select(*keys, "metric", "value_new", "value_old",
                    (F.col("value_new").isNull() | F.col("value_old").isNull()
                     | (F.abs(F.col("value_new") - F.col("value_old")) > tol)).alias("mismatch"))

