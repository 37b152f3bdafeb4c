"""Frozen drift baselines and PSI comparison.

Wide feature tables are unpivoted to long ``(feature, value)`` form so *one* shuffle serves every
feature. The baseline is small by construction (one row per feature, ≤ 10 edges, one row per category
level) and is joined to the window by feature key; Spark broadcasts it after its size check.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import PSI_ACT, QUANTILE_LEVELS, digitize, hash_uniform, psi_class, psi_term, r6
from ..session import materialize
from .quantiles import exact_quantiles
from .ranking import checked_broadcast, with_row

N_BINS = 10
Q_NAMES = tuple(f"p{int(round(q * 100)):02d}" for q in QUANTILE_LEVELS)


def long_numeric(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids…, feature, value DOUBLE); text that is not a number becomes null (try_cast)."""
    cols = [F.expr(f"try_cast({c} AS DOUBLE)").alias(c) if dict(df.dtypes)[c] == "string"
            else F.col(c).cast("double").alias(c) for c in features]
    return df.select(*ids, *cols).unpivot(list(ids), list(features), "feature", "value")


def long_categorical(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    cols = [F.col(c).cast("string").alias(c) for c in features]
    return df.select(*ids, *cols).unpivot(list(ids), list(features), "feature", "level")


def numeric_baseline(df: DataFrame, features: Sequence[str], n_bins: int = N_BINS) -> DataFrame:
    """Per feature: n, missing share, mean, sample std, min, max, quantiles (6 dp) and PSI ``edges``
    (distinct rounded inner quantiles) plus frozen bin proportions ``props`` (rounded)."""
    long = long_numeric(df, features)
    stats = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        r6(F.avg(F.col("value").isNull().cast("double"))).alias("missing"),
        r6(F.avg("value")).alias("mean"), r6(F.stddev_samp("value")).alias("std"),
        r6(F.min("value")).alias("min"), r6(F.max("value")).alias("max"))
    inner = [i / n_bins for i in range(1, n_bins)]
    probs = sorted(set(inner) | set(QUANTILE_LEVELS))
    q = exact_quantiles(long, "value", probs, ["feature"])
    qs = q.groupBy("feature").agg(
        *[r6(F.max(F.when(F.col("prob") == p, F.col("quantile")))).alias(n) for p, n in zip(QUANTILE_LEVELS, Q_NAMES)],
        F.array_sort(F.array_distinct(F.collect_list(
            F.when(F.col("prob").isin(inner), F.round("quantile", 6))))).alias("edges"))
    base = stats.join(qs, "feature", "left")
    base = materialize(base, "numeric-baseline-stats")
    props = bin_proportions(long, base.select("feature", "edges"))
    return materialize(base.join(props.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bin", "prop"))), lambda s: s["prop"]).alias("props")),
        "feature", "left"), "numeric-baseline")


def bin_proportions(long: DataFrame, edges: DataFrame, round_props: bool = True) -> DataFrame:
    """(feature, bin, prop) for every bin 0..len(edges) including empty ones; empty sample → zeros."""
    edges = checked_broadcast(edges, "edges")      # one row per feature: a long feature does not meet in one task
    d = long.where(F.col("value").isNotNull()).join(edges, "feature")
    counts = d.groupBy("feature", digitize("value", F.col("edges")).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    skel = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    tot = counts.groupBy("feature").agg(F.sum("c").alias("n"))
    p = F.coalesce(F.col("c") / F.col("n"), F.lit(0.0))
    return (skel.join(counts, ["feature", "bin"], "left").join(tot, "feature", "left")
                .select("feature", "bin", (r6(p) if round_props else p).alias("prop"),
                        F.coalesce("n", F.lit(0)).alias("n")))


def category_baseline(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, level, freq) over non-null values, plus n and missing share per feature."""
    long = long_categorical(df, features)
    tot = long.groupBy("feature").agg(F.count("level").alias("n"),
                                      r6(F.avg(F.col("level").isNull().cast("double"))).alias("missing"))
    lv = long.where(F.col("level").isNotNull()).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("c"))
    return materialize(lv.join(tot, "feature").select("feature", "level", r6(F.col("c") / F.col("n")).alias("freq"),
                                                      "n", "missing"), "category-baseline")


def compare_numeric(baseline: DataFrame, window: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """PSI of a window against the frozen baseline per numeric feature present in the window.

    Baseline features missing from the window are omitted (not measured ≠ stable); a present but
    empty feature gives psi null / 'no-data'.
    """
    # features absent from the window are omitted (schema check); features absent from the baseline
    # drop out in the key join with the baseline — no extra job
    num_types = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal", "string")
    feats = [f for f in (features or window.columns) if f in window.columns
             and (features is not None or dict(window.dtypes)[f].startswith(num_types))]
    if not feats:          # nothing measured: an empty report, not a report of zeros
        return window.sparkSession.createDataFrame(
            [], "feature string, kind string, psi double, class string, n long, mean_ref double, mean_window double")
    long = long_numeric(window, feats)
    wp = bin_proportions(long, baseline.select("feature", "edges"), round_props=False)
    ep = baseline.select("feature", F.posexplode("props").alias("bin", "e"))
    j = wp.join(ep, ["feature", "bin"], "left")
    psi = j.groupBy("feature").agg(F.sum(psi_term(F.coalesce("e", F.lit(0.0)), "prop")).alias("_psi"),
                                   F.max("n").alias("n"))
    means = long.groupBy("feature").agg(r6(F.avg("value")).alias("mean_window"))
    out = psi.join(means, "feature").join(baseline.select("feature", F.col("mean").alias("mean_ref")), "feature")
    p = F.when(F.col("n") > 0, r6("_psi"))
    return out.select("feature", F.lit("numeric").alias("kind"), p.alias("psi"), psi_class(p).alias("class"),
                      F.col("n").cast("long").alias("n"), "mean_ref", "mean_window")


def compare_categorical(baseline: DataFrame, window: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """PSI over the union of baseline and window levels (full outer join); unseen levels listed."""
    feats = [f for f in (features or window.columns) if f in window.columns]
    if not feats:
        return window.sparkSession.createDataFrame(
            [], "feature string, kind string, psi double, class string, n long, unseen string")
    long = long_categorical(window, feats).where(F.col("level").isNotNull()) \
        .join(baseline.select("feature").distinct(), "feature", "left_semi")     # baseline features only
    wc = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("c"))
    wn = wc.groupBy("feature").agg(F.sum("c").alias("n"))
    a = wc.join(wn, "feature").select("feature", "level", (F.col("c") / F.col("n")).alias("a"))
    e = baseline.where(F.col("feature").isin(feats)).select("feature", "level", F.col("freq").alias("e"))
    u = e.join(a, ["feature", "level"], "full")
    psi = u.groupBy("feature").agg(
        F.sum(psi_term(F.coalesce("e", F.lit(0.0)), F.coalesce("a", F.lit(0.0)))).alias("_psi"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("e").isNull(), F.col("level")))), ",").alias("unseen"))
    out = psi.join(wn, "feature", "left")
    p = F.when(F.col("n") > 0, r6("_psi"))
    return out.select("feature", F.lit("categorical").alias("kind"), p.alias("psi"), psi_class(p).alias("class"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("n"), "unseen")


def unseen_levels(baseline: DataFrame, window: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, level, n) of window levels absent from the baseline: a left anti join."""
    long = long_categorical(window, features).where(F.col("level").isNotNull())
    return (long.join(baseline.select("feature", "level"), ["feature", "level"], "left_anti")
                .groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n")))


def score_baseline(scores: DataFrame, score: str = "score", threshold: float | None = None,
                   n_bins: int = N_BINS, by: Sequence[str] = ()) -> DataFrame:
    """Prediction-drift baseline: n, mean, quantiles, edges, props and the share at/above threshold."""
    d = scores.select(*by, F.col(score).alias("value")).withColumn("feature", F.lit("score"))
    keys = list(by) + ["feature"]
    inner = [i / n_bins for i in range(1, n_bins)]
    q = exact_quantiles(d, "value", inner, keys)
    edges = materialize(q.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.collect_list(F.round("quantile", 6)))).alias("edges")), "score-edges")
    st = d.groupBy(*keys).agg(F.count("value").alias("n"), r6(F.avg("value")).alias("mean"),
                              *([r6(F.avg((F.col("value") >= threshold).cast("double"))).alias("rate_above")]
                                if threshold is not None else []))
    long = d.select(*keys, "value")
    dd = long.where(F.col("value").isNotNull()).join(edges, keys)
    cnt = dd.groupBy(*keys, digitize("value", F.col("edges")).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    skel = edges.select(*keys, F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    props = (skel.join(cnt, keys + ["bin"], "left").join(st.select(*keys, "n"), keys)
                 .select(*keys, "bin", r6(F.coalesce(F.col("c") / F.col("n"), F.lit(0.0))).alias("prop")))
    pa = props.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "prop"))),
                                              lambda s: s["prop"]).alias("props"))
    out = st.join(edges, keys).join(pa, keys)
    if threshold is not None:
        out = out.withColumn("threshold", F.lit(float(threshold)))
    return materialize(out, "score-baseline")


def compare_scores(baseline: DataFrame, window: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Score PSI, class, means, share at/above the frozen threshold and the queue multiplier
    (3 dp, only when the baseline share is positive). An empty window → psi null / 'no-data'."""
    keys = list(by)
    w = window.select(*keys, F.col(score).alias("value")).where(F.col("value").isNotNull())
    b = baseline.drop("feature")
    d = w.join(b.select(*keys, "edges", "threshold") if keys else b.select("edges", "threshold"), keys) if keys \
        else with_row(w, b.select("edges", "threshold"))
    cnt = d.groupBy(*keys, digitize("value", F.col("edges")).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    st = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("_mean"),
                              F.avg((F.col("value") >= F.col("threshold")).cast("double")).alias("_rate"))
    ep = b.select(*keys, F.posexplode("props").alias("bin", "e"))
    j = ep.join(cnt, keys + ["bin"], "left")
    jn = j.join(st, keys, "left") if keys else with_row(j, st)
    agg = jn.groupBy(*keys).agg(
        F.sum(psi_term("e", F.coalesce(F.col("c") / F.col("n"), F.lit(0.0)))).alias("_psi"),
        F.max("n").alias("n"), F.max("_mean").alias("_mean"), F.max("_rate").alias("_rate"))
    ref = b.select(*keys, F.col("mean").alias("mean_ref"), F.col("rate_above").alias("rate_above_ref"))
    out = agg.join(ref, keys) if keys else with_row(agg, ref)
    has = F.coalesce(F.col("n"), F.lit(0)) > 0
    p = F.when(has, r6("_psi"))
    return out.select(
        *keys, F.coalesce("n", F.lit(0)).cast("long").alias("n"), p.alias("psi"), psi_class(p).alias("class"),
        "mean_ref", F.when(has, r6("_mean")).alias("mean_window"), "rate_above_ref",
        F.when(has, r6("_rate")).alias("rate_above"),
        F.when(has & (F.col("rate_above_ref") > 0),
               F.round(r6("_rate") / F.col("rate_above_ref"), 3)).alias("queue_x"))


def noise_floor(train: DataFrame, val: DataFrame, features: Sequence[str], id_col: str = "customer_id", repeats: int = 20, seed: str = "noise",
                trigger: float = PSI_ACT) -> DataFrame:
    """What nothing happening measures (D13): per feature the PSI of validation against train (the partition's noise), the
    mean and the largest PSI of ``repeats`` random halves of train against the other half, and how many times the largest
    of these noises the drift trigger is (null where there was none).

    Bins are the frozen ones of train. A row's half in a repeat is decided by a hash of its id; all repeats and features
    are counted in one aggregate of (feature, repeat, half, bin), made before the shuffle."""
    base = numeric_baseline(train, features)
    edges = checked_broadcast(base.select("feature", "edges"), "noise-edges")
    half = lambda r: (hash_uniform(id_col, f"{seed}{r}") < 0.5).cast("int")
    halves = train.select("*", F.array(*[half(r) for r in range(repeats)]).alias("_halves"))
    long = long_numeric(halves, features, ids=["_halves"]).where(F.col("value").isNotNull()).join(edges, "feature")
    binned = long.groupBy("feature", digitize("value", F.col("edges")).alias("bin"), "_halves").agg(F.count(F.lit(1)).alias("c"))
    cells = binned.select("feature", "bin", "c", F.posexplode("_halves").alias("rep", "half")).groupBy("feature", "rep", "bin").agg(
        F.sum(F.when(F.col("half") == 0, F.col("c")).otherwise(0)).alias("c0"), F.sum(F.when(F.col("half") == 1, F.col("c")).otherwise(0)).alias("c1"))
    n = cells.groupBy("feature", "rep").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"))
    # a bin that is empty in both halves adds nothing
    psi = cells.join(n, ["feature", "rep"]).groupBy("feature", "rep").agg(r6(F.sum(psi_term(F.col("c0") / F.col("n0"), F.col("c1") / F.col("n1")))).alias("psi"))
    noise = psi.groupBy("feature").agg(r6(F.avg("psi")).alias("halves_mean"), F.max("psi").alias("halves_max"))
    split = compare_numeric(base, val, features).select("feature", F.col("psi").alias("split_psi"))
    largest = F.greatest("halves_max", "split_psi")
    return noise.join(split, "feature").select("feature", "split_psi", "halves_mean", "halves_max",
                                               F.when(largest > 0, F.round(F.lit(trigger) / largest, 3)).alias("trigger_to_noise"))


def whitening(baseline_df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[list[float]]]:
    """Mean and inverse covariance of the baseline's complete rows: one aggregate of k + k² numbers."""
    import numpy as np
    k = len(features)
    rows = baseline_df.select(*[F.col(c).cast("double").alias(c) for c in features]).dropna()
    row = rows.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                   *[F.covar_pop(a, b).alias(f"c_{i}_{j}") for i, a in enumerate(features) for j, b in enumerate(features)]).first()
    cov = np.array([[row[f"c_{i}_{j}"] for j in range(k)] for i in range(k)], float)
    return [float(row[f"m_{i}"]) for i in range(k)], np.linalg.pinv(cov).tolist()


def mahalanobis(df: DataFrame, features: Sequence[str], mean: Sequence[float], inverse: Sequence[Sequence[float]]) -> DataFrame:
    """(d, shares) for every complete row: its distance, and each feature's part of the squared distance (they add up to
    it)."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features]).dropna()
    centred = [F.col(c) - F.lit(m) for c, m in zip(features, mean, strict=True)]
    parts = [centred[i] * sum((centred[j] * F.lit(inverse[i][j]) for j in range(len(features))), F.lit(0.0)) for i in range(len(features))]
    rows = rows.select(F.array(*parts).alias("shares"))
    return rows.select(F.sqrt(F.greatest(F.aggregate("shares", F.lit(0.0), lambda a, x: a + x), F.lit(0.0))).alias("d"), "shares")


def mahalanobis_share(baseline_df: DataFrame, window: DataFrame, features: Sequence[str], quantile: float = 0.99) -> DataFrame:
    """Multivariate drift: share of window rows beyond the baseline's own ``quantile`` distance (exact), and what each
    feature adds to their squared distance on average (``by_feature``, in the order of ``features``)."""
    mean, inverse = whitening(baseline_df, features)
    cut = exact_quantiles(mahalanobis(baseline_df, features, mean, inverse), "d", [quantile]).select(r6("quantile").alias("cut"))
    rows = with_row(mahalanobis(window, features, mean, inverse), cut)
    beyond = F.col("d") > F.col("cut")
    mean_part = lambda i: r6(F.avg(F.when(beyond, F.col("shares")[i])))
    return rows.agg(F.count(F.lit(1)).alias("n"), r6(F.avg(beyond.cast("double"))).alias("share_unusual"), F.max("cut").alias("cut"),
                    F.array(*[F.struct(F.lit(c).alias("feature"), mean_part(i).alias("part")) for i, c in enumerate(features)]).alias("by_feature"))
