"""Ranking, calibration and cost queries over the customer snapshot (M1–M21, M-A, M-I, M-J, M-N, M-O, M-P, P7, P8)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import metrics as M
from ..operators import queues as Q
from ..operators.split import stratified_split
from .common import snapshot
from .registry import query
from .sql import ctes, u
from .sqlmetrics import ap_sql, auc_sql, cost_curve_sql, point_sql, recall_k_sql

SNAP = ctes("snapshot")


@query("customer_snapshot", ops=("IO1", "P1", "B1"), sql=SNAP + "SELECT * FROM snapshot")
def q_customer_snapshot(spark, sf_dir):
    """The per-customer snapshot (features, value, label, score) built from five tables."""
    return snapshot(spark, sf_dir)


_EVAL_SQL = SNAP + f"""
SELECT pm.*, ap.ap, auc.roc_auc,
       r10.recall_at_k AS recall_at_10, r10.lift_at_k AS lift_at_10, r10.pct_ceiling AS pct_ceiling_10,
       r20.recall_at_k AS recall_at_20, r20.lift_at_k AS lift_at_20, r20.pct_ceiling AS pct_ceiling_20
FROM {point_sql('snapshot', ['segment'])} pm
LEFT JOIN {ap_sql('snapshot', ['segment'])} ap USING (segment)
LEFT JOIN {auc_sql('snapshot', ['segment'])} auc USING (segment)
LEFT JOIN (SELECT * FROM {recall_k_sql('snapshot', ['segment'])} x WHERE k = 0.1) r10 USING (segment)
LEFT JOIN (SELECT * FROM {recall_k_sql('snapshot', ['segment'])} x WHERE k = 0.2) r20 USING (segment)
"""


@query("metrics_by_segment", ops=("M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9", "M10", "M12"),
       sql=_EVAL_SQL)
def q_metrics_by_segment(spark, sf_dir):
    """Flagship: full metric bundle per market segment in one job."""
    return M.evaluate(snapshot(spark, sf_dir), by=["segment"])


# Scores closer to each other than a millionth, in groups of which one is null.
_CLOSE = SNAP + """, close AS (SELECT customer_id, last_priority, y_signal, 0.5 + score * 1e-7 AS score FROM snapshot)
"""


@query("ranking_close_scores", ops=("M1", "M2", "M7", "M8", "M9"), sql=_CLOSE + f"""
SELECT ap.last_priority, ap.ap, auc.roc_auc, r.k, r.recall_at_k FROM {ap_sql('close', ['last_priority'], y='y_signal')} ap
JOIN {auc_sql('close', ['last_priority'], y='y_signal')} auc ON auc.last_priority IS NOT DISTINCT FROM ap.last_priority
JOIN {recall_k_sql('close', ['last_priority'], y='y_signal')} r ON r.last_priority IS NOT DISTINCT FROM ap.last_priority""")
def q_ranking_close_scores(spark, sf_dir):
    """AP, ROC-AUC and recall@k of raw scores that differ by less than a millionth, by last priority (null is a group)."""
    d = snapshot(spark, sf_dir).select("customer_id", "last_priority", "y_signal", (F.lit(0.5) + F.col("score") * 1e-7).alias("score"))
    by = ["last_priority"]
    gs = lambda df: df.withColumn("_g2", F.struct("last_priority"))
    ap, auc = M.average_precision(d, label="y_signal", by=by), M.roc_auc(d, label="y_signal", by=by)
    rk = M.recall_at_k(d, label="y_signal", by=by).select("last_priority", "k", "recall_at_k")
    return gs(ap).join(gs(auc).drop("last_priority"), "_g2").join(gs(rk).drop("last_priority"), "_g2").drop("_g2")


@query("average_precision", ops=("M1",),
       sql=SNAP + "SELECT * FROM " + ap_sql("snapshot", ["region"], y="y_signal") + " x")
def q_average_precision(spark, sf_dir):
    return M.average_precision(snapshot(spark, sf_dir), label="y_signal", by=["region"])


@query("average_precision_overall", ops=("M1",),
       sql=SNAP + "SELECT * FROM " + ap_sql("snapshot", [], y="y_signal") + " x")
def q_average_precision_overall(spark, sf_dir):
    return M.average_precision(snapshot(spark, sf_dir), label="y_signal")


@query("roc_auc", ops=("M2",),
       sql=SNAP + "SELECT * FROM " + auc_sql("snapshot", ["region"], y="y_signal") + " x")
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(snapshot(spark, sf_dir), label="y_signal", by=["region"])


@query("point_metrics", ops=("M3", "M4", "M5", "M6", "M10", "P7"),
       sql=SNAP + "SELECT * FROM " + point_sql("snapshot", ["region"], threshold=0.29, y="y_signal") + " x")
def q_point_metrics(spark, sf_dir):
    return M.point_metrics(snapshot(spark, sf_dir), label="y_signal", threshold=0.29, by=["region"])


@query("recall_at_k", ops=("M7", "M8", "M9"),
       sql=SNAP + "SELECT * FROM " + recall_k_sql("snapshot", [], ks=(0.05, 0.1, 0.2, 0.5), y="y_signal") + " x")
def q_recall_at_k(spark, sf_dir):
    return M.recall_at_k(snapshot(spark, sf_dir), label="y_signal", ks=(0.05, 0.1, 0.2, 0.5))


@query("cost_curve", ops=("M11",),
       sql=SNAP + "SELECT * FROM " + cost_curve_sql("snapshot", ["segment"]) + " x")
def q_cost_curve(spark, sf_dir):
    return M.cost_curve(snapshot(spark, sf_dir), by=["segment"])


@query("cost_optimum", ops=("M11", "M18"), sql=SNAP + f"""
, curve AS (SELECT * FROM {cost_curve_sql('snapshot', ['segment'], y='y_signal')} c)
SELECT segment, arg_min(threshold, (cost, threshold)) AS best_threshold, min(cost) AS best_cost,
       max(cost) FILTER (WHERE threshold = 0.5) AS cost_at_05,
       max(cost) FILTER (WHERE threshold = 0.22) AS cost_inherited,
       round(max(cost) FILTER (WHERE threshold = 0.22) - min(cost), 6) AS regret
FROM curve GROUP BY segment""")
def q_cost_optimum(spark, sf_dir):
    curve = M.cost_curve(snapshot(spark, sf_dir), label="y_signal", by=["segment"])
    return M.cost_optimum(curve, by=["segment"], inherited=0.22)


@query("trivial_costs", ops=("M14",), sql=SNAP + """
SELECT segment, round(sum(y) * 194.0::DOUBLE, 6) AS cost_do_nothing, round(sum(1 - y) * 62.0::DOUBLE, 6) AS cost_contact_all
FROM snapshot GROUP BY segment""")
def q_trivial_costs(spark, sf_dir):
    return M.trivial_costs(snapshot(spark, sf_dir), by=["segment"])


@query("gain_curve", ops=("M15",), sql=SNAP + """
, r AS (SELECT y_signal AS y, row_number() OVER (ORDER BY round(score, 6) DESC, customer_id) AS rn,
               sum(y_signal) OVER (ORDER BY round(score, 6) DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cp
        FROM snapshot),
  tot AS (SELECT count(*) AS n, sum(y_signal) AS p FROM snapshot),
  grid AS (SELECT i, n, p, CAST(ceil(round(i * n / 100, 9)) AS BIGINT) AS cut FROM tot, range(1, 101) g(i))
SELECT round(i / 100, 6) AS fraction, cut AS contacted, round(coalesce(r.cp, 0) / nullif(p, 0), 6) AS captured,
       round(least((i / 100) / (p / n), 1.0), 6) AS ceiling, round(i / 100, 6) AS chance
FROM grid LEFT JOIN r ON r.rn = grid.cut""")
def q_gain_curve(spark, sf_dir):
    return M.gain_curve(snapshot(spark, sf_dir), label="y_signal")


@query("probability_histogram", ops=("M17",), sql=SNAP + """
SELECT y, CAST(least(floor(score * 40), 39) AS INTEGER) AS bin, count(*) AS n FROM snapshot GROUP BY ALL""")
def q_probability_histogram(spark, sf_dir):
    return M.probability_histogram(snapshot(spark, sf_dir))


@query("score_summary", ops=("M19",), sql=SNAP + """
SELECT segment, round(min(score), 6) AS p_min, round(max(score), 6) AS p_max, round(stddev_pop(score), 6) AS p_std
FROM snapshot GROUP BY segment""")
def q_score_summary(spark, sf_dir):
    return M.score_summary(snapshot(spark, sf_dir), by=["segment"])


@query("score_bands", ops=("M20",), sql=SNAP + """
SELECT CAST(least(floor(score / 0.1), 9) AS INTEGER) AS band, count(*) FILTER (WHERE y = 0) AS n_y0,
       count(*) FILTER (WHERE y = 1) AS n_y1 FROM snapshot GROUP BY ALL""")
def q_score_bands(spark, sf_dir):
    return M.score_bands(snapshot(spark, sf_dir))


@query("retention_queue", ops=("M-J",), sql=SNAP + """
SELECT *, round(score * value, 6) AS expected_loss FROM snapshot
ORDER BY round(score * value, 6) DESC, customer_id LIMIT 100""")
def q_retention_queue(spark, sf_dir):
    """Top-100 contact list by expected loss (the limit is the feature: team capacity)."""
    return Q.expected_loss_queue(snapshot(spark, sf_dir), 100)


@query("team_queues", ops=("M-J",), sql=SNAP + """
SELECT * FROM (SELECT *, round(score * value, 6) AS expected_loss,
  row_number() OVER (PARTITION BY region ORDER BY round(score * value, 6) DESC, customer_id) AS queue_rank
  FROM snapshot) t WHERE queue_rank <= 20""")
def q_team_queues(spark, sf_dir):
    """Per-region top-20 queues; hot regions are pre-cut in hashed slices before the final rank."""
    d = snapshot(spark, sf_dir).withColumn("expected_loss", F.round(F.col("score") * F.col("value"), 6))
    return Q.top_k_per_group(d, ["region"], [F.col("expected_loss").desc(), F.col("customer_id").asc()], 20,
                             salt_col="customer_id")


@query("fallback_queue", ops=("M-P",), sql=SNAP + """
SELECT *, CAST(coalesce(last_priority = '1-URGENT', false) AS INTEGER) AS priority_flag FROM snapshot
ORDER BY priority_flag DESC, value DESC, customer_id LIMIT 100""")
def q_fallback_queue(spark, sf_dir):
    flag = F.coalesce(F.col("last_priority") == "1-URGENT", F.lit(False))
    return Q.fallback_queue(snapshot(spark, sf_dir), 100, flag)


@query("external_score_rescale", ops=("P8", "M1", "M2"), sql=SNAP + f"""
, ext AS (SELECT customer_id, segment, y, CAST(round(score * 100) AS INTEGER) / 100.0 AS score FROM snapshot)
SELECT a.segment, a.ap, b.roc_auc FROM {ap_sql('ext', ['segment'])} a JOIN {auc_sql('ext', ['segment'])} b USING (segment)""")
def q_external_score_rescale(spark, sf_dir):
    """An integer 0–100 external score rescaled ÷100 and ranked like a model."""
    s = snapshot(spark, sf_dir)
    ext = s.select("customer_id", "segment", "y",
                   (F.round(F.col("score") * 100).cast("int") / 100.0).alias("score"))
    return M.average_precision(ext, by=["segment"]).join(M.roc_auc(ext, by=["segment"]), "segment")


@query("prior_baseline", ops=("M-A", "M1", "M3"), sql=SNAP + f"""
, prior AS (SELECT s.*, p.prev AS prior_score FROM snapshot s, (SELECT avg(CAST(y AS DOUBLE)) AS prev FROM snapshot) p)
SELECT a.segment, a.ap, b.brier FROM {ap_sql('prior', ['segment'], score='prior_score')} a
JOIN (SELECT segment, round(avg(pow(prior_score - y, 2)), 6) AS brier FROM prior GROUP BY segment) b USING (segment)""")
def q_prior_baseline(spark, sf_dir):
    """Constant-prevalence scorer: AP equals the group prevalence (the floor any model must beat)."""
    s = snapshot(spark, sf_dir)
    prev = s.agg(F.avg(F.col("y").cast("double")).alias("prior_score"))      # one row
    from ..operators.ranking import with_row
    d = with_row(s, prev)
    ap = M.average_precision(d, score="prior_score", by=["segment"])
    brier = d.groupBy("segment").agg(r6(F.avg(F.pow(F.col("prior_score") - F.col("y"), 2))).alias("brier"))
    return ap.join(brier, "segment")


@query("scored_decisions", ops=("M-I", "P7"), sql=SNAP + """
SELECT customer_id, score AS probability, score >= 0.29 AS decision, 0.29::DOUBLE AS threshold, 'v1' AS model_version
FROM snapshot""")
def q_scored_decisions(spark, sf_dir):
    s = snapshot(spark, sf_dir)
    return s.select("customer_id", F.col("score").alias("probability"),
                    (F.col("score") >= F.lit(0.29)).alias("decision"),
                    F.lit(0.29).alias("threshold"), F.lit("v1").alias("model_version"))


_SEEDS = (0, 1, 2, 3, 4)


@query("prediction_variance", ops=("M-N", "S7"), sql=SNAP + f"""
, v AS (SELECT customer_id, s AS seed,
          CASE WHEN recency_days IS NULL THEN 1.0
               ELSE round(recency_days / (recency_days + 240.0 + 20.0 * s), 6) END AS p
        FROM snapshot, range(0, 5) t(s)),
  per AS (SELECT customer_id, stddev_pop(p) AS sd FROM v GROUP BY customer_id)
SELECT round(avg(sd), 6) AS mean_prediction_std, round(max(sd), 6) AS max_prediction_std,
       count(*) AS n_customers FROM per""")
def q_prediction_variance(spark, sf_dir):
    """Std (ddof 0) of one customer's score across five seed variants, then its mean over customers."""
    s = snapshot(spark, sf_dir)
    v = s.select("customer_id", F.explode(F.array(*[F.lit(x) for x in _SEEDS])).alias("seed"), "recency_days")
    v = v.withColumn("p", F.when(F.col("recency_days").isNull(), F.lit(1.0)).otherwise(
        F.round(F.col("recency_days") / (F.col("recency_days") + 240.0 + 20.0 * F.col("seed")), 6)))
    per = v.groupBy("customer_id").agg(F.stddev_pop("p").alias("sd"))
    return per.agg(r6(F.avg("sd")).alias("mean_prediction_std"), r6(F.max("sd")).alias("max_prediction_std"),
                   F.count(F.lit(1)).alias("n_customers"))


# Fixed coefficients of the illustrative linear scorer used by the explanation operator.
_COEF = {"tenure_days": -0.0004, "monthly_charges": 0.00002, "recency_days": 0.0009, "value": -0.00005}


@query("linear_contributions", ops=("M-O",), sql=SNAP + """
, c AS (SELECT customer_id, f.feature, f.contribution FROM snapshot,
        LATERAL (SELECT unnest([
          {'feature': 'tenure_days', 'contribution': round(-0.0004 * coalesce(tenure_days, 0.0), 6)},
          {'feature': 'monthly_charges', 'contribution': round(0.00002 * coalesce(monthly_charges, 0.0), 6)},
          {'feature': 'recency_days', 'contribution': round(0.0009 * coalesce(recency_days, 0.0), 6)},
          {'feature': 'value', 'contribution': round(-0.00005 * coalesce(value, 0.0), 6)}]) AS f))
SELECT customer_id, feature, contribution, rk AS contribution_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS rk FROM c) t
WHERE rk <= 2""")
def q_linear_contributions(spark, sf_dir):
    """Top-2 terms β_j·x_j per customer — ranked inside the row (array sort), no shuffle."""
    s = snapshot(spark, sf_dir)
    terms = F.array(*[F.struct(F.lit(k).alias("feature"),
                               F.round(F.lit(v) * F.coalesce(F.col(k), F.lit(0.0)), 6).alias("contribution"))
                      for k, v in _COEF.items()])
    ordered = F.array_sort(terms, lambda a, b: F.when(F.abs(a.contribution) > F.abs(b.contribution), -1)
                           .when(F.abs(a.contribution) < F.abs(b.contribution), 1)
                           .when(a.feature < b.feature, -1).when(a.feature > b.feature, 1).otherwise(0))
    top = s.select("customer_id", F.posexplode(F.slice(ordered, 1, 2)).alias("pos", "t"))
    return top.select("customer_id", "t.feature", "t.contribution",
                      (F.col("pos") + 1).cast("long").alias("contribution_rank"))


@query("split_gap", ops=("M13", "S1"), sql=SNAP + f"""
, h AS (SELECT *, ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15))::UBIGINT AS hk FROM snapshot),
  rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY hk, customer_id) AS rn, count(*) OVER (PARTITION BY y) AS n FROM h),
  sp AS (SELECT *, CASE WHEN rn <= ceil(round(n * 0.2, 9)) THEN 'test'
                        WHEN rn <= ceil(round(n * 0.2, 9)) + ceil(round((n - ceil(round(n * 0.2, 9))) * 0.25, 9)) THEN 'val'
                        ELSE 'train' END AS split FROM rk),
  b AS (SELECT a.split, a.ap, p.brier FROM {ap_sql('sp', ['split'], y='y_signal')} a
        JOIN {point_sql('sp', ['split'], y='y_signal')} p USING (split)),
  l AS (SELECT split, 'ap' AS metric, CAST(ap AS DOUBLE) AS value FROM b UNION ALL
        SELECT split, 'brier', CAST(brier AS DOUBLE) FROM b)
SELECT metric, max(value) FILTER (WHERE split = 'train') AS value_train,
       max(value) FILTER (WHERE split = 'val') AS value_val,
       round(max(value) FILTER (WHERE split = 'train') - max(value) FILTER (WHERE split = 'val'), 6) AS gap
FROM l GROUP BY metric""")
def q_split_gap(spark, sf_dir):
    """Train − validation gap of AP and Brier after the stratified split."""
    sp = stratified_split(snapshot(spark, sf_dir))
    ap = M.average_precision(sp, label="y_signal", by=["split"])
    pm = M.point_metrics(sp, label="y_signal", by=["split"]).select("split", "brier")
    return M.metric_gap(ap.join(pm, "split"), "split", "train", "val", ["ap", "brier"])


@query("registry_check", ops=("M21", "IO10"), sql=SNAP + f"""
SELECT segment, 'ap' AS metric, CAST(ap AS DOUBLE) AS value_new, CAST(ap AS DOUBLE) AS value_old, false AS mismatch
FROM {ap_sql('snapshot', ['segment'])} a""")
def q_registry_check(spark, sf_dir):
    """Re-execution on a re-partitioned copy of the input must reproduce the recorded metrics exactly."""
    s = snapshot(spark, sf_dir)
    cur = M.average_precision(s, by=["segment"]).select("segment", F.lit("ap").alias("metric"), F.col("ap").alias("value"))
    again = M.average_precision(s.repartition(17, "customer_id"), by=["segment"]) \
        .select("segment", F.lit("ap").alias("metric"), F.col("ap").alias("value"))
    return M.compare_to_registry(cur, again, ["segment"])
