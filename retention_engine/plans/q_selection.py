"""Model-selection queries over a cross-validation table computed from the data.

Candidates are twelve recency scorers with different half-lives (complexity columns C and l1 attached);
each is scored on the held-out fold of a repeated stratified 5 × 3 split of the training rows, so the
``cv_scores`` table is real cross-validation output whose size follows the data.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import metrics as M
from ..operators import selection as SE
from ..operators.split import repeated_folds, stratified_split
from ..session import materialize
from .common import snapshot
from .q_split import _SPLIT
from .registry import query
from .sql import ctes
from .sqlmetrics import ap_sql, cost_curve_sql, point_sql, recall_k_sql

N_CAND = 12
BASE = 0


def _cand_score(c):
    return F.when(F.col("recency_days").isNull(), F.lit(1.0)).otherwise(
        F.round(F.col("recency_days") / (F.col("recency_days") + (F.lit(60) + 40 * c)), 6))


def _with_candidates(df):
    used = [c for c in df.columns if c in ("customer_id", "y_signal", "recency_days", "rep", "fold")]
    d = df.select(*used, F.explode(F.sequence(F.lit(0), F.lit(N_CAND - 1))).alias("candidate"))
    d = d.withColumn("candidate", F.col("candidate").cast("long")).withColumn("score", _cand_score(F.col("candidate")))
    return d.withColumn("C", F.pow(F.lit(10.0), (F.col("candidate") % 6) - 3)) \
            .withColumn("l1", (F.floor(F.col("candidate") / 6)).cast("double"))


def _cv(spark, sf_dir):
    sp = stratified_split(snapshot(spark, sf_dir))
    folds = repeated_folds(sp.where(F.col("split") == "train"), k=5, reps=3, label="y_signal")
    scored = _with_candidates(folds)
    cv = M.average_precision(scored, label="y_signal", by=["candidate", "rep", "fold"]) \
          .withColumnRenamed("ap", "score")
    return materialize(cv, "cv-scores"), sp


_CV_SQL = _SPLIT.rstrip("\n") + """,
tr AS (SELECT * FROM sp WHERE split = 'train'),
rf AS (SELECT t.*, CAST(r AS INTEGER) AS rep,
         CAST((row_number() OVER (PARTITION BY r, y_signal ORDER BY
               ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42-' || CAST(r AS VARCHAR)), 1, 15))::UBIGINT, customer_id) - 1) % 5 AS INTEGER) AS fold
       FROM tr t, range(0, 3) x(r)),
cand AS (SELECT rf.customer_id, rf.y_signal, rf.rep, rf.fold, c AS candidate,
           CASE WHEN recency_days IS NULL THEN 1.0 ELSE round(recency_days / (recency_days + (60 + 40 * c)), 6) END AS score
         FROM rf, range(0, 12) y(c)),
cv AS (SELECT candidate, rep, fold, ap AS score FROM """ + ap_sql("cand", ["candidate", "rep", "fold"], y="y_signal") + """ a),
summ AS (SELECT candidate, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, count(*) AS k,
                pow(10.0, (candidate % 6) - 3) AS "C", CAST(floor(candidate / 6) AS DOUBLE) AS l1 FROM cv GROUP BY candidate)"""


@query("cv_scores", ops=("V1", "S4"), sql=_CV_SQL + "\nSELECT candidate, CAST(rep AS INTEGER) AS rep, fold, score FROM cv")
def q_cv_scores(spark, sf_dir):
    """AP of each candidate on each held-out fold (same folds for every candidate)."""
    cv, _ = _cv(spark, sf_dir)
    return cv.select("candidate", F.col("rep").cast("int").alias("rep"), "fold", "score")


@query("cv_summary", ops=("V1",), sql=_CV_SQL + "\nSELECT candidate, mean, std, k FROM summ")
def q_cv_summary(spark, sf_dir):
    cv, _ = _cv(spark, sf_dir)
    return SE.cv_summary(cv)


@query("cv_comparison", ops=("V2",), sql=_CV_SQL + """
SELECT candidate, mean, std, round(mean - b.bm, 6) AS delta, round((mean - b.bm) / b.bs, 6) AS delta_in_base_std,
       row_number() OVER (ORDER BY mean DESC, candidate) AS rank
FROM summ, (SELECT mean AS bm, std AS bs FROM summ WHERE candidate = 0) b""")
def q_cv_comparison(spark, sf_dir):
    """Δ and Δ in base-std units against the base candidate, ranked."""
    cv, _ = _cv(spark, sf_dir)
    return SE.compare_to_base(SE.cv_summary(cv), BASE)


def _summary_with_complexity(cv):
    s = SE.cv_summary(cv)
    return s.withColumn("C", F.pow(F.lit(10.0), (F.col("candidate") % 6) - 3)) \
            .withColumn("l1", F.floor(F.col("candidate") / 6).cast("double"))


@query("one_se_choice", ops=("V6", "V7"), sql=_CV_SQL + """,
best AS (SELECT mean AS best_mean, candidate AS best_candidate, round(mean - std / sqrt(k), 6) AS cut FROM summ
         ORDER BY mean DESC, candidate LIMIT 1)
SELECT candidate, mean, std, k, "C", l1, best_mean, best_candidate, cut FROM summ, best WHERE mean >= cut
ORDER BY "C", l1 DESC, candidate LIMIT 1""")
def q_one_se_choice(spark, sf_dir):
    """1-SE rule: the simplest candidate (smallest C, then largest l1) within one standard error of the best."""
    cv, _ = _cv(spark, sf_dir)
    s = _summary_with_complexity(cv)
    return SE.one_se(s, [F.col("C").asc(), F.col("l1").desc(), F.col("candidate").asc()])


@query("cv_envelopes", ops=("V8",), sql=_CV_SQL + """,
best AS (SELECT mean AS m, std AS s FROM summ ORDER BY mean DESC, candidate LIMIT 1)
SELECT count(*) FILTER (WHERE mean >= m - s / sqrt(15)) AS inside_se, count(*) FILTER (WHERE mean >= m - s / sqrt(5)) AS inside_conservative,
       count(*) FILTER (WHERE mean >= m - s) AS inside_full_std, round(max(m - s / sqrt(15)), 6) AS cut_se,
       round(max(m - s / sqrt(5)), 6) AS cut_conservative, round(max(m - s), 6) AS cut_full_std FROM summ, best""")
def q_cv_envelopes(spark, sf_dir):
    cv, _ = _cv(spark, sf_dir)
    return SE.envelopes(SE.cv_summary(cv))


@query("grid_edge_warnings", ops=("V9",), sql=_CV_SQL + """,
best AS (SELECT mean - std / sqrt(k) AS cut FROM summ ORDER BY mean DESC, candidate LIMIT 1),
ch AS (SELECT "C", l1 FROM summ, best WHERE mean >= round(cut, 6) ORDER BY "C", l1 DESC, candidate LIMIT 1),
long AS (SELECT 'C' AS param, "C" AS value FROM ch UNION ALL SELECT 'l1', l1 FROM ch),
more AS (SELECT * FROM long UNION ALL SELECT * FROM (VALUES ('depth', 2.0), ('leaves', 1.0), ('rate', 0.0015), ('rate', 0.01)) x(param, value)),
grid AS (SELECT * FROM (VALUES ('C', 0.001, 100.0, false, true, false, false), ('l1', 0.0, 1.0, false, false, true, true),
         ('depth', 1.0, 20.0, false, false, false, false), ('leaves', 1.0, 20.0, false, false, false, false),
         ('rate', 0.001, 1.0, true, true, false, false))
         g(param, lo, hi, continuous, log_scale, natural_lo, natural_hi)),
j AS (SELECT l.param, l.value, g.*  EXCLUDE (param),
        CASE WHEN g.log_scale THEN (log10(l.value) - log10(g.lo)) / (log10(g.hi) - log10(g.lo)) ELSE (l.value - g.lo) / (g.hi - g.lo) END AS rel
      FROM more l JOIN grid g USING (param)),
e AS (SELECT *, (CASE WHEN continuous THEN rel < 0.1 ELSE value = lo END) AND NOT natural_lo AS low,
                (CASE WHEN continuous THEN rel > 0.9 ELSE value = hi END) AND NOT natural_hi AS high FROM j)
SELECT param, value, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, low OR high AS at_edge,
       CASE WHEN low THEN 'low' WHEN high THEN 'high' END AS side FROM e""")
def q_grid_edge_warnings(spark, sf_dir):
    """Is the 1-SE choice at the edge of the declared grid? (l1 ∈ [0, 1] has natural limits.) Beside it one value of a
    listed axis next to its end, one at it, and two of a continuous log axis."""
    cv, _ = _cv(spark, sf_dir)
    s = _summary_with_complexity(cv)
    ch = SE.one_se(s, [F.col("C").asc(), F.col("l1").desc(), F.col("candidate").asc()]).select("C", "l1")
    grid = spark.createDataFrame(
        [("C", 0.001, 100.0, False, True, False, False), ("l1", 0.0, 1.0, False, False, True, True),
         ("depth", 1.0, 20.0, False, False, False, False), ("leaves", 1.0, 20.0, False, False, False, False),
         ("rate", 0.001, 1.0, True, True, False, False)],
        "param string, lo double, hi double, continuous boolean, log_scale boolean, natural_lo boolean, natural_hi boolean")
    listed = ch.select("*", F.lit(2.0).alias("depth"), F.lit(1.0).alias("leaves"), F.lit(0.0015).alias("rate"))
    more = ch.limit(1).select(F.lit(0.01).alias("rate"))
    return SE.edge_warnings(listed, grid).unionByName(SE.edge_warnings(more, grid))


@query("paired_comparison", ops=("V10",), sql=_CV_SQL + """,
d AS (SELECT a.score - b.score AS d FROM cv a JOIN cv b ON a.rep = b.rep AND a.fold = b.fold WHERE a.candidate = 5 AND b.candidate = 0),
r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS rk FROM d)
SELECT count(*) AS n, round(avg(d), 6) AS mean_delta, count(*) FILTER (WHERE d > 0) AS wins,
       round(avg(d) / nullif(stddev_samp(d) / sqrt(count(*)), 0), 6) AS t_stat,
       round(least(coalesce(sum(CASE WHEN d > 0 THEN rk WHEN d = 0 THEN rk / 2 END), 0.0),
                   coalesce(sum(CASE WHEN d < 0 THEN rk WHEN d = 0 THEN rk / 2 END), 0.0)), 6) AS wilcoxon_w FROM r""")
def q_paired_comparison(spark, sf_dir):
    """Candidate 5 against the base on identical folds: mean Δ, wins, paired t, Wilcoxon W."""
    cv, _ = _cv(spark, sf_dir)
    return SE.paired(cv, 5, 0)


@query("paired_pvalues", ops=("V10",))
def q_paired_pvalues(spark, sf_dir):
    """Two-sided p-values (t, Wilcoxon zsplit) of every candidate against the base."""
    cv, _ = _cv(spark, sf_dir)
    pairs = cv.select(F.col("candidate").alias("a")).distinct().where(F.col("a") != BASE).withColumn("b", F.lit(BASE).cast("long"))
    return SE.paired_pvalues(cv, pairs)


@query("seed_vs_fold_variance", ops=("V14",), sql=_CV_SQL + """,
per AS (SELECT candidate, rep, avg(score) AS m, stddev_pop(score) AS s FROM cv GROUP BY ALL)
SELECT candidate, round(stddev_samp(m), 6) AS seed_std, round(avg(s), 6) AS fold_std FROM per GROUP BY candidate""")
def q_seed_vs_fold_variance(spark, sf_dir):
    cv, _ = _cv(spark, sf_dir)
    return SE.seed_vs_fold(cv)


_VAL_SQL = _CV_SQL + """,
va AS (SELECT customer_id, y_signal AS y, c AS candidate,
         CASE WHEN recency_days IS NULL THEN 1.0 ELSE round(recency_days / (recency_days + (60 + 40 * c)), 6) END AS score
       FROM sp, range(0, 12) z(c) WHERE split = 'val'),
curve AS (SELECT * FROM """ + cost_curve_sql("va", ["candidate"]) + """ c),
opt AS (SELECT candidate, arg_min(threshold, (cost, threshold)) AS own_threshold, min(cost) AS own_cost FROM curve GROUP BY candidate),
fin AS (SELECT a.candidate, a.ap, p.brier, o.own_threshold, o.own_cost, r.recall_at_k AS recall_at_10
        FROM """ + ap_sql("va", ["candidate"]) + """ a JOIN """ + point_sql("va", ["candidate"]) + """ p USING (candidate)
        JOIN opt o USING (candidate) JOIN (SELECT * FROM """ + recall_k_sql("va", ["candidate"], ks=(0.1,)) + """ x) r USING (candidate))"""


def _finalists(spark, sf_dir, sp=None):
    """Every candidate on the validation split; ``sp`` is the split when a caller has made it already."""
    sp = stratified_split(snapshot(spark, sf_dir)) if sp is None else sp
    va = _with_candidates(sp.where(F.col("split") == "val")).withColumn("y", F.col("y_signal"))
    ap = M.average_precision(va, by=["candidate"])
    pm = M.point_metrics(va, by=["candidate"]).select("candidate", "brier")
    opt = M.cost_optimum(M.cost_curve(va, by=["candidate"]), by=["candidate"]).select(
        "candidate", F.col("best_threshold").alias("own_threshold"), F.col("best_cost").alias("own_cost"))
    rk = M.recall_at_k(va, ks=(0.1,), by=["candidate"]).select("candidate", F.col("recall_at_k").alias("recall_at_10"))
    return ap.join(pm, "candidate").join(opt, "candidate").join(rk, "candidate")


@query("finalists_validation", ops=("V17", "M12", "M11"), sql=_VAL_SQL + "\nSELECT * FROM fin")
def q_finalists_validation(spark, sf_dir):
    """Every candidate on the validation split: AP, Brier, own cost-optimal threshold and cost, recall@10%."""
    return _finalists(spark, sf_dir)


@query("selection_bias", ops=("V15",), sql=_VAL_SQL + """,
best AS (SELECT mean - std / sqrt(k) AS cut FROM summ ORDER BY mean DESC, candidate LIMIT 1),
ch AS (SELECT candidate FROM summ, best WHERE mean >= round(cut, 6) ORDER BY "C", l1 DESC, candidate LIMIT 1),
t AS (SELECT s.candidate, round(f.ap - s.mean, 6) AS drop_val_minus_cv FROM summ s JOIN fin f USING (candidate))
SELECT c.candidate AS chosen, t1.drop_val_minus_cv AS chosen_drop, t0.drop_val_minus_cv AS control_drop,
       round(t1.drop_val_minus_cv - t0.drop_val_minus_cv, 6) AS excess
FROM ch c JOIN t t1 ON t1.candidate = c.candidate, (SELECT * FROM t WHERE candidate = 0) t0""")
def q_selection_bias(spark, sf_dir):
    """(validation − CV) of the 1-SE choice minus the same drop for the untuned control."""
    cv, sp = _cv(spark, sf_dir)
    fin = _finalists(spark, sf_dir, sp)
    s = _summary_with_complexity(cv)
    ch = SE.one_se(s, [F.col("C").asc(), F.col("l1").desc(), F.col("candidate").asc()]).select("candidate")
    t = s.join(fin, "candidate").select("candidate", r6(F.col("ap") - F.col("mean")).alias("drop"))
    c1 = ch.join(t, "candidate").select(F.col("candidate").alias("chosen"), F.col("drop").alias("chosen_drop"))
    c0 = t.where(F.col("candidate") == BASE).select(F.col("drop").alias("control_drop"))
    from ..operators.ranking import with_row
    return with_row(c1, c0) \
             .withColumn("excess", r6(F.col("chosen_drop") - F.col("control_drop")))


@query("promotion_gate", ops=("G1",), sql=_VAL_SQL + """
SELECT candidate, ap, brier, ap >= 0.66 AND brier <= 0.14 AS approved,
       CASE WHEN ap >= 0.66 AND brier <= 0.14 THEN 'approved' WHEN ap < 0.66 AND brier > 0.14 THEN 'ap and brier'
            WHEN ap < 0.66 THEN 'ap below floor' ELSE 'brier above ceiling' END AS reason FROM fin""")
def q_promotion_gate(spark, sf_dir):
    """Two-axis gate (AP ≥ 0.66 and Brier ≤ 0.14) for every finalist, with the failing axis named."""
    fin = _finalists(spark, sf_dir)
    return SE.gate(fin.select("candidate", "ap", "brier"))


@query("score_identity", ops=("G6",), sql=ctes("snapshot") + """
, b AS (SELECT o_custkey AS customer_id,
               round(date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '1999-07-01')
                     / (date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '1999-07-01') + 240.0), 6) AS score
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01 00:00:00' GROUP BY o_custkey),
  j AS (SELECT a.score AS s1, b.score AS s2 FROM (SELECT customer_id, score FROM snapshot) a FULL JOIN b USING (customer_id)),
  t AS (SELECT count(*) AS rows, max(abs(s1 - s2)) AS max_abs_diff,
               count(*) FILTER (WHERE (s1 >= 0.29) <> (s2 >= 0.29)) AS decisions_swapped,
               count(*) FILTER (WHERE s1 IS NULL OR s2 IS NULL) AS unmatched FROM j)
SELECT rows, round(CAST(max_abs_diff AS DOUBLE), 9) AS max_abs_diff, decisions_swapped, unmatched,
       max_abs_diff <= 1e-9 AND decisions_swapped = 0 AND unmatched = 0 AS identical FROM t""")
def q_score_identity(spark, sf_dir):
    """Scores of the snapshot path vs an independent recomputation from raw orders: identical values
    and no swapped decisions (joined on customer id, never on score). Customers without orders have a score in the
    snapshot alone and count as unmatched."""
    from ..sources.tables import load
    s = snapshot(spark, sf_dir).select("customer_id", "score")
    o = load(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("1999-07-01").cast("timestamp_ntz"))
    last = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.max(F.to_date("o_orderdate")).alias("last_d"))
    rec = F.datediff(F.to_date(F.lit("1999-07-01")), F.col("last_d"))
    b = last.select("customer_id", F.round(rec / (rec + 240.0), 6).alias("score"))
    out = SE.identity_check(s, b, "customer_id", threshold=0.29)
    return out.withColumn("max_abs_diff", F.round(F.col("max_abs_diff").cast("double"), 9))
