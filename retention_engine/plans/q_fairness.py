"""Fairness audit queries over labelled documents (Q1–Q6)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fairness as FA
from ..sources import adapters
from .registry import query
from .sql import ctes
from .sqlmetrics import cost_curve_sql

ATTRS = ["lang", "source"]
T_OP = 0.5
QL = ctes("quality_labels")

_RATES_SQL = """
, long AS (SELECT * FROM (SELECT score, y, lang, source FROM quality_labels)
           UNPIVOT (grp FOR attr IN (lang, source))),
  rates AS (SELECT attr, grp AS "group", count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
              count(*) FILTER (WHERE score >= {t} AND y = 1) AS tp,
              avg(CAST(score >= {t} AS DOUBLE)) AS sel, avg(CAST(y AS DOUBLE)) AS prev
            FROM long GROUP BY attr, grp),
  r AS (SELECT attr, "group", n, positives, tp, round(tp / nullif(positives, 0), 6) AS recall,
          round(1 - tp / nullif(positives, 0), 6) AS fnr, round(sel, 6) AS selection_rate,
          round(prev, 6) AS prevalence, positives >= 30 AS reliable FROM rates)"""


@query("fairness_groups", ops=("Q1", "Q5"), sql=QL.rstrip("\n") + _RATES_SQL.format(t="0.5::DOUBLE") + "\nSELECT * FROM r")
def q_fairness_groups(spark, sf_dir):
    """Per (attribute, group): n, positives, recall, FNR, selection rate, prevalence, reliability."""
    return FA.group_rates(adapters.quality_labels(spark, sf_dir), ATTRS, T_OP)


@query("fairness_disparity", ops=("Q3", "Q4"), sql=QL.rstrip("\n") + _RATES_SQL.format(t="0.5::DOUBLE") + """
SELECT attr, round(max(recall) - min(recall), 6) AS disparity, arg_min("group", (recall, "group")) AS worst_group,
       min(recall) AS worst_recall, round(max(recall) - min(recall), 6) <= 0.1 AS within_limit
FROM r WHERE recall IS NOT NULL GROUP BY attr""")
def q_fairness_disparity(spark, sf_dir):
    """Recall disparity (max − min) per attribute, the worst group and the policy check (≤ 10 pp)."""
    return FA.disparity(FA.group_rates(adapters.quality_labels(spark, sf_dir), ATTRS, T_OP))


@query("fairness_recall_ci", ops=("Q2",))
def q_fairness_recall_ci(spark, sf_dir):
    """Clopper-Pearson 95 % interval per group recall (pandas UDF over the aggregated group rows)."""
    return FA.recall_ci(FA.group_rates(adapters.quality_labels(spark, sf_dir), ATTRS, T_OP))


@query("fairness_group_thresholds", ops=("Q6", "M11"), sql=QL + f"""
, curve AS (SELECT * FROM {cost_curve_sql('quality_labels', ['lang'])} c)
SELECT lang, arg_min(threshold, (cost, threshold)) AS best_threshold, min(cost) AS best_cost,
       max(cost) FILTER (WHERE threshold = 0.5) AS cost_at_05 FROM curve GROUP BY lang""")
def q_fairness_group_thresholds(spark, sf_dir):
    """Cheapest threshold per language group."""
    return FA.group_thresholds(adapters.quality_labels(spark, sf_dir), "lang")


@query("fairness_mitigated", ops=("Q6", "Q1"), sql=QL + f"""
, curve AS (SELECT * FROM {cost_curve_sql('quality_labels', ['lang'])} c),
  th AS (SELECT lang, arg_min(threshold, (cost, threshold)) AS t_group FROM curve GROUP BY lang),
  d AS (SELECT q.*, th.t_group FROM quality_labels q JOIN th USING (lang))
SELECT lang AS "group", count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
       round(count(*) FILTER (WHERE score >= t_group AND y = 1) / nullif(sum(y), 0), 6) AS recall,
       round(avg(CAST(score >= t_group AS DOUBLE)), 6) AS selection_rate, max(t_group) AS threshold
FROM d GROUP BY lang""")
def q_fairness_mitigated(spark, sf_dir):
    """Audit re-run with each language's own cheapest threshold (joined back by group)."""
    q = adapters.quality_labels(spark, sf_dir)
    th = FA.group_thresholds(q, "lang").select("lang", F.col("best_threshold").alias("t_group"))
    d = q.join(th, "lang")
    r = FA.group_rates(d, ["lang"], threshold_col="t_group")
    t = th.withColumnRenamed("lang", "group")
    return r.join(t, "group").select("group", "n", "positives", "recall", "selection_rate",
                                     F.col("t_group").alias("threshold"))
