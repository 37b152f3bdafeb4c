"""Exploratory profiling queries over the customer snapshot."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PF
from .common import snapshot
from .registry import query
from .sql import ctes

S = ctes("snapshot")
NUMS = ["tenure_days", "monthly_charges", "total_charges", "recency_days", "value"]
CATS = ["segment", "region", "balance_sign", "last_priority"]
ALL = ["segment", "region", "balance_sign", "last_priority"] + NUMS


@query("target_distribution", ops=("E1", "M10"), sql=S + """
SELECT y, count(*) AS n, round(count(*) / (SELECT count(*) FROM snapshot), 6) AS share FROM snapshot GROUP BY y""")
def q_target_distribution(spark, sf_dir):
    return PF.target_distribution(snapshot(spark, sf_dir))


@query("null_pattern", ops=("E2",), sql=S + f"""
SELECT "column", y, CAST(sum(is_null) AS BIGINT) AS nulls FROM (
  SELECT * FROM (SELECT y, {', '.join(f'CAST({c} IS NULL AS INTEGER) AS {c}' for c in ALL)} FROM snapshot)
  UNPIVOT (is_null FOR "column" IN ({', '.join(ALL)}))) GROUP BY ALL""")
def q_null_pattern(spark, sf_dir):
    """Null count per column and class (leakage by null pattern)."""
    return PF.null_pattern(snapshot(spark, sf_dir), ALL)


@query("by_class_stats", ops=("E3",), sql=S + """
SELECT y, round(avg(score), 6) AS mean, round(min(score), 6) AS min, round(max(score), 6) AS max FROM snapshot GROUP BY y""")
def q_by_class_stats(spark, sf_dir):
    return PF.by_class_stats(snapshot(spark, sf_dir), "score")


@query("degenerate_columns", ops=("E4",), sql=S + f"""
SELECT "column", count(DISTINCT v) AS n_distinct, count(DISTINCT v) <= 1 AS degenerate FROM (
  SELECT * FROM (SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in ALL)} FROM snapshot)
  UNPIVOT (v FOR "column" IN ({', '.join(ALL)}))) GROUP BY ALL""")
def q_degenerate_columns(spark, sf_dir):
    return PF.degenerate_columns(snapshot(spark, sf_dir), ALL)


_LEVEL_SQL = S + f"""
, lv AS (SELECT feature, level, count(*) AS n, avg(CAST(y AS DOUBLE)) AS rate FROM (
  SELECT * FROM (SELECT y, {', '.join(CATS)} FROM snapshot) UNPIVOT (level FOR feature IN ({', '.join(CATS)}))) GROUP BY ALL)"""


@query("rate_amplitude", ops=("E5", "E7"), sql=_LEVEL_SQL + """
SELECT feature, round((max(rate) - min(rate)) * 100, 1) AS amplitude_pp, count(*) AS levels FROM lv GROUP BY feature""")
def q_rate_amplitude(spark, sf_dir):
    """Target-rate amplitude (pp) per categorical, including the sensitive attributes."""
    return PF.rate_amplitude(snapshot(spark, sf_dir), CATS)


@query("level_rates", ops=("E5", "E7"), sql=_LEVEL_SQL + "SELECT feature, level, n, round(rate, 6) AS rate FROM lv")
def q_level_rates(spark, sf_dir):
    return PF.level_rates(snapshot(spark, sf_dir), CATS)


@query("outliers_corr", ops=("E8",), sql=S + f"""
, long AS (SELECT * FROM (SELECT y, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMS)} FROM snapshot)
           UNPIVOT (value FOR feature IN ({', '.join(NUMS)}))),
  st AS (SELECT feature, avg(value) AS m, stddev_samp(value) AS s, round(min(value), 6) AS min, round(max(value), 6) AS max,
                round(corr(value, CAST(y AS DOUBLE)), 6) AS corr_target FROM long GROUP BY feature)
SELECT st.feature, st.min, st.max, st.corr_target,
       (SELECT count(*) FROM long l WHERE l.feature = st.feature AND abs((l.value - st.m) / st.s) > 3) AS outliers FROM st""")
def q_outliers_corr(spark, sf_dir):
    return PF.outliers_and_corr(snapshot(spark, sf_dir), NUMS)


@query("redundancy", ops=("E9",), sql=S + """
, d AS (SELECT total_charges AS t, monthly_charges * (tenure_days / 30.0) AS ab FROM snapshot WHERE tenure_days > 0)
SELECT round(corr(t, ab), 6) AS corr, count(*) AS n, round(quantile_cont(abs((t - ab) / t), 0.5), 6) AS median_rel_error FROM d""")
def q_redundancy(spark, sf_dir):
    """Is total ≈ monthly × tenure? correlation and median relative error on customers with tenure."""
    s = snapshot(spark, sf_dir).withColumn("tenure_months", F.col("tenure_days") / 30.0)
    return PF.redundancy(s, "total_charges", "monthly_charges", "tenure_months", F.col("tenure_days") > 0)


@query("quartile_rates", ops=("E10",), sql=S + """
, d AS (SELECT total_charges / monthly_charges AS r, y FROM snapshot WHERE total_charges / monthly_charges IS NOT NULL),
  e AS (SELECT quantile_cont(r, [0.25, 0.5, 0.75]) AS q FROM d)
SELECT CAST(len(list_filter(e.q, lambda x: x < d.r)) AS INTEGER) AS quartile, count(*) AS n,
       round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM d, e GROUP BY 1""")
def q_quartile_rates(spark, sf_dir):
    """Churn rate by quartile of the orders-count ratio (total / monthly), right-closed quartile bins."""
    s = snapshot(spark, sf_dir).withColumn("r", F.col("total_charges") / F.col("monthly_charges"))
    return PF.quartile_rates(s.where(F.col("r").isNotNull()), "r")


@query("zero_denominator", ops=("E11",), sql=S + """
SELECT count(*) FILTER (WHERE tenure_days = 0) AS tenure_zero, count(*) FILTER (WHERE total_charges IS NULL) AS total_blank,
       bool_and((tenure_days = 0) = (total_charges IS NULL)) AS blank_iff_new FROM snapshot""")
def q_zero_denominator(spark, sf_dir):
    s = snapshot(spark, sf_dir)
    return s.agg(F.count_if(F.col("tenure_days") == 0).alias("tenure_zero"),
                 F.count_if(F.col("total_charges").isNull()).alias("total_blank"),
                 F.bool_and((F.col("tenure_days") == 0) == F.col("total_charges").isNull()).alias("blank_iff_new"))


@query("crosstab_shares", ops=("E12",), sql=S + """
SELECT segment, last_priority, n, round(n / sum(n) OVER (PARTITION BY segment), 6) AS row_share
FROM (SELECT segment, last_priority, count(*) AS n FROM snapshot GROUP BY segment, last_priority) c""")
def q_crosstab_shares(spark, sf_dir):
    return PF.crosstab_shares(snapshot(spark, sf_dir), "segment", "last_priority")


@query("cardinality", ops=("E13",), sql=S + f"""
SELECT "column", count(DISTINCT v) AS n_distinct, (SELECT count(*) FROM snapshot) AS rows,
       round((SELECT count(*) FROM snapshot) / count(DISTINCT v), 1) AS rows_per_level FROM (
  SELECT * FROM (SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in CATS)} FROM snapshot)
  UNPIVOT (v FOR "column" IN ({', '.join(CATS)}))) GROUP BY ALL""")
def q_cardinality(spark, sf_dir):
    return PF.cardinality(snapshot(spark, sf_dir), CATS)
