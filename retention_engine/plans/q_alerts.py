"""Alert policies over the window metrics of the inference log, in batch and as a stream (L12, ST5)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import alerts as AL
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import monitor as MO
from ..operators.ranking import with_row
from ..session import materialize, scratch_path
from ..sources import adapters
from ..streaming import service as ST
from .common import log
from .q_monitor import _D, _OUT_SQL, _psi, BASE_END
from .registry import query
from .sqlmetrics import ap_sql

#: Parameters of these queries: limits that the test log crosses, beside those the service is run by.
TIGHT = [
    ("server errors, test", "share_5xx", "above", 0.20, 0.18, 2, "read the log"),
    ("refused requests, test", "share_4xx", "above", 0.022, 0.015, 1, "contract broken upstream"),
    ("slow, test", "latency_p95", "above", 150.0, 140.0, 2, "compare network and application time"),
    ("volume, test", "volume_ratio", "below", 0.95, 1.0, 2, "failure upstream"),
    ("score drift, test", "score_psi", "above", 0.03, 0.015, 1, "check integrity"),
    ("queue size, test", "queue_deviation", "above", 0.08, 0.03, 2, "talk to operations"),
    ("calibration, test", "brier", "above", 0.21, 0.205, 1, "recalibrate"),
]


def window_metrics(spark, sf_dir) -> DataFrame:
    """(signal, entity, window_start, value) by day (Brier and average precision by weekly lot of labels), written."""
    lg = log(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))
    share = lambda lo: r6(F.avg(((F.col("status_code") >= lo) & (F.col("status_code") < lo + 100)).cast("double")))
    shares = lg.groupBy("day").agg(share(500).alias("s5"), share(400).alias("s4"))
    p95 = MO.latency_percentiles(lg, by=["route", "day"]).select("route", "day", "p95")
    daily = lg.groupBy("artifact", "day").agg(F.count_if(F.col("score").isNotNull()).alias("volume"))
    ratio = MO.volume_ratio(daily, "volume", ["artifact"], "day")
    scored = lg.where(F.col("score").isNotNull())
    cut = F.lit(BASE_END).cast("timestamp_ntz")
    later = scored.where(F.col("ts") >= cut)
    base = D.score_baseline(scored.where(F.col("ts") < cut), threshold=0.5)
    drift = D.compare_scores(with_row(later.select("day").distinct(), base), later, by=["day"])
    deviation = F.abs(F.col("rate_above") / F.col("rate_above_ref") - 1)
    lots = MO.reconcile(scored, adapters.outcomes(lg)).withColumn("lot", F.date_trunc("week", "ts"))
    lots = materialize(lots, "lots")
    precision = M.average_precision(lots, by=["lot"])
    lots = lots.groupBy("lot").agg(r6(F.avg(F.pow(F.col("score") - F.col("y"), 2))).alias("brier"))
    every = F.lit("all")
    parts = [AL.signal(shares, "share_5xx", every, "day", F.col("s5")), AL.signal(shares, "share_4xx", every, "day", F.col("s4")),
             AL.signal(p95, "latency_p95", F.col("route"), "day", F.col("p95")),
             AL.signal(ratio, "volume_ratio", F.col("artifact"), "day", F.col("ratio")),
             AL.signal(drift, "score_psi", every, "day", F.col("psi")),
             AL.signal(drift, "queue_deviation", every, "day", r6(deviation)),
             AL.signal(lots, "brier", every, "lot", F.col("brier")),
             AL.signal(precision, "average_precision", every, "lot", F.col("ap"))]
    return materialize(reduce(DataFrame.unionByName, parts), "window-metrics")


def _values(rows) -> str:
    text = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


_METRICS_SQL = _OUT_SQL + f"""
, lg AS (SELECT *, date_trunc('day', ts) AS day FROM inference_log),
  ref AS (SELECT score FROM lg WHERE ts < TIMESTAMP '{BASE_END} 00:00:00' AND score IS NOT NULL),
  rstat AS (SELECT count(*) AS n, round(avg(CAST(score >= 0.5 AS DOUBLE)), 6) AS rate,
            list_sort(list_distinct(list_transform(quantile_cont(score, {_D}), lambda x: round(x, 6)))) AS edges FROM ref),
  rcount AS (SELECT len(list_filter(s.edges, lambda e: e <= r.score)) AS bin, count(*) AS c FROM ref r, rstat s GROUP BY ALL),
  rprops AS (SELECT k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS e
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin, n FROM rstat) k LEFT JOIN rcount c USING (bin)),
  win AS (SELECT day, score FROM lg WHERE ts >= TIMESTAMP '{BASE_END} 00:00:00' AND score IS NOT NULL),
  wstat AS (SELECT day, count(*) AS n, round(avg(CAST(score >= 0.5 AS DOUBLE)), 6) AS rate FROM win GROUP BY day),
  wcount AS (SELECT day, len(list_filter(s.edges, lambda e: e <= w.score)) AS bin, count(*) AS c FROM win w, rstat s GROUP BY ALL),
  psi AS (SELECT ws.day, round(sum({_psi('p.e', 'coalesce(w.c / ws.n, 0.0)')}), 6) AS v
          FROM rprops p CROSS JOIN wstat ws LEFT JOIN wcount w ON w.bin = p.bin AND w.day = ws.day GROUP BY ws.day),
  daily AS (SELECT artifact, day, count(*) FILTER (WHERE score IS NOT NULL) AS volume FROM lg GROUP BY ALL),
  med AS (SELECT *, median(volume) OVER (PARTITION BY artifact ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS m FROM daily),
  metric AS (
    SELECT 'share_5xx' AS signal, 'all' AS entity, day AS window_start, round(avg(CAST(status_code BETWEEN 500 AND 599 AS DOUBLE)), 6) AS value FROM lg GROUP BY day
    UNION ALL SELECT 'share_4xx', 'all', day, round(avg(CAST(status_code BETWEEN 400 AND 499 AS DOUBLE)), 6) FROM lg GROUP BY day
    UNION ALL SELECT 'latency_p95', route, day, CAST(round(CAST(quantile_cont(latency_ms, 0.95) AS DECIMAL(20,6)), 3) AS DOUBLE) FROM lg GROUP BY route, day
    UNION ALL SELECT 'volume_ratio', artifact, day, round(volume / m, 6) FROM med
    UNION ALL SELECT 'score_psi', 'all', day, v FROM psi
    UNION ALL SELECT 'queue_deviation', 'all', w.day, round(abs(w.rate / r.rate - 1), 6) FROM wstat w, rstat r
    UNION ALL SELECT 'brier', 'all', lot, round(avg(pow(score - y, 2)), 6) FROM lots GROUP BY lot
    UNION ALL SELECT 'average_precision', 'all', lot, ap FROM {ap_sql('lots', ['lot'])}),
  pol(policy, signal, direction, opens, closes, k, "action") AS (VALUES {_values([*AL.POLICIES, *TIGHT])}),
  o AS (SELECT policy, entity, window_start, value, k, "action", m.signal,
               coalesce(CASE direction WHEN 'above' THEN value > opens ELSE value < opens END, false) AS beyond,
               coalesce(CASE direction WHEN 'above' THEN value < closes ELSE value > closes END, false) AS back,
               row_number() OVER (PARTITION BY policy, entity ORDER BY window_start) AS i
        FROM metric m JOIN pol USING (signal)),
  s AS (SELECT *, i - coalesce(max(CASE WHEN NOT beyond THEN i END) OVER (PARTITION BY policy, entity ORDER BY i), 0) AS run FROM o),
  e AS (SELECT *, CASE WHEN beyond AND run >= k THEN 1 WHEN back THEN 0 END AS ev FROM s),
  alerted AS (SELECT *, coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY policy, entity ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS alert FROM e)"""
_ALERTS_SQL = _METRICS_SQL + """
SELECT policy, signal, entity, CAST(window_start AS TIMESTAMP) AS window_start, value, "action", alert FROM alerted"""


def _policies(spark) -> DataFrame:
    return AL.policy_table(spark, [*AL.POLICIES, *TIGHT])


@query("alert_policies", ops=("L12",), sql=_ALERTS_SQL)
def q_alert_policies(spark, sf_dir):
    """Every policy on the log's window metrics (error shares, latency by route, volume by artefact, score drift, queue
    size, Brier, average precision), with the state of its alert after each window."""
    out = AL.evaluate(window_metrics(spark, sf_dir), _policies(spark))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("alert_episodes", ops=("L12",), sql=_METRICS_SQL + """
, b AS (SELECT *, sum(CAST(alert AND NOT before AS INTEGER)) OVER (PARTITION BY policy, entity ORDER BY i) AS no
        FROM (SELECT *, coalesce(lag(alert) OVER (PARTITION BY policy, entity ORDER BY i), false) AS before FROM alerted))
SELECT policy, entity, CAST(min(window_start) FILTER (alert) AS TIMESTAMP) AS opened, CAST(min(window_start) FILTER (NOT alert) AS TIMESTAMP) AS closed,
       count(*) FILTER (alert) AS n_windows, min(value) FILTER (alert) AS lowest, max(value) FILTER (alert) AS highest, max("action") AS "action"
FROM b WHERE no > 0 GROUP BY policy, entity, no""")
def q_alert_episodes(spark, sf_dir):
    """Each time an alert was on, with the windows that opened and closed it and the action its policy asks for."""
    out = AL.episodes(AL.evaluate(window_metrics(spark, sf_dir), _policies(spark)))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("opened", "closed")})


@query("stream_alert_policies", ops=("L12", "ST5"), sql=_ALERTS_SQL)
def q_stream_alert_policies(spark, sf_dir):
    """The same policies as a stream of window metrics, a file of ten days a trigger, with the alert state kept by policy
    and entity from trigger to trigger."""
    metrics = window_metrics(spark, sf_dir)
    path = scratch_path(spark, "metrics-folder")
    part = F.floor((F.dayofyear("window_start") - 1) / 10)
    for row in metrics.select(part.alias("part")).distinct().orderBy("part").collect():      # a file for each ten days
        metrics.where(part == row["part"]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(metrics.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = ST.run_available_now(AL.evaluate_stream(stream, _policies(spark)), "policies")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
