"""Streaming queries run to completion (Trigger.AvailableNow) over the events file (ST2, ST3, ST6)."""
from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import contract as CO
from ..operators import drift as D
from ..operators import models as MD
from ..operators.split import stratified_split
from ..session import materialize, scratch_path
from ..sources import adapters
from ..sources.tables import load
from ..streaming import panel as PN
from ..streaming import scoring as SC
from ..streaming import service as ST
from .common import log as log_frame
from .common import snapshot
from .q_monitor import _D, _psi, BASE_END
from .q_split import _SPLIT as SPLIT_SQL
from .registry import query
from .sql import ctes


@query("stream_service_panel", ops=("ST3", "L1", "L4"), sql=ctes("inference_log") + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, route, count(*) AS requests,
       count(*) FILTER (WHERE status_code >= 400) AS errors, count(score) AS with_predictions, max(latency_ms) AS max_latency
FROM inference_log GROUP BY ALL""")
def q_stream_service_panel(spark, sf_dir):
    """Hourly per-route panel computed by a streaming aggregation. ``complete`` output mode returns every
    window including the ones the watermark has not closed yet (append mode, used in production, emits
    a window once it is final). The panel state is one row per (hour, route), independent of volume."""
    log = ST.as_log(ST.event_stream(spark, sf_dir))
    out = ST.run_available_now(ST.service_panel_stream(log), "panel", output_mode="complete")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_dedup", ops=("ST2",), sql=ctes("inference_log") + """
SELECT 2 * count(*) AS rows_in, count(*) AS rows_out, count(DISTINCT request_id) AS distinct_requests FROM inference_log""")
def q_stream_dedup(spark, sf_dir):
    """Request-id de-duplication within the watermark: every record comes twice, every id is kept once."""
    twice = ST.as_log(ST.event_stream(spark, sf_dir)).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    n = 2 * load(spark, sf_dir, "events").count()
    out = ST.run_available_now(ST.dedup_stream(twice).select("request_id"), "dedup")
    return out.agg(F.lit(n).cast("long").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
                   F.count_distinct("request_id").alias("distinct_requests"))


@query("stream_volume_windows", ops=("ST4",), sql=ctes("inference_log") + """
, p AS (SELECT artifact, score, row_number() OVER (PARTITION BY artifact ORDER BY ts, request_id) AS rn
        FROM inference_log WHERE score IS NOT NULL)
SELECT artifact, CAST(floor((rn - 1) / 400) AS BIGINT) AS window_no, count(*) AS n, round(avg(score), 6) AS mean_score
FROM p GROUP BY ALL HAVING count(*) = 400""")
def q_stream_volume_windows(spark, sf_dir):
    """Closed windows of 400 predictions per artefact, kept in state; the rows arrive in no order of time."""
    log = ST.as_log(ST.event_stream(spark, sf_dir)).repartition(8, F.md5(F.col("request_id").cast("string")))
    return ST.run_available_now(ST.volume_windows_stream(log), "volume")


@query("stream_alerts", ops=("ST5",), sql=ctes("inference_log") + """
, m AS (SELECT route AS signal, date_trunc('day', ts) AS day, round(avg(CAST(status_code >= 400 AS DOUBLE)), 6) AS value
        FROM inference_log GROUP BY ALL),
  r AS (SELECT *, (min(CAST(value > 0.12 AS INTEGER)) OVER w2 = 1 AND count(*) OVER w2 = 2) AS run, value < 0.08 AS back
        FROM m WINDOW w2 AS (PARTITION BY signal ORDER BY day ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
  e AS (SELECT *, CASE WHEN run THEN 1 WHEN back THEN 0 END AS ev FROM r)
SELECT signal, CAST(day AS TIMESTAMP) AS window_start, value,
       coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY signal ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS alert
FROM e""")
def q_stream_alerts(spark, sf_dir):
    """Daily error-rate alerts per route by the streaming state machine, over the stream of written daily metrics."""
    daily = ST.as_log(load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))).groupBy(
        F.col("route").alias("signal"), F.date_trunc("day", "ts").alias("window_start")).agg(
        r6(F.avg((F.col("status_code") >= 400).cast("double"))).alias("value"))
    path = scratch_path(spark, "daily-metrics")
    daily.write.parquet(path)
    stream = spark.readStream.schema(daily.schema).parquet(path)
    out = ST.run_available_now(ST.alert_stream(stream, 0.12, 0.08, 2), "alerts")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_late_outcomes", ops=("ST6",), sql=ctes("inference_log") + """
, o AS (SELECT request_id, ts + to_days(CAST(request_id % 90 AS INTEGER)) AS outcome_ts FROM inference_log
        WHERE score IS NOT NULL AND request_id % 3 <> 0)
SELECT p.request_id, round(p.score, 6) AS score, date_diff('day', p.ts, o.outcome_ts) AS delay_days
FROM inference_log p JOIN o USING (request_id) WHERE p.score IS NOT NULL""")
def q_stream_late_outcomes(spark, sf_dir):
    """Predictions joined with their late outcomes, both as streams, bounded in time by the label delay."""
    log = ST.as_log(ST.event_stream(spark, sf_dir)).where("score IS NOT NULL").select("request_id", "ts", "score")
    late = ST.as_log(load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))).where(
        "score IS NOT NULL AND request_id % 3 <> 0").select(
        F.col("request_id").alias("o_request_id"), (F.col("ts") + F.expr("make_interval(0, 0, 0, request_id % 90)")).alias("outcome_ts"))
    path = scratch_path(spark, "outcomes")
    late.write.parquet(path)
    out = ST.run_available_now(ST.late_outcome_join(log, spark.readStream.schema(late.schema).parquet(path)), "late")
    return out.select("request_id", "score", F.datediff("outcome_ts", "ts").cast("long").alias("delay_days"))


@query("stream_validated_log", ops=("ST1",), sql=ctes("inference_log") + """
SELECT request_id, artifact, CASE WHEN status_code = 200 AND (score IS NULL OR score < 0 OR score > 1 OR latency_ms IS NULL) THEN 'quarantine'
       WHEN status_code = 200 THEN 'accepted' ELSE 'rejected' END AS sink,
       CASE WHEN status_code = 200 THEN coalesce(score >= 0.5, false) END AS decision FROM inference_log""")
def q_stream_validated_log(spark, sf_dir):
    """Each record validated, routed and decided as it streams by (a projection: no state)."""
    log = ST.as_log(ST.event_stream(spark, sf_dir))
    ok = F.col("status_code") == 200
    bad = F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1) | F.col("latency_ms").isNull()
    routed = log.select("request_id", "artifact",
                        F.when(ok & bad, "quarantine").when(ok, "accepted").otherwise("rejected").alias("sink"),
                        F.when(ok, F.coalesce(F.col("score") >= 0.5, F.lit(False))).alias("decision"))
    return ST.run_available_now(routed, "routed")


# ---- ST3: latency percentiles, score drift and late rows -----------------------------------------------

def _arrivals(spark, sf_dir):
    """Stand-in for a growing log folder: the log as six-day files in order of arrival. Every 13th record arrives nine
    days late, every 29th is delivered once more six days later. Returns the stream of one file a trigger."""
    log = ST.as_log(load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    rid, at = F.col("request_id"), F.col("ts")
    first = log.withColumn("arrival", F.when(rid % 13 == 0, at + F.expr("INTERVAL 9 DAYS")).otherwise(at))
    again = log.where(rid % 29 == 0).withColumn("arrival", at + F.expr("INTERVAL 6 DAYS"))
    sliced = materialize(first.unionByName(again).withColumn("slice", F.floor((F.dayofyear("arrival") - 1) / 6).cast("int")), "arrivals")
    path = scratch_path(spark, "log-folder")
    for row in sliced.select("slice").distinct().orderBy("slice").collect():     # a file for each six days
        sliced.where(F.col("slice") == row["slice"]).select(*log.columns).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _baseline(spark, sf_dir):
    """Edges and shares of the scores of the first ten days, as the frozen baseline."""
    scored = log_frame(spark, sf_dir).where(F.col("score").isNotNull() & (F.col("ts") < F.lit(BASE_END).cast("timestamp_ntz")))
    row = D.score_baseline(scored, threshold=0.5).select("edges", "props").first()      # one row, ten bins
    return list(row["edges"]), list(row["props"])


_ARRIVALS_SQL = ctes("inference_log") + """
, arr AS (SELECT *, CASE WHEN request_id % 13 = 0 THEN ts + INTERVAL 9 DAY ELSE ts END AS arrival FROM inference_log
          UNION ALL SELECT *, ts + INTERVAL 6 DAY FROM inference_log WHERE request_id % 29 = 0),
  tr AS (SELECT *, dense_rank() OVER (ORDER BY floor((dayofyear(arrival) - 1) / 6)) - 1 AS trig FROM arr),
  mx AS (SELECT trig, max(ts) AS m FROM tr GROUP BY trig),
  wm AS (SELECT t.trig, date_trunc('millisecond', max(o.m)) - INTERVAL 2 DAY AS old FROM mx t LEFT JOIN mx o ON o.trig <= t.trig - 2 GROUP BY t.trig),
  j AS (SELECT tr.*, coalesce(ts <= old, false) AS late FROM tr JOIN wm USING (trig))"""

_G = "(1.01::DOUBLE / 0.99)"


def _told(q: float) -> str:
    return f"round(2 * pow({_G}, bs[CAST(floor(1 + {q}::DOUBLE * (len(bs) - 1)) AS INTEGER)]) / ({_G} + 1), 3)"


@query("stream_latency_panel", ops=("ST3", "L1", "L3", "L4", "L6", "D11"), sql=_ARRIVALS_SQL + f"""
, ref AS (SELECT score FROM inference_log WHERE ts < TIMESTAMP '{BASE_END} 00:00:00' AND score IS NOT NULL),
  rstat AS (SELECT count(*) AS n, list_sort(list_distinct(list_transform(quantile_cont(score, {_D}), lambda x: round(x, 6)))) AS edges FROM ref),
  rcount AS (SELECT len(list_filter(s.edges, lambda e: e <= r.score)) AS bin, count(*) AS c FROM ref r, rstat s GROUP BY ALL),
  rprops AS (SELECT k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS e
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin, n FROM rstat) k LEFT JOIN rcount c USING (bin)),
  once AS (SELECT DISTINCT ON (request_id) *, date_trunc('day', ts) AS day FROM j WHERE NOT late),
  closed AS (SELECT * FROM once WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM j)),
  p AS (SELECT day, route, count(*) AS requests, count(*) FILTER (status_code >= 400) AS errors, round(max(latency_ms), 3) AS max,
               count(score) AS with_predictions, list_sort(list(ceil(ln(latency_ms) / ln({_G})))) AS bs FROM closed GROUP BY ALL),
  c AS (SELECT day, route, len(list_filter(s.edges, lambda e: e <= score)) AS bin, count(*) AS c FROM closed, rstat s WHERE score IS NOT NULL GROUP BY ALL),
  v AS (SELECT p.day, p.route, round(sum({_psi('r.e', 'coalesce(c.c / p.with_predictions, 0.0)')}), 6) AS psi
        FROM p CROSS JOIN rprops r LEFT JOIN c ON c.day = p.day AND c.route = p.route AND c.bin = r.bin WHERE p.with_predictions > 0 GROUP BY ALL)
SELECT p.day AS window_start, p.route, requests, errors, round(errors / requests, 4) AS error_rate, {_told(0.5)} AS p50, {_told(0.95)} AS p95,
       {_told(0.99)} AS p99, max, with_predictions, psi,
       CASE WHEN psi IS NULL THEN 'no-data' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'investigate' ELSE 'act' END AS class
FROM p LEFT JOIN v USING (day, route)""")
def q_stream_latency_panel(spark, sf_dir):
    """Daily panel per route of a stream with late and repeated records, over several triggers in append mode: counts,
    latency percentiles within 1 %, and the PSI of the scores against a frozen baseline."""
    out, _ = PN.run_panel(_arrivals(spark, sf_dir), *_baseline(spark, sf_dir), by=["route"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_late_rows", ops=("ST3",), sql=_ARRIVALS_SQL + """
SELECT CAST(trig AS BIGINT) AS "trigger", count(*) AS rows_in, count(*) FILTER (late) AS late_rows FROM j GROUP BY trig""")
def q_stream_late_rows(spark, sf_dir):
    """Rows of each trigger and those among them that were dropped as late, from Spark's metric of the operator that drops them."""
    _, late = PN.run_panel(_arrivals(spark, sf_dir), *_baseline(spark, sf_dir), by=["route"])
    return late.where("rows_in > 0")


# ---- ST1: validate and score in the stream, killed and started again ------------------------------------

_SCORED_NUMS, _SCORED_ZERO = ["tenure_days", "monthly_charges"], ["total_charges"]
_SCORED_CATS = ["segment", "region", "balance_sign", "last_priority"]
_LIMITS = {"tenure_days": (0.0, 20000.0), "monthly_charges": (0.0, 1e6), "total_charges": (0.0, 1e8)}


def _field_errors_sql() -> str:
    out = [f"CASE WHEN {c} IS NULL THEN '{c}:missing' END" for c in [*_SCORED_NUMS, *_SCORED_CATS]]
    out += [f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN '{c}:out_of_range' END" for c, (lo, hi) in _LIMITS.items()]
    out += [f"CASE WHEN {c} NOT IN (SELECT {c} FROM sp WHERE split = 'train' AND {c} IS NOT NULL) THEN '{c}:unknown_category' END" for c in _SCORED_CATS]
    return "list_sort(list_filter([" + ", ".join(out) + "], lambda x: x IS NOT NULL))"


class _Killed(RuntimeError):
    pass


@query("stream_scored_requests", ops=("ST1", "P10", "P11", "P19", "M-I"), sql=SPLIT_SQL + f"""
, dirty AS (
  SELECT customer_id, CASE WHEN customer_id % 50 = 0 THEN 'UNKNOWN' ELSE segment END AS segment, region, balance_sign, last_priority,
         CASE WHEN customer_id % 53 = 0 THEN -999.0 ELSE tenure_days END AS tenure_days,
         CASE WHEN customer_id % 59 = 0 THEN NULL ELSE monthly_charges END AS monthly_charges,
         CASE WHEN customer_id % 61 = 0 THEN NULL WHEN customer_id % 67 = 0 THEN 1e9 ELSE total_charges END AS total_charges,
         CAST(floor(customer_id / 3) AS BIGINT) AS request_id FROM sp),
  e AS (SELECT customer_id, request_id, array_to_string({_field_errors_sql()}, ',') AS errors FROM dirty),
  r AS (SELECT request_id, bool_or(errors <> '') AS bad FROM e GROUP BY 1)
SELECT customer_id, e.request_id, CASE WHEN bad THEN 'quarantine' ELSE 'accepted' END AS sink, CASE WHEN bad THEN 422 ELSE 200 END AS status_code,
       errors, CASE WHEN NOT bad THEN true END AS as_in_batch FROM e JOIN r USING (request_id)""")
def q_stream_scored_requests(spark, sf_dir):
    """Requests of three rows, validated by the contract of the fitted pipeline and scored by it as they stream by. The
    job dies in its second trigger with one of two sinks written and is started again; every row is in one sink once,
    and accepted rows have the score that the pipeline gives them in batch."""
    snap = snapshot(spark, sf_dir)
    split = stratified_split(snap)
    model = MD.fit_pipeline(split.where(F.col("split") == "train"), "lr", _SCORED_ZERO, _SCORED_NUMS, _SCORED_CATS, label="y_signal")
    dirty = adapters.dirty_payload(snap).withColumn("request_id", F.floor(F.col("customer_id") / 3))
    source, out, checkpoint = (scratch_path(spark, n) for n in ("requests", "scored", "scored-checkpoint"))
    dirty.repartition(4, "request_id").write.parquet(source)                            # a request lies in one file
    stream = spark.readStream.schema(dirty.schema).option("maxFilesPerTrigger", 1).parquet(source)
    contract = CO.contract_from_model(model, _LIMITS)

    def die(trigger: int, sink: str) -> None:
        if (trigger, sink) == (1, "accepted"):
            raise _Killed("between the two sinks")
    first = SC.ScoringJob(contract, model, 0.29, CO.version(contract), out, after_write=die)
    try:
        first.run(stream, checkpoint)
    except StreamingQueryException as e:
        if "between the two sinks" not in str(e):
            raise
    SC.ScoringJob(contract, model, 0.29, CO.version(contract), out).run(stream, checkpoint)
    ok, bad, requests = (SC.committed(spark, out, s) for s in SC.SINKS)
    batch = MD.score(model, ok.select(*dirty.columns)).select(F.col("customer_id").alias("c"), F.col("probability").alias("again"))
    accepted = ok.join(batch, F.col("customer_id") == F.col("c")).select(
        "customer_id", "request_id", F.lit("accepted").alias("sink"), F.lit("").alias("errors"), (F.col("probability") == F.col("again")).alias("as_in_batch"))
    refused = bad.select("customer_id", "request_id", F.lit("quarantine").alias("sink"), F.array_join(F.array_sort(F.transform(
        "errors", lambda x: F.concat(x["field"], F.lit(":"), x["type"]))), ",").alias("errors"), F.lit(None).cast("boolean").alias("as_in_batch"))
    return accepted.unionByName(refused).join(requests.select("request_id", "status_code"), "request_id").select(
        "customer_id", "request_id", "sink", "status_code", "errors", "as_in_batch")
