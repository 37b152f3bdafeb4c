"""Service-monitoring queries over the inference log derived from ``events`` (L1–L16, IO3)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import monitor as MO
from ..session import scratch_path
from ..sources import adapters
from ..sources import logs
from .common import log, snapshot
from .registry import query
from .sql import ctes
from .sqlmetrics import ap_sql

LOG = ctes("inference_log")
BASE_END = "2024-01-11"


@query("service_totals", ops=("L1", "L4", "L5"), sql=LOG + """
SELECT route, count(*) AS requests, count(*) FILTER (WHERE score IS NOT NULL) AS with_predictions,
       CAST(coalesce(sum(n_rows) FILTER (WHERE score IS NOT NULL), 0) AS BIGINT) AS rows_scored,
       round(avg(CAST(status_code >= 400 AS DOUBLE)), 4) AS error_rate,
       count(DISTINCT artifact) AS artifacts, count(DISTINCT artifact) <= 1 AS homogeneous,
       (bool_and(artifact = 'A') AND count(*) > 0) AS same_artifact_as_baseline
FROM inference_log GROUP BY route""")
def q_service_totals(spark, sf_dir):
    """Per-route panel: volume, predictions, scored rows, error rate, artefact identity."""
    return MO.service_totals(log(spark, sf_dir), baseline_artifact="A", by=["route"])


@query("status_histogram", ops=("L2",), sql=LOG + """
SELECT date_trunc('day', ts) AS day, status_code, count(*) AS n FROM inference_log GROUP BY ALL""")
def q_status_histogram(spark, sf_dir):
    lg = log(spark, sf_dir).withColumn("day", F.date_trunc("day", F.col("ts")))
    return MO.status_histogram(lg, by=["day"])


@query("latency_percentiles", ops=("L3", "L16"), sql=LOG + """
SELECT route, CAST(round(CAST(quantile_cont(latency_ms, 0.5) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p50, CAST(round(CAST(quantile_cont(latency_ms, 0.95) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p95,
       CAST(round(CAST(quantile_cont(latency_ms, 0.99) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p99, round(max(latency_ms), 3) AS max
FROM inference_log WHERE latency_ms IS NOT NULL GROUP BY route""")
def q_latency_percentiles(spark, sf_dir):
    return MO.latency_percentiles(log(spark, sf_dir), by=["route"])


@query("latency_percentiles_overall", ops=("L3",), sql=LOG + """
SELECT CAST(round(CAST(quantile_cont(latency_ms, 0.5) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p50, CAST(round(CAST(quantile_cont(latency_ms, 0.95) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p95,
       CAST(round(CAST(quantile_cont(latency_ms, 0.99) AS DECIMAL(20,6)), 3) AS DOUBLE) AS p99, round(max(latency_ms), 3) AS max
FROM inference_log WHERE latency_ms IS NOT NULL""")
def q_latency_percentiles_overall(spark, sf_dir):
    return MO.latency_percentiles(log(spark, sf_dir))


_D = "[" + ", ".join(f"{i / 10}::DOUBLE" for i in range(1, 10)) + "]"
_EPS = "1e-6::DOUBLE"


def _psi(e, a):
    return f"(greatest({a}, {_EPS}) - greatest({e}, {_EPS})) * ln(greatest({a}, {_EPS}) / greatest({e}, {_EPS}))"


@query("log_score_drift", ops=("L6", "D11"), sql=LOG + f"""
, ref AS (SELECT score FROM inference_log WHERE ts < TIMESTAMP '{BASE_END} 00:00:00' AND score IS NOT NULL),
  rstat AS (SELECT count(*) AS n, round(avg(score), 6) AS mean, round(avg(CAST(score >= 0.5 AS DOUBLE)), 6) AS rate,
            list_sort(list_distinct(list_transform(quantile_cont(score, {_D}), lambda x: round(x, 6)))) AS edges FROM ref),
  rcount AS (SELECT len(list_filter(s.edges, lambda e: e <= r.score)) AS bin, count(*) AS c FROM ref r, rstat s GROUP BY ALL),
  rprops AS (SELECT k.bin, round(coalesce(c.c / k.n, 0.0), 6) AS e
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin, n FROM rstat) k LEFT JOIN rcount c USING (bin)),
  win AS (SELECT date_trunc('day', ts) AS day, score FROM inference_log WHERE ts >= TIMESTAMP '{BASE_END} 00:00:00' AND score IS NOT NULL),
  wstat AS (SELECT day, count(*) AS n, avg(score) AS mean, avg(CAST(score >= 0.5 AS DOUBLE)) AS rate FROM win GROUP BY day),
  wcount AS (SELECT day, len(list_filter(s.edges, lambda e: e <= w.score)) AS bin, count(*) AS c FROM win w, rstat s GROUP BY ALL),
  psi AS (SELECT ws.day, sum({_psi('p.e', 'coalesce(w.c / ws.n, 0.0)')}) AS v
          FROM rprops p CROSS JOIN wstat ws LEFT JOIN wcount w ON w.bin = p.bin AND w.day = ws.day GROUP BY ws.day)
SELECT ws.day, CAST(ws.n AS BIGINT) AS n, round(psi.v, 6) AS psi,
       CASE WHEN round(psi.v, 6) < 0.1 THEN 'stable' WHEN round(psi.v, 6) < 0.25 THEN 'investigate' ELSE 'act' END AS class,
       rs.mean AS mean_ref, round(ws.mean, 6) AS mean_window, rs.rate AS rate_above_ref, round(ws.rate, 6) AS rate_above,
       CASE WHEN rs.rate > 0 THEN round(round(ws.rate, 6) / rs.rate, 3) END AS queue_x
FROM wstat ws JOIN psi USING (day), rstat rs""")
def q_log_score_drift(spark, sf_dir):
    """Daily score drift of logged predictions against the first ten days (frozen baseline)."""
    lg = log(spark, sf_dir).where(F.col("score").isNotNull())
    ref = lg.where(F.col("ts") < F.lit(BASE_END).cast("timestamp_ntz"))
    win = lg.where(F.col("ts") >= F.lit(BASE_END).cast("timestamp_ntz")).withColumn("day", F.date_trunc("day", "ts"))
    b = D.score_baseline(ref, threshold=0.5)
    days = win.select("day").distinct()
    from ..operators.ranking import with_row
    b_per_day = with_row(days, b)
    return D.compare_scores(b_per_day, win, by=["day"])


@query("drift_report_sorted", ops=("L8",), sql=None)
def q_drift_report_sorted(spark, sf_dir):
    """Feature drift table sorted by PSI (descending) with a severity mark."""
    from .q_drift import NUM, _pair
    base, win = _pair(spark, sf_dir)
    cmp = D.compare_numeric(D.numeric_baseline(base, NUM), win, NUM)
    mark = F.when(F.col("class") == "act", "!!").when(F.col("class") == "investigate", "!").otherwise("")
    return cmp.withColumn("mark", mark).orderBy(F.col("psi").desc_nulls_last(), "feature")


@query("log_phase_split", ops=("L10",), sql=LOG + """
, buyers AS (SELECT DISTINCT user_id FROM inference_log WHERE route = 'purchase'),
  phase AS (SELECT request_id FROM inference_log WHERE user_id IN (SELECT user_id FROM buyers))
SELECT CASE WHEN request_id IN (SELECT request_id FROM phase) THEN 'after' ELSE 'before' END AS phase,
       count(*) AS requests, count(*) FILTER (WHERE score IS NOT NULL) AS with_predictions
FROM inference_log GROUP BY 1""")
def q_log_phase_split(spark, sf_dir):
    """Split the log by a returned id set (left semi / left anti join), then count each side."""
    lg = log(spark, sf_dir)
    buyers = lg.where(F.col("route") == "purchase").select("user_id").distinct()
    ids = lg.join(buyers, "user_id", "left_semi").select("request_id")
    after = lg.join(ids, "request_id", "left_semi").withColumn("phase", F.lit("after"))
    before = lg.join(ids, "request_id", "left_anti").withColumn("phase", F.lit("before"))
    both = after.unionByName(before)
    return both.groupBy("phase").agg(F.count(F.lit(1)).alias("requests"),
                                     F.count_if(F.col("score").isNotNull()).alias("with_predictions"))


@query("rejected_share", ops=("L11",), sql=LOG + """
SELECT date_trunc('day', ts) AS day, count(*) AS requests,
       round(avg(CAST(status_code >= 400 AS DOUBLE)), 6) AS rejected_share,
       CASE WHEN round(avg(CAST(status_code >= 400 AS DOUBLE)), 6) > 0.25 THEN 'contract-break' ELSE 'drift-readable' END AS verdict
FROM inference_log GROUP BY 1""")
def q_rejected_share(spark, sf_dir):
    lg = log(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))
    return MO.rejected_share(lg, ["day"], limit=0.25)


@query("volume_windows", ops=("L13",), sql=LOG + """
, p AS (SELECT artifact, ts, request_id, score,
               row_number() OVER (PARTITION BY artifact ORDER BY ts, request_id) AS rn
        FROM inference_log WHERE score IS NOT NULL)
SELECT artifact, CAST(floor((rn - 1) / 400) AS BIGINT) AS window_no, count(*) AS n, min(ts) AS start_ts,
       max(ts) AS end_ts, round(avg(score), 6) AS mean_score
FROM p GROUP BY ALL HAVING count(*) = 400""")
def q_volume_windows(spark, sf_dir):
    """Closed windows of 400 consecutive predictions per artefact."""
    return MO.volume_windows(log(spark, sf_dir))


_DAILY_SQL = LOG + """
, daily AS (SELECT artifact, date_trunc('day', ts) AS day, count(*) FILTER (WHERE score IS NOT NULL) AS volume
            FROM inference_log GROUP BY ALL),
  hist AS (SELECT *, list_sort(list(volume) OVER (PARTITION BY artifact ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)) AS prev
           FROM daily),
  med AS (SELECT *, CASE WHEN len(prev) = 0 THEN NULL
                         ELSE (prev[CAST(greatest(ceil(len(prev) / 2), 1) AS INTEGER)] + prev[CAST(floor(len(prev) / 2) + 1 AS INTEGER)]) / 2.0 END AS median_prev
          FROM hist)"""


@query("volume_ratio", ops=("L14",), sql=_DAILY_SQL + """
SELECT artifact, day, volume, median_prev, round(volume / median_prev, 6) AS ratio FROM med""")
def q_volume_ratio(spark, sf_dir):
    """Daily volume per artefact against the median of the four previous days."""
    lg = log(spark, sf_dir)
    daily = lg.groupBy("artifact", F.date_trunc("day", "ts").alias("day")).agg(
        F.count_if(F.col("score").isNotNull()).alias("volume"))
    return MO.volume_ratio(daily, "volume", ["artifact"], "day")


@query("alert_hysteresis", ops=("L12",), sql=LOG + """
, m AS (SELECT route AS signal, date_trunc('day', ts) AS day, round(avg(CAST(status_code >= 400 AS DOUBLE)), 6) AS value
        FROM inference_log GROUP BY ALL),
  r AS (SELECT *, (min(CAST(value > 0.12 AS INTEGER)) OVER w3 = 1 AND count(*) OVER w3 = 2) AS run, value < 0.08 AS back
        FROM m WINDOW w3 AS (PARTITION BY signal ORDER BY day ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
  e AS (SELECT *, CASE WHEN run THEN 1 WHEN back THEN 0 END AS ev FROM r)
SELECT signal, day, value,
       coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY signal ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS alert
FROM e""")
def q_alert_hysteresis(spark, sf_dir):
    """Daily error-rate alert per route: fires after 2 days above 12 %, disarms below 8 %."""
    lg = log(spark, sf_dir)
    m = lg.groupBy(F.col("route").alias("signal"), F.date_trunc("day", "ts").alias("day")).agg(
        r6(F.avg((F.col("status_code") >= 400).cast("double"))).alias("value"))
    return MO.hysteresis(m, "signal", "day", "value", trigger=0.12, disarm=0.08, k=2)


_OUT_SQL = LOG + """
, outcomes AS (SELECT request_id, ts + to_days(CAST(request_id % 90 AS INTEGER)) AS outcome_ts,
                      CASE WHEN (('0x' || substr(md5(CAST(request_id AS VARCHAR) || '|o'), 1, 8))::UBIGINT)::DOUBLE / 4294967296.0 < score
                           THEN 1 ELSE 0 END AS y
               FROM inference_log WHERE score IS NOT NULL AND request_id % 3 <> 0),
  matched AS (SELECT p.request_id, p.ts, p.score, o.outcome_ts, o.y FROM inference_log p JOIN outcomes o USING (request_id)
              WHERE p.score IS NOT NULL AND o.outcome_ts >= p.ts AND o.outcome_ts <= p.ts + INTERVAL 90 DAY),
  lots AS (SELECT *, CAST(date_trunc('week', ts) AS TIMESTAMP) AS lot FROM matched)"""


@query("label_reconciliation", ops=("L15",), sql=_OUT_SQL + f"""
SELECT a.lot, b.n, a.ap, b.brier FROM {ap_sql('lots', ['lot'])} a
JOIN (SELECT lot, count(*) AS n, round(avg(pow(score - y, 2)), 6) AS brier FROM lots GROUP BY lot) b USING (lot)""")
def q_label_reconciliation(spark, sf_dir):
    """Predictions ⋈ late outcomes (within 90 days); AP and Brier per weekly label lot."""
    lg = log(spark, sf_dir)
    out = adapters.outcomes(lg)
    m = MO.reconcile(lg.where(F.col("score").isNotNull()), out).withColumn("lot", F.date_trunc("week", "ts"))
    ap = M.average_precision(m, by=["lot"])
    b = m.groupBy("lot").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.pow(F.col("score") - F.col("y"), 2))).alias("brier"))
    return ap.join(b, "lot")


@query("label_unmatched", ops=("L15",), sql=LOG + """
SELECT count(*) AS unmatched FROM inference_log p
WHERE p.score IS NOT NULL AND p.request_id % 3 = 0""")
def q_label_unmatched(spark, sf_dir):
    """Predictions still without an outcome (left anti join)."""
    lg = log(spark, sf_dir).where(F.col("score").isNotNull())
    return lg.join(adapters.outcomes(lg), "request_id", "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


_JSONL = LOG + """
, lines AS (SELECT request_id, CASE
      WHEN request_id % 101 = 0 THEN ''
      WHEN request_id % 103 = 0 THEN 'INFO access log line ' || CAST(request_id AS VARCHAR)
      WHEN request_id % 107 = 0 THEN '[1, 2, 3]'
      WHEN request_id % 109 = 0 THEN '42'
      ELSE '{"request_id": "' || CAST(request_id AS VARCHAR) || '", "status_code": ' || CAST(status_code AS VARCHAR) || '}' END AS value
    FROM inference_log)"""


@query("log_json_read", ops=("IO3",), sql=_JSONL + """
SELECT count(*) FILTER (WHERE trim(value) <> '' AND json_valid(value) AND ltrim(value) LIKE '{%') AS read_ok,
       count(*) FILTER (WHERE trim(value) <> '' AND NOT (json_valid(value) AND ltrim(value) LIKE '{%')) AS invalid,
       count(*) FILTER (WHERE trim(value) = '') AS blank
FROM lines""")
def q_log_json_read(spark, sf_dir):
    """Inference log as JSON lines with planted blank, plain-text, array and scalar lines: parsed rows
    kept, unreadable ones counted (not dropped silently, arrays not exploded)."""
    lg = log(spark, sf_dir)
    rid = F.col("request_id")
    obj = F.concat(F.lit('{"request_id": "'), rid.cast("string"), F.lit('", "status_code": '),
                   F.col("status_code").cast("string"), F.lit("}"))
    lines = lg.select(F.when(rid % 101 == 0, F.lit("")).when(rid % 103 == 0, F.concat(F.lit("INFO access log line "), rid.cast("string")))
                      .when(rid % 107 == 0, F.lit("[1, 2, 3]")).when(rid % 109 == 0, F.lit("42")).otherwise(obj).alias("value"))
    parsed = MO.read_json_log(lines)
    blank = lines.where(F.trim("value") == "").agg(F.count(F.lit(1)).alias("blank"))
    counts = parsed.agg(F.count_if(~F.col("corrupt")).alias("read_ok"), F.count_if(F.col("corrupt")).alias("invalid"))
    from ..operators.ranking import with_row
    return with_row(counts, blank)


@query("log_json_records", ops=("IO4", "IO5"))
def q_log_json_records(spark, sf_dir):
    """JSON line per record: optional fields absent (not zero) when a request was rejected; no features."""
    return MO.to_json_records(log(spark, sf_dir))


@query("log_features_flatten", ops=("L7", "IO5"), sql=ctes("snapshot") + """
SELECT segment, count(*) AS n, round(avg(tenure_days), 6) AS mean_tenure FROM snapshot GROUP BY segment""")
def q_log_features_flatten(spark, sf_dir):
    """Requests of 25 customers carrying their feature records (logged only when feature logging is
    on); flattening them back gives one row per scored customer for data-drift measurement."""
    from .common import snapshot
    s = snapshot(spark, sf_dir)
    req = s.groupBy(F.floor(F.col("customer_id") / 25).alias("request_id")).agg(
        F.collect_list(F.struct("customer_id", "segment", "tenure_days")).alias("features"))   # ≤ 25 per request
    flat = MO.flatten_features(req)
    return flat.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("tenure_days")).alias("mean_tenure"))


@query("log_files", ops=("IO3", "IO4", "IO5"), sql=LOG + """
, junk AS (SELECT date_trunc('day', ts)::DATE AS date, count(*) FILTER (request_id % 103 = 0) + 2 * count(*) FILTER (request_id % 107 = 0) AS corrupt
           FROM inference_log GROUP BY 1)
SELECT date_trunc('day', ts)::DATE AS date, count(*) AS records, count(DISTINCT request_id) AS requests, any_value(corrupt) AS corrupt,
       count(*) FILTER (score IS NOT NULL) AS with_scores, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows, round(sum(score), 4) AS sum_scores,
       0 AS with_features, round(max(latency_ms), 6) AS max_latency
FROM inference_log JOIN junk ON junk.date = date_trunc('day', ts)::DATE GROUP BY 1""")
def q_log_files(spark, sf_dir):
    """The log appended to dated files of JSON lines, beside lines of another writer, and read back: records by day, those
    that cannot be read, and none with features although the log has them (the mask is the default)."""
    lg = log(spark, sf_dir).withColumn("features", F.array(F.struct(F.col("user_id").alias("customer_id"), F.lit("x").alias("segment"))))
    path = scratch_path(spark, "log-files")
    for part in ("status_code < 400", "status_code >= 400"):                       # two writers, one after the other
        logs.append_log(lg.where(part), path)
    rid, date = F.col("request_id"), F.to_date("ts").alias("date")
    other = lg.select(date, F.explode(F.when(rid % 103 == 0, F.array(F.concat(F.lit("INFO: served "), rid.cast("string")), F.lit("  ")))
                                      .when(rid % 107 == 0, F.array(F.lit("[1, 2]"), F.lit('{"status_code": ')))).alias("value"))
    both = lg.where((rid % 103 == 0) & (rid % 107 == 0)).select(date, F.explode(F.array(F.lit("[1, 2]"), F.lit('{"status_code": '))).alias("value"))
    other.unionByName(both).write.mode("append").partitionBy("date").text(path)
    got = logs.read_log(spark, path, logs.with_features(lg.schema["features"].dataType.elementType))
    ok = ~F.col("corrupt")
    return got.groupBy("date").agg(
        F.count_if(ok).alias("records"), F.count_distinct(F.when(ok, F.col("request_id"))).alias("requests"), F.count_if("corrupt").alias("corrupt"),
        F.count_if(ok & F.col("scores").isNotNull()).alias("with_scores"), F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).cast("long").alias("n_rows"),
        F.round(F.sum(F.when(ok, F.col("scores")[0])), 4).alias("sum_scores"), F.count_if(F.col("features").isNotNull()).cast("int").alias("with_features"),
        r6(F.max(F.when(ok, F.col("latency_ms")))).alias("max_latency"))


_LOGGED_NUM, _LOGGED_CAT = ["tenure_days", "monthly_charges", "recency_days"], ["segment", "region"]


def _logged_sql() -> str:
    num = " UNION ALL ".join(f"SELECT balance_sign AS w, '{c}' AS feature, {c}::DOUBLE AS v FROM snapshot WHERE {c} IS NOT NULL" for c in _LOGGED_NUM)
    cat = " UNION ALL ".join(f"SELECT balance_sign AS w, '{c}' AS feature, {c} AS v FROM snapshot WHERE {c} IS NOT NULL" for c in _LOGGED_CAT)
    return ctes("snapshot") + f"""
, l AS ({num}), c AS ({cat}),
  ed AS (SELECT feature, count(*) AS n, list_sort(list_distinct(list_transform(quantile_cont(v, {_D}), lambda x: round(x, 6)))) AS edges FROM l WHERE w = 'pos' GROUP BY 1),
  b AS (SELECT w, feature, len(list_filter(edges, lambda e: e <= v)) AS bin, count(*) AS c FROM l JOIN ed USING (feature) GROUP BY ALL),
  nn AS (SELECT feature, sum(c) AS n FROM b WHERE w = 'neg' GROUP BY 1),
  k AS (SELECT feature, unnest(range(0, len(edges) + 1)) AS bin, n FROM ed),
  pn AS (SELECT k.feature, 'numeric' AS kind, any_value(nn.n) AS n, round(sum({_psi('round(coalesce(x.c / k.n, 0.0), 6)', 'coalesce(y.c / nn.n, 0.0)')}), 6) AS psi
         FROM k JOIN nn USING (feature) LEFT JOIN b x ON x.w = 'pos' AND x.feature = k.feature AND x.bin = k.bin
         LEFT JOIN b y ON y.w = 'neg' AND y.feature = k.feature AND y.bin = k.bin GROUP BY 1),
  cv AS (SELECT w, feature, v, count(*) AS c FROM c GROUP BY w, feature, v), cc AS (SELECT *, sum(c) OVER (PARTITION BY w, feature) AS n FROM cv),
  pc AS (SELECT feature, 'categorical' AS kind, max(yn) AS n, round(sum({_psi('coalesce(e, 0.0)', 'coalesce(a, 0.0)')}), 6) AS psi
         FROM (SELECT coalesce(x.feature, y.feature) AS feature, round(x.c / x.n, 6) AS e, y.c / y.n AS a, y.n AS yn
               FROM (SELECT * FROM cc WHERE w = 'pos') x FULL JOIN (SELECT * FROM cc WHERE w = 'neg') y ON x.feature = y.feature AND x.v = y.v) GROUP BY 1)
SELECT feature, kind, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'investigate' ELSE 'act' END AS class, CAST(n AS BIGINT) AS n
FROM (SELECT * FROM pn UNION ALL BY NAME SELECT * FROM pc)"""


@query("logged_feature_drift", ops=("L7", "D9", "IO3", "IO5"), sql=_logged_sql())
def q_logged_feature_drift(spark, sf_dir):
    """Requests of customers with a negative balance, logged with their features (the flag is on), read from the files and
    compared with the frozen baselines of the customers with a positive one."""
    s = snapshot(spark, sf_dir)
    base, seen = s.where("balance_sign = 'pos'"), s.where("balance_sign = 'neg'")
    numeric, categorical = D.numeric_baseline(base, _LOGGED_NUM), D.category_baseline(base, _LOGGED_CAT)
    record = F.struct(*_LOGGED_NUM, *_LOGGED_CAT)
    requests = seen.groupBy(F.floor(F.col("customer_id") / 25).alias("request_id")).agg(F.collect_list(record).alias("features"))     # up to 25 a request
    requests = requests.select("request_id", F.lit("2024-01-31 12:00:00").cast("timestamp").alias("ts"), F.lit("predict").alias("route"), F.lit(200).alias("status_code"),
                               F.lit(1.0).alias("latency_ms"), F.lit("A").alias("artifact"), F.size("features").alias("n_rows"), F.lit(0.5).alias("score"), "features")
    path = scratch_path(spark, "log-features")
    logs.append_log(requests, path, log_features=True)
    read = logs.read_log(spark, path, logs.with_features(requests.schema["features"].dataType.elementType))
    return logs.feature_drift(read, numeric, categorical)
