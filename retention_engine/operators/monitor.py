"""Service monitoring from inference logs (L1–L16, IO3–IO5): one grouped pass per panel.

Percentiles are exact (numpy ``linear``) through :func:`quantiles.exact_quantiles`; running counts per
artefact use :func:`ranking.running_totals`, so one artefact holding most of the traffic is still
numbered by many tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import r6
from .quantiles import exact_quantiles
from .ranking import running_totals, with_row

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("artifact_sha256", T.StringType()),
    T.StructField("n_rows", T.IntegerType()),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
])


def service_totals(log: DataFrame, baseline_artifact: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Requests, requests with predictions, scored rows, error rate (4 dp), artefact identity."""
    has_pred = F.col("score").isNotNull()
    aggs = [F.count(F.lit(1)).alias("requests"),
            F.count_if(has_pred).alias("with_predictions"),
            F.coalesce(F.sum(F.when(has_pred, F.col("n_rows"))), F.lit(0)).cast("long").alias("rows_scored"),
            F.round(F.avg((F.col("status_code") >= 400).cast("double")), 4).alias("error_rate"),
            F.count_distinct("artifact").alias("artifacts"),
            (F.count_distinct("artifact") <= 1).alias("homogeneous")]
    if baseline_artifact is not None:
        aggs.append((F.bool_and(F.col("artifact") == F.lit(baseline_artifact)) & (F.count(F.lit(1)) > 0))
                    .alias("same_artifact_as_baseline"))
    return log.groupBy(*by).agg(*aggs)


def status_histogram(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, status_code, n), the most common status of each group first."""
    return log.groupBy(*by, "status_code").agg(F.count(F.lit(1)).alias("n")).orderBy(*by, F.desc("n"), "status_code")


def latency_percentiles(log: DataFrame, by: Sequence[str] = (), value: str = "latency_ms") -> DataFrame:
    """p50/p95/p99 (exact, linear interpolation) and max, 3 dp, over rows that carry a latency."""
    q = exact_quantiles(log, value, [0.5, 0.95, 0.99], by)
    # half-up at 3 dp on the 6-dp decimal value (no binary-representation surprises on .0005 ties)
    wide = q.groupBy(*by).agg(*[F.round(F.max(F.when(F.col("prob") == p, F.col("quantile"))).cast("decimal(20,6)"), 3)
                                .cast("double").alias(n)
                                for p, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])
    mx = log.groupBy(*by).agg(F.round(F.max(value), 3).alias("max"))
    return wide.join(mx, list(by)) if by else with_row(wide, mx)


def flatten_scores(log: DataFrame, scores: str = "scores") -> DataFrame:
    """One row per logged score (array column) → input of score drift."""
    return log.select("*", F.explode(scores).alias("score")).drop(scores)


def flatten_features(log: DataFrame, features: str = "features") -> DataFrame:
    """One row per logged feature record; an absent column yields an empty frame (not measured)."""
    if features not in log.columns:
        return log.sparkSession.createDataFrame([], T.StructType([]))
    return log.select(F.explode(features).alias("_f")).select("_f.*")


def rejected_share(log: DataFrame, by: Sequence[str], limit: float = 0.05) -> DataFrame:
    """Share of requests rejected (status ≥ 400) per window and the verdict it implies."""
    share = F.avg((F.col("status_code") >= 400).cast("double"))
    out = log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"), r6(share).alias("rejected_share"))
    return out.withColumn("verdict", F.when(F.col("rejected_share") > limit, "contract-break").otherwise("drift-readable"))


def volume_windows(log: DataFrame, size: int = 400, key: str = "artifact", ts: str = "ts",
                   id_col: str = "request_id") -> DataFrame:
    """Count-based windows: every ``size`` consecutive predictions of one artefact form a window;
    only closed (full) windows are reported, with their time span and mean score."""
    p = log.where(F.col("score").isNotNull()).select(key, ts, id_col, "score")
    p = p.withColumn("_k", F.unix_micros(F.col(ts).cast("timestamp")))
    r = running_totals(p, "_k", [], [key], tiebreak=[id_col])
    w = r.withColumn("window_no", F.floor((F.col("_rn") - 1) / size).cast("long"))
    agg = w.groupBy(key, "window_no").agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("start_ts"),
                                          F.max(ts).alias("end_ts"), r6(F.avg("score")).alias("mean_score"))
    return agg.where(F.col("n") == size)


def median_of_previous(values: str, k: int, partition: Sequence[str], order: str):
    """Median of the ``k`` previous rows' values (frame median: percentile cannot take a frame)."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-k, -1)
    arr = F.array_sort(F.collect_list(values).over(w))
    m = F.size(arr)
    mid_hi = F.element_at(arr, (F.floor(m / 2) + 1).cast("int"))
    mid_lo = F.element_at(arr, F.greatest(F.ceil(m / 2), F.lit(1)).cast("int"))
    return F.when(m == 0, F.lit(None).cast("double")).otherwise((mid_lo + mid_hi) / 2.0)


def volume_ratio(daily: DataFrame, value: str, partition: Sequence[str], order: str, k: int = 4) -> DataFrame:
    """Volume relative to the median of the ``k`` previous windows (null while there is no history)."""
    med = median_of_previous(value, k, partition, order)
    return daily.withColumn("median_prev", med).withColumn("ratio", r6(F.col(value) / F.col("median_prev")))


def hysteresis(metrics: DataFrame, signal: str, order: str, value: str, trigger: float, disarm: float,
               k: int, above: bool = True) -> DataFrame:
    """Alert state per window: fires after ``k`` consecutive windows beyond ``trigger``; stays on until a
    window is back beyond ``disarm``. Windows are per signal (small), so the frame is cheap."""
    w = Window.partitionBy(signal).orderBy(order)
    cond = (F.col(value) > trigger) if above else (F.col(value) < trigger)
    back = (F.col(value) < disarm) if above else (F.col(value) > disarm)
    runk = w.rowsBetween(-(k - 1), 0)
    run = (F.min(cond.cast("int")).over(runk) == 1) & (F.count(F.lit(1)).over(runk) == k)
    ev = F.when(run, F.lit(1)).when(back, F.lit(0))
    d = metrics.withColumn("_ev", ev)
    state = F.last("_ev", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn("alert", F.coalesce(state, F.lit(0)) == 1).drop("_ev")


def reconcile(predictions: DataFrame, outcomes: DataFrame, max_delay_days: int = 90,
              id_col: str = "request_id") -> DataFrame:
    """Late labels joined to their predictions within the label delay (an equi-join on the id plus a
    time bound)."""
    p = predictions.select(id_col, "ts", "score")
    o = outcomes.select(id_col, "outcome_ts", "y")
    return p.join(o, id_col).where(
        (F.col("outcome_ts") >= F.col("ts"))
        & (F.col("outcome_ts") <= F.col("ts") + F.expr(f"make_interval(0, 0, 0, {max_delay_days})")))


def read_json_log(lines: DataFrame, schema: T.StructType = LOG_SCHEMA, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse JSON lines: blank lines skipped; lines that are not a JSON object (junk, arrays, scalars,
    wrong types) flagged ``corrupt`` rather than dropped silently or exploded. Columns ``keep`` of the lines stay."""
    nonblank = lines.where(F.trim(F.col(text)) != "")
    s = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    is_obj = F.trim(F.col(text)).startswith("{")
    parsed = nonblank.select(
        F.when(is_obj, F.from_json(F.col(text), s, {"mode": "PERMISSIVE",
                                                    "columnNameOfCorruptRecord": "_corrupt_record"})).alias("r"),
        is_obj.alias("_obj"), *keep)
    return parsed.select("r.*", *keep, (~F.col("_obj") | F.col("r").isNull() | F.col("r._corrupt_record").isNotNull())
                         .alias("corrupt")).drop("_corrupt_record")


def to_json_records(log: DataFrame, log_features: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON line per record; absent optional fields are omitted (to_json drops nulls), scores
    rounded to 6; features only when explicitly enabled (privacy default)."""
    fields = [F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
              F.col("request_id").cast("string").alias("request_id"), F.lit("POST").alias("method"),
              F.col("route"), F.col("status_code"), F.col("latency_ms"),
              F.col("artifact").alias("artifact_sha256"), F.col("n_rows"),
              F.when(F.col("score").isNotNull(), F.array(F.round("score", 6))).alias("scores")]
    if log_features and "features" in log.columns:
        fields.append(F.col("features"))
    return log.select(F.to_json(F.struct(*fields)).alias("value"), *keep)
