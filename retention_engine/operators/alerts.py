"""Alert policies as data (L12): which signal, when an alert opens, when it closes, for how many windows, and what to do.

A policy has two limits, so that a value that swings about one of them does not open and close an alert each window: the
alert opens after ``windows`` windows in a row beyond ``trigger`` and closes at the first window back beyond ``disarm``.
``direction`` says on which side trouble lies. A window without a value (nothing measured) neither opens nor closes an
alert, and ends a run. State is kept by (policy, entity); the policies are a table that may be changed without code.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .ranking import checked_broadcast

POLICY = "policy string, signal string, direction string, trigger double, disarm double, windows int, action string"

# The alert table that the service is run by (shares as fractions, latencies in ms).
POLICIES = [
    ("client latency", "latency_p95", "above", 1500.0, 800.0, 3, "compare network and application time"),
    ("server errors", "share_5xx", "above", 0.01, 0.002, 2, "a bug, not drift: read the log by request id"),
    ("refused requests", "share_4xx", "above", 0.05, 0.01, 1, "contract broken upstream"),
    ("feature drift", "feature_psi", "above", 0.25, 0.10, 3, "check integrity, then open the retraining decision"),
    ("score drift", "score_psi", "above", 0.25, 0.10, 3, "check integrity, then open the retraining decision"),
    ("queue size", "queue_deviation", "above", 0.25, 0.10, 3, "talk to operations"),
    ("volume", "volume_ratio", "below", 0.5, 0.8, 2, "failure upstream"),
    ("ranking quality", "average_precision", "below", 0.66, 0.68, 1, "re-evaluate; retraining passes the gate"),
    ("calibration", "brier", "above", 0.14, 0.13, 1, "recalibrate or derive the threshold again"),
    ("fairness", "recall_disparity", "above", 0.10, 0.07, 1, "fairness review"),
]


def policy_table(spark: SparkSession, rows=POLICIES) -> DataFrame:
    """The policies as a table; a policy whose limits leave no dead band, or that is not well formed, is an error."""
    names = [r[0] for r in rows]
    if len(set(names)) != len(names):
        raise ValueError("policies must have different names")
    for name, _, direction, trigger, disarm, windows, _ in rows:
        if direction not in ("above", "below") or windows < 1:
            raise ValueError(f"policy {name!r}: direction is above or below, windows at least 1")
        if (trigger < disarm) if direction == "above" else (trigger > disarm):
            raise ValueError(f"policy {name!r}: the alert would close where it has not yet opened")
    return spark.createDataFrame(rows, POLICY)


def watched(metrics: DataFrame, policies: DataFrame) -> DataFrame:
    """Window metrics (signal, entity, window_start, value) beside every policy on their signal, with ``beyond`` and
    ``back``. Also for a stream of metrics: the policies are a table."""
    side = lambda limit, other: F.when(F.col("direction") == "above", limit).otherwise(other)
    rows = metrics.select("signal", "entity", "window_start", F.col("value").cast("double").alias("value")).join(checked_broadcast(policies, "policies"), "signal")
    value = F.col("value")
    return rows.select("policy", "signal", "entity", "window_start", "value", "windows", "action",
                       F.coalesce(side(value > F.col("trigger"), value < F.col("trigger")), F.lit(False)).alias("beyond"),
                       F.coalesce(side(value < F.col("disarm"), value > F.col("disarm")), F.lit(False)).alias("back"))


def evaluate(metrics: DataFrame, policies: DataFrame) -> DataFrame:
    """(policy, signal, entity, window_start, value, alert) for every window of every policy on its signal."""
    order = Window.partitionBy("policy", "entity").orderBy("window_start")
    rows = watched(metrics, policies)
    runs = rows.withColumn("_run", F.sum((~F.col("beyond")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy("policy", "entity", "_run").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("beyond") & (F.sum(F.col("beyond").cast("int")).over(in_run) >= F.col("windows"))
    event = runs.withColumn("_event", F.when(opens, True).when(F.col("back"), False))
    state = F.coalesce(F.last("_event", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(False))
    return event.select("policy", "signal", "entity", "window_start", "value", "action", state.alias("alert"))


def episodes(evaluated: DataFrame) -> DataFrame:
    """One row for each time an alert was on: (policy, entity, opened, closed, n_windows, lowest, highest, action);
    ``closed`` is the window that closed it, null while it is on."""
    order = Window.partitionBy("policy", "entity").orderBy("window_start")
    before = F.coalesce(F.lag("alert").over(order), F.lit(False))
    rows = (evaluated.withColumn("_no", F.sum((F.col("alert") & ~before).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .select("*"))
    ended = F.min(F.when(~F.col("alert"), F.col("window_start")))
    on = lambda c: F.when(F.col("alert"), F.col(c))
    return (rows.where("_no > 0").groupBy("policy", "entity", "_no").agg(
        F.min(on("window_start")).alias("opened"), ended.alias("closed"), F.count(on("window_start")).alias("n_windows"),
        F.min(on("value")).alias("lowest"), F.max(on("value")).alias("highest"), F.max("action").alias("action")).drop("_no"))


def _step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The windows of one (policy, entity) in order, from the state (run, alert)."""
    run, alert = state.get if state.exists else (0, False)
    rows = pd.concat(list(frames)).sort_values("window_start")
    alerts = []
    for beyond, back, windows in zip(rows["beyond"], rows["back"], rows["windows"], strict=True):
        run = run + 1 if beyond else 0
        alert = True if beyond and run >= windows else False if back else alert
        alerts.append(bool(alert))
    state.update((int(run), bool(alert)))
    yield rows.assign(alert=alerts)[["policy", "signal", "entity", "window_start", "value", "action", "alert"]]


def evaluate_stream(metrics: DataFrame, policies: DataFrame) -> DataFrame:
    """The same for a stream of window metrics. A trigger's windows of one (policy, entity), some dozens, are taken in
    their order; windows of a later trigger come after them. The state is a run length and whether the alert is on."""
    return watched(metrics, policies).groupBy("policy", "entity").applyInPandasWithState(
        lambda key, frames, state: _step(key, frames, state),
        "policy string, signal string, entity string, window_start timestamp, value double, action string, alert boolean",
        "run long, alert boolean", "append", GroupStateTimeout.NoTimeout)


def signal(df: DataFrame, name: str, entity: Column, window_start: str, value: Column) -> DataFrame:
    """One signal's rows of window metrics."""
    return df.select(F.lit(name).alias("signal"), entity.cast("string").alias("entity"), F.col(window_start).cast("timestamp").alias("window_start"),
                     value.cast("double").alias("value"))
