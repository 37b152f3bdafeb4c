"""Structured Streaming versions of scoring and monitoring (ST1–ST6).

The same pure ``DataFrame → DataFrame`` operators used in batch are applied to streaming frames;
stateful pieces use watermarks (bounded state), ``applyInPandasWithState`` keyed by a small key (alert
signal) or a small state table written by each trigger (count windows). Jobs run with ``Trigger.AvailableNow`` over file sources and keep their
progress in the shared checkpoint folder, so a restarted job resumes where it stopped.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import quality as QU
from ..operators.ranking import checked_broadcast, running_totals
from ..session import materialize, scratch_path
from ..sources.tables import table_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A table read as a stream by the file source, whether it is one Parquet file or a folder of them. ``max_files`` per
    trigger; without it one trigger takes all that is there (files need not be in the order of time)."""
    path = table_path(sf_dir, name)
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at).isDirectory():
        return r.parquet(path)
    # the file source watches a folder; the glob keeps it to the table's one file
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table read as a stream; ``ts`` cast to TIMESTAMP for watermarks."""
    return table_stream(spark, sf_dir, "events", EVENT_SCHEMA, max_files).withColumn("ts", F.col("ts").cast("timestamp"))


def as_log(events: DataFrame) -> DataFrame:
    """Same projection as the batch inference-log adapter (pure, works on streams)."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(F.col("event_type") == "error", 500)
               .when((F.col("event_type") == "signup") & (k % 10 == 0), 422).otherwise(200))
    ok = status == 200
    return events.select(F.col("event_id").alias("request_id"), "ts", "user_id", F.col("event_type").alias("route"),
                         status.alias("status_code"), F.col("value").alias("latency_ms"),
                         F.when(k < 50, "A").otherwise("B").alias("artifact"),
                         F.when(ok, F.round(F.col("value") / (F.col("value") + 50.0), 6)).alias("score"),
                         F.when(ok, 1 + k % 5).alias("n_rows"))


def run_available_now(df: DataFrame | VolumeWindows, name: str, output_mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a streaming frame to completion over what is available; return its output.

    Appended rows go to a Parquet table in the shared folder, whatever their number. Only the ``complete`` mode, which
    the file sink does not take, uses a memory table: it is for small aggregates.
    """
    if isinstance(df, VolumeWindows):
        return _run_volume_windows(df, name, checkpoint)
    spark = df.sparkSession
    w = (df.writeStream.outputMode(output_mode).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}")))
    qn, path = f"{name}_{uuid.uuid4().hex[:8]}", scratch_path(spark, f"sink-{name}")
    q = w.format("memory").queryName(qn).start() if output_mode == "complete" else w.format("parquet").start(path)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.table(qn) if output_mode == "complete" else spark.read.schema(df.schema).parquet(path)


def _run_volume_windows(windows: VolumeWindows, name: str, checkpoint: str | None) -> DataFrame:
    spark = windows.scores.sparkSession
    checkpoint, path = checkpoint or scratch_path(spark, f"stream-{name}"), scratch_path(spark, f"sink-{name}")
    spark.createDataFrame([], VolumeWindows.SCHEMA).write.parquet(f"{path}/trigger=none")  # there may be nothing new
    # The state stands beside the checkpoint, so a restarted job finds it.
    q = (windows.scores.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .foreachBatch(windows.trigger(f"{checkpoint.rstrip('/')}-windows", path)).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(VolumeWindows.SCHEMA).parquet(f"{path}/trigger=*")


def service_panel_stream(log: DataFrame, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """ST3: tumbling event-time panel per route (append mode: a window is emitted once the watermark
    passes it; state is bounded by the watermark)."""
    return (log.withWatermark("ts", watermark)
               .groupBy(F.window("ts", window).alias("w"), "route")
               .agg(F.count(F.lit(1)).alias("requests"),
                    F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors"),
                    F.count(F.col("score")).alias("with_predictions"),
                    F.max("latency_ms").alias("max_latency"))
               .select(F.col("w.start").alias("window_start"), "route", "requests", "errors",
                       "with_predictions", "max_latency"))


def dedup_stream(log: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """ST2: drop repeated request ids within the watermark delay (bounded state)."""
    return log.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["request_id"])


def late_outcome_join(pred: DataFrame, outcomes: DataFrame, delay_days: int = 90) -> DataFrame:
    """ST6: stream–stream inner join of predictions and late outcomes, bounded in time on both sides."""
    p = pred.withWatermark("ts", "1 day").alias("p")
    o = outcomes.withWatermark("outcome_ts", "1 day").alias("o")
    return p.join(o, F.expr(f"""p.request_id = o.o_request_id AND o.outcome_ts >= p.ts AND
                                 o.outcome_ts <= p.ts + interval {delay_days} days"""))


def validate_and_route(batch_df: DataFrame, contract: QU.TableContract, accepted_path: str, quarantine_path: str,
                       request_col: str = "request_id") -> None:
    """ST1 micro-batch body: validate, decide per request, append to the accepted or quarantine sink."""
    v = QU.validate(batch_df, contract)
    req = QU.validate_requests(v, request_col)
    ok, bad = QU.split_accepted(v, req, request_col)
    ok.drop("errors", "valid").write.mode("append").parquet(accepted_path)
    bad.select(request_col, *[c for c in batch_df.columns if c != request_col], "errors") \
       .write.mode("append").parquet(quarantine_path)


# ---- ST4 / ST5: custom state ----------------------------------------------------------------------

@dataclass
class VolumeWindows:
    """Count windows of a stream of (artifact, ts, request_id, score), run by ``run_available_now``."""
    scores: DataFrame
    size: int

    SCHEMA = "artifact string, window_no long, n long, mean_score double"

    def trigger(self, state_path: str, out_path: str):
        """Micro-batch body: the trigger's rows are ranked in range-partitioned chunks; only sums and counts of windows are
        gathered. The state, one row an artefact (its open window), is a table for each trigger, so a trigger that is
        run again after a failure reads the same state and writes the same rows."""
        size = self.size

        def run(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            state = (spark.read.parquet(f"{state_path}/{batch_id - 1}") if batch_id else
                     spark.createDataFrame([], "artifact string, window_no long, n long, total double"))
            # Rows without a time come last.
            rows = batch.withColumn("_k", F.coalesce(F.unix_micros("ts"), F.lit(2**63 - 1)))
            ranked = running_totals(rows, "_k", [], ["artifact"], tiebreak=["request_id"]).select("artifact", "_rn", "score")
            held = checked_broadcast(state.select(F.col("artifact").alias("a"), "window_no", "n"), "volume-held")
            ranked = ranked.join(held, F.col("artifact").eqNullSafe(F.col("a")), "left")
            no = F.coalesce("window_no", F.lit(0)) + F.floor((F.coalesce("n", F.lit(0)) + F.col("_rn") - 1) / size)
            sums = ranked.groupBy("artifact", no.cast("long").alias("window_no")).agg(F.count("*").alias("n"), F.sum("score").alias("total"))
            sums = sums.unionByName(state).groupBy("artifact", "window_no").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            sums = materialize(sums, "volume-sums")
            closed = F.col("n") == size
            (sums.where(closed).select("artifact", "window_no", "n", F.round(F.col("total") / size, 6).alias("mean_score"))
             .write.mode("overwrite").parquet(f"{out_path}/trigger={batch_id}"))
            last = sums.groupBy("artifact").agg(F.max(F.struct("window_no", "n", "total")).alias("w")).select("artifact", "w.*")
            last.select("artifact", F.when(closed, F.col("window_no") + 1).otherwise(F.col("window_no")).alias("window_no"),
                        F.when(closed, 0).otherwise(F.col("n")).cast("long").alias("n"),
                        F.when(closed, 0.0).otherwise(F.col("total")).alias("total")
                        ).write.mode("overwrite").parquet(f"{state_path}/{batch_id}")
        return run


def volume_windows_stream(log: DataFrame, size: int = 400) -> VolumeWindows:
    """ST4: count-based windows per artefact; the state is the open window (number, count, sum) of each.

    Rows of one trigger are ordered by time, then id; rows of a later trigger come after them whatever their time (a
    closed window is never opened again). No task holds an artefact's rows."""
    return VolumeWindows(log.where(F.col("score").isNotNull()).select("artifact", "ts", "request_id", "score"), size)


ALERT_OUT = T.StructType([T.StructField("signal", T.StringType()), T.StructField("window_start", T.TimestampType()),
                          T.StructField("value", T.DoubleType()), T.StructField("alert", T.BooleanType())])
ALERT_STATE = T.StructType([T.StructField("run", T.LongType()), T.StructField("on", T.BooleanType())])


def _alert_fn(trigger: float, disarm: float, k: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, on = state.get if state.exists else (0, False)
        out = []
        for ws, v in pd.concat(list(pdfs)).sort_values("window_start")[["window_start", "value"]].itertuples(index=False):
            run = run + 1 if v > trigger else 0
            if run >= k:
                on = True
            elif v < disarm:
                on = False
            out.append((key[0], ws, float(v), bool(on)))
        state.update((run, on))
        yield pd.DataFrame(out, columns=["signal", "window_start", "value", "alert"])
    return fn


def alert_stream(window_metrics: DataFrame, trigger: float, disarm: float, k: int) -> DataFrame:
    """ST5: hysteresis alert per signal; state = (current run length, alert on/off)."""
    return window_metrics.groupBy("signal").applyInPandasWithState(
        _alert_fn(trigger, disarm, k), ALERT_OUT, ALERT_STATE, "append", GroupStateTimeout.NoTimeout)
