"""Streaming results equal the batch operators on the same input."""
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from retention_engine.operators import monitor as MO
from retention_engine.operators import quality as QU
from retention_engine.sources import adapters
from retention_engine.streaming import service as ST

SF = "/root/testdata/sf0.001"


def test_panel_stream_equals_batch(spark):
    log = ST.as_log(ST.event_stream(spark, SF))
    s = ST.run_available_now(ST.service_panel_stream(log), "t_panel", output_mode="complete")
    b = adapters.inference_log(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    bb = b.groupBy(F.window("ts", "1 hour").start.alias("window_start"), "route").agg(
        F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors"),
        F.count("score").alias("with_predictions"), F.max("latency_ms").alias("max_latency"))
    assert sorted(s.collect()) == sorted(bb.collect())


def test_dedup_stream(spark):
    log = ST.as_log(ST.event_stream(spark, SF))
    s = ST.run_available_now(ST.dedup_stream(log).select("request_id"), "t_dedup")
    assert s.count() == adapters.inference_log(spark, SF).select("request_id").distinct().count()


def test_volume_windows_stream_equals_batch(spark):
    log = ST.as_log(ST.event_stream(spark, SF))
    s = ST.run_available_now(ST.volume_windows_stream(log, size=50), "t_vol")
    b = MO.volume_windows(adapters.inference_log(spark, SF), size=50)
    got = sorted((r["artifact"], r["window_no"], r["n"], r["mean_score"]) for r in s.collect())
    exp = sorted((r["artifact"], r["window_no"], r["n"], r["mean_score"]) for r in b.collect())
    assert got == exp and len(got) > 0


def test_alert_stream_equals_batch(spark):
    b = adapters.inference_log(spark, SF)
    m = b.groupBy(F.col("route").alias("signal"), F.date_trunc("day", "ts").cast("timestamp").alias("window_start")) \
         .agg(F.round(F.avg((F.col("status_code") >= 400).cast("double")), 6).alias("value"))
    path = tempfile.mkdtemp(prefix="re-alert-")
    m.write.mode("overwrite").parquet(path)
    st = spark.readStream.schema(m.schema).parquet(path)
    s = ST.run_available_now(ST.alert_stream(st, 0.12, 0.08, 2), "t_alert")
    bat = MO.hysteresis(m, "signal", "window_start", "value", 0.12, 0.08, 2)
    assert sorted((r["signal"], r["window_start"], r["alert"]) for r in s.collect()) == \
        sorted((r["signal"], r["window_start"], r["alert"]) for r in bat.collect())


def test_late_outcome_join_equals_batch(spark):
    b = adapters.inference_log(spark, SF).where(F.col("score").isNotNull())
    out = adapters.outcomes(b)
    pdir, odir = tempfile.mkdtemp(prefix="re-p-"), tempfile.mkdtemp(prefix="re-o-")
    b.select("request_id", F.col("ts").cast("timestamp").alias("ts"), "score").write.mode("overwrite").parquet(pdir)
    out.select(F.col("request_id").alias("o_request_id"), F.col("outcome_ts").cast("timestamp").alias("outcome_ts"), "y") \
       .write.mode("overwrite").parquet(odir)
    ps = spark.readStream.schema("request_id long, ts timestamp, score double").parquet(pdir)
    os_ = spark.readStream.schema("o_request_id long, outcome_ts timestamp, y int").parquet(odir)
    s = ST.run_available_now(ST.late_outcome_join(ps, os_).select("request_id", "y"), "t_join")
    batch = MO.reconcile(b, out).select("request_id", "y")
    assert sorted(s.collect()) == sorted(batch.collect())


def test_validate_and_route_micro_batch(spark):
    snap = adapters.customer_snapshot(spark, SF)
    dirty = adapters.dirty_payload(snap)
    c = QU.TableContract((QU.FieldRule("segment", "categorical",
                                       allowed=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
                          QU.FieldRule("tenure_days", "numeric", 0.0, 20000.0)))
    src = tempfile.mkdtemp(prefix="re-src-")
    dirty.write.mode("overwrite").parquet(src)
    acc, qua, ck = (tempfile.mkdtemp(prefix=p) for p in ("re-acc-", "re-qua-", "re-ck-"))
    stream = spark.readStream.schema(dirty.schema).parquet(src)
    q = (stream.writeStream.foreachBatch(lambda df, _: ST.validate_and_route(df, c, acc, qua))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    v = QU.validate(dirty, c)
    ok, bad = QU.split_accepted(v, QU.validate_requests(v))
    assert spark.read.parquet(acc).count() == ok.count()
    assert spark.read.parquet(qua).count() == bad.count()


def test_folder_table_streams_like_a_file(spark, tmp_path):
    ev = spark.read.parquet(os.path.join(SF, "events.parquet"))
    ev.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for files in (None, 1):
        s = ST.run_available_now(ST.as_log(ST.event_stream(spark, str(tmp_path), files)).select("request_id"), "t_folder")
        assert s.count() == ev.count() > 0


def test_volume_windows_in_any_order_of_arrival(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        log = ST.as_log(ST.event_stream(spark, SF)).repartition(5, F.md5(F.col("request_id").cast("string")))
        s = ST.run_available_now(ST.volume_windows_stream(log, size=50), "t_order")
        b = MO.volume_windows(adapters.inference_log(spark, SF), size=50)
        cols = ("artifact", "window_no", "n", "mean_score")
        assert sorted(tuple(r[c] for c in cols) for r in s.collect()) == sorted(tuple(r[c] for c in cols) for r in b.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_volume_windows_over_several_triggers(spark, tmp_path):
    ev = spark.read.parquet(os.path.join(SF, "events.parquet"))
    for i, part in enumerate(("event_id < 300", "event_id >= 300")):
        ev.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    s = ST.run_available_now(ST.volume_windows_stream(ST.as_log(ST.event_stream(spark, str(tmp_path), 1)), size=50), "t_triggers")
    n = ST.as_log(ev.withColumn("ts", F.col("ts").cast("timestamp"))).where("score IS NOT NULL").groupBy("artifact").count().collect()
    got = {r["artifact"]: r["k"] for r in s.groupBy("artifact").agg(F.count("*").alias("k")).collect()}
    assert got == {r["artifact"]: r["count"] // 50 for r in n} and s.where("n <> 50").count() == 0


def test_volume_windows_gather_no_artefact_in_a_task(spark, tmp_path):
    """No Python group holds rows, and a restarted job goes on in the open window."""
    ev = spark.read.parquet(os.path.join(SF, "events.parquet"))
    whole = ST.volume_windows_stream(ST.as_log(ST.event_stream(spark, SF)), size=50)
    assert "FlatMapGroupsInPandasWithState" not in whole.scores._jdf.queryExecution().analyzed().toString()
    ck, out = str(tmp_path / "ck"), []
    for part in ("event_id < 300", "event_id >= 300"):
        ev.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        windows = ST.volume_windows_stream(ST.as_log(ST.event_stream(spark, str(tmp_path))), size=50)
        out += ST.run_available_now(windows, "t_restart", checkpoint=ck).collect()
    log = ST.as_log(ev.withColumn("ts", F.col("ts").cast("timestamp"))).where("score IS NOT NULL").withColumn("late", F.col("request_id") >= 300)
    rows = log.toPandas().sort_values(["late", "ts", "request_id"])
    want = {(a, w): g["score"].mean() for a, x in rows.groupby("artifact") for w, g in x.groupby(np.arange(len(x)) // 50) if len(g) == 50}
    assert {(r["artifact"], r["window_no"]) for r in out} == set(want) and len(out) == len(want)
    assert all(abs(r["mean_score"] - want[r["artifact"], r["window_no"]]) < 1e-6 for r in out)
