"""The streaming panel (percentiles, drift, late rows) and the transactional scoring job."""
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from retention_engine.operators import contract as CO
from retention_engine.operators import models as MD
from retention_engine.operators import quality as QU
from retention_engine.session import scratch_path
from retention_engine.sources import adapters
from retention_engine.streaming import panel as PN
from retention_engine.streaming import scoring as SC

SF = "/root/testdata/sf0.001"
EDGES, PROPS = [0.1, 0.2, 0.4], [0.25, 0.25, 0.25, 0.25]


def log(spark):
    return adapters.inference_log(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))


def test_percentiles_within_the_stated_error(spark):
    rows = log(spark)
    got = {r["route"]: r for r in PN.panel(PN.cells(rows, EDGES, ["route"], window="400 days"), PROPS, ["route"]).collect()}
    for route, want in rows.groupBy("route").agg(F.array_sort(F.collect_list("latency_ms"))).collect():
        for name, q in PN.PERCENTILES.items():
            exact = want[int(q * (len(want) - 1))]
            assert abs(got[route][name] - exact) <= PN.ERROR * exact + 0.0005
    assert len(got) > 3


def test_cells_add_up(spark):
    """A panel of days made from the cells of hours is the panel of days."""
    rows = log(spark)
    hours = PN.cells(rows, EDGES, ["route"], window="1 hour").withColumn("window_start", F.date_trunc("day", "window_start"))
    days = PN.cells(rows, EDGES, ["route"], window="1 day")
    assert sorted(map(str, PN.panel(hours, PROPS, ["route"]).collect())) == sorted(map(str, PN.panel(days, PROPS, ["route"]).collect()))
    whole = PN.panel(days.withColumn("window_start", F.lit(0)), PROPS, []).first()
    assert whole["requests"] == rows.count() and whole["with_predictions"] == rows.where("score IS NOT NULL").count()


def test_values_that_are_not_there(spark):
    rows = spark.createDataFrame([(1, 0, 200, None, None), (2, 0, 500, 0.0, None), (3, 0, 200, -1.0, None), (4, 0, 200, 8.0, None)],
                                 "request_id long, t long, status_code int, latency_ms double, score double").withColumn("ts", F.timestamp_seconds("t"))
    r = PN.panel(PN.cells(rows, EDGES, []), PROPS, []).first()
    assert (r["requests"], r["errors"], r["p50"], r["max"], r["with_predictions"], r["psi"], r["class"]) == (4, 1, 0.0, 8.0, 0, None, "no-data")
    r = PN.panel(PN.cells(rows.where("request_id = 1"), EDGES, []), PROPS, []).first()
    assert (r["requests"], r["p50"], r["p99"], r["max"]) == (1, None, None, None)
    assert PN.panel(PN.cells(rows.where("false"), EDGES, []), PROPS, []).count() == 0


def deliver(spark, path, rows):
    spark.createDataFrame([(i, d * 86400, 200, 5.0, 0.3) for i, d in rows], "request_id long, t long, status_code int, latency_ms double, score double").withColumn(
        "ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(path)


def test_late_and_repeated_rows_over_triggers_and_a_restart(spark, tmp_path):
    path = str(tmp_path / "log")
    deliver(spark, path, [(1, 10), (2, 11)])
    deliver(spark, path, [(3, 20), (1, 10)])       # 1 once more
    deliver(spark, path, [(4, 21), (5, 2)])        # 5 is older than 11 - 2 days: late
    stream = PN.cells(spark.readStream.schema("request_id long, status_code int, latency_ms double, score double, ts timestamp")
                      .option("maxFilesPerTrigger", 1).parquet(path), EDGES, [])
    out, checkpoint = PN.PanelRun(str(tmp_path / "cells"), str(tmp_path / "late")), str(tmp_path / "checkpoint")
    PN.run(stream, checkpoint, out)
    deliver(spark, path, [(6, 30), (7, 12), (8, 40)])   # 7 is older than 21 - 2 days
    PN.run(stream, checkpoint, out)
    got, late = PN.written(spark, out, stream.schema)
    days = {r["window_start"].day: r["requests"] for r in PN.panel(got, PROPS, []).collect()}
    first = spark.sql("SELECT day(timestamp_seconds(10 * 86400)) AS d").first()["d"]
    assert days == {first: 1, first + 1: 1, first + 10: 1, first + 11: 1, first + 20: 1}
    assert late.agg(F.sum("late_rows")).first()[0] == 2
    assert {r["trigger"]: r["late_rows"] for r in late.where("rows_in > 0").collect()}[2] == 1


class Killed(RuntimeError):
    pass


@pytest.fixture(scope="module")
def requests(spark):
    snap = adapters.customer_snapshot(spark, SF)
    model = MD.fit_pipeline(snap, "lr", ["total_charges"], ["tenure_days", "monthly_charges"], ["segment", "region"], label="y_signal")
    rows = adapters.dirty_payload(snap).withColumn("request_id", F.floor(F.col("customer_id") / 2))
    path = scratch_path(spark, "t-requests")
    rows.repartition(3, "request_id").write.parquet(path)
    limits = {"total_charges": (0.0, 1e8), "tenure_days": (0.0, 2e4), "monthly_charges": (0.0, 1e6)}
    return model, CO.contract_from_model(model, limits), rows, path


@pytest.mark.parametrize("where", [(0, "accepted"), (1, "quarantine"), (2, "requests")])
def test_a_killed_job_writes_nothing_twice(spark, requests, where, tmp_path):
    model, contract, rows, path = requests
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def die(trigger, sink):
        if (trigger, sink) == where:
            raise Killed("killed here")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    with pytest.raises(StreamingQueryException, match="killed here"):
        SC.ScoringJob(contract, model, 0.3, "v1", out, after_write=die).run(stream, checkpoint)
    if where[0]:   # what is committed so far is whole, what is not is not seen
        assert SC.committed(spark, out, "requests").agg(F.max("trigger")).first()[0] == where[0] - 1
    job = SC.ScoringJob(contract, model, 0.3, "v1", out)
    job.run(stream, checkpoint)
    job.run(stream, checkpoint)      # nothing new: nothing happens
    ok, bad, records = (SC.committed(spark, out, s) for s in SC.SINKS)
    v = QU.validate(rows, contract)
    want_ok, want_bad = QU.split_accepted(v, QU.validate_requests(v))
    ids = lambda df: sorted(r["customer_id"] for r in df.select("customer_id").collect())
    assert ids(ok) == ids(want_ok) and ids(bad) == ids(want_bad) and len(ids(ok)) > 10 and len(ids(bad)) > 10
    batch = {r["customer_id"]: (r["probability"], r["decision"]) for r in MD.score(model, want_ok.select(*rows.columns), 0.3).collect()}
    assert {r["customer_id"]: (r["probability"], r["decision"]) for r in ok.collect()} == batch
    refused = records.where("status_code = 422")
    assert refused.count() == want_bad.select("request_id").distinct().count() and refused.where("n_scored > 0 OR mean_score IS NOT NULL").count() == 0
    assert records.count() == rows.select("request_id").distinct().count()
    with pytest.raises(ValueError):
        SC.committed(spark, out, "elsewhere")
