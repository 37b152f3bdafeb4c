"""Service monitoring semantics."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from retention_engine.operators import monitor as MO


def _log(spark, rows):
    return spark.createDataFrame(rows, "request_id long, ts timestamp, route string, status_code int, "
                                       "latency_ms double, artifact string, score double, n_rows int")


def test_error_rate_and_predictions(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, t, "score", 200, float(i), "A", 0.5, 1) for i in range(1, 100)]
    rows += [(100, t, "score", 422, 1.0, "A", None, None), (101, t, "score", 500, 2.0, "A", None, None)]
    r = MO.service_totals(_log(spark, rows), baseline_artifact="A").first()
    assert r["requests"] == 101 and r["with_predictions"] == 99
    assert r["error_rate"] == round(2 / 101, 4) and r["homogeneous"] and r["same_artifact_as_baseline"]


def test_mixed_artifacts_not_homogeneous(spark):
    t = dt.datetime(2024, 1, 1)
    r = MO.service_totals(_log(spark, [(1, t, "s", 200, 1.0, "A", .1, 1), (2, t, "s", 200, 1.0, "B", .1, 1)]),
                          baseline_artifact="A").first()
    assert not r["homogeneous"] and not r["same_artifact_as_baseline"]


def test_latency_percentiles_linear(spark):
    import numpy as np
    t = dt.datetime(2024, 1, 1)
    lat = [float(i) for i in range(1, 100)]
    r = MO.latency_percentiles(_log(spark, [(i, t, "s", 200, v, "A", .1, 1) for i, v in enumerate(lat)])).first()
    assert r["p95"] == round(float(np.percentile(lat, 95)), 3) and r["max"] == 99.0


def test_json_reader_counts_invalid(spark):
    lines = spark.createDataFrame([('{"request_id": "a", "status_code": 200}',), ('{"request_id": "b"}',),
                                   ("plain text",), ("",), ("[1, 2]",), ("42",)], "value string")
    p = MO.read_json_log(lines)
    assert p.where(~F.col("corrupt")).count() == 2 and p.where("corrupt").count() == 3


def test_hysteresis(spark):
    vals = [0.0, 0.2, 0.2, 0.1, 0.05, 0.2]
    d = spark.createDataFrame([("s", i, v) for i, v in enumerate(vals)], "signal string, w int, value double")
    a = [r["alert"] for r in MO.hysteresis(d, "signal", "w", "value", 0.12, 0.08, 2).orderBy("w").collect()]
    assert a == [False, False, True, True, False, False]


def test_volume_ratio_median_of_previous(spark):
    d = spark.createDataFrame([("A", i, float(v)) for i, v in enumerate([10, 20, 30, 40, 10])], "a string, d int, v double")
    r = [x["median_prev"] for x in MO.volume_ratio(d, "v", ["a"], "d").orderBy("d").collect()]
    assert r == [None, 10.0, 15.0, 20.0, 25.0]
