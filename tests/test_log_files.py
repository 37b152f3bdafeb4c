import numpy as np
import pytest
from pyspark.sql import functions as F

from retention_engine.operators import drift as D
from retention_engine.operators.ranking import ingestion_order
from retention_engine.sources import logs

FEATURES = "array<struct<age: double, plan: string>>"
SCHEMA = f"request_id long, day int, route string, status_code int, latency_ms double, artifact string, n_rows int, score double, features {FEATURES}"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.expr("timestamp'2024-03-01 10:00:00' + make_interval(0, 0, 0, day)"))


ROWS = [(1, 0, "p", 200, 1.5, "A", 2, 0.1234567, [(30.0, "a"), (None, "b")]), (2, 0, "p", 422, 0.5, "A", None, None, None),
        (3, 1, "p", 200, 2.5, "A", 1, 0.5, [(40.0, "a")])]


def test_dated_files_and_the_mask(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_log(records(spark, ROWS), path)
    assert sorted(p.name for p in (tmp_path / "log").glob("date=*")) == ["date=2024-03-01", "date=2024-03-02"]
    text = "".join(p.read_text() for p in (tmp_path / "log").rglob("*.txt"))
    assert "features" not in text and "30" not in text and '"scores":[0.123457]' in text
    got = {r["request_id"]: r for r in logs.read_log(spark, path).collect()}
    assert set(got) == {"1", "2", "3"} and not any(r["corrupt"] for r in got.values())
    assert got["2"]["scores"] is None and got["2"]["n_rows"] is None and got["2"]["status_code"] == 422 and str(got["3"]["date"]) == "2024-03-02"
    assert [ln for ln in text.splitlines() if '"status_code":422' in ln and ("scores" in ln or "n_rows" in ln)] == []
    logs.append_log(records(spark, ROWS), path, log_features=True)
    both = logs.read_log(spark, path, logs.with_features(records(spark, ROWS).schema["features"].dataType.elementType))
    assert both.count() == 6 and both.where("features IS NOT NULL").count() == 2


def test_lines_of_another_writer_are_counted(spark, tmp_path):
    path = tmp_path / "log"
    logs.append_log(records(spark, ROWS), str(path))
    (path / "date=2024-03-01" / "other.txt").write_text('INFO up\n\n   \n[1, 2]\n42\n{"status_code": \n{"request_id": "9", "status_code": 200}\n')
    got = logs.read_log(spark, str(path))
    assert got.where("corrupt").count() == 4 and got.where("NOT corrupt").count() == 4
    assert sorted(r["line"].strip() for r in got.where("corrupt").collect()) == ["42", "INFO up", "[1, 2]", '{"status_code":']
    assert got.where("NOT corrupt AND line IS NOT NULL").count() == 0
    assert logs.read_log(spark, str(path)).where("date = date'2024-03-02'").count() == 1


def test_a_growing_folder_is_read_once(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))

    def run():
        q = (logs.read_log_stream(spark, path).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").start(out))
        q.awaitTermination()
        return sorted(r["request_id"] for r in spark.read.parquet(out).collect())
    logs.append_log(records(spark, ROWS[:2]), path)
    assert run() == ["1", "2"]
    logs.append_log(records(spark, ROWS[2:]), path)
    assert run() == ["1", "2", "3"] and run() == ["1", "2", "3"]


def test_logged_features_against_the_baseline(spark, tmp_path):
    rng = np.random.default_rng(1)
    people = spark.createDataFrame([(float(a), "ab"[int(a) % 2]) for a in rng.normal(40, 10, 500)], "age double, plan string")
    numeric, categorical = D.numeric_baseline(people, ["age"]), D.category_baseline(people, ["plan"])
    shifted = [(i, 0, "p", 200, 1.0, "A", 1, 0.5, [(float(a), "c")]) for i, a in enumerate(rng.normal(60, 10, 300))]
    path = str(tmp_path / "log")
    logs.append_log(records(spark, shifted), path, log_features=True)
    read = logs.read_log(spark, path, logs.with_features(records(spark, shifted).schema["features"].dataType.elementType))
    got = {r["feature"]: r for r in logs.feature_drift(read, numeric, categorical).collect()}
    assert got["age"]["class"] == "act" and got["plan"]["class"] == "act" and got["age"]["n"] == 300
    masked = str(tmp_path / "masked")
    logs.append_log(records(spark, shifted), masked)
    assert logs.feature_drift(logs.read_log(spark, masked), numeric, categorical).count() == 0      # not measured is not stable
    empty = logs.read_log(spark, masked, logs.with_features(records(spark, shifted).schema["features"].dataType.elementType))
    assert logs.feature_drift(empty, numeric, categorical).count() == 0


def test_multivariate_drift_is_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 2]])
    y = rng.normal(size=(200, 3)) + np.array([0, 3, 0])
    frame = lambda a: spark.createDataFrame([tuple(map(float, r)) for r in a] + [(None, 1.0, 1.0)], "a double, b double, c double")
    got = D.mahalanobis_share(frame(x), frame(y), ["a", "b", "c"]).first()
    inv = np.linalg.inv(np.cov(x.T, ddof=0))
    d = lambda v: np.sqrt(np.einsum("ij,jk,ik->i", v - x.mean(0), inv, v - x.mean(0)))
    cut = np.quantile(d(x), 0.99)
    beyond = y[d(y) > cut] - x.mean(0)
    parts = (beyond * (beyond @ inv)).mean(0)
    assert got["n"] == 200 and got["cut"] == pytest.approx(cut, abs=1e-6) and got["share_unusual"] == pytest.approx((d(y) > cut).mean(), abs=1e-6)
    assert [p["feature"] for p in got["by_feature"]] == ["a", "b", "c"]
    assert [p["part"] for p in got["by_feature"]] == pytest.approx(list(parts), abs=1e-5) and int(np.argmax(parts)) == 1


def test_noise_floor(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(v), 1.0) for i, v in enumerate(rng.normal(size=3000))], "customer_id long, x double, flat double")
    got = {r["feature"]: r for r in D.noise_floor(df.where("customer_id < 2000"), df.where("customer_id >= 2000"), ["x", "flat"]).collect()}
    assert 0 < got["x"]["halves_mean"] <= got["x"]["halves_max"] < 0.1 and 0 < got["x"]["split_psi"] < 0.1 and got["x"]["trigger_to_noise"] > 2.5
    assert got["flat"]["halves_max"] == 0 and got["flat"]["split_psi"] == 0 and got["flat"]["trigger_to_noise"] is None


def test_ingestion_order_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for lo, hi in ((0, 50), (50, 53), (53, 120)):
        spark.range(lo, hi).coalesce(1).write.mode("append").parquet(path)
    rows = spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    got = ingestion_order(rows).orderBy("_position").collect()
    assert [r["_position"] for r in got] == list(range(120)) and {r["_rows"] for r in got} == {120}
    ids = [r["id"] for r in got]
    assert sum(b != a + 1 for a, b in zip(ids, ids[1:])) <= 2 and sorted(ids) == list(range(120))
