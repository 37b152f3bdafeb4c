"""Inference logs as files: dated JSON lines out, a growing folder of them in (IO3–IO5, L7).

Records are appended to ``date=YYYY-MM-DD`` folders, one JSON object a line. A record of a refused request has neither
rows nor scores (absent, not zero). Features are personal data: they are written only when ``log_features`` is set, which
no default does. Lines are read as text and parsed beside it, so that a line of another writer (plain text, an array, a
number, a broken object) is counted as corrupt instead of failing the read or turning into rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import drift as D
from ..operators.monitor import LOG_SCHEMA, read_json_log, to_json_records

DATE = "date"


def append_log(log: DataFrame, path: str, log_features: bool = False, by_date: Column | None = None) -> None:
    """Appends the records of ``log`` (ts, request_id, route, status_code, …) under the date of their ``ts``."""
    day = by_date if by_date is not None else F.to_date("ts")
    lines = to_json_records(log.withColumn(DATE, day), log_features, keep=[DATE])
    lines.write.mode("append").partitionBy(DATE).text(path)


def with_features(features: T.StructType) -> T.StructType:
    """The log's schema with a list of feature records."""
    return T.StructType([*LOG_SCHEMA.fields, T.StructField("features", T.ArrayType(features))])


def read_log(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """(record fields, date, corrupt, line): every line that is not blank, with the line itself where it is corrupt.
    Dates that are asked for are the only folders read."""
    return _parsed(spark.read.schema(f"value string, {DATE} date").text(path), schema)


def read_log_stream(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA, max_files: int | None = None) -> DataFrame:
    """The same over a folder that grows; each line is read once by a job that keeps its checkpoint."""
    r = spark.readStream.schema(f"value string, {DATE} date")
    return _parsed((r.option("maxFilesPerTrigger", max_files) if max_files else r).text(path), schema)


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    out = read_json_log(lines, schema, keep=["value", DATE])
    return out.withColumn("line", F.when(F.col("corrupt"), F.col("value"))).drop("value")


def feature_drift(records: DataFrame, numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    """Logged features of a window against the frozen baselines (``drift.numeric_baseline``, ``drift.category_baseline``):
    (feature, kind, psi, class, n). A log without features gives no rows: nothing measured is not no drift."""
    out = records.sparkSession.createDataFrame([], "feature string, kind string, psi double, class string, n long")
    if "features" not in records.columns:
        return out
    flat = records.where(~F.col("corrupt")).select(F.explode("features").alias("f")).select("f.*")
    if flat.isEmpty():
        return out
    known = lambda b: [r["feature"] for r in b.select("feature").distinct().collect() if r["feature"] in flat.columns]  # noqa: E731  (a row a feature)
    parts = [D.compare_numeric(numeric, flat, sorted(known(numeric))), D.compare_categorical(categorical, flat, sorted(known(categorical)))]
    for p in parts:
        out = out.unionByName(p.select("feature", "kind", "psi", "class", "n"))
    return out
