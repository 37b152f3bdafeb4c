"""Result sinks and run tracking (IO8–IO10): append-only tables on shared storage."""
from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Write a result table (Parquet by default, CSV with header for people)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def log_run(spark: SparkSession, root: str, stage: str, dataset_fp: str, tags: dict, params: dict,
            metrics: dict[str, float]) -> str:
    """Experiment tracking: one row in ``runs`` and one row per metric in ``run_metrics`` (append)."""
    run_id = uuid.uuid4().hex
    spark.createDataFrame([(run_id, stage, dataset_fp, json.dumps(tags, sort_keys=True), json.dumps(params, sort_keys=True))],
                          "run_id string, stage string, dataset_fp string, tags string, params string") \
        .withColumn("ts", F.current_timestamp()).write.mode("append").parquet(os.path.join(root, "runs"))
    spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items()], "run_id string, metric string, value double") \
        .write.mode("append").parquet(os.path.join(root, "run_metrics"))
    return run_id


def read_or_compute(spark: SparkSession, path: str, compute) -> DataFrame:
    """Final registry: read the recorded result if it exists, otherwise compute it once and record it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    compute().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
