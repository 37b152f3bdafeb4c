"""Shared inputs of the registered queries (each one re-derived from the tables by Spark)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize
from ..sources import adapters


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer snapshot, derived from the tables and written once to the shared checkpoint folder
    for this query: every operator branch then reads one Parquet relation instead of re-planning (and
    re-running) the five-table derivation, and the lineage is cut."""
    return materialize(adapters.customer_snapshot(spark, sf_dir), "snapshot")


def log(spark: SparkSession, sf_dir: str, homogeneous: bool = False) -> DataFrame:
    return adapters.inference_log(spark, sf_dir, homogeneous)
