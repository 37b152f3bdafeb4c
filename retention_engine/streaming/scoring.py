"""Streaming validate + score (ST1): two sinks, written once each for every trigger, and read only when both are there.

Each trigger is validated by the contract of the fitted pipeline, decided request by request, and scored in the stream by
that pipeline. Accepted rows, quarantined rows and one log record a request are written to a folder of that trigger's
number, replacing what an attempt that died there may have left; a commit record of the trigger is written last. Readers
take the triggers that have one (``committed``), so rows of a half-written trigger are never seen, and a trigger that is
run again after a failure is seen once. A request must arrive whole in one trigger (a file of the source).
"""
from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as QU
from ..operators.models import score
from ..session import materialize

SINKS = ("accepted", "quarantine", "requests")


@dataclass
class ScoringJob:
    contract: QU.TableContract
    model: PipelineModel
    threshold: float
    version: str
    path: str
    request_col: str = "request_id"
    #: called with (trigger, sink) after each write; a test makes it raise to see the job die there
    after_write: Callable[[int, str], None] | None = None

    def trigger(self, batch: DataFrame, batch_id: int) -> None:
        """Micro-batch body: the same result however often it is run for one trigger."""
        rows = materialize(QU.validate(batch, self.contract), "stream-validated")
        requests = materialize(QU.validate_requests(rows, self.request_col), "stream-requests")
        ok, bad = QU.split_accepted(rows, requests, self.request_col)
        scored = score(self.model, ok.drop("errors", "valid"), self.threshold, self.version)
        refused = bad.drop("valid").join(requests.select(self.request_col, "status_code"), self.request_col)
        # a refused request is a record too: its status, and no scores
        answers = scored.groupBy(self.request_col).agg(F.count(F.lit(1)).alias("n_scored"), F.avg("probability").alias("mean_score"))
        records = requests.join(answers, self.request_col, "left").select(
            self.request_col, "status_code", "n_rows", "n_invalid", F.coalesce("n_scored", F.lit(0)).alias("n_scored"), "mean_score")
        for sink, df in zip(SINKS, (scored, refused, records), strict=True):
            df.write.mode("overwrite").parquet(os.path.join(self.path, sink, f"trigger={batch_id}"))
            if self.after_write:
                self.after_write(batch_id, sink)
        batch.sparkSession.range(1).select(F.lit(self.version).alias("model_version")).coalesce(1).write.mode("overwrite").parquet(
            os.path.join(self.path, "commits", f"trigger={batch_id}"))

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Runs what is available to the end; a job that died goes on here in the trigger it died in."""
        q = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(self.trigger).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def committed(spark: SparkSession, path: str, sink: str) -> DataFrame:
    """The rows of a sink of all committed triggers, with their ``trigger``."""
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}; one of {SINKS}")
    done = spark.read.parquet(os.path.join(path, "commits")).select("trigger").distinct()
    return spark.read.parquet(os.path.join(path, sink)).join(done, "trigger", "left_semi")
