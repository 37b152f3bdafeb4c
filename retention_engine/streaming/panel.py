"""Streaming service panel with latency percentiles, score drift and a count of late rows (ST3).

The log may deliver a record more than once and late. Records are first de-duplicated by request id within the watermark
delay; that operator drops rows older than the watermark, row by row, and Spark's metric of it is the count of late
rows. Then one watermarked aggregate in append mode counts *cells* of an event-time window: all records of a key, those
in a latency bucket, and those in a score bin of a frozen baseline. State and output are one row a cell, whatever the
volume; cells add up, so panels of longer windows or fewer keys are made from the same cells.

Latency buckets grow geometrically: bucket i holds values in (g^(i-1), g^i] with g = (1 + e) / (1 - e). The value told
for a percentile is 2 g^i / (g + 1) for the bucket of the row at rank floor(1 + q (n - 1)); it differs from that row's
latency by at most the share e of it (``ERROR``, 1 %). Latencies of 0 or less are in a bucket of their own, told as 0.

Rows are late by the watermark of the trigger before the last one (Spark compares with the previous watermark, so that a
trigger's rows are not late by its own predecessor's end); a row as old as the watermark is late.
"""
from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import digitize, psi_class, psi_term, r6
from ..session import scratch_path

ERROR = 0.01
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Bucket of values that are not positive.
NO_LATENCY = -(2**31) + 1
CELLS = "window_start timestamp, window_end timestamp, kind string, bin int, n long, errors long, max_latency double"


def growth(error: float = ERROR) -> float:
    return (1 + error) / (1 - error)


def bucket(value: Column, error: float = ERROR) -> Column:
    """Number of the geometric bucket of a value."""
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(growth(error))))).otherwise(NO_LATENCY).cast("int")


def bucket_value(number: Column, error: float = ERROR) -> Column:
    """The value told for a bucket."""
    g = growth(error)
    return F.when(number == NO_LATENCY, 0.0).otherwise(2 * F.pow(F.lit(g), number.cast("double")) / (g + 1))


def cells(log: DataFrame, edges: list[float], by: list[str], window: str = "1 day", watermark: str = "2 days", error: float = ERROR) -> DataFrame:
    """(window, by…, kind, bin, n, errors, max_latency) of a log of (request_id, ts, status_code, latency_ms, score), as a
    batch or a stream. The edges are those of a frozen baseline."""
    once = log.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["request_id"]) if log.isStreaming else log.dropDuplicates(["request_id"])
    kept = F.filter(F.array(
        F.struct(F.lit("all").alias("kind"), F.lit(0).alias("bin")),
        F.when(F.col("latency_ms").isNotNull(), F.struct(F.lit("latency").alias("kind"), bucket(F.col("latency_ms"), error).alias("bin"))),
        F.when(F.col("score").isNotNull(), F.struct(F.lit("score").alias("kind"),
                                                    digitize("score", F.array(*[F.lit(float(e)) for e in edges])).alias("bin")))), lambda c: c.isNotNull())
    rows = once.select("ts", *by, "status_code", "latency_ms", F.explode(kept).alias("c"))
    return (rows.groupBy(F.window("ts", window).alias("w"), *by, F.col("c.kind").alias("kind"), F.col("c.bin").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code") >= 400).alias("errors"), F.max("latency_ms").alias("max_latency"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "kind", "bin", "n", "errors", "max_latency"))


def _percentile(histogram: Column, q: float, error: float) -> Column:
    """The value at rank floor(1 + q (n - 1)) of a sorted array of (bin, n)."""
    total = F.aggregate(histogram, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    rank = F.floor(1 + F.lit(q) * (total - 1))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bin"))
    at = F.aggregate(histogram, start, lambda a, x: F.struct(
        (a["seen"] + x["n"]).alias("seen"), F.coalesce(a["bin"], F.when(a["seen"] + x["n"] >= rank, x["bin"])).alias("bin")))
    return F.when(F.size(histogram) > 0, F.round(bucket_value(at["bin"], error), 3))


def panel(counted: DataFrame, props: list[float], by: list[str], error: float = ERROR) -> DataFrame:
    """The panel of written cells: requests, errors, error rate, latency percentiles, scores, PSI and its class by window
    and ``by``. ``props`` are the baseline's shares; a window without scores has no PSI ('no-data')."""
    histogram = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("bin", "n"))))
    everything = F.col("kind") == "all"
    # cells of one bin may come from several triggers or keys
    keys = ["window_start", *by]
    added = counted.groupBy(*keys, "kind", "bin").agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.max("max_latency").alias("max_latency"))
    rows = added.groupBy(*keys).agg(
        F.sum(F.when(everything, F.col("n"))).alias("requests"), F.sum(F.when(everything, F.col("errors"))).alias("errors"),
        F.max("max_latency").alias("max_latency"), histogram("latency").alias("latency"), histogram("score").alias("scores"))
    n_scores = F.aggregate("scores", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    in_bin = F.map_from_entries("scores")
    terms = [psi_term(F.lit(float(e)), F.coalesce(F.element_at(in_bin, F.lit(i)), F.lit(0)) / F.col("n_scores")) for i, e in enumerate(props)]
    psi = F.when(F.col("n_scores") > 0, r6(sum(terms[1:], terms[0])))
    out = rows.withColumn("n_scores", n_scores).withColumn("psi", psi)
    return out.select(*keys, "requests", "errors", F.round(F.col("errors") / F.col("requests"), 4).alias("error_rate"),
                      *[_percentile(F.col("latency"), q, error).alias(n) for n, q in PERCENTILES.items()],
                      F.round("max_latency", 3).alias("max"), F.col("n_scores").alias("with_predictions"), "psi", psi_class("psi").alias("class"))


@dataclass
class PanelRun:
    """Where a job writes: closed cells by trigger, and late rows by trigger."""
    cells: str
    late: str


def run(stream: DataFrame, checkpoint: str, out: PanelRun) -> None:
    """Runs a stream of cells over what is available. Cells of windows that the watermark closed are appended; the rows
    dropped as late are written by trigger, so a job that is started again adds its own triggers."""
    spark = stream.sparkSession
    # the progress of every trigger of this run is read when it has ended
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    q = (stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .format("parquet").start(out.cells))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    rows = {}
    for p in q.recentProgress:
        dropped = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
        rows[p["batchId"]] = (p["batchId"], p["numInputRows"], dropped)
    if rows:
        (spark.createDataFrame(list(rows.values()), "trigger long, rows_in long, late_rows long").coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(out.late, f"from={min(rows)}")))


def written(spark: SparkSession, out: PanelRun, schema) -> tuple[DataFrame, DataFrame]:
    """(cells, late rows by trigger) as written so far."""
    return spark.read.schema(schema).parquet(out.cells), spark.read.parquet(out.late).select("trigger", "rows_in", "late_rows")


def run_panel(log: DataFrame, edges: list[float], props: list[float], by: list[str], window: str = "1 day", watermark: str = "2 days",
              checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Runs the job to the end of what is available: (panel of the closed windows, late rows by trigger)."""
    spark = log.sparkSession
    stream = cells(log, edges, by, window, watermark)
    out = PanelRun(scratch_path(spark, "panel-cells"), scratch_path(spark, "panel-late"))
    run(stream, checkpoint or scratch_path(spark, "panel-checkpoint"), out)
    got, late = written(spark, out, stream.schema)
    return panel(got, props, by), late
