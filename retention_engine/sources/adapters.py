"""Deterministic adapters that give the ranking / monitoring / fairness operators their input shapes,
derived from the driver's tables by Spark (so their size grows with the tables).

* ``customer_snapshot``  — one row per customer at a cut-off date: features, value, churn label, score.
* ``inference_log``      — one scoring-service log record per event.
* ``drift_pair``         — line items split into a frozen baseline period and a later window.
* ``quality_labels``     — labelled documents with a length-based score and group attributes.
* ``dirty_payload``      — the snapshot with contract violations planted at fixed key residues.
* ``outcomes``           — late labels joined back to logged predictions.
* ``raw_text``           — the snapshot with ``total_charges`` as text (blank and junk values).
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from .tables import load

# Fixed values of the snapshot definition.
SNAPSHOT_DATE = "1999-07-01"
HORIZON_DAYS = 365
RECENCY_HALF = 240.0
BASELINE_CUTOFF = "1998-07-01"
LOG_SCORE_HALF = 50.0
DOC_SCORE_HALF = 1500.0


def customer_snapshot(spark: SparkSession, sf_dir: str, as_of: str = SNAPSHOT_DATE,
                      horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """customer ⟕ nation ⟕ region ⟕ per-customer order history before ``as_of`` and churn label.

    One aggregation over ``orders`` (filter pushed into the scan, partial aggregation before the
    shuffle) produces both the history features and the label; the dimension joins are tiny and
    broadcast by Catalyst's size check.
    """
    t0 = F.to_date(F.lit(as_of))
    end = F.to_date(F.lit((_dt.date.fromisoformat(as_of) + _dt.timedelta(days=horizon_days)).isoformat()))
    o = (load(spark, sf_dir, "orders")
         .where(F.col("o_orderdate") < F.lit(
             (_dt.date.fromisoformat(as_of) + _dt.timedelta(days=horizon_days)).isoformat()).cast("timestamp_ntz"))
         .select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority",
                 F.to_date("o_orderdate").alias("d")))
    before = F.col("d") < t0
    hist = o.groupBy("o_custkey").agg(
        F.min(F.when(before, F.col("d"))).alias("first_d"),
        F.max(F.when(before, F.col("d"))).alias("last_d"),
        F.avg(F.when(before, F.col("o_totalprice"))).alias("avg_price"),
        F.sum(F.when(before, F.col("o_totalprice"))).alias("sum_price"),
        F.max_by(F.when(before, F.col("o_orderpriority")),
                 F.when(before, F.struct("d", "o_orderkey"))).alias("last_priority"),
        F.count_if((F.col("d") >= t0) & (F.col("d") < end)).alias("n_future"),
    )
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .join(hist, c.c_custkey == hist.o_custkey, "left"))
    recency = F.datediff(t0, F.col("last_d"))
    return base.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.when(F.col("c_acctbal") < 0, "neg").otherwise("pos").alias("balance_sign"),
        F.col("last_priority"),
        F.coalesce(F.datediff(t0, F.col("first_d")), F.lit(0)).cast("double").alias("tenure_days"),
        F.round("avg_price", 6).alias("monthly_charges"),
        F.round("sum_price", 6).alias("total_charges"),
        recency.cast("double").alias("recency_days"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("value"),
        F.when(F.coalesce(F.col("n_future"), F.lit(0)) == 0, 1).otherwise(0).alias("y"),
        F.when(F.col("last_d").isNull(), F.lit(1.0))
         .otherwise(F.round(recency / (recency + F.lit(RECENCY_HALF)), 6)).alias("score"),
    ).withColumn(
        "y_signal",
        F.when(hash_uniform("customer_id", "s") < F.lit(0.05) + F.lit(0.6) * F.col("score"), 1).otherwise(0))


def inference_log(spark: SparkSession, sf_dir: str, homogeneous: bool = False) -> DataFrame:
    """One log record per event: request id, time, route, status, latency, artefact, score, rows."""
    e = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(F.col("event_type") == "error", 500)
               .when((F.col("event_type") == "signup") & (k % 10 == 0), 422)
               .otherwise(200))
    ok = status == 200
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        F.col("user_id"),
        F.col("event_type").alias("route"),
        status.alias("status_code"),
        F.col("value").alias("latency_ms"),
        (F.lit("A") if homogeneous else F.when(k < 50, "A").otherwise("B")).alias("artifact"),
        F.when(ok, F.round(F.col("value") / (F.col("value") + F.lit(LOG_SCORE_HALF)), 6)).alias("score"),
        F.when(ok, 1 + k % 5).alias("n_rows"),
    )


def drift_pair(spark: SparkSession, sf_dir: str, cutoff: str = BASELINE_CUTOFF) -> DataFrame:
    """Line items with a ``period`` column: 'baseline' before the cut-off, 'window' after."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_shipdate") < F.lit(cutoff).cast("timestamp_ntz"), "baseline")
         .otherwise("window").alias("period"))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels: y = 1 - quality; score shrinks with length; lang / source as groups."""
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(
        "doc_id", "lang", "source", "n_chars",
        (F.lit(1) - F.col("quality")).alias("y"),
        F.round(F.lit(DOC_SCORE_HALF) / (F.lit(DOC_SCORE_HALF) + F.col("n_chars")), 6).alias("score"))


def dirty_payload(snapshot: DataFrame) -> DataFrame:
    """Contract violations planted at fixed key residues (a fixture rule, not a filter)."""
    i = F.col("customer_id")
    return snapshot.select(
        "customer_id",
        F.when(i % 50 == 0, "UNKNOWN").otherwise(F.col("segment")).alias("segment"),
        "region", "balance_sign", "last_priority",
        F.when(i % 53 == 0, F.lit(-999.0)).otherwise(F.col("tenure_days")).alias("tenure_days"),
        F.when(i % 59 == 0, F.lit(None).cast("double")).otherwise(F.col("monthly_charges")).alias("monthly_charges"),
        F.when(i % 61 == 0, F.lit(None).cast("double"))
         .when(i % 67 == 0, F.lit(1e9)).otherwise(F.col("total_charges")).alias("total_charges"),
        "value", "y", "score",
        (F.floor(i / 25)).alias("request_id"),
    )


def outcomes(log: DataFrame) -> DataFrame:
    """Late labels for scored requests: two thirds of them arrive, 0..89 days after the prediction."""
    rid = F.col("request_id")
    return (log.where(F.col("score").isNotNull() & (rid % 3 != 0))
               .select("request_id",
                       F.expr("ts + make_interval(0, 0, 0, cast(request_id % 90 as int))").alias("outcome_ts"),
                       F.when(hash_uniform("request_id", "o") < F.col("score"), 1).otherwise(0).alias("y")))


def raw_text(snapshot: DataFrame) -> DataFrame:
    """``total_charges`` as text: ' ' when missing, 'abc' junk on every 97th key."""
    i = F.col("customer_id")
    return snapshot.select(
        "customer_id", "tenure_days", "monthly_charges",
        F.when(i % 97 == 0, F.lit("abc"))
         .when(F.col("total_charges").isNull(), F.lit(" "))
         .otherwise(F.col("total_charges").cast("string")).alias("total_charges_text"))
