"""Split, fold and sampling queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as SP
from ..operators.bootstrap import bootstrap_ap
from ..operators.ranking import ingestion_order, running_totals
from ..sources.tables import load
from .common import snapshot
from .registry import query
from .sql import ctes, u

_SPLIT = ctes("snapshot", extra=[
    ("h", "SELECT *, ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15))::UBIGINT AS hk FROM snapshot"),
    ("rk", "SELECT *, row_number() OVER (PARTITION BY y ORDER BY hk, customer_id) AS rn, count(*) OVER (PARTITION BY y) AS n FROM h"),
    ("sp", """SELECT *, CASE WHEN rn <= ceil(round(n * 0.2, 9)) THEN 'test'
               WHEN rn <= ceil(round(n * 0.2, 9)) + ceil(round((n - ceil(round(n * 0.2, 9))) * 0.25, 9)) THEN 'val'
               ELSE 'train' END AS split FROM rk"""),
])


@query("split_audit", ops=("S1", "S2"), sql=_SPLIT + """
SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round(avg(CAST(y AS DOUBLE)), 6) AS rate,
       round(count(*) / (SELECT count(*) FROM sp), 6) AS share FROM sp GROUP BY split""")
def q_split_audit(spark, sf_dir):
    """Stratified 60/20/20 split: size share and positive rate per split (rates equal within rounding)."""
    sp = SP.stratified_split(snapshot(spark, sf_dir))
    tot = sp.count()          # one number
    return sp.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("positives"),
                                   F.round(F.avg(F.col("y").cast("double")), 6).alias("rate"),
                                   F.round(F.count(F.lit(1)) / F.lit(tot), 6).alias("share"))


@query("split_disjoint", ops=("S2",), sql=_SPLIT + """
SELECT a.split AS split_a, b.split AS split_b, count(*) AS overlap
FROM (SELECT DISTINCT split FROM sp) a, (SELECT DISTINCT split FROM sp) b, sp x, sp y
WHERE a.split < b.split AND x.split = a.split AND y.split = b.split AND x.customer_id = y.customer_id
GROUP BY ALL
UNION ALL SELECT 'test', 'train', 0 UNION ALL SELECT 'test', 'val', 0 UNION ALL SELECT 'train', 'val', 0""")
def q_split_disjoint(spark, sf_dir):
    """Id overlap between every pair of splits (INTERSECT) — must be zero."""
    sp = SP.stratified_split(snapshot(spark, sf_dir))
    names = ["test", "train", "val"]
    rows = None
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            inter = sp.where(F.col("split") == a).select("customer_id").intersect(
                sp.where(F.col("split") == b).select("customer_id"))
            r = inter.agg(F.count(F.lit(1)).alias("overlap")).select(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), "overlap")
            rows = r if rows is None else rows.unionByName(r)
    return rows


_FOLDS = ctes("snapshot", extra=[
    ("rf", """SELECT s.*, r AS rep,
               CAST((row_number() OVER (PARTITION BY r, y_signal ORDER BY
                     ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42-' || CAST(r AS VARCHAR)), 1, 15))::UBIGINT, customer_id) - 1) % 5 AS INTEGER) AS fold
             FROM snapshot s, range(0, 3) t(r)"""),
])


@query("fold_audit", ops=("S3", "S4"), sql=_FOLDS + """
SELECT CAST(rep AS INTEGER) AS rep, fold, count(*) AS n, CAST(sum(y_signal) AS BIGINT) AS positives FROM rf GROUP BY ALL""")
def q_fold_audit(spark, sf_dir):
    """Repeated stratified 5-fold × 3: fold sizes and positives per (rep, fold)."""
    f = SP.repeated_folds(snapshot(spark, sf_dir), k=5, reps=3, label="y_signal")
    return f.groupBy(F.col("rep").cast("int").alias("rep"), "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_signal").cast("long").alias("positives"))


@query("holdout_control", ops=("S10",), sql=ctes("snapshot") + f"""
SELECT segment, count(*) FILTER (WHERE {u('customer_id', 'holdout')} < 0.1) AS control,
       count(*) FILTER (WHERE NOT ({u('customer_id', 'holdout')} < 0.1)) AS treated FROM snapshot GROUP BY segment""")
def q_holdout_control(spark, sf_dir):
    """10 % hash-selected control group kept out of retention treatment, per segment."""
    h = SP.holdout_flag(snapshot(spark, sf_dir), 0.1)
    return h.groupBy("segment").agg(F.count_if("control").alias("control"), F.count_if(~F.col("control")).alias("treated"))


@query("sample_without_replacement", ops=("S8",), sql=ctes("snapshot") + """
SELECT * FROM snapshot ORDER BY ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15))::UBIGINT, customer_id LIMIT 200""")
def q_sample_without_replacement(spark, sf_dir):
    """A reproducible sample of 200 customers (the limit is the sampling operator itself)."""
    return SP.sample_n(snapshot(spark, sf_dir), 200)


@query("order_bias", ops=("S9",), sql=ctes("snapshot") + """
SELECT CAST(floor((rn - 1) * 10 / n) AS INTEGER) AS decile, count(*) AS rows, round(avg(CAST(y AS DOUBLE)), 6) AS rate
FROM (SELECT y, row_number() OVER (ORDER BY customer_id) AS rn, count(*) OVER () AS n FROM snapshot) GROUP BY 1""")
def q_order_bias(spark, sf_dir):
    """Target rate by ingestion-order decile: a file sorted by the target shows rates 1 … 0."""
    s = snapshot(spark, sf_dir).select("customer_id", "y")
    r = running_totals(s, "customer_id", [])
    n = s.count()             # one number
    return r.groupBy(F.floor((F.col("_rn") - 1) * 10 / F.lit(n)).cast("int").alias("decile")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("y").cast("double")), 6).alias("rate"))


@query("order_bias_ingestion", ops=("S9", "IO1"), sql=ctes("snapshot") + """
, c AS (SELECT c_custkey, row_number() OVER () AS rn, count(*) OVER () AS n FROM customer)
SELECT CAST(floor((rn - 1) * 10 / n) AS INTEGER) AS decile, count(*) AS rows, round(avg(CAST(y AS DOUBLE)), 6) AS rate
FROM c JOIN snapshot ON customer_id = c_custkey GROUP BY 1""")
def q_order_bias_ingestion(spark, sf_dir):
    """Target rate by decile of the order in which the customer rows stand in their files."""
    rows = ingestion_order(load(spark, sf_dir, "customer").select("c_custkey", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")))
    rows = rows.join(snapshot(spark, sf_dir).select("customer_id", "y"), F.col("customer_id") == F.col("c_custkey"))
    return rows.groupBy(F.floor(F.col("_position") * 10 / F.col("_rows")).cast("int").alias("decile")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("y").cast("double")), 6).alias("rate"))


@query("bootstrap_ap_ci", ops=("M16", "S5"))
def q_bootstrap_ap_ci(spark, sf_dir):
    """95 % percentile interval of AP from 2000 bootstrap replicates (Poisson resampling of the score
    histogram, replicates spread over tasks; single-class replicates skipped)."""
    return bootstrap_ap(snapshot(spark, sf_dir), label="y_signal", replicates=2000)


@query("inner_holdout", ops=("S6",), sql=ctes("snapshot") + """
, rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|42'), 1, 15))::UBIGINT, customer_id) AS rn,
                count(*) OVER (PARTITION BY y) AS n FROM snapshot)
SELECT CASE WHEN rn <= ceil(round(n * 0.15, 9)) THEN 'inner_holdout' ELSE 'fit' END AS part, y, count(*) AS n FROM rk GROUP BY ALL""")
def q_inner_holdout(spark, sf_dir):
    """Inner stratified 15 % holdout (used for early stopping / budget controls)."""
    h = SP.holdout_split(snapshot(spark, sf_dir), 0.15)
    return h.groupBy("part", "y").agg(F.count(F.lit(1)).alias("n"))
