"""Contract validation, quarantine and data-expectation queries (P9–P19, IO2, P1–P3)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import identifier
from ..operators import quality as QU
from ..operators.drift import long_categorical
from ..sources import adapters
from ..sources.tables import load
from .common import snapshot
from .registry import query
from .sql import ctes

NUMERIC = {"tenure_days": (0.0, 20000.0, False), "monthly_charges": (0.0, 1e6, False),
           "total_charges": (0.0, 1e8, True)}
CATEG = ["segment", "balance_sign"]

DIRTY = ctes("snapshot", extra=[("dirty", """
  SELECT customer_id,
         CASE WHEN customer_id % 50 = 0 THEN 'UNKNOWN' ELSE segment END AS segment,
         region, balance_sign, last_priority,
         CASE WHEN customer_id % 53 = 0 THEN -999.0 ELSE tenure_days END AS tenure_days,
         CASE WHEN customer_id % 59 = 0 THEN NULL ELSE monthly_charges END AS monthly_charges,
         CASE WHEN customer_id % 61 = 0 THEN NULL WHEN customer_id % 67 = 0 THEN 1e9 ELSE total_charges END AS total_charges,
         value, y, score, CAST(floor(customer_id / 25) AS BIGINT) AS request_id
  FROM snapshot"""),
    ("errs", """
  SELECT customer_id, request_id, 'missing' AS error_type, 'segment' AS field FROM dirty WHERE segment IS NULL
  UNION ALL SELECT customer_id, request_id, 'unknown_category', 'segment' FROM dirty
    WHERE segment IS NOT NULL AND segment NOT IN (SELECT DISTINCT segment FROM snapshot WHERE segment IS NOT NULL)
  UNION ALL SELECT customer_id, request_id, 'missing', 'balance_sign' FROM dirty WHERE balance_sign IS NULL
  UNION ALL SELECT customer_id, request_id, 'unknown_category', 'balance_sign' FROM dirty
    WHERE balance_sign IS NOT NULL AND balance_sign NOT IN (SELECT DISTINCT balance_sign FROM snapshot WHERE balance_sign IS NOT NULL)
  UNION ALL SELECT customer_id, request_id, 'missing', 'tenure_days' FROM dirty WHERE tenure_days IS NULL
  UNION ALL SELECT customer_id, request_id, 'not_finite', 'tenure_days' FROM dirty WHERE NOT isfinite(tenure_days)
  UNION ALL SELECT customer_id, request_id, 'out_of_range', 'tenure_days' FROM dirty WHERE isfinite(tenure_days) AND (tenure_days < 0 OR tenure_days > 20000)
  UNION ALL SELECT customer_id, request_id, 'missing', 'monthly_charges' FROM dirty WHERE monthly_charges IS NULL
  UNION ALL SELECT customer_id, request_id, 'not_finite', 'monthly_charges' FROM dirty WHERE NOT isfinite(monthly_charges)
  UNION ALL SELECT customer_id, request_id, 'out_of_range', 'monthly_charges' FROM dirty WHERE isfinite(monthly_charges) AND (monthly_charges < 0 OR monthly_charges > 1e6)
  UNION ALL SELECT customer_id, request_id, 'not_finite', 'total_charges' FROM dirty WHERE NOT isfinite(total_charges)
  UNION ALL SELECT customer_id, request_id, 'out_of_range', 'total_charges' FROM dirty WHERE isfinite(total_charges) AND (total_charges < 0 OR total_charges > 1e8)""")])


def _validated(spark, sf_dir):
    snap = snapshot(spark, sf_dir)
    levels = long_categorical(snap, CATEG).where(F.col("level").isNotNull()).distinct()
    contract = QU.contract_from_levels(levels, NUMERIC, CATEG)
    return QU.validate(adapters.dirty_payload(snap), contract)


@query("validation_errors", ops=("P10", "P11", "P13"), sql=DIRTY + "SELECT customer_id, error_type, field FROM errs")
def q_validation_errors(spark, sf_dir):
    """Every broken rule as (row, type, field) — the value itself is never carried."""
    v = _validated(spark, sf_dir)
    return v.select("customer_id", F.explode("errors").alias("e")).select(
        "customer_id", F.col("e.type").alias("error_type"), F.col("e.field").alias("field"))


@query("request_atomicity", ops=("P19", "P14"), sql=DIRTY + """
SELECT request_id, count(*) AS n_rows,
       count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM errs)) AS n_invalid,
       count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM errs)) = 0 AND count(*) BETWEEN 1 AND 5000 AS accepted,
       CASE WHEN count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM errs)) > 0 OR count(*) > 5000 THEN 422 ELSE 200 END AS status_code
FROM dirty GROUP BY request_id""")
def q_request_atomicity(spark, sf_dir):
    """Requests of 25 rows: one invalid row rejects the whole request (status 422)."""
    return QU.validate_requests(_validated(spark, sf_dir))


@query("quarantine_split", ops=("P19",), sql=DIRTY + """
, bad AS (SELECT DISTINCT request_id FROM errs)
SELECT CASE WHEN request_id IN (SELECT request_id FROM bad) THEN 'quarantine' ELSE 'accepted' END AS sink,
       count(*) AS n_rows, count(DISTINCT request_id) AS n_requests
FROM dirty GROUP BY 1""")
def q_quarantine_split(spark, sf_dir):
    """Rows routed to the accepted or quarantine sink by their request's verdict."""
    v = _validated(spark, sf_dir)
    ok, bad = QU.split_accepted(v, QU.validate_requests(v))
    both = ok.withColumn("sink", F.lit("accepted")).unionByName(bad.withColumn("sink", F.lit("quarantine")))
    return both.groupBy("sink").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("request_id").alias("n_requests"))


@query("unknown_fields", ops=("P12",), sql=DIRTY + """
SELECT customer_id, 'c_name' AS extra_fields FROM dirty WHERE customer_id % 71 = 0""")
def q_unknown_fields(spark, sf_dir):
    """JSON payloads carrying keys outside the contract (extra fields are rejected)."""
    d = adapters.dirty_payload(snapshot(spark, sf_dir))
    cust = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_name")
    d = d.join(cust, "customer_id", "left")
    payload = F.to_json(F.struct("customer_id", "segment", "balance_sign", "tenure_days", "monthly_charges",
                                 "total_charges", F.when(F.col("customer_id") % 71 == 0, F.col("c_name")).alias("c_name")))
    allowed = ["customer_id", "segment", "balance_sign", "tenure_days", "monthly_charges", "total_charges"]
    extra = QU.unknown_fields(payload, allowed)
    return d.select("customer_id", F.array_join(extra, ",").alias("extra_fields")).where(F.col("extra_fields") != "")


@query("dataset_expectations", ops=("P16",), sql=ctes("snapshot") + """
SELECT * FROM (SELECT count(*) FILTER (WHERE tenure_days < 0) AS tenure_negative,
       count(*) FILTER (WHERE monthly_charges <= 0) AS monthly_not_positive,
       count(*) FILTER (WHERE total_charges < 0) AS total_negative,
       count(*) FILTER (WHERE customer_id IS NULL) AS key_missing,
       count(*) - count(DISTINCT customer_id) AS key_duplicated FROM snapshot)
UNPIVOT (violations FOR expectation IN (tenure_negative, monthly_not_positive, total_negative, key_missing, key_duplicated))""")
def q_dataset_expectations(spark, sf_dir):
    """Domain expectations in one pass: (expectation, violations)."""
    s = snapshot(spark, sf_dir)
    checks = {"tenure_negative": F.col("tenure_days") < 0, "monthly_not_positive": F.col("monthly_charges") <= 0,
              "total_negative": F.col("total_charges") < 0, "key_missing": F.col("customer_id").isNull()}
    e = QU.expectations(s, checks)
    dup = s.agg((F.count(F.lit(1)) - F.count_distinct("customer_id")).alias("violations")) \
           .select(F.lit("key_duplicated").alias("expectation"), "violations")
    return e.unionByName(dup)


@query("non_finite_check", ops=("P17",), sql=ctes("snapshot") + """
SELECT feature, count(*) FILTER (WHERE v IS NOT NULL AND NOT isfinite(v)) AS non_finite, count(*) FILTER (WHERE v IS NULL) AS nulls
FROM (SELECT * FROM (SELECT tenure_days, monthly_charges, total_charges, recency_days, value FROM snapshot)
      UNPIVOT INCLUDE NULLS (v FOR feature IN (tenure_days, monthly_charges, total_charges, recency_days, value))) GROUP BY feature""")
def q_non_finite_check(spark, sf_dir):
    return QU.non_finite_counts(snapshot(spark, sf_dir),
                                ["tenure_days", "monthly_charges", "total_charges", "recency_days", "value"])


@query("identifier_normalise", ops=("P9",), sql="""
SELECT DISTINCT p_type, lower(trim(regexp_replace(p_type, '[^0-9a-zA-Z]+', '_', 'g'), '_')) AS identifier FROM part""")
def q_identifier_normalise(spark, sf_dir):
    """Free-text labels → identifiers: non-alphanumeric runs to '_', trimmed, lower case."""
    return load(spark, sf_dir, "part").select("p_type").distinct().select("p_type", identifier(F.col("p_type")).alias("identifier"))


@query("table_fingerprint", ops=("IO2",), sql="""
SELECT count(*) AS rows,
       CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
            CAST(c_acctbal AS VARCHAR), c_mktsegment)), 1, 8))::UBIGINT AS BIGINT)) AS BIGINT) AS hash_sum
FROM customer""")
def q_table_fingerprint(spark, sf_dir):
    """Order-insensitive fingerprint of the customer table (which snapshot built a model)."""
    c = load(spark, sf_dir, "customer")
    return QU.fingerprint(c, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]).drop("hash_xor")


@query("raw_text_coercion", ops=("IO1", "F1"), sql=ctes("snapshot") + """
, raw AS (SELECT customer_id, CASE WHEN customer_id % 97 = 0 THEN 'abc' WHEN total_charges IS NULL THEN ' '
                 ELSE CAST(total_charges AS VARCHAR) END AS t FROM snapshot)
SELECT count(*) FILTER (WHERE TRY_CAST(trim(t) AS DOUBLE) IS NULL) AS coerced_null,
       count(*) FILTER (WHERE trim(t) = '') AS blank, count(*) FILTER (WHERE t = 'abc') AS junk,
       round(sum(coalesce(TRY_CAST(trim(t) AS DOUBLE), 0.0)), 2) AS total_after_zero_fill FROM raw""")
def q_raw_text_coercion(spark, sf_dir):
    """Text → number with blank/junk → null (try_cast), then blank = true zero."""
    r = adapters.raw_text(snapshot(spark, sf_dir))
    v = F.expr("try_cast(trim(total_charges_text) AS DOUBLE)")
    return r.agg(F.count_if(v.isNull()).alias("coerced_null"),
                 F.count_if(F.trim("total_charges_text") == "").alias("blank"),
                 F.count_if(F.col("total_charges_text") == "abc").alias("junk"),
                 F.round(F.sum(F.coalesce(v, F.lit(0.0))), 2).alias("total_after_zero_fill"))
