"""Preprocessing queries: fitted statistics, transforms and encodings."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import eda_tenure_bin, r6
from ..operators import prep as PR
from ..operators.split import stratified_split
from .common import snapshot
from .q_split import _SPLIT
from .registry import query

ZERO = ["total_charges"]
NUMS = ["tenure_days", "monthly_charges", "recency_days"]
CATS = ["segment", "last_priority", "region", "balance_sign"]


def _split(spark, sf_dir):
    return stratified_split(snapshot(spark, sf_dir))


def _model(sp, encoding="onehot"):
    return PR.Preprocessor(zeroCols=ZERO, numCols=NUMS, catCols=CATS, encoding=encoding).fit(
        sp.where(F.col("split") == "train"))


_NUM_STATS_SQL = _SPLIT.rstrip("\n") + """,
tr AS (SELECT * FROM sp WHERE split = 'train'),
fills AS (SELECT 'tenure_days' AS feature, quantile_cont(tenure_days, 0.5) AS fill, 'median' AS grp FROM tr
          UNION ALL SELECT 'monthly_charges', quantile_cont(monthly_charges, 0.5), 'median' FROM tr
          UNION ALL SELECT 'recency_days', quantile_cont(recency_days, 0.5), 'median' FROM tr
          UNION ALL SELECT 'total_charges', 0.0, 'zero'),
long AS (SELECT * FROM (SELECT tenure_days, monthly_charges, recency_days, total_charges FROM tr)
         UNPIVOT INCLUDE NULLS (v FOR feature IN (tenure_days, monthly_charges, recency_days, total_charges))),
st AS (SELECT l.feature, max(f.fill) AS fill, avg(coalesce(l.v, f.fill)) AS mean, stddev_pop(coalesce(l.v, f.fill)) AS sd, max(f.grp) AS grp
       FROM long l JOIN fills f USING (feature) GROUP BY l.feature)"""


@query("prep_fit_numeric", ops=("F1", "F2", "F4"), sql=_NUM_STATS_SQL + """
SELECT feature, grp AS "group", round(fill, 6) AS fill, round(mean, 6) AS mean,
       round(CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 6) AS scale FROM st""")
def q_prep_fit_numeric(spark, sf_dir):
    """Fitted on train only: fill (0 for the 'blank = zero' group, exact median otherwise), mean and
    population std of the imputed column."""
    st = _model(_split(spark, sf_dir)).fitted["numeric"]
    rows = [(c, s["group"], float(s["fill"]), float(s["mean"]), float(s["scale"])) for c, s in st.items()]
    df = spark.createDataFrame(rows, "feature string, `group` string, fill double, mean double, scale double")
    return df.select("feature", "group", r6("fill").alias("fill"), r6("mean").alias("mean"), r6("scale").alias("scale"))


@query("prep_fit_modes", ops=("F3",), sql=_SPLIT.rstrip("\n") + """,
long AS (SELECT * FROM (SELECT segment, last_priority, region, balance_sign FROM sp WHERE split = 'train')
         UNPIVOT (level FOR feature IN (segment, last_priority, region, balance_sign))),
c AS (SELECT feature, level, count(*) AS n FROM long GROUP BY ALL)
SELECT feature, arg_min(level, (-n, level)) AS mode, count(*) AS vocab_size FROM c GROUP BY feature""")
def q_prep_fit_modes(spark, sf_dir):
    """Most frequent level per categorical (lowest name on ties) and vocabulary size."""
    st = _model(_split(spark, sf_dir)).fitted["categorical"]
    rows = [(c, s["mode"], len(s["vocab"])) for c, s in st.items()]
    return spark.createDataFrame(rows, "feature string, mode string, vocab_size long")


@query("prep_scaled_values", ops=("F1", "F2", "F4", "F8"), sql=_NUM_STATS_SQL + """,
va AS (SELECT * FROM sp WHERE split = 'val'),
vl AS (SELECT * FROM (SELECT customer_id, tenure_days, monthly_charges, recency_days, total_charges FROM va)
       UNPIVOT INCLUDE NULLS (v FOR feature IN (tenure_days, monthly_charges, recency_days, total_charges)))
SELECT customer_id, feature || '_z' AS feature, round((coalesce(v, fill) - mean) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 6) AS value
FROM vl JOIN st USING (feature)""")
def q_prep_scaled_values(spark, sf_dir):
    """Validation rows transformed with statistics fitted on train: imputed, standardised."""
    sp = _split(spark, sf_dir)
    m = _model(sp)
    out = m.transform(sp.where(F.col("split") == "val"))
    zc = [f"{c}_z" for c in ZERO + NUMS]
    return out.select("customer_id", *zc).unpivot(["customer_id"], zc, "feature", "value") \
              .withColumn("value", r6("value"))


@query("prep_fit_on_train_only", ops=("F12",), sql=_NUM_STATS_SQL + """,
al AS (SELECT * FROM (SELECT split, tenure_days, monthly_charges, recency_days, total_charges FROM sp)
       UNPIVOT INCLUDE NULLS (v FOR feature IN (tenure_days, monthly_charges, recency_days, total_charges))),
z AS (SELECT split, feature, avg((coalesce(v, fill) - mean) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END) AS m FROM al JOIN st USING (feature) GROUP BY ALL)
SELECT split, feature || '_z' AS feature, abs(m) < 1e-9 AS centred FROM z""")
def q_prep_fit_on_train_only(spark, sf_dir):
    """Scaled columns are centred on train only (validation/test means stay away from 0)."""
    sp = _split(spark, sf_dir)
    out = _model(sp).transform(sp)
    zc = [f"{c}_z" for c in ZERO + NUMS]
    long = out.select("split", *zc).unpivot(["split"], zc, "feature", "v")
    return long.groupBy("split", "feature").agg((F.abs(F.avg("v")) < 1e-9).alias("centred"))


@query("onehot_encoding", ops=("F5", "F10"), sql=_SPLIT.rstrip("\n") + """,
long AS (SELECT * FROM (SELECT segment, last_priority, region, balance_sign FROM sp WHERE split = 'train')
         UNPIVOT (level FOR feature IN (segment, last_priority, region, balance_sign))),
c AS (SELECT feature, level, count(*) AS n FROM long GROUP BY ALL),
modes AS (SELECT feature, arg_min(level, (-n, level)) AS mode FROM c GROUP BY feature),
vl AS (SELECT * FROM (SELECT customer_id, segment, last_priority, region, balance_sign FROM sp WHERE split = 'val')
       UNPIVOT INCLUDE NULLS (level FOR feature IN (segment, last_priority, region, balance_sign)))
SELECT v.customer_id, v.feature || '=' || coalesce(v.level, m.mode) AS dummy FROM vl v JOIN modes m USING (feature)
WHERE EXISTS (SELECT 1 FROM c WHERE c.feature = v.feature AND c.level = coalesce(v.level, m.mode))""")
def q_onehot_encoding(spark, sf_dir):
    """Active one-hot slots of validation rows (null → mode; a level unseen in train → no slot)."""
    sp = _split(spark, sf_dir)
    m = _model(sp)
    out = m.transform(sp.where(F.col("split") == "val"))
    dummies = [n for n in m.feature_names() if "=" in n]
    long = out.select("customer_id", *[F.col(f"`{d}`") for d in dummies]).unpivot(["customer_id"], dummies, "dummy", "v")
    return long.where(F.col("v") == 1.0).select("customer_id", "dummy")


@query("ordinal_encoding", ops=("F6",), sql=_SPLIT.rstrip("\n") + """,
long AS (SELECT * FROM (SELECT segment, last_priority, region, balance_sign FROM sp WHERE split = 'train')
         UNPIVOT (level FOR feature IN (segment, last_priority, region, balance_sign))),
c0 AS (SELECT feature, level, count(*) AS n FROM long GROUP BY feature, level),
c AS (SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS DOUBLE) AS code FROM c0),
modes AS (SELECT feature, arg_min(level, (-n, level)) AS mode FROM c GROUP BY feature),
vl AS (SELECT * FROM (SELECT customer_id, segment, last_priority, region, balance_sign FROM sp WHERE split <> 'train')
       UNPIVOT INCLUDE NULLS (level FOR feature IN (segment, last_priority, region, balance_sign)))
SELECT v.customer_id, v.feature || '_code' AS feature, coalesce(c.code, -1.0) AS code
FROM vl v JOIN modes m USING (feature) LEFT JOIN c ON c.feature = v.feature AND c.level = coalesce(v.level, m.mode)""")
def q_ordinal_encoding(spark, sf_dir):
    """Ordinal codes (index in the sorted train vocabulary; unknown → −1) for non-train rows."""
    sp = _split(spark, sf_dir)
    m = _model(sp, encoding="ordinal")
    out = m.transform(sp.where(F.col("split") != "train"))
    cc = [f"{c}_code" for c in CATS]
    return out.select("customer_id", *cc).unpivot(["customer_id"], cc, "feature", "code")


@query("anova_f", ops=("F13",), sql=_SPLIT.rstrip("\n") + """,
long AS (SELECT * FROM (SELECT y_signal, tenure_days, monthly_charges, recency_days, total_charges, value FROM sp WHERE split = 'train')
         UNPIVOT (v FOR feature IN (tenure_days, monthly_charges, recency_days, total_charges, value))),
g AS (SELECT feature, y_signal, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM long GROUP BY ALL),
t AS (SELECT feature, sum(n) AS nn, sum(s) AS s, sum(ss) AS ss, count(*) AS k, sum(s * s / n) AS b FROM g GROUP BY feature)
SELECT feature, round(((b - s * s / nn) / (k - 1)) / ((ss - b) / (nn - k)), 6) AS f_stat FROM t""")
def q_anova_f(spark, sf_dir):
    """ANOVA F of each numeric feature against the label (univariate filter score, fit on train)."""
    sp = _split(spark, sf_dir).where(F.col("split") == "train")
    return PR.anova_f(sp, ["tenure_days", "monthly_charges", "recency_days", "total_charges", "value"], "y_signal")


@query("tenure_bands", ops=("P5",), sql=_SPLIT.rstrip("\n") + """
SELECT CASE WHEN tenure_days IS NULL THEN NULL WHEN tenure_days / 30.0 <= 6 THEN '0-6m' WHEN tenure_days / 30.0 <= 12 THEN '7-12m'
            WHEN tenure_days / 30.0 <= 24 THEN '13-24m' WHEN tenure_days / 30.0 <= 48 THEN '25-48m' ELSE '49m+' END AS tenure_band,
       count(*) AS n, round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM sp GROUP BY 1""")
def q_tenure_bands(spark, sf_dir):
    """Right-closed tenure bands (months) with row count and churn rate."""
    b = PR.tenure_months_band(snapshot(spark, sf_dir))
    return b.groupBy("tenure_band").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("y").cast("double"))).alias("rate"))


@query("eda_tenure_bins", ops=("P6", "E6"), sql=_SPLIT.rstrip("\n") + """
SELECT CASE WHEN tenure_days / 30.0 > -1 AND tenure_days / 30.0 <= 6 THEN '(-1, 6]'
            WHEN tenure_days / 30.0 > 6 AND tenure_days / 30.0 <= 12 THEN '(6, 12]'
            WHEN tenure_days / 30.0 > 12 AND tenure_days / 30.0 <= 24 THEN '(12, 24]'
            WHEN tenure_days / 30.0 > 24 AND tenure_days / 30.0 <= 48 THEN '(24, 48]'
            WHEN tenure_days / 30.0 > 48 AND tenure_days / 30.0 <= 72 THEN '(48, 72]' END AS bin,
       count(*) AS n, round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM sp GROUP BY 1""")
def q_eda_tenure_bins(spark, sf_dir):
    """Bounded EDA bins of tenure months (outside (−1, 72] → null) with churn rate."""
    s = snapshot(spark, sf_dir).withColumn("bin", eda_tenure_bin(F.col("tenure_days") / 30.0))
    return s.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("y").cast("double"))).alias("rate"))


@query("derived_features", ops=("P4", "P18"), sql=_SPLIT.rstrip("\n") + f"""
, d AS (SELECT *, {PR.DERIVED['n_flags']} AS n_flags,
               CASE WHEN {PR.DERIVED['n_flags']} = 0 THEN NULL ELSE monthly_charges / {PR.DERIVED['n_flags']} END AS charge_per_flag,
               {PR.DERIVED['urgent_flag']} AS urgent_flag FROM sp)
SELECT n_flags, urgent_flag, count(*) AS n, round(avg(charge_per_flag), 6) AS mean_charge_per_flag FROM d GROUP BY ALL""")
def q_derived_features(spark, sf_dir):
    """Derived features enabled by name (SQLTransformer stage): flag count, charge per flag, urgency."""
    from pyspark.ml.feature import SQLTransformer
    names = ["n_flags", "charge_per_flag", "urgent_flag"]
    stmt = "SELECT *, " + ", ".join(f"{PR.DERIVED[d]} AS {d}" for d in names) + " FROM __THIS__"
    d = SQLTransformer(statement=stmt).transform(snapshot(spark, sf_dir))
    return d.groupBy("n_flags", "urgent_flag").agg(F.count(F.lit(1)).alias("n"),
                                                  r6(F.avg("charge_per_flag")).alias("mean_charge_per_flag"))
