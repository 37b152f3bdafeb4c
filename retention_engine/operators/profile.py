"""Exploratory profiling (E1–E13): every profile is one or two grouped passes over long-form columns."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import r6
from .drift import long_categorical, long_numeric
from .quantiles import exact_quantiles
from .ranking import checked_broadcast, with_row


def target_distribution(df: DataFrame, label: str = "y") -> DataFrame:
    """Class counts, shares and the accuracy floor of always predicting the majority."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    return with_row(c, tot).select(
        label, "n", r6(F.col("n") / F.col("_t")).alias("share"))


def null_pattern(df: DataFrame, cols: Sequence[str], label: str = "y") -> DataFrame:
    """Null count per (column, class): a column null only in one class leaks the target."""
    d = df.select(label, *[F.col(c).isNull().cast("int").alias(c) for c in cols])
    long = d.unpivot([label], list(cols), "column", "is_null")
    return long.groupBy("column", label).agg(F.sum("is_null").cast("long").alias("nulls"))


def by_class_stats(df: DataFrame, value: str, label: str = "y") -> DataFrame:
    return df.groupBy(label).agg(r6(F.avg(value)).alias("mean"), r6(F.min(value)).alias("min"),
                                 r6(F.max(value)).alias("max"))


def degenerate_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct count per column (nulls ignored); one value → degenerate."""
    d = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = d.unpivot([], list(cols), "column", "v").where(F.col("v").isNotNull())
    return long.groupBy("column").agg(F.count_distinct("v").alias("n_distinct")) \
               .withColumn("degenerate", F.col("n_distinct") <= 1)


def rate_amplitude(df: DataFrame, cats: Sequence[str], label: str = "y") -> DataFrame:
    """Per categorical: target rate per level, amplitude = (max − min) in percentage points (1 dp)."""
    long = long_categorical(df, cats, ids=[label]).where(F.col("level").isNotNull())
    lv = long.groupBy("feature", "level").agg(F.avg(F.col(label).cast("double")).alias("rate"),
                                              F.count(F.lit(1)).alias("n"))
    return lv.groupBy("feature").agg(F.round((F.max("rate") - F.min("rate")) * 100, 1).alias("amplitude_pp"),
                                     F.count(F.lit(1)).alias("levels"))


def level_rates(df: DataFrame, cats: Sequence[str], label: str = "y") -> DataFrame:
    long = long_categorical(df, cats, ids=[label]).where(F.col("level").isNotNull())
    return long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"),
                                                r6(F.avg(F.col(label).cast("double"))).alias("rate"))


def outliers_and_corr(df: DataFrame, nums: Sequence[str], label: str = "y") -> DataFrame:
    """|z| > 3 count (sample std), min, max and Pearson correlation with the target, per column."""
    long = long_numeric(df, nums, ids=[label]).where(F.col("value").isNotNull())
    st = long.groupBy("feature").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"),
                                     r6(F.min("value")).alias("min"), r6(F.max("value")).alias("max"),
                                     r6(F.corr("value", F.col(label).cast("double"))).alias("corr_target"))
    st = checked_broadcast(st, "column-stats")       # one row per feature
    j = long.join(st.select("feature", "_m", "_s"), "feature")
    z = j.groupBy("feature").agg(F.count_if(F.abs((F.col("value") - F.col("_m")) / F.col("_s")) > 3).alias("outliers"))
    return st.join(z, "feature").drop("_m", "_s")


def redundancy(df: DataFrame, target: str, a: str, b: str, where=None) -> DataFrame:
    """corr(target, a·b) and median relative error |(target − a·b)/target| (rows passing ``where``)."""
    d = df.where(where) if where is not None else df
    d = d.select(F.col(target).alias("t"), (F.col(a) * F.col(b)).alias("ab"))
    c = d.agg(r6(F.corr("t", "ab")).alias("corr"), F.count(F.lit(1)).alias("n"))
    rel = d.select(F.abs((F.col("t") - F.col("ab")) / F.col("t")).alias("rel"))
    med = exact_quantiles(rel, "rel", [0.5]).select(r6("quantile").alias("median_rel_error"))
    return with_row(c, med)


def quartile_rates(df: DataFrame, value: str, label: str = "y") -> DataFrame:
    """Target rate by quartile bin of ``value`` (edges = exact quartiles, right-closed like qcut)."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75])
    edges = q.agg(F.array_sort(F.collect_list("quantile")).alias("_e"))       # 3 numbers
    d = with_row(df.where(F.col(value).isNotNull()), edges)
    b = F.size(F.filter("_e", lambda e: e < F.col(value)))                       # right-closed
    return d.groupBy(b.alias("quartile")).agg(F.count(F.lit(1)).alias("n"),
                                              r6(F.avg(F.col(label).cast("double"))).alias("rate"))


def crosstab_shares(df: DataFrame, row: str, col: str) -> DataFrame:
    """Cross-tab in long form with the share of each cell within its row."""
    c = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(row)
    return c.withColumn("row_share", r6(F.col("n") / F.sum("n").over(w)))


def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, exact distinct levels and mean rows per level per column."""
    n = df.count()                      # one number
    d = degenerate_columns(df, cols)
    return d.select("column", "n_distinct", F.lit(n).cast("long").alias("rows"),
                    F.round(F.lit(n) / F.col("n_distinct"), 1).alias("rows_per_level"))
