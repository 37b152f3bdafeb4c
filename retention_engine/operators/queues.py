"""Contact queues (M-J, M-P): top-k by expected loss, per team and fallback rules."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k: ``orderBy().limit(k)`` plans as TakeOrderedAndProject (a bounded heap per task)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                    salt_col: str | None = None, salt_buckets: int = 64) -> DataFrame:
    """Top-k rows per group without sorting a whole (possibly huge) group in one task.

    Stage 1 keeps the top k inside each (group, salt) slice, salt = hash of a key column; stage 2 ranks
    the at most ``k × salt_buckets`` survivors per group. Exact: every global top-k row is in the top k
    of its own slice.
    """
    by = list(by)
    d = df
    if salt_col:
        d = d.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*by, "_salt").orderBy(*order)
        d = d.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*by).orderBy(*order)
    return d.withColumn("queue_rank", F.row_number().over(w2).cast("long")).where(F.col("queue_rank") <= k)


def expected_loss_queue(df: DataFrame, k: int, score: str = "score", value: str = "value",
                        id_col: str = "customer_id") -> DataFrame:
    """Retention queue ordered by P(churn) × value, ties by id."""
    d = df.withColumn("expected_loss", F.round(F.col(score) * F.col(value), 6))
    return top_k(d, [F.col("expected_loss").desc(), F.col(id_col).asc()], k)


def fallback_queue(df: DataFrame, k: int, flag: Column, value: str = "value",
                   id_col: str = "customer_id") -> DataFrame:
    """Rule queue used when no valid model exists: flagged customers first, then by value."""
    d = df.withColumn("priority_flag", flag.cast("int"))
    return top_k(d, [F.col("priority_flag").desc(), F.col(value).desc(), F.col(id_col).asc()], k)
