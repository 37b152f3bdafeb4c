"""Global ranks and running totals without a single-partition window.

A window ordered over *all* rows (``Window.orderBy(score)``) pulls the table into one task. Here the rows are
range-partitioned by (group, order key): every partition is a contiguous chunk of a group's order, found by Spark's own
range partitioner. Each chunk is ranked by a window partitioned by ``(group, chunk)`` and shifted by the exact totals
of the chunks before it. Results are exact, and a hot group is spread over many chunks. The chunked rows are written
once, because totals and ranks must see the same chunks.

Groups are compared as one struct, so null group values are a group like any other.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Rows of a table that may be broadcast after they were counted.
BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame, name: str = "small") -> DataFrame:
    """``df``, written once, with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows; beyond that Spark joins it by a
    shuffle."""
    df = materialize(df, name)
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def group_struct(gk: Sequence[str]) -> Column:
    """The group as one value; structs with null fields are equal to each other in joins."""
    return F.struct(*[F.col(c) for c in gk])


def _group_keys(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if by:
        return df, list(by)
    return df.withColumn("_g", F.lit(0)), ["_g"]


def _drop_g(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.drop("_g")


def default_chunks(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def running_totals(df: DataFrame, key: str, cols: Sequence[str] = (), by: Sequence[str] = (),
                   descending: bool = False, chunks: int | None = None,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``_rn`` (1-based rank by ``key`` then ``tiebreak`` within ``by``) and ``cum_<c>`` (inclusive
    running sums). ``(key, tiebreak)`` must be unique within each group so the result is deterministic.
    Rows sharing a ``key`` always land in the same chunk, so the tie-break order is global. Null keys come first
    (last when descending).
    """
    d, gk = _group_keys(df, by)
    kd = F.col(key).cast("double")
    order_key = (-kd).asc_nulls_last() if descending else kd.asc_nulls_first()
    d = (d.repartitionByRange(chunks or default_chunks(df), *[F.col(g) for g in gk], order_key)
          .withColumn("_chunk", F.spark_partition_id()).withColumn("_grp", group_struct(gk)))
    d = materialize(d, "chunks")
    tot = d.groupBy("_grp", "_chunk").agg(F.count(F.lit(1)).alias("_cn"), *[F.sum(c).alias(f"_cs_{c}") for c in cols])
    w_before = Window.partitionBy("_grp").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_grp", "_chunk", F.coalesce(F.sum("_cn").over(w_before), F.lit(0)).alias("_on"),
                      *[F.coalesce(F.sum(f"_cs_{c}").over(w_before), F.lit(0)).alias(f"_os_{c}") for c in cols])
    order = [F.col(key).desc() if descending else F.col(key).asc()] + [F.col(t).asc() for t in tiebreak]
    w_loc = Window.partitionBy("_grp", "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", F.row_number().over(w_loc).alias("_rl"), *[F.sum(c).over(w_loc).alias(f"_cl_{c}") for c in cols])
    d = d.join(offs, ["_grp", "_chunk"])
    d = d.withColumn("_rn", F.col("_on") + F.col("_rl"))
    for c in cols:
        d = d.withColumn(f"cum_{c}", F.col(f"_os_{c}") + F.col(f"_cl_{c}"))
    d = d.drop("_chunk", "_grp", "_on", "_rl", *[f"_os_{c}" for c in cols], *[f"_cl_{c}" for c in cols])
    return _drop_g(d, by)


def ingestion_order(df: DataFrame, file: str = "_file", row: str = "_row") -> DataFrame:
    """Add ``_position`` (from 0) and ``_rows`` of rows that carry the file and row number they were read from
    (``_metadata.file_path`` and ``_metadata.row_index``). A row's place is its file's offset plus its number in the file,
    so nothing is sorted; only the table of files (one row each) is added up. Files count in the order of their paths."""
    files = df.groupBy(file).agg((F.max(row) + 1).alias("_n"))
    offset = F.sum("_n").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    files = files.select(file, F.coalesce(offset, F.lit(0)).alias("_offset"), total.alias("_rows"))
    return df.join(checked_broadcast(files, "files"), file).withColumn("_position", F.col("_offset") + F.col(row)).drop("_offset")


def with_row(df: DataFrame, row_df: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a scalar summary) to every row of ``df`` as literals.

    The summary is collected (exactly one row — a bounded size), so no join, and in particular no
    nested-loop / cartesian join, is planned for it.
    """
    rows = row_df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one summary row, got {len(rows)}")
    r = rows[0]

    def plain(v):
        if hasattr(v, "asDict"):
            return {k: plain(x) for k, x in v.asDict().items()}
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        return v

    def lit(f):
        v = r[f.name]
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) and v is not None:
            return F.from_json(F.lit(json.dumps(plain(v))), f.dataType).alias(f.name)
        return F.lit(v).cast(f.dataType).alias(f.name)
    return df.select("*", *[lit(f) for f in row_df.schema.fields if f.name != "_g"])
