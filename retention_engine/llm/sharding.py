"""Sharding by Karmarkar-Karp differencing, law ``bytes``: shards of near equal size from indivisible groups.

A partial partition is a tuple of ``shards`` sums, largest first. Differencing repeatedly takes the two partial
partitions with the largest spread (largest sum less smallest) and joins them in opposite order, the largest sum of
one with the smallest of the other, until one is left. The groups that matter for a level result, those of at least
1 / (shards * LARGE) of all bytes, are differenced first; there are at most shards * LARGE of them, whatever the
corpus. All others are hashed to buckets of about ``BUCKET_GROUPS`` groups, and each bucket is differenced by a task
of its own together with its share of the first result, so it fills up what the large groups left uneven.

A group is the set of rows with equal text (null counts as empty): its rows always share a shard, also when one
group alone is larger than an equal share; the other shards are then levelled beside it.

Nulls and edge cases: a null text has size 16 and crc32 0; a null id is a row like any other; repeated rows share a
shard and get a slot each; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SHARDS = 40
OVERHEAD = 16
BUCKET_GROUPS = 20_000
LARGE = 25
#: Rows of one shard that one task numbers.
CHUNK_ROWS = 50_000
LEAST_CHUNKS = 16


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins partial partitions (rows of sums, each largest first) to one.

    Returns its sums (as differences to the smallest) and, for each row and position, the shard it ends in.
    """
    n, k = parts.shape
    sums = [p - p[-1] for p in parts.astype(np.int64)]
    heap = [(-int(s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        # Position p of the result holds position order[p] of a and k - 1 - order[p] of b.
        joined.append((a, b, order))
        sums[a] = sums[b] = None
        sums.append(both - both[-1])
        heapq.heappush(heap, (-int(sums[-1][0]), len(sums) - 1))
    if n == 0:
        return np.zeros(k, np.int64), np.zeros((0, k), np.int32)
    place = np.zeros((n + len(joined), k), np.int32)
    place[-1] = np.arange(k)
    for i in range(len(joined) - 1, -1, -1):
        a, b, order = joined[i]
        place[a][order] = place[n + i]
        place[b][k - 1 - order] = place[n + i]
    return sums[-1], place[:n]


def _singles(sizes: np.ndarray, k: int) -> np.ndarray:
    parts = np.zeros((len(sizes), k), np.int64)
    parts[:, 0] = sizes
    return parts


def _bucket(base: np.ndarray, buckets: int):
    """``base``: what each shard holds already."""
    order = np.argsort(-base, kind="stable")
    share = (base - base.min())[order] // buckets

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["group_bytes", "digest"], ascending=False, kind="stable")
        _, place = difference(np.vstack([share, _singles(pdf["group_bytes"].to_numpy(), len(base))]))
        shard_at = np.empty(len(base), np.int32)
        shard_at[place[0]] = order
        return pdf[["digest"]].assign(shard=shard_at[place[1:, 0]])
    return solve


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for every row."""
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("digest")), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    groups = materialize(groups, "shard-groups")
    n, total = groups.agg(F.count("*"), F.sum("group_bytes")).first()
    if n == 0:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    is_large = F.col("group_bytes") * (shards * LARGE) >= F.lit(total)
    large = groups.where(is_large).orderBy(F.desc("group_bytes"), "digest").collect()  # shards * LARGE rows at most
    base, place = difference(_singles(np.array([r["group_bytes"] for r in large], np.int64), shards))
    buckets = -(-n // BUCKET_GROUPS)
    rest = (groups.where(~is_large).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
            .groupBy("bucket").applyInPandas(_bucket(base, buckets), "digest binary, shard int"))
    first = docs.sparkSession.createDataFrame(
        [(bytes(r["digest"]), int(p[0])) for r, p in zip(large, place, strict=True)], "digest binary, shard int")
    return _slots(materialize(rows.join(rest.unionByName(first), "digest"), "shard-joined"))


def _slots(out: DataFrame) -> DataFrame:
    """Gapless slots per shard: rows are numbered in chunks of a shard, behind the counts of its earlier chunks."""
    counts = {r["shard"]: r["count"] for r in out.groupBy("shard").count().collect()}  # one row per shard
    chunks = F.array(*[F.lit(max(LEAST_CHUNKS, -(-counts.get(s, 0) // CHUNK_ROWS))) for s in range(max(counts) + 1)])
    cut = out.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "text_crc32"), chunks[F.col("shard")]))
    before = (cut.groupBy("shard", "_chunk").count().withColumn("_before", F.sum("count").over(
        Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)))
        .select("shard", "_chunk", F.coalesce("_before", F.lit(0)).alias("_before")))
    nth = F.row_number().over(Window.partitionBy("shard", "_chunk").orderBy("doc_id", "digest"))
    return (cut.withColumn("_nth", nth).join(before, ["shard", "_chunk"])
            .withColumn("slot", (F.col("_nth") - 1 + F.col("_before")).cast("long")).drop("_chunk", "_nth", "_before"))
