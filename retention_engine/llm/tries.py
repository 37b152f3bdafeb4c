"""Prefix trie of conversations as a burst trie.

A node is a distinct sequence of first turns (role, text). Its members are the conversations that begin with it; it is
named by its smallest member and its depth, which no two nodes share. A turn's id is 128 bits hashed from role and text.

Conversations lie as suffixes in containers under trie heads, at first all in one under the root. A container of more
than ``container_turns`` turns bursts: the path that all its suffixes share becomes nodes at once, then the suffixes
are dealt by their next turn id to containers one turn deeper, in a round of joins for all containers that are too
large. The rounds end when none is. A container of one single long sequence, or of any number of copies of one, is
such a path and does not burst again. The remaining containers, each of bounded size, are dealt to shards of about
``container_turns`` turns; a task sorts a container's suffixes and sweeps over them once, closing nodes as the common
prefix with the next suffix falls back.

Sizes, common paths and next turns are aggregated before they are shuffled, so neither a conversation, nor a first turn
nor a group of copies that has a third of all rows is gathered in one task; positions in a conversation and sums along
a path are counted in chunks. Subtree sums of the swept containers are added to all heads above by one aggregate.
Digests of the members that end at a head are joined in parts of ``DIGEST_PART`` ids and read in order by one stream of
constant memory (SHA-256 cannot be computed out of order).

Nulls and edge cases: a null role or text is empty; turns are ordered by their number (null first), then role, then
text, so ties and repeated rows have a place. Rows without a conversation id belong to none and are left out. An empty
table has no nodes. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_totals
from ..session import materialize
from .common import leave_memos

CONTAINER_TURNS = 20_000
DIGEST_PART = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Fixed values of the contract: conversations are rebuilt in groups of so many ids, with a prefix of 0 to 8 turns.
GROUP, PREFIXES = 5, 9

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, pos, t1, t2, bytes): the turns of every conversation in order, ``pos`` from 0, written."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                text(role_col).alias("role"), text(text_col).alias("text")).where(F.col("conv_id").isNotNull())
    rows = running_totals(rows, "turn", by=["conv_id"], tiebreak=["role", "text"])
    return materialize(rows.select("conv_id", (F.col("_rn") - 1).cast("long").alias("pos"), F.xxhash64("role", "text").alias("t1"),
                                   F.xxhash64(F.lit(1), "text", "role").alias("t2"), F.octet_length("text").cast("long").alias("bytes")), "turns")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of every conversation that has turns."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) and the turns of the rebuilt conversations, both written: conversation c begins with the first h
    turns of the first of its group of five ids and goes on with its own after its first h, h = crc32(c) % 9."""
    own = materialize(lengths(turns), "lengths")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % PREFIXES
    convs = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), h.alias("h"), "n_turns")
    base = own.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = materialize(convs.withColumn("n_rebuilt", F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))), "rebuilt-lengths")
    first = turns.where(F.col("pos") < PREFIXES - 1).withColumnRenamed("conv_id", "base")
    begin = convs.select("conv_id", "base", "h").join(first, "base").where("pos < h").select("conv_id", "pos", "t1", "t2", "bytes")
    rest = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "bytes"))
    return convs.select("conv_id", F.col("n_rebuilt").alias("n_turns")), materialize(begin.unionByName(rest), "rebuilt")


def _sweep_container(seqs: list[tuple[tuple, int, tuple]], head: int, depth: int, parent: int | None, head_bytes: int) -> Iterator[tuple]:
    """The nodes of one container: ``seqs`` are (turn codes, conversation, bytes of the turns), all below one head."""
    seqs.sort()
    # a node: [smallest member, members, children, leaves, saved, bytes, ends, parent's index, depth]
    nodes = [[seqs[0][1], 0, 0, 0, 0, head_bytes, [], -1, depth]]
    path = [0]
    last: tuple = ()

    def close():
        node = nodes[path.pop()]
        node[3] += not node[2]
        node[4] += (node[1] - 1) * node[5]
        if path:
            up = nodes[path[-1]]
            up[0], up[1], up[2], up[3], up[4] = min(up[0], node[0]), up[1] + node[1], up[2] + 1, up[3] + node[3], up[4] + node[4]

    for codes, conv, sizes in seqs:
        common = 0
        for x, y in zip(last, codes, strict=False):
            if x != y:
                break
            common += 1
        while len(path) > common + 1:
            close()
        for k in range(common, len(codes)):
            nodes.append([conv, 0, 0, 0, 0, sizes[k], [], path[-1], depth + k + 1])
            path.append(len(nodes) - 1)
        node = nodes[path[-1]]
        node[0], node[1] = min(node[0], conv), node[1] + 1
        node[6].append(conv)
        last = codes
    while path:
        close()
    for first, n, children, leaves, saved, _, ends, up, d in nodes:
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest() if ends else NO_ENDS
        yield first, d, parent if up < 0 else nodes[up][0], n, children, leaves, saved, digest, up < 0


def _sweep_shard(table: pa.Table) -> pa.Table:
    """Sorts and sweeps the containers of a shard. A row is one turn of a suffix, or a suffix without turns (null pos)."""
    leave_memos()
    col = {c: table[c].combine_chunks() for c in table.column_names}
    t = np.stack([col[c].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t1", "t2")], axis=1)
    codes = np.unique(np.ascontiguousarray(t).view("V16").ravel(), return_inverse=True)[1].ravel()
    head, depth, conv = (col[c].to_numpy(zero_copy_only=False) for c in ("head", "depth", "conv_id"))
    pos = col["pos"].fill_null(-1).to_numpy(zero_copy_only=False)
    size = col["bytes"].fill_null(0).to_numpy(zero_copy_only=False)
    parent, head_bytes = col["parent"].to_pylist(), col["head_bytes"].to_pylist()
    order = np.lexsort((pos, conv, depth, head))
    new_conv = np.ones(len(order) + 1, bool)
    new_box = np.ones(len(order) + 1, bool)
    new_box[1:-1] = (np.diff(head[order]) != 0) | (np.diff(depth[order]) != 0)
    new_conv[1:-1] = new_box[1:-1] | (np.diff(conv[order]) != 0)
    at = np.flatnonzero(new_conv)
    out: list[tuple] = []
    seqs: list[tuple[tuple, int, tuple]] = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        rows = order[a:b]
        rows = rows[pos[rows] >= 0]
        i = order[a]
        seqs.append((tuple(codes[rows].tolist()), int(conv[i]), tuple(size[rows].tolist())))
        if new_box[b]:
            out.extend(_sweep_container(seqs, int(head[i]), int(depth[i]), parent[i], head_bytes[i]))
            seqs = []
    types = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    names = [f.split()[0] for f in NODE.split(", ")] + ["is_head"]
    return pa.table([pa.array(v, ty) for v, ty in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _digests(ends: DataFrame) -> DataFrame:
    """(head, depth, ends_sha256) of the members (head, depth, conv_id) that end at large containers."""
    ranked = running_totals(ends, "conv_id", by=["head", "depth"])
    part = F.floor((F.col("_rn") - 1) / DIGEST_PART).cast("long")
    parts = ranked.groupBy("head", "depth", part.alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        emit = lambda: pa.RecordBatch.from_pylist([{"head": now[0], "depth": now[1], "ends_sha256": digest.hexdigest()}])
        for batch in batches:
            for row in batch.to_pylist():
                if (row["head"], row["depth"]) != now:
                    if now is not None:
                        yield emit()
                    now, digest = (row["head"], row["depth"]), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(row["ids"].encode())
        if now is not None:
            yield emit()
    return (parts.repartition("head", "depth").sortWithinPartitions("head", "depth", "part").select("head", "depth", "ids")
            .mapInArrow(read, "head long, depth long, ends_sha256 string"))


def nodes(convs: DataFrame, turns: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """Every node of the trie: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``convs`` has (conv_id, n_turns) once for every conversation, ``turns`` has (conv_id, pos, t1, t2, bytes)."""
    spark = convs.sparkSession
    everyone = convs.agg(F.min("conv_id").alias("head"), F.count("*").alias("members"), F.sum(F.col("n_turns") + 1).alias("size")).first()
    if not everyone["members"]:
        return spark.createDataFrame([], NODE)
    box = ["head", "depth"]
    # one row a container: its head node, the heads above it, its members and turns
    boxes = spark.range(1).select(F.lit(everyone["head"]).alias("head"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
                                  F.lit(0).cast("long").alias("head_bytes"), F.expr("cast(array() AS array<struct<head: bigint, depth: bigint>>)").alias("up"),
                                  F.lit(everyone["members"]).alias("members"), F.lit(everyone["size"]).alias("size"))
    where = convs.select("conv_id", "n_turns", F.lit(everyone["head"]).alias("head"), F.lit(0).cast("long").alias("depth"))
    small, burst, paths, ends = [], [], [], []
    while True:
        boxes = materialize(boxes, "containers")
        small.append((where, boxes.where(F.col("size") <= container_turns)))
        large = boxes.where(F.col("size") > container_turns)
        if large.isEmpty():
            break
        inside = where.join(large.select(*box, "members"), box)
        rows = materialize(inside.join(turns, "conv_id").where("pos >= depth"), "burst")
        # the path all suffixes share: positions where every member has the same turn
        places = materialize(rows.groupBy(*box, "pos").agg(
            F.count("*").alias("n"), F.max("members").alias("members"), F.max("bytes").alias("bytes"),
            ((F.count("*") == F.max("members")) & (F.min("t1") == F.max("t1")) & (F.min("t2") == F.max("t2"))).alias("shared")), "places")
        bottom = places.groupBy(*box).agg(F.coalesce(F.min(F.when(~F.col("shared"), F.col("pos"))), F.max("pos") + 1).alias("bottom"))
        bottom = materialize(large.select(*box).join(bottom, box, "left").select(*box, F.coalesce("bottom", "depth").alias("bottom")), "bottoms")
        paths.append(places.join(bottom, box).where("pos < bottom").select(*box, (F.col("pos") + 1).alias("node_depth"), "members", "bytes"))
        ends.append(where.join(bottom, box).where("n_turns = bottom").select(*box, "conv_id"))
        # burst by the next turn
        after = rows.join(bottom, box).where("pos = bottom")
        children = after.groupBy(*box, "t1", "t2").agg(
            F.min("conv_id").alias("child"), F.max("bottom").alias("bottom"), F.max("bytes").alias("bytes"), F.count("*").alias("n"),
            F.sum(F.col("n_turns") - F.col("bottom")).alias("turns"))
        children = materialize(children, "children")
        burst.append(large.join(bottom, box).join(children.groupBy(*box).agg(F.count("*").alias("n_children")), box, "left"))
        where = materialize(after.join(children.select(*box, "t1", "t2", "child"), [*box, "t1", "t2"])
                            .select("conv_id", "n_turns", F.col("child").alias("head"), (F.col("bottom") + 1).alias("depth")), "dealt")
        boxes = children.join(large.select(*box, "up"), box).select(
            F.col("child").alias("head"), (F.col("bottom") + 1).alias("depth"), F.col("head").alias("parent"), F.col("bytes").alias("head_bytes"),
            F.concat("up", F.array(F.struct("head", "depth"))).alias("up"), F.col("n").alias("members"), F.col("turns").alias("size"))

    union = lambda frames: reduce(DataFrame.unionByName, frames)
    boxed = materialize(union([w.join(b.select(*box, "parent", "head_bytes"), box) for w, b in small]), "boxed")
    total = boxed.agg(F.sum(F.col("n_turns") - F.col("depth") + 1)).first()[0] or 0
    shard = F.pmod(F.xxhash64(*box), F.lit(-(-total // container_turns) or 1))
    t = turns.withColumnRenamed("conv_id", "c")
    suffixes = boxed.join(t, (F.col("conv_id") == F.col("c")) & (F.col("pos") >= F.col("depth")), "left").withColumn("shard", shard)
    swept = materialize(suffixes.select("shard", *box, "conv_id", "pos", "t1", "t2", "bytes", "parent", "head_bytes")
                        .groupBy("shard").applyInArrow(_sweep_shard, NODE + ", is_head boolean"), "swept")
    if not burst:
        return swept.drop("is_head")

    large = materialize(union(burst).withColumn("n_children", F.coalesce("n_children", F.lit(0))), "burst-heads")
    line = union(paths).unionByName(large.select(*box, F.col("depth").alias("node_depth"), "members", F.col("head_bytes").alias("bytes")))
    line = line.withColumn("cost", (F.col("members") - 1) * F.col("bytes"))
    line = materialize(running_totals(line, "node_depth", ["cost"], by=box, descending=True)
                       .select(*box, "node_depth", "members", F.col("cum_cost").cast("long").alias("below")), "paths")
    # what containers add to the heads above them
    up = union([b.select(F.col("head").alias("conv_id"), "depth", "up") for _, b in small])
    added = (swept.where("is_head").join(up, ["conv_id", "depth"]).groupBy("up")
             .agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")))
    own = line.groupBy(*box).agg(F.max("below").alias("saved"))
    added = added.unionByName(large.join(own, box).select("up", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved"))
    added = (added.select(F.explode("up").alias("u"), "leaves", "saved").groupBy("u.head", "u.depth")
             .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    heads = (large.select(*box, "parent", "bottom", "n_children").join(added, box, "left").join(_digests(union(ends)), box, "left")
             .withColumn("leaves", F.coalesce("leaves", F.lit(0)) + (F.col("n_children") == 0).cast("long")))
    at_bottom = F.col("node_depth") == F.col("bottom")
    above = line.join(heads, box).select(
        F.col("head").alias("conv_id"), F.col("node_depth").alias("depth"),
        F.when(F.col("node_depth") == F.col("depth"), F.col("parent")).otherwise(F.col("head")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.when(at_bottom, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"), (F.col("below") + F.coalesce("saved", F.lit(0))).cast("long").alias("saved_tokens"),
        F.when(at_bottom, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"))
    return swept.drop("is_head").unionByName(above)


def prefix_trie(conversations: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie of the conversations as they are."""
    turns = sequences(conversations)
    return nodes(materialize(lengths(turns), "lengths"), turns, container_turns)


def rebuilt_trie(conversations: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations."""
    return nodes(*rebuilt(sequences(conversations)), container_turns)


def oracle() -> str:
    """The nodes of the rebuilt conversations' trie in DuckDB SQL, over ``conversations``."""
    return f"""
WITH t AS (SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(x ORDER BY rn) AS s FROM t GROUP BY conv_id),
h AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda e, f: xor(e >> 1, 3988292384 * (e & 1)))), 4294967295) % {PREFIXES} AS h FROM c),
b AS (SELECT h.conv_id, coalesce(c.s[1:h], []) || h.s[h + 1:] AS s FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % {GROUP}),
p AS (SELECT conv_id, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS d FROM b),
m AS (SELECT conv_id, n, d, strlen(s[d][2]) AS bytes, min(conv_id) OVER (PARTITION BY d, s[1:d]) AS c FROM p),
g AS (SELECT c, d, count(*) AS n_convs, coalesce(any_value(bytes), 0) AS bytes,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY c, d),
u AS (SELECT g.*, m.c AS parent FROM g LEFT JOIN m ON m.conv_id = g.c AND m.d = g.d - 1),
k AS (SELECT parent AS c, d - 1 AS d, count(*) AS n_children FROM u WHERE d > 0 GROUP BY ALL),
v AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (c, d)),
a AS (SELECT m.c, m.d, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.bytes)::BIGINT AS saved_tokens
      FROM v JOIN m ON m.conv_id = v.c AND m.d <= v.d GROUP BY ALL)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM v JOIN a USING (c, d)
"""
