"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A text's set is its distinct runs of k words (as 64-bit hashes). All sets are ordered by one total order, rarest n-gram
first. Two sets with Jaccard similarity t or more share an n-gram within their prefixes, the first
|x| - ceil(t |x|) + 1 of each. The order's frequencies are those of all texts, counted into ``SKETCH`` cells of fixed
size (several n-grams may share a cell: that moves an n-gram in the order, which stays one and the same for all
sets, so no pair is lost).

Equal sets are collapsed first. Sets that share a prefix n-gram are candidates if
  length      the smaller has at least t times the larger's size,
  position    at their first shared n-gram, which stands at i in one and j in the other, the lesser of |x| - i and
              |y| - j is enough: all else that they share lies behind it in both,
  suffix      few enough n-grams can be in one of both only. A set's PARITY_BITS parities (whether an odd number of its
              hashes falls to each bit) differ in at most as many bits as there are such n-grams.
All three are conditions of the join itself, so only pairs that pass leave it. Each pair is verified once, on the whole
sets, cut at the same hashes first: the overlap is counted, and 100 * overlap >= 100t * union decides.

Groups of near copies are not joined with themselves. First, in ``ROUNDS`` rounds, each set is verified against one
partner: of the leaders of its prefix n-grams that pass the filters the one whose parities differ least. A leader is one set for each n-gram, in
the first round the one with the largest part of its prefix shared (what near copies were copied from), later one
by hash. The links found are contracted to components, and n-grams with sets of one component only are done with.
Only then are the remaining pairs formed, of sets that share a prefix n-gram but not a component, and verified. A
pair that is skipped has both ends in one component already, so the components are those of all links.

A set is known by a 64-bit hash of its hashes; equal sets are one node (a task sends the prefix of a set once).

Nulls and edge cases: a text with fewer than k words is one n-gram of all its words; a null text or one without words
has an empty set and links with nothing; a null id has no links; repeated rows are copies of each other; an empty
table gives an empty result; other columns are ignored. Texts of any length are read whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import batch_rows, components, leave_memos, mix, shingles, slices, split_words, whitespace_mask

NGRAM, PERCENT = 4, 85
SKETCH_BITS = 20
SKETCH_PARTS = 64
PARITY_BITS = 256
PARITIES = [f"p{i}" for i in range(PARITY_BITS // 64)]
#: Texts to verify whose ids are broadcast to pick them out; more are picked by a shuffled join.
BROADCAST_IDS = 1_000_000
ROUNDS = 2


def sets_of(col: pa.Array, ngram: int) -> Iterator[np.ndarray]:
    """The distinct n-gram hashes of every text, sorted."""
    mask = whitespace_mask()
    for a, b, data, off in slices(col):
        w = split_words(data, off, mask, lower=True)
        h, at = shingles(w, ngram)
        doc = w.doc[at]
        first = np.searchsorted(doc, np.arange(b - a + 1))
        for i in range(b - a):
            if first[i + 1] > first[i]:
                yield np.unique(h[first[i]:first[i + 1]])
            else:
                some = w.hash[w.first[i]:w.first[i + 1]]
                if len(some):
                    one = np.uint64(len(some))
                    for x in some:
                        one = mix(np.array([one * np.uint64(0x9E3779B97F4A7C15) + x]))[0]
                    yield np.array([one])
                else:
                    yield np.zeros(0, np.uint64)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _node(s: np.ndarray) -> int:
    """The hash that stands for a whole set."""
    x = np.array([mix(s).sum(), s.sum()], np.uint64)
    return int(mix(mix(x[:1]) + x[1:]).view(np.int64)[0])


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of PARITY_BITS bits (as longs) for each set: whether an odd number of its hashes falls to the bit."""
    n = len(sets)
    at = np.repeat(np.arange(n), [len(s) for s in sets]) * PARITY_BITS
    bit = (np.concatenate([np.zeros(0, np.uint64), *sets]) % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(at + bit, minlength=n * PARITY_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, PARITY_BITS), axis=1).view(np.int64)


READ_SCHEMA = f"doc_id long, n_shingles long, node long, {', '.join(f'{p} long' for p in PARITIES)}, part int, counts binary"


def _read(ngram: int):
    """A row per text (doc_id, n_shingles, node, parities), and at a task's end the frequencies of its n-grams' cells."""
    step = (1 << SKETCH_BITS) // SKETCH_PARTS
    names = ["doc_id", "n_shingles", "node", *PARITIES, "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_memos()
        total = np.zeros(1 << SKETCH_BITS, np.int32)
        for b in batches:
            sets = list(sets_of(b.column(1), ngram))
            np.add.at(total, _cell(np.concatenate(sets) if sets else np.zeros(0, np.uint64)), 1)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                 *(pa.array(p) for p in parities(sets).T.copy()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        some = [i for i in range(SKETCH_PARTS) if total[i * step:(i + 1) * step].any()]
        n = len(some)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64())] * (len(names) - 2) + [
                pa.array(some, pa.int32()), pa.array([total[i * step:(i + 1) * step].tobytes() for i in some], pa.binary())], names)
    return run


def _frequencies(read: DataFrame) -> np.ndarray:
    """Frequencies of all cells, summed over all tasks on the executors in two steps."""
    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.int64)
        for n in pdf["counts"]:
            total += np.frombuffer(n, np.int64 if len(n) == total.nbytes else np.int32)
        return pd.DataFrame({"part": [key[0]], "counts": [total.tobytes()]})

    parts = read.where("part IS NOT NULL").select("part", "counts", (F.spark_partition_id() % 64).alias("some"))
    parts = parts.groupBy("part", "some").applyInPandas(add, "part int, counts binary")
    parts = parts.groupBy("part").applyInPandas(add, "part int, counts binary")
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for r in parts.collect():  # SKETCH_PARTS rows of fixed size
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(out.ravel(), 0xFFFFFFFF).astype(np.uint32)


def prefix_of(s: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The rarest |x| - ceil(t |x|) + 1 n-grams of a set in the total order (frequency, hash)."""
    m = len(s) - -(-percent * len(s) // 100) + 1
    top = rank[_cell(s)]
    near = np.flatnonzero(top <= np.partition(top, m - 1)[m - 1]) if m < len(s) else np.arange(len(s))
    return s[near[np.argsort(top[near], kind="stable")][:m]]  # a set is in the order of its hashes already


def _prefixes(rank: np.ndarray, ngram: int, percent: int):
    """(gram, node, size, at) for the prefix of every set, ``at``: the n-gram's place in it; a task sends equal sets once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            grams, nodes, sizes = [np.zeros(0, np.uint64)], [], []
            for s in sets_of(b.column(0), ngram):
                if len(s) and (node := _node(s)) not in seen:
                    seen.add(node)
                    grams.append(prefix_of(s, rank, percent))
                    nodes.append(node)
                    sizes.append(len(s))
            n = np.array([len(g) for g in grams[1:]], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), n)),
                 pa.array(np.repeat(np.array(sizes, np.int32), n)),
                 pa.array(np.concatenate([np.zeros(0, np.int32), *(np.arange(x, dtype=np.int32) for x in n)]))], ["gram", "node", "size", "at"])
    return run


def similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity: length filter, suffix filter, then the overlap itself."""
    if min(len(s), len(t)) * 100 < max(len(s), len(t)) * percent:
        return False
    need = -(-percent * (len(s) + len(t)) // (100 + percent))
    cuts = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
    parts = [np.diff(np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]])) for x in (s, t)]
    if np.minimum(*parts).sum() < need:
        return False
    both = np.concatenate([s, t])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum()) >= need


def _verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, ngram: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of nodes that link, written. Only texts of nodes in a pair are read into sets and shuffled."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Another text with the same id is not the node's.
            own = [(n, s.tobytes()) for n, s in zip(b.column(0).to_pylist(), sets_of(b.column(1), ngram), strict=True) if len(s) and _node(s) == n]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in own], pa.int64()), pa.array([s for _, s in own], pa.binary())], ["node", "set"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array([similar(*(np.frombuffer(x.as_buffer(), np.uint64) for x in xy), percent)
                             for xy in zip(b.column(2), b.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    pairs = materialize(pairs, f"{name}-pairs")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    needed = materialize(needed.join(reps.select("node", "rep"), "node"), f"{name}-needed")
    ids = needed.select("node", F.col("rep").alias("doc_id"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    found = docs.join(ids, "doc_id").select("node", "text").mapInArrow(sets, "node long, `set` binary")
    found = materialize(found, f"{name}-sets")
    left, right = (found.select(F.col("node").alias(n), F.col("set").alias(f"set_{n}")) for n in "ab")
    links = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(decide, "a long, b long")
    links = materialize(links, f"{name}-links")
    discard(pairs, needed, found)
    return links


def _need(s: Column, t: Column, percent: int) -> Column:
    """The overlap at which sets of these sizes link."""
    return F.ceil(percent * (s + t) / F.lit(100 + percent))


def _differ(one: str, two: str) -> Column:
    """How many parities differ; ``one`` and ``two`` are the prefixes of the columns' names."""
    bits = [F.bit_count(F.col(f"{one}{p}").bitwiseXOR(F.col(f"{two}{p}"))) for p in PARITIES]
    return sum(bits[1:], bits[0])


def _possible(one: str, two: str, percent: int) -> Column:
    """Length and suffix filter on two sets."""
    s, t = F.col(f"{one}size"), F.col(f"{two}size")
    lengths = F.least(s, t) * 100 >= F.greatest(s, t) * percent
    return lengths & (_differ(one, two) <= s + t - 2 * _need(s, t, percent))


def _in_place(one: str, two: str, percent: int) -> Column:
    """Positional filter on an n-gram that two sets share."""
    s, t = F.col(f"{one}size"), F.col(f"{two}size")
    return F.least(s - F.col(f"{one}at"), t - F.col(f"{two}at")) >= _need(s, t, percent)


def _mixed(shared: DataFrame, every: DataFrame) -> DataFrame:
    """Entries (gram, node, size, at, parities, c, main), written, of the n-grams that sets of several components hold; ``main``: the largest."""
    placed = shared.join(every, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    placed = materialize(placed, "jaccard-placed")
    main = placed.groupBy("gram", "c").count().groupBy("gram").agg(
        F.max_by("c", F.struct("count", "c")).alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
    main = materialize(main, "jaccard-main")
    mixed = materialize(placed.join(main, "gram"), "jaccard-mixed")
    discard(placed, main)
    return mixed


def _partners(mixed: DataFrame, turn: int, percent: int, done: DataFrame | None) -> DataFrame:
    """One pair (a, b) for each node, written, with the leader of another component whose parities differ least."""
    if turn == 0:
        part = mixed.groupBy("node", "size").agg((F.count("*") / F.col("size")).alias("w")).select("node", "w")
        ranked = mixed.join(part, "node")
    else:
        ranked = mixed.withColumn("w", F.xxhash64("node", F.lit(turn)))
    leader = ranked.groupBy("gram").agg(F.max(F.struct("w", "node", "c", "size", "at", *PARITIES)).alias("l")).select("gram", "l")
    leader = materialize(leader, f"jaccard-leaders-{turn}")
    found = mixed.alias("x").join(leader, "gram").where(
        (F.col("c") != F.col("l.c")) & _possible("x.", "l.", percent) & _in_place("x.", "l.", percent))
    found = found.select("node", F.col("l.node").alias("leader"), _differ("x.", "l.").alias("differ"),
                         F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b"))
    if done is not None:
        found = found.join(done, ["a", "b"], "left_anti")
    best = found.groupBy("node").agg(F.min_by(F.struct("a", "b"), F.struct("differ", "leader")).alias("p"))
    pairs = materialize(best.select("p.a", "p.b").distinct(), f"jaccard-pairs-{turn}")
    discard(leader)
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; sets link at ``percent`` hundredths of Jaccard similarity."""
    batch_rows(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    read = materialize(rows.mapInArrow(_read(ngram), READ_SCHEMA), "jaccard-read")
    narrow = read.where("part IS NULL").select("doc_id", "n_shingles", "node", *PARITIES)
    reps = materialize(narrow.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").cast("int").alias("size"), *(F.max(p).alias(p) for p in PARITIES)), "jaccard-nodes")
    rank = _frequencies(read)
    prefix = materialize(rows.where("doc_id IS NOT NULL").select("text").mapInArrow(
        _prefixes(rank, ngram, percent), "gram long, node long, size int, at int"), "jaccard-prefixes")
    often = prefix.groupBy("gram").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("gram")
    # Sums are written before they are joined: a join straight on two shuffles is one that Spark can split.
    often = materialize(often, "jaccard-often")
    twice = materialize(prefix.join(often, "gram"), "jaccard-twice")
    discard(prefix, often)
    once = materialize(twice.distinct(), "jaccard-once")
    discard(twice)
    shared = materialize(once.join(reps.select("node", *PARITIES), "node"), "jaccard-shared")
    discard(once)

    links = pairs = None
    every = docs.sparkSession.createDataFrame([], "node long, component long")
    for turn in range(ROUNDS):
        mixed = _mixed(shared, every)
        new = _partners(mixed, turn, percent, pairs)
        discard(mixed)
        if new.isEmpty():
            break
        found = _verify(new, rows, reps, ngram, percent, f"turn-{turn}")
        links = found if links is None else links.unionByName(found)
        pairs = new if pairs is None else pairs.unionByName(new)
        every = components(links, "a", "b", "jaccard")

    # Then all pairs that share an n-gram and no component and pass the filters, once for each n-gram where they do.
    mixed = _mixed(shared, every)
    discard(shared)
    x, y = mixed.where("c <> main").alias("x"), mixed.alias("y")
    once = (F.col("y.c") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    rest = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.c") != F.col("y.c")) & once
                  & _possible("x.", "y.", percent) & _in_place("x.", "y.", percent)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    if pairs is not None:
        rest = rest.join(pairs, ["a", "b"], "left_anti")
    more = _verify(rest, rows, reps, ngram, percent, "rest")
    discard(mixed)
    every = components(more if links is None else links.unionByName(more), "a", "b", "jaccard-all")

    # A component's name is its smallest id; a node that links with nothing has its copies.
    named = reps.join(every, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "component").select("node", "component_id")
    lone = F.when(F.col("node").isNotNull() & F.col("doc_id").isNotNull(), F.col("node"))
    keyed = narrow.drop(*PARITIES).withColumn("k", F.coalesce(lone, F.xxhash64("doc_id", F.lit("alone")))).withColumn("ok", lone.isNotNull())
    out = keyed.join(named.withColumnRenamed("node", "k"), "k", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
