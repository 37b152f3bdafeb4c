"""Helpers shared by the corpus operators: word and shingle hashing on Arrow buffers, components of a link table.

Hashing works on the UTF-8 bytes of a whole Arrow batch at once. A word is a maximal run of bytes outside a set
of ASCII delimiters (bytes of multi-byte characters never are delimiters), so byte runs and character runs agree.
"""
from __future__ import annotations

import gc
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize

#: Documents are hashed in slices of about this many bytes, which bounds the temporary arrays.
SLICE_BYTES = 1 << 18
BATCH_ROWS = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Value of each byte in the rolling hash, as it is and with A-Z lower-cased.
BYTE_VALUES = {False: _BYTE, True: _BYTE[_LOWER]}
_powers: dict[str, np.ndarray] = {}


def whitespace_mask() -> np.ndarray:
    """Word bytes for words ``[^\\x20\\x09-\\x0D]+``."""
    m = np.ones(256, bool)
    m[[9, 10, 11, 12, 13, 32]] = False
    return m


def batch_rows(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of long texts must fit beside the JVM heap of an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def leave_memos() -> None:
    """Drops what earlier tasks of another operator left in this worker (the tokenizer's memo): Python workers live on
    from stage to stage, and what each keeps would add up."""
    tokens = sys.modules.get(f"{__package__}.tokens")
    if tokens is not None and tokens._encoders:
        tokens._encoders.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, for n positions."""
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, SLICE_BYTES + 1)
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in (("up", _BASE), ("down", inv)):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of documents: ``doc`` (row in the slice), byte ``start``/``end`` in that document, ``hash``;
    ``first[d]:first[d + 1]`` are the words of row d."""
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    buf = col.buffers()
    off = np.frombuffer(buf[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None and buf[2].size else np.zeros(0, np.uint8)
    return data, off


def slices(col: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``slice_bytes`` bytes (one row at least): first row, end row, bytes, row offsets."""
    data, off = text_buffers(col)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + slice_bytes, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def split_words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    n, rows = len(data), len(off) - 1
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
    w = is_word[data]
    head = np.zeros(n + 1, bool)  # a document begins (or the slice ends) here
    head[off] = True
    begins = w.copy()
    begins[1:] &= ~w[:-1] | head[1:n]
    ends = w.copy()
    ends[:-1] &= ~w[1:] | head[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[lower][data] * up[:n], out=total[1:])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    first = np.searchsorted(s, off)
    doc = np.repeat(np.arange(rows), np.diff(first))
    return Words(doc, s - off[doc], e - off[doc], h, first)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words that stay inside one document, and the index of each run's first word."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _BASE + w.hash[j:j + n]
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1:])
    return mix(h[at] + np.uint64(k)), at


def components(links: DataFrame, a: str, b: str, name: str, most: int = 60) -> DataFrame:
    """(node, component) for every node of a link table; a component's name is its smallest node.

    Alternates the two star contractions (each neighbour points to the smallest neighbour) until the links
    stand still. Minima are aggregated before they are joined back, so a node with very many links is never
    gathered into one group, and each round is a written table, the last of which alone is kept: a lost executor costs one
    round at most.
    Null ends and loops are ignored; an empty table gives an empty one. More than ``most`` rounds is an error.
    """
    e = (links.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v"))
         .where("u <> v").distinct())
    e = materialize(e, f"{name}-links")
    seen = None
    for _ in range(most):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
            .where("u <> v").distinct())
        last, e = e, materialize(small, f"{name}-round")
        discard(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {most} rounds")


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the ends of the given links and the smallest end of their component: at most one per node."""
    if len(a) == 0:
        return a, b
    nodes, ij = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ij[:len(a)], ij[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]
