"""Token-id files compressed by Re-Pair grammars, with random access by document.

Documents are dealt to shards by ranges of their id, so that shard after shard, and row after row within one, they
stand in ascending id order. A shard is written as blocks of bounded size. Each block has a grammar of its own: the
most frequent pairs of neighbouring symbols are replaced by nonterminals, round after round, until no pair is
frequent enough or ``ROUNDS`` are done. One round replaces many pairs, chosen by falling frequency such that no
symbol is first in one and second in another: their occurrences cannot overlap, and every one is replaced (in a run
of one symbol, whose pair is a symbol twice, every other one).

A block's bytes: a header of six unsigned 32-bit integers (documents, rules, symbols, ids, width of a symbol in
bytes, first nonterminal), then the rules (two symbols each), the expansion length of each rule, the first symbol of
each document (no symbol spans two documents), the documents' numbers of ids, and the symbols. All integers are
little-endian. A document is decoded from its own symbols alone; within one, the expansion lengths lead to any id.

Blocks are rows of a Parquet table that Spark writes and reads (shard, block, ids, doc_ids, data), so the files live
in any store Spark can reach and a lost executor costs its own tasks.

Nulls and edge cases: a null text is the end id alone; rows with a null id come first; repeated rows are stored each
for itself; an empty table writes and reads no rows; other columns are ignored. A document larger than a block is a
block of its own.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import batch_rows
from .tokens import encoder, vocabulary_path

END_ID = 2
BLOCK_IDS = 1 << 20
#: A pair is replaced while it occurs at least this often in its block.
LEAST_COUNT = 48
ROUND_RULES = 2048
ROUNDS = 6
HEADER = struct.Struct("<6I")


def _choose(keys: np.ndarray, counts: np.ndarray, bits: int, most: int, least: int) -> np.ndarray:
    """The most frequent pairs such that no symbol is first in one and second in another."""
    frequent = np.flatnonzero(counts >= least)
    order = frequent[np.argsort(-counts[frequent], kind="stable")][:4 * most]
    firsts: set[int] = set()
    seconds: set[int] = set()
    out = []
    for key in keys[order].tolist():
        a, b = key >> bits, key & ((1 << bits) - 1)
        if a not in seconds and b not in firsts and (a != b or a not in firsts and b not in seconds):
            firsts.add(a)
            seconds.add(b)
            out.append(key)
            if len(out) == most:
                break
    return np.array(sorted(out), keys.dtype)


def compress(ids: np.ndarray, starts: np.ndarray, least: int = LEAST_COUNT, rounds: int = ROUNDS,
             most: int = ROUND_RULES) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, rules (n, 2), each document's first symbol, and the first nonterminal."""
    sym = ids.astype(np.uint32)
    first = int(sym.max()) + 1 if len(sym) else 0
    heads = np.zeros(len(sym) + 1, bool)  # where a document begins: no pair reaches over it
    heads[starts] = True
    # A pair is one number, half as wide where all symbols fit in 16 bits.
    bits = 16 if first + rounds * most < 0xFFFF else 32
    kind = np.uint32 if bits == 16 else np.uint64
    none = np.iinfo(kind).max
    rules: list[np.ndarray] = []
    n = 0
    for _ in range(rounds):
        if len(sym) < 2:
            break
        key = (sym[:-1].astype(kind) << kind(bits)) | sym[1:]
        key[heads[1:len(sym)]] = none
        ordered = np.sort(key)
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(edge, len(ordered)))
        values = ordered[edge]
        if values[-1] == none:
            values, counts = values[:-1], counts[:-1]
        chosen = _choose(values, counts, bits, most, least)
        if not len(chosen):
            break
        # Only symbols that are first in a chosen pair are looked up.
        a_of = np.zeros(first + n + 1, bool)
        a_of[(chosen >> kind(bits)).astype(np.int64)] = True
        at = np.flatnonzero(a_of[sym[:-1]])
        k = np.searchsorted(chosen, key[at])
        k[k == len(chosen)] = 0
        hit = chosen[k] == key[at]
        at, k = at[hit], k[hit]
        i = np.arange(len(at))  # neighbouring hits are a run of one symbol: every other pair of it
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) != 1
        even = (i - np.maximum.accumulate(np.where(fresh, i, 0))) % 2 == 0
        at, k = at[even], k[even]
        sym[at] = first + n + k
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        heads = heads[np.append(keep, True)]
        sym = sym[keep]
        rules.append(np.stack([chosen >> kind(bits), chosen & kind((1 << bits) - 1)], axis=1).astype(np.uint32))
        n += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return sym, table, np.flatnonzero(heads[:-1]) if len(sym) else np.zeros(0, np.int64), first


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule stands for; a rule's symbols are ids or earlier rules' nonterminals."""
    out = np.zeros(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = (out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1)
    return out


def pack_block(docs: list[np.ndarray]) -> bytes:
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs)
    sym, rules, starts, first = compress(ids, np.cumsum(sizes) - sizes)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    return b"".join([HEADER.pack(len(docs), len(rules), len(sym), len(ids), width, first), rules.astype("<u4").tobytes(),
                     expansion_lengths(rules, first).astype("<u4").tobytes(), starts.astype("<u4").tobytes(),
                     sizes.astype("<u4").tobytes(), sym.astype(f"<u{width}").tobytes()])


class Block:
    """A block read back; ``doc(i)`` decodes one document, ``piece(i, at, n)`` a few of its ids."""

    def __init__(self, data: bytes):
        docs, rules, symbols, self.n_ids, width, self.first = HEADER.unpack_from(data)
        at = HEADER.size
        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out
        self.rules = take(2 * rules, "<u4").reshape(-1, 2)
        self.lengths = take(rules, "<u4")
        self.starts = np.append(take(docs, "<u4"), symbols).astype(np.int64)
        self.sizes = take(docs, "<u4")
        self.symbols = take(symbols, f"<u{width}")

    def _expand(self, sym: np.ndarray) -> np.ndarray:
        sym = sym.astype(np.int64)
        while len(big := np.flatnonzero(sym >= self.first)):
            wide = np.ones(len(sym), np.int64)
            wide[big] = 2
            at = np.cumsum(wide) - wide
            out = np.empty(at[-1] + wide[-1], np.int64)
            out[at] = sym
            pair = self.rules[sym[big] - self.first]
            out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
            sym = out
        return sym.astype("<u4")

    def all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def doc(self, i: int) -> np.ndarray:
        return self._expand(self.symbols[self.starts[i]:self.starts[i + 1]])

    def piece(self, i: int, at: int, n: int) -> np.ndarray:
        """Ids at .. at + n of document i: only the symbols that cover them are expanded."""
        sym = self.symbols[self.starts[i]:self.starts[i + 1]].astype(np.int64)
        span = np.ones(len(sym), np.int64)
        big = sym >= self.first
        span[big] = self.lengths[sym[big] - self.first]
        ends = np.cumsum(span)
        a, b = np.searchsorted(ends, at, side="right"), np.searchsorted(ends, at + n, side="left") + 1
        skip = at - (ends[a - 1] if a else 0)
        return self._expand(sym[a:b])[skip:skip + n]


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          vocabulary: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Shards of blocks, as a table in the folder ``path``."""
    batch_rows(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        enc, held, ids_held, shard, k, n = encoder(vocabulary), [], [], None, 0, 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"shard": [shard], "block": [k], "ids": [n], "doc_ids": [ids_held], "data": [pack_block(held)]})

        for b in batches:
            shard = b.column(2)[0].as_py() if shard is None and b.num_rows else shard
            for d, ids in zip(b.column(0).to_pylist(), enc(b.column(1).to_pylist()), strict=True):
                if held and n + len(ids) >= block_ids:
                    yield closed()
                    held, ids_held, k, n = [], [], k + 1, 0
                held.append(np.append(ids, np.uint32(end_id)))
                ids_held.append(d)
                n += len(ids) + 1
        if held:
            yield closed()

    def as_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("data", pa.binary())])
        for pdf in blocks(batches):
            yield pa.RecordBatch.from_pandas(pdf, schema, preserve_index=False)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    (rows.repartitionByRange("doc_id").withColumn("shard", F.spark_partition_id()).sortWithinPartitions("doc_id")
     .mapInArrow(as_arrow, "shard int, block int, ids long, doc_ids array<long>, data binary").write.parquet(path))


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the files."""
    blocks = spark.read.parquet(path)
    # A row per shard, and one per block: ids before a block are those of earlier shards and of earlier blocks.
    shard = blocks.groupBy("shard").agg(F.sum("ids").alias("n"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard = shard.select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before_shard"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    place = (blocks.select("shard", "block", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("before_block"))
             .join(shard, "shard").select("shard", "block", (F.col("before_shard") + F.col("before_block")).alias("before")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, k, doc_ids, data in zip(*(b.column(c) for c in ("shard", "block", "doc_ids", "data")), strict=True):
                block = Block(data.as_py())
                ids = block.all()
                cuts = np.concatenate([[0], np.cumsum(block.sizes.astype(np.int64))])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * x:4 * y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                n = len(crc)
                cols = [pa.array([shard.as_py()] * n, pa.int32()), pa.array([k.as_py()] * n, pa.int32()), doc_ids.values,
                        pa.array(cuts[:-1]), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())]
                names = ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"
    docs = blocks.select("shard", "block", "doc_ids", "data").mapInArrow(
        decode, schema + (", ids array<long>" if with_ids else ""))
    return docs.join(place, ["shard", "block"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def write_and_read(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-ids")
    write(docs, path)
    return read(docs.sparkSession, path, with_ids)
