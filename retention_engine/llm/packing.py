"""Best-fit packing by minimum bin slack: documents' tokens into as few fixed-length sequences as possible.

A document becomes one piece, or, when longer than a sequence, full pieces behind a shorter first one. Only the
lengths of pieces matter for packing, and there are at most ``seq_len`` of them, so the packing is solved on their
histogram (bounded, whatever the corpus): for one bin at a time, the largest length left is placed and a bitset
subset-sum dynamic program over the lengths still available finds the fullest feasible rest. That combination is
removed as often as the histogram allows, which is what repeating the step bin by bin would do. The pieces of one
length are then numbered on the executors (in chunks, so that a length which a third of all pieces share is spread
over many tasks) and a piece's number gives its sequence and offset by arithmetic.

Nulls and edge cases: a null or empty text is the end id alone; a null id is a row like any other; repeated rows
are packed each for itself (rows that agree in id and piece are interchangeable); an empty table gives an empty
result; other columns of the input are ignored. Texts of any length are encoded whole.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import batch_rows
from .tokens import encoder, vocabulary_path

SEQ_LEN = 1024
END_ID = 2
#: Rows of one length that one task numbers.
CHUNK_ROWS = 50_000
LEAST_CHUNKS = 16


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Lengths (with how often) of the fullest combination of available items that fits ``room``.

    ``reach`` has bit s set when some combination of the lengths looked at so far sums to s.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, many = min(int(counts[length]), room // length), 1
        while left > 0:
            m = min(many, left)
            steps.append((length, m, reach))
            reach |= (reach << (length * m)) & mask
            left, many = left - m, many * 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, m, before in reversed(steps):
        if not before >> at & 1:
            at -= length * m
            used[length] = used.get(length, 0) + m
    return list(used.items())


def minimum_bin_slack(counts: np.ndarray, seq_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns of bins (how many bins, [(length, how often)]) that use every item of a length histogram."""
    counts, plan = counts.astype(np.int64).copy(), []
    counts[0] = 0
    while counts.any():
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        rest = fullest(counts, seq_len - largest)
        counts[largest] += 1
        use = dict(rest)
        use[largest] = use.get(largest, 0) + 1
        times = min(int(counts[k]) // v for k, v in use.items())
        for k, v in use.items():
            counts[k] -= times * v
        plan.append((times, sorted(use.items(), reverse=True)))
    return plan


def places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each length, ranges of piece numbers: first number, pieces per bin, first sequence, offset in it."""
    rows, base, seen = [], 0, {}
    for times, use in plan:
        at = 0
        for length, per in use:
            rows.append((length, seen.get(length, 0), per, base, at))
            seen[length] = seen.get(length, 0) + times * per
            at += length * per
        base += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "per", "sequence", "offset"), cols, strict=True))


def _cut(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    head = n % seq_len or seq_len
    return [(0, head)] + [(a, seq_len) for a in range(head, n, seq_len)]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN,
                 end_id: int = END_ID, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every document."""
    batch_rows(docs.sparkSession)
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            ids_of = enc(b.column(1).to_pylist())
            out = []
            for d, ids in zip(b.column(0).to_pylist(), ids_of, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (a, n) in enumerate(_cut(len(ids), seq_len)):
                    part = ids[a:a + n]
                    out.append((d, k, a, n, zlib.crc32(part.tobytes()), part if with_ids else None))
            cols = list(zip(*out, strict=True)) or [()] * 6
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([p.tolist() for p in cols[5]], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(cut, schema + (", ids array<long>" if with_ids else "")))


def pack(pieces: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces (``doc_id``, ``piece``, ``length``, any others)."""
    # Chunks are drawn from a number of the row's own: rows may repeat an id, or have none.
    made = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    sizes = made.groupBy("length").count().collect()  # at most seq_len rows
    counts = np.zeros(seq_len + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    at = places(minimum_bin_slack(counts, seq_len))
    chunks = F.array(*[F.lit(max(LEAST_CHUNKS, -(-int(c) // CHUNK_ROWS))) for c in counts])
    slot = made.withColumn("_chunk", F.pmod(F.xxhash64("_row"), chunks[F.col("length")]))
    before = (slot.groupBy("length", "_chunk").count().withColumn("_before", F.sum("count").over(
        Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "_chunk", F.coalesce("_before", F.lit(0)).alias("_before")))
    nth = F.row_number().over(Window.partitionBy("length", "_chunk").orderBy("doc_id", "piece", "_row"))
    # A piece's number counts the pieces of its length in earlier chunks, then those before it in its own.
    numbered = (slot.withColumn("_nth", nth).join(before, ["length", "_chunk"])
                .withColumn("_number", F.col("_nth") - 1 + F.col("_before")).drop("_row", "_chunk", "_nth", "_before"))
    bits = 45
    keys = (at["length"] << bits) | at["first"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            number = b.column("_number").to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.searchsorted(keys, (length << bits) | number, side="right") - 1
            i = number - at["first"][k]
            t = pa.table(b).drop_columns(["_number"])
            t = t.append_column("sequence_id", pa.array(at["sequence"][k] + i // at["per"][k]))
            t = t.append_column("offset", pa.array(at["offset"][k] + i % at["per"][k] * length))
            yield from t.to_batches()

    schema = ", ".join(f"`{c}` {t}" for c, t in numbered.drop("_number").dtypes)
    return numbered.mapInArrow(put, f"{schema}, sequence_id long, `offset` long")


def best_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN,
             end_id: int = END_ID, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Packs every document; with ``with_ids`` each row carries its piece's ids."""
    return pack(token_pieces(docs, id_col, text_col, seq_len, end_id, path, with_ids), seq_len).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
