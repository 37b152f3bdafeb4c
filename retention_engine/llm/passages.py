"""Substring deduplication by collinear chaining: fuzzy passages that a document shares with an earlier one.

Seeds are runs of K words whose first or last word has the least hash of the K: a choice that the run alone decides, so a
run that two documents share is a seed in both or in neither, whatever stands around it. Of any K consecutive words'
runs one is a seed, so 2 K - 1 words that two documents share word for word hold a common one.

A seed's owner is its first place in the smallest id that has it; every other document's places are matched with it,
not with each other, so a passage in thousands of documents gives thousands of matches, not millions. The rows of a
seed stream sorted through a task that keeps the owner alone. What the owners leave is compared in full: every place of a
seed outside the passages found with every earlier document's place of that seed, by the BEYOND words on both sides
(95 words with the seed). 40 words of which 32 agree hold five common runs of four words at least (with m words that
differ and j skipped, 5 m + 4 j <= 40, and 37 - 4 m - 3 j runs are left), so places that share fewer in those windows
are none of a passage there. A place that agrees with some on its own diagonal is matched with the first of them, any
other with all that may agree where words are skipped. So a shared seed with 40 words
around it that agree with an earlier document's as above (at most MOST_SKIPS skipped) lies in a passage given out; not
every document that has the passage is named, and a passage without a common seed is not found. Windows hold 16 bits a
word, passages are aligned by 32. Places with equal windows are one class, of which only the
first place is compared, and the others are matched with it. A frequent seed's classes are compared in blocks, every
pair of blocks in a unit of its own: quadratic in the different surroundings of one seed, bounded in memory.

The matches of a document with an owner are chained: ordered in both texts, a chain gains K for each match and pays
GAP for each word it skips in either text. The best chain that ends at a match is the best prefix maximum of earlier
ones, kept in a Fenwick tree over the owner's places. Chains are cut where more than MOST_GAP words lie between
matches; one seed is enough for a chain.

A chain is aligned word by word on its diagonals and on beyond its ends: a word that agrees counts 1, one that does not
(and each word skipped where the diagonal changes, at the place that agrees best) counts -IDENTITY / (1 - IDENTITY).
The stretches of highest sum are the passages: their words agree to IDENTITY or more at both ends. Those of at least
LEAST_WORDS words are given out. The first document that has a passage keeps it; ``remove`` takes it out of others.

Words are runs of characters other than space, tab, line feed and the like, A-Z lower-cased.

Nulls and edge cases: null and empty texts and rows with a null id have no passages; rows that repeat an id are one
document where their texts are equal, and otherwise only those texts that really agree give a passage (``text_crc32``
tells which); passages repeated inside one document only are left; an empty table gives an empty result; other columns
are ignored (``remove`` keeps them). Texts of any length are read whole.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import batch_rows, leave_memos, mix, shingles, slices, split_words, whitespace_mask

K = 5
GAP = 0.05
MOST_GAP = 30
IDENTITY = 0.8
LEAST_WORDS = 40
#: Words beside a chain that an alignment may run on; passages grow further by chains of their own.
BEYOND = 45
#: Places of a seed are compared where this many runs of RUN words are common to the words around them.
RUN = 4
LEAST_RUNS = 5
#: Words that a passage of LEAST_WORDS words can skip.
MOST_SKIPS = 10
#: Places of one seed that are compared in one piece, those that take the way for few, rows read at a time, rows of a tile.
BLOCK = 4096
SMALL_UNIT = 32
UNIT_ROWS = 4096
TILE = 256
NONE = np.uint64(2**64 - 1)
NARROW_ROWS = 8192
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Ids whose texts are picked out by a broadcast; more are picked by a shuffled join.
BROADCAST_IDS = 1_000_000


def _narrow_rows(spark: SparkSession) -> None:
    """Larger Arrow batches, for rows of a few numbers (texts on the way end them by their bytes); ``batch_rows`` makes them
    small again."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(NARROW_ROWS))
    spark.conf.set(BATCH_BYTES, str(1 << 20))


def is_seed(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Which of the runs of k word hashes that begin at ``at`` are seeds."""
    v = mix(words)
    least = v[at]
    for j in range(1, k):
        least = np.minimum(least, v[at + j])
    return (v[at] == least) | (v[at + k - 1] == least)


def _seeds(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_memos()
        mask = whitespace_mask()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for a, z, data, off in slices(b.column(1)):
                w = split_words(data, off, mask, lower=True)
                h, at = shingles(w, k)
                some = np.flatnonzero(is_seed(w.hash, at, k))
                doc = w.doc[at[some]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[some].view(np.int64)), pa.array(ids[a:z][doc]), pa.array((at[some] - w.first[doc]).astype(np.int32))],
                    ["h", "doc", "pos"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc, pos) in their order to (h, doc, pos, owner, opos) of the seeds that two documents have. Only the owner of
    the seed at hand, and its places while it is alone, are kept from batch to batch."""
    alone: list[np.ndarray] = []  # rows of the last seed, while only one document has it
    last = None                   # (h, owner, opos) of the last seed
    for b in batches:
        if not b.num_rows:
            continue
        m = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
        if last is not None and m[0, 0] == last[0] and not alone:
            m = np.concatenate([np.array([last]), m])  # the owner stands before the seed's further rows
            extra = 1
        else:
            m, extra = np.concatenate([*alone, m]), 0
        first = np.flatnonzero(np.append(True, m[1:, 0] != m[:-1, 0]))
        size = np.diff(np.append(first, len(m)))
        own = np.repeat(m[first, 1], size)
        two = np.repeat(np.maximum.reduceat(m[:, 1], first) > m[first, 1], size)
        at = first[-1]
        last = tuple(m[at].tolist())
        # A seed with one document so far waits for more rows; its copies here are not given out yet.
        if two[-1] or extra and at == 0:
            alone = []
            two[at:] = True
        else:
            alone = [m[at:]]
        if extra:
            two[0] = False
            if at != 0:
                two[1:size[0]] = True
        opos = np.repeat(m[first, 2], size)
        out = [pa.array(m[two, 0]), pa.array(m[two, 1]), pa.array(m[two, 2].astype(np.int32)), pa.array(own[two]), pa.array(opos[two].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(out, ["h", "doc", "pos", "owner", "opos"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Rows of long columns that agree in the first ``keys`` columns, from sorted batches; a group may reach over several."""
    held: np.ndarray | None = None
    for b in batches:
        if not b.num_rows:
            continue
        m = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
        m = m if held is None else np.concatenate([held, m])
        edge = np.flatnonzero(np.append(True, (m[1:, :keys] != m[:-1, :keys]).any(axis=1)))
        for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            yield m[x:y]
        held = m[edge[-1]:]
    if held is not None:
        yield held


def chain(pos: np.ndarray, opos: np.ndarray, k: int = K, gap: float = GAP) -> list[list[int]]:
    """Chains of matches, best first; every match is in one chain at most. ``pos`` is ascending."""
    n = len(pos)
    if (np.diff(pos) > 0).all() and (np.diff(opos) > 0).all() and ((np.diff(pos) + np.diff(opos)) * gap <= k).all():
        return [list(range(n))]  # all in order, no gap costs more than a match gains: the best chain has them all
    values, rank = np.unique(opos, return_inverse=True)
    size = len(values)
    best, whence = [-1.0] * (size + 1), [-1] * (size + 1)  # Fenwick tree of prefix maxima
    score, back = [0.0] * n, [-1] * n
    p, o, r = pos.tolist(), opos.tolist(), rank.tolist()
    i = 0
    while i < n:
        j = i
        while j < n and p[j] == p[i]:  # matches at one place cannot follow each other
            top, at, q = -1.0, -1, r[j]
            while q > 0:
                if best[q] > top:
                    top, at = best[q], whence[q]
                q -= q & -q
            gain = top - gap * (p[j] + o[j])
            score[j], back[j] = (k + gain, at) if at >= 0 and gain > 0 else (float(k), -1)
            j += 1
        for x in range(i, j):
            value, q = score[x] + gap * (p[x] + o[x]), r[x] + 1
            while q <= size:
                if value > best[q]:
                    best[q], whence[q] = value, x
                q += q & -q
        i = j
    used, out = [False] * n, []
    for x in sorted(range(n), key=lambda x: -score[x]):
        run = []
        while x >= 0 and not used[x]:
            used[x] = True
            run.append(x)
            x = back[x]
        if run:
            out.append(run[::-1])
    return out


def _pieces(pos: np.ndarray, opos: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chains cut at wide gaps."""
    for run in chain(pos, opos, k):
        p, o = pos[run], opos[run]
        cuts = np.flatnonzero((np.diff(p) > MOST_GAP + k) | (np.diff(o) > MOST_GAP + k)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(p)], strict=True):
            yield p[a:b], o[a:b]


def _runs(p: np.ndarray, o: np.ndarray, k: int) -> np.ndarray:
    """First and last place of each stretch on one diagonal: rows (first pos, end pos, diagonal)."""
    d = o - p
    at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    end = np.append(at[1:], len(p)) - 1
    return np.stack([p[at], p[end] + k, d[at]], axis=1)


CHAIN_SCHEMA = "doc long, owner long, a int, z int, oa int, oz int, runs binary"


def _chains(k: int):
    """Sorted matches (doc, owner, pos, opos) to chains; a pair's matches may reach over several batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                              ["doc", "owner", "a", "z", "oa", "oz", "runs"])

        for m in _groups(batches, 2):
            doc, owner = int(m[0, 0]), int(m[0, 1])
            for p, o in _pieces(m[:, 2], m[:, 3], k):
                a, oa = max(0, int(p[0]) - BEYOND), max(0, int(o[0]) - BEYOND)
                rows.append((doc, owner, a, int(p[-1]) + k + BEYOND, oa, int(o[-1]) + k + BEYOND, _runs(p, o, k).astype("<i8").tobytes()))
            if len(rows) >= 4096:
                yield batch()
                rows = []
        yield batch()
    return run


def align(x: np.ndarray, y: np.ndarray, runs: np.ndarray, identity: float = IDENTITY, least: int = LEAST_WORDS) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, other start, other end, words that agree) of a chain.

    ``x`` and ``y`` are the words around it in both texts, ``runs`` its stretches (first, end, diagonal) in places of
    ``x``; a diagonal is the place in ``y`` less the place in ``x``.
    """
    lose = -identity / (1 - identity)
    n = len(x)

    def agree(a: int, b: int, d: int) -> np.ndarray:
        out = np.zeros(max(0, b - a), bool)
        lo, hi = max(a, -d, 0), min(b, len(y) - d, n)
        if hi > lo:
            out[lo - a:hi - a] = x[lo:hi] == y[lo + d:hi + d]
        return out

    same, diagonal, jump = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n)
    at, d = 0, int(runs[0, 2])
    for i in range(len(runs)):
        last = i + 1 == len(runs)
        end = int(runs[i, 1])
        if last:
            b = n
        else:
            # Between two stretches: the words before the change on this diagonal, those after on the next.
            stop, nd = int(runs[i + 1, 0]), int(runs[i + 1, 2])
            end = min(end, stop)
            here, there = agree(end, stop, d), agree(end, stop, nd)
            good = np.concatenate([[0], np.cumsum(here)]) + np.concatenate([np.cumsum(there[::-1])[::-1], [0]])
            b = end + int(np.argmax(good))
        same[at:b], diagonal[at:b] = agree(at, b, d), d
        at = b
        if not last:
            if b < n:
                jump[b] = lose * abs(nd - d)
            d = nd
    if same.sum() < identity * least:
        return []
    value = np.where(same, 1.0, lose) + jump
    out, todo = [], [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        total = np.concatenate([[0.0], np.cumsum(value[a:b])])
        low = np.minimum.accumulate(total)
        e = int(np.argmax(total - low))
        if total[e] - low[e] <= 0:
            continue
        s = int(np.flatnonzero(total[:e + 1] == low[e])[-1])
        s, e = a + s, a + e
        if e - s >= least:
            out.append((s, e, int(s + diagonal[s]), int(e + diagonal[e - 1]), int(same[s:e].sum())))
        todo += [(a, s), (e, b)]
    return sorted(out)


SCHEMA = "doc_id long, start_word int, end_word int, source_id long, source_start int, source_end int, agreeing int, text_crc32 long"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """32-bit hashes of a text's words, one after another."""
    mask = whitespace_mask()
    for b in batches:
        out, crc = [], [zlib.crc32((t or "").encode()) for t in b.column(1).to_pylist()]
        for a, z, data, off in slices(b.column(1)):
            w = split_words(data, off, mask, lower=True)
            h = (w.hash >> np.uint64(32)).astype("<u4")
            out += [h[w.first[i]:w.first[i + 1]].tobytes() for i in range(z - a)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(crc, pa.int64()), pa.array(out, pa.binary())], ["id", "crc", "words"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), *[pa.int32()] * 2, pa.int64(), *[pa.int32()] * 3, pa.int64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for b in batches:
        rows = []
        for doc, owner, a, oa, runs, x, y, crc in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
            r = np.frombuffer(runs, "<i8").reshape(-1, 3) - np.array([a, a, oa - a])
            for s, e, os, oe, n in align(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), r):
                rows.append((doc, a + s, a + e, owner, oa + os, oa + oe, n, crc))
        cols = list(zip(*rows, strict=True)) or [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def _pick(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (column ``id``), or with ``left_anti`` is not."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def _words_of(rows: DataFrame, ids: DataFrame, twice: DataFrame) -> DataFrame:
    """(id, crc, words) of the texts with these ids, each once. They are made anew where they are needed, not written, and only those
    of ids that several rows have (``twice``) are shuffled to tell them apart."""
    made = lambda d: d.mapInArrow(_words, "id long, crc long, words binary")
    some = _pick(rows, ids)
    if twice.isEmpty():
        return made(some)
    return made(_pick(some, twice, "left_anti")).unionByName(made(_pick(some, twice)).distinct())


def _found(matches: DataFrame, rows: DataFrame, twice: DataFrame, k: int, name: str) -> DataFrame:
    """Passages of matches (doc, owner, pos, opos), written."""
    _narrow_rows(matches.sparkSession)
    chains = (matches.repartition("doc", "owner").sortWithinPartitions("doc", "owner", "pos", "opos")
              .mapInArrow(_chains(k), CHAIN_SCHEMA))
    chains = materialize(chains, f"{name}-chains")
    batch_rows(matches.sparkSession)
    docs, owners = (materialize(chains.select(F.col(c).alias("id")).distinct(), f"{name}-ids") for c in ("doc", "owner"))
    # Only the words around a chain travel on. One join's shuffle files go before the next one's come.
    cut = lambda a, z: F.expr(f"substring(words, 4 * {a} + 1, 4 * ({z} - {a}))")
    one = chains.join(_words_of(rows, docs, twice).withColumnRenamed("id", "doc"), "doc").select("*", cut("a", "z").alias("x")).drop("words", "z")
    one = materialize(one, f"{name}-cut")
    discard(chains, docs)
    two = one.join(_words_of(rows, owners, twice).select(F.col("id").alias("owner"), "words"), "owner").select(
        "doc", "owner", "a", "oa", "runs", "x", cut("oa", "oz").alias("y"), "crc")
    found = materialize(two.mapInArrow(_align, SCHEMA).distinct(), f"{name}-found")
    discard(one, owners)
    return found


def _flags(k: int):
    """Sorted rows (doc, pos, end, h), of seeds (end -1) and of passages found (h 0), to (h, doc, pos, bare) of the seeds.
    ``bare``: the seed is not inside a passage."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, cover = None, -1  # the document at hand and the furthest end of its passages so far
        for b in batches:
            if not b.num_rows:
                continue
            m = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
            first = np.flatnonzero(np.append(True, m[1:, 0] != m[:-1, 0]))
            # Documents are set apart by more than any end, so that one running maximum serves them all.
            apart = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(m)))) << 40
            ends = m[:, 2] + apart
            if m[0, 0] == doc:
                ends[0] = max(ends[0], cover)
            ends = np.maximum.accumulate(ends) - apart
            doc, cover = int(m[-1, 0]), int(ends[-1])
            seed = m[:, 2] < 0
            yield pa.RecordBatch.from_arrays([pa.array(m[seed, 3]), pa.array(m[seed, 0]), pa.array(m[seed, 1].astype(np.int32)),
                                              pa.array(ends[seed] < m[seed, 1] + k)], ["h", "doc", "pos", "bare"])
    return run


def _open_seeds(shared: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(h, doc, pos, bare), written: all places of the seeds that a document has outside its passages and an earlier one has as well.
    ``shared`` is discarded."""
    ends = found.groupBy(F.col("doc_id").alias("doc"), F.col("start_word").alias("pos")).agg(F.max("end_word").alias("end"))
    both = shared.select("doc", "pos", F.lit(-1).alias("end"), "h").unionByName(
        ends.select("doc", "pos", "end", F.lit(0).cast("long").alias("h")))
    # A passage that begins where a seed stands comes before it.
    flagged = materialize(both.repartition("doc").sortWithinPartitions("doc", "pos", F.desc("end")).mapInArrow(
        _flags(k), "h long, doc long, pos int, bare boolean"), "seeds-flagged")
    discard(shared)
    some = flagged.groupBy("h").agg(F.min("doc").alias("x"), F.max(F.when(F.col("bare"), F.col("doc"))).alias("z"))
    left = materialize(flagged.join(some.where("x < z").select("h"), "h"), "seeds-left")
    discard(flagged)
    return left


def run_tokens(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the runs of RUN words in each window of 16-bit word hashes; a run's further places in the same window
    have values of their own, so that common values count common places."""
    size = np.array([len(w) for w in windows]) // 2
    wide = max(int(size.max()), RUN)
    words = np.zeros((len(windows), wide), np.uint64)
    words[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(windows), "<u2")
    n = wide - RUN + 1
    g = np.zeros((len(windows), n), np.uint64)
    for j in range(RUN):
        g = (g << np.uint64(16)) | words[:, j:j + n]
    g = mix(g)
    g[np.arange(n) >= (size - RUN + 1)[:, None]] = NONE
    g.sort(axis=1)
    first = np.ones(g.shape, bool)
    first[:, 1:] = g[:, 1:] != g[:, :-1]
    nth = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0), axis=1)
    row, at = np.nonzero(g != NONE)
    return row, g[row, at] + nth[row, at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def alike_in_units(unit: np.ndarray, row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Codes x * n + y (x < y) of the n rows of one small unit that share LEAST_RUNS values, for many units at once."""
    n = len(unit)
    key = mix(value ^ mix(unit[row].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")  # rows of one value stay in ascending order
    key, row = key[order], row[order]
    codes, far = [], 1
    at = np.flatnonzero(key[1:] == key[:-1])
    while len(at):
        codes.append(row[at] * n + row[at + far])
        far += 1
        at = at[at + far < len(key)]
        at = at[key[at] == key[at + far]]
    codes, many = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_counts=True)
    return codes[many >= LEAST_RUNS]


def alike_in_unit(left: np.ndarray, right: np.ndarray, row: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``left``, row of ``right``) of one large unit that share LEAST_RUNS values, tile by tile."""
    first = np.searchsorted(row, np.arange(row[-1] + 2 if len(row) else 1))

    def tiles(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out = []
        for part in np.array_split(rows, -(-len(rows) // TILE)):
            part = part[part + 1 < len(first)]
            size = first[part + 1] - first[part]
            at = np.repeat(first[part] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            out.append((part, np.repeat(np.arange(len(part)), size), value[at]))
        return out

    others = [(*t, np.unique(t[2])) for t in tiles(right)] if len(right) else []
    for x, xr, xv in tiles(left) if len(left) else []:
        mine = np.unique(xv)
        for y, yr, yv, theirs in others:
            if not len(x) or not len(y) or x[-1] < y[0]:
                continue
            both = np.intersect1d(mine, theirs, assume_unique=True)
            if len(both) < LEAST_RUNS:
                continue
            tables = []
            for r, v, m in ((xr, xv, len(x)), (yr, yv, len(y))):
                at = np.minimum(np.searchsorted(both, v), len(both) - 1)
                hit = both[at] == v
                table = np.zeros((m, len(both)), np.float32)
                table[r[hit], at[hit]] = 1
                tables.append(table)
            i, j = np.nonzero(tables[0] @ tables[1].T >= LEAST_RUNS)
            yield x[i], y[j]


def frames(windows: list[bytes], pos: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """One row a window, its seed at column MOST_SKIPS + BEYOND, and the value that stands where it has no word. MOST_SKIPS
    columns on both sides have none, so a row moved by as many places meets no word of the next. 16 bits a value where
    one of them is no word of the windows."""
    size = np.array([len(w) for w in windows]) // 2
    words = np.frombuffer(b"".join(windows), "<u2")
    free = np.flatnonzero(np.bincount(words, minlength=1 << 16) == 0)
    none = int(free[0]) if len(free) else 1 << 16
    at = np.arange(2 * (MOST_SKIPS + BEYOND) + k) - (MOST_SKIPS + BEYOND - np.minimum(pos, BEYOND))[:, None]
    out = np.full(at.shape, none, np.uint16 if len(free) else np.uint32)
    out[(at >= 0) & (at < size[:, None])] = words
    return out, none


def around_seed(same: np.ndarray, k: int) -> np.ndarray:
    """Whether the stretch of highest sum that holds the seed has LEAST_WORDS words; ``same``: words that agree, a row a pair."""
    wide = same.shape[1]
    # IDENTITY of a stretch's words beside the seed agree; rows with fewer in all have none.
    need = np.ceil(IDENTITY * (LEAST_WORDS - k) - 1e-9) + np.count_nonzero(same[:, BEYOND:BEYOND + k], axis=1)
    bits = np.zeros((len(same), -(-wide // 64) * 8), np.uint8)
    bits[:, :-(-wide // 8)] = np.packbits(same, axis=1)
    some = np.flatnonzero(np.bitwise_count(bits.view(np.uint64)).sum(axis=1) >= need)
    out = np.zeros(len(same), bool)
    total = np.zeros((len(some), wide + 1), np.float32)
    np.cumsum(np.where(same[some], 1, -IDENTITY / (1 - IDENTITY)), axis=1, out=total[:, 1:])
    start = BEYOND - np.argmin(total[:, BEYOND::-1], axis=1)
    end = BEYOND + k + np.argmax(total[:, BEYOND + k:], axis=1)
    out[some] = end - start >= LEAST_WORDS
    return out


def agrees(x: np.ndarray, y: np.ndarray, none: int, skips: int) -> np.ndarray:
    """Which words of the frames ``x`` agree with one of ``y`` at most ``skips`` places away; columns beside the frames are
    left out."""
    a, b = x.reshape(-1), y.reshape(-1)
    out = np.zeros(len(a), bool)
    inner = out[MOST_SKIPS:len(a) - MOST_SKIPS]
    for d in range(-skips, skips + 1):
        inner |= a[MOST_SKIPS:len(a) - MOST_SKIPS] == b[MOST_SKIPS + d:len(b) - MOST_SKIPS + d]
    out &= a != none
    return out.reshape(x.shape)[:, MOST_SKIPS:x.shape[1] - MOST_SKIPS]


def _compare(k: int):
    """Sorted rows (h, i, j, doc, pos, bare, block, window) to matches (doc, owner, pos, opos). A unit (h, i, j) compares each bare
    place of block i with the earlier documents' of block j, and the other way round. A place that has a passage on its own diagonal is matched
    with the first document it has one with, any other with all that may have one where words are skipped."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def matches(t: pa.Table) -> Iterator[pa.RecordBatch]:
        h, i, j, doc, pos, bare, block = (t.column(c).to_numpy().astype(np.int64) for c in range(7))
        windows = t.column(7).to_pylist()
        frame, none = frames(windows, pos, k)
        edge = np.append(np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))), len(h))
        unit = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        small = np.flatnonzero(np.diff(edge)[unit] <= SMALL_UNIT)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if len(small):
                codes = alike_in_units(unit[small], *run_tokens([windows[x] for x in small.tolist()]))
                a, z = small[codes // len(small)], small[codes % len(small)]
                yield np.append(a, z), np.append(z, a)
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if z - a > SMALL_UNIT:
                    row, value = run_tokens(windows[a:z])
                    # Values that only one place has take no part.
                    _, back, many = np.unique(value, return_inverse=True, return_counts=True)
                    row, value = row[many[back] > 1], value[many[back] > 1]
                    for x, y in alike_in_unit(np.flatnonzero(bare[a:z]), np.arange(z - a), row, value):
                        yield a + x, a + y

        def batch(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((doc[x], doc[y], pos[x], pos[y]), kinds, strict=True)],
                                              ["doc", "owner", "pos", "opos"])

        done, late = np.zeros(len(h), bool), []
        for x, y in pairs():
            good = (bare[x] == 1) & (doc[y] < doc[x]) & ((i[x] == j[x]) | (block[x] != block[y]))
            order = np.lexsort((y[good], x[good]))
            x, y = x[good][order], y[good][order]
            for at in range(0, len(x), TILE * 16):
                p, q = x[at:at + TILE * 16], y[at:at + TILE * 16]
                p, q = p[~done[p]], q[~done[p]]
                found = np.flatnonzero(around_seed(agrees(frame[p], frame[q], none, 0), k))
                first = found[np.append(True, p[found][1:] != p[found][:-1])] if len(found) else found
                done[p[first]] = True
                if len(first):
                    yield batch(p[first], q[first])
                p, q = p[~done[p]], q[~done[p]]
                some = around_seed(agrees(frame[p], frame[q], none, MOST_SKIPS), k)
                late.append((p[some], q[some]))
        for p, q in late:
            yield batch(p[~done[p]], q[~done[p]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_memos()
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < UNIT_ROWS:
                continue
            t = pa.Table.from_batches(held)
            keys = [t.column(c).to_numpy() for c in range(3)]
            edge = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1]))
            if len(edge):  # the last unit may go on in the next batch
                yield from matches(t.slice(0, int(edge[-1]) + 1))
                held = t.slice(int(edge[-1]) + 1).to_batches()
        if held:
            yield from matches(pa.Table.from_batches(held))
    return run


def _rest(shared: DataFrame, found: DataFrame, rows: DataFrame, twice: DataFrame, k: int) -> DataFrame:
    """Matches (doc, owner, pos, opos), written, of each seed outside the passages with every earlier place of it that is alike
    around. ``shared`` is discarded on the way.

    Places with equal windows are one class: its other members are matched with its first place only. The first places of all
    classes of a seed are compared with each other, those of a frequent seed in blocks, each pair of blocks for itself."""
    seeds = _open_seeds(shared, found, k)
    batch_rows(seeds.sparkSession)
    ids = materialize(seeds.select(F.col("doc").alias("id")).distinct(), "seeds-ids")
    words = _words_of(rows, ids, twice).drop("crc")
    start = F.greatest(F.col("pos") - BEYOND, F.lit(0))
    around = F.expr(f"substring(words, 4 * start + 1, 4 * (pos + {k + BEYOND} - start))")
    around = seeds.join(words.withColumnRenamed("id", "doc"), "doc").withColumn("start", start).withColumn("window", around)
    _narrow_rows(seeds.sparkSession)
    around = around.select("h", "doc", "pos", "bare", F.xxhash64("window").alias("w"), "window").mapInArrow(
        _halves, "h long, doc long, pos int, bare boolean, w long, window binary")
    around = materialize(around, "seeds-around")
    discard(seeds, ids)
    reps = materialize(around.groupBy("h", "w").agg(F.min(F.struct("doc", "pos", "bare", "window")).alias("r")).select("h", "w", "r.*"), "seeds-classes")
    same = around.where("bare").select("h", "w", "doc", "pos").join(
        reps.select("h", "w", F.col("doc").alias("owner"), F.col("pos").alias("opos")), ["h", "w"])
    same = materialize(same.where("owner < doc").select("doc", "owner", "pos", "opos"), "rest-same")
    discard(around)
    sizes = reps.groupBy("h").agg(F.count("*").alias("n"), F.min("doc").alias("x"), F.max(F.when(F.col("bare"), F.col("doc"))).alias("z"))
    sizes = materialize(sizes.where("x < z").select("h", F.ceil(F.col("n") / BLOCK).cast("int").alias("m")), "seeds-sizes")
    block = F.pmod(F.xxhash64("doc", "pos"), F.col("m")).cast("int")
    units = reps.join(sizes, "h").withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, m - 1)")))
    units = units.select("h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc", "pos", "bare", "block", "window")
    alike = units.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "doc", "pos").mapInArrow(
        _compare(k), "doc long, owner long, pos int, opos int")
    matches = materialize(alike.unionByName(same).distinct(), "rest-matches")
    discard(same, reps, sizes)
    return matches


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows (last column) with 16 bits of each word's 32."""
    for b in batches:
        out = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], b.schema.names)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, start_word, end_word, source_id, source_start, source_end, agreeing, text_crc32) of every passage of a
    document that stands in one of a smaller id, in places of words."""
    spark = docs.sparkSession
    _narrow_rows(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL")
    twice = materialize(rows.groupBy("id").count().where("count > 1").select("id"), "ids-twice")
    seeds = rows.mapInArrow(_seeds(k), "h long, doc long, pos int").repartition("h").sortWithinPartitions("h", "doc", "pos")
    shared = materialize(seeds.mapInArrow(_shared, "h long, doc long, pos int, owner long, opos int"), "seeds-shared")
    first = _found(shared.where("doc <> owner").select("doc", "owner", "pos", "opos"), rows, twice, k, "owners")
    _narrow_rows(spark)
    matches = _rest(shared, first, rows, twice, k)
    rest = _found(matches, rows, twice, k, "rest")
    discard(matches, twice)
    batch_rows(spark)
    spark.conf.unset(BATCH_BYTES)
    return first.unionByName(rest).distinct()


def _without(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without those words; the white space before a word goes with it."""
    data = np.frombuffer(text.encode(), np.uint8)
    w = split_words(data, np.array([0, len(data)]), whitespace_mask(), lower=True)
    keep = np.ones(len(data), bool)
    for a, b in ranges:
        if a < len(w.start):
            keep[(w.end[a - 1] if a else 0):w.end[min(b, len(w.end)) - 1]] = False
    return data[keep].tobytes().decode().lstrip(" \t\n\x0b\x0c\r")


def remove(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the passages found: all its columns, the text of documents with passages cut."""
    cuts = passages.groupBy(F.col("doc_id").alias("_rm_id"), F.col("text_crc32").alias("_rm_crc")).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias("_rm_ranges"))
    cuts = materialize(cuts, "cuts")
    if cuts.count() <= BROADCAST_IDS // 10:
        cuts = F.broadcast(cuts)

    @F.pandas_udf("string")
    def without(texts, ranges):
        return texts.combine(ranges, lambda t, r: t if r is None else _without(t, [(int(x["start_word"]), int(x["end_word"])) for x in r]))

    crc = F.crc32(F.encode(F.col(text_col).cast("string"), "UTF-8"))
    out = docs.join(cuts, (F.col(id_col).cast("long") == F.col("_rm_id")) & (crc == F.col("_rm_crc")), "left")
    # Only texts with passages go through Python.
    cut = out.where("_rm_ranges IS NOT NULL").withColumn(text_col, without(F.col(text_col), "_rm_ranges"))
    return out.where("_rm_ranges IS NULL").select(*docs.columns).unionByName(cut.select(*docs.columns))
