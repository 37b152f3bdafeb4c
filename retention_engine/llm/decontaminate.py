"""Benchmark decontamination by the q-gram lemma and banded alignment.

An item of m characters that stands in a text with at most e edits shares at least m - q + 1 - e * q of its q-grams
with it, and all of these lie within e diagonals of each other (diagonal: place in the text less place in the item).
Diagonals are counted in bands of width w > 2 * e that overlap by half, so some band holds them all. A band with
fewer shared q-grams than the lemma asks for cannot hold the item; every other one is aligned: the item against the
region of the text around the band, both ends of the region free, in a band of the alignment matrix. An item's edit budget
is e = floor(RATE * m), lowered where needed so that the lemma asks for at least ``LEAST_SHARED`` q-grams. Bands that
touch are aligned together, so a row stands for each stretch of diagonals with the item and its best place there.

Texts and items are compared in lower case with each run of characters that are neither letters nor digits as one
space. Items are searched whatever their length; ``least_chars`` leaves shorter ones out where a caller wants that.
Short items have no edits (below q + LEAST_SHARED characters all their q-grams are asked for), and each of their exact
places is a row. Items of fewer than q characters have no q-gram: they are found where they stand as whole words.

The benchmark is a query set: it is cut into blocks of at most ``BLOCK_CHARS`` characters, one block at a time is
sent to the executors, and all texts are read against each block. Q-grams of a text are looked up in the block's
sorted table, guarded by a bitmap; nothing is joined or shuffled.

Nulls and edge cases: a null or empty text matches nothing; null items and items without letters or digits are left
out; a null id is a row like any other; repeated rows, and repeated items, match each for itself; texts of any length
are read whole; an empty table on either side gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_rows

Q = 8
RATE = 0.1
LEAST_SHARED = 6
#: Items with fewer normal characters are left out; 1: only those without any.
LEAST_CHARS = 1
BLOCK_CHARS = 2_000_000
_GAPS = re.compile(r"[\W_]+")
_BITS = 22


def normal(text: str | None) -> str:
    return _GAPS.sub(" ", (text or "").lower()).strip()


def budget(m: int, rate: float, q: int = Q) -> int:
    """Edits allowed in an item of m characters: the lemma must still ask for LEAST_SHARED q-grams."""
    return max(0, min(int(rate * m), (m - q + 1 - LEAST_SHARED) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of the eight characters from each place on (by doubling: pairs, fours, eights)."""
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for step, mul in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93)):
        h = h[:-step] * np.uint64(mul) + h[step:]
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x9E3779B97F4A7C15)


class Items:
    """A block of items and the table of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.codes = [_codes(t) for t in self.texts]
        self.edits = np.array([budget(len(c), rate) for c in self.codes], np.int64)
        self.need = np.array([len(c) - Q + 1 for c in self.codes], np.int64) - self.edits * Q
        self.width = np.maximum(2 * self.edits + 2, 8)  # bands of this width, one every half of it
        grams = [_grams(c) if len(c) >= Q else np.zeros(0, np.uint64) for c in self.codes]
        self.tiny: dict[str, list[int]] = {}
        for i, t in enumerate(self.texts):
            if len(t) < Q:
                self.tiny.setdefault(t, []).append(i)
        self.tiny_words = sorted({t.count(" ") + 1 for t in self.tiny})
        h = np.concatenate(grams)
        order = np.argsort(h, kind="stable")
        self.hash, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.item = np.repeat(np.arange(len(items)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def bands(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the bands that share enough q-grams with the text."""
        if len(codes) < Q:
            return []
        h = _grams(codes)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        g = np.searchsorted(self.hash, h[at])
        g[g == len(self.hash)] = 0
        found = self.hash[g] == h[at]
        at, g = at[found], g[found]
        n = self.count[g]
        k = np.repeat(self.first[g] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, item = np.repeat(at, n), self.item[k]
        # An item that is hit fewer times than it asks for in the whole text has no band.
        often = (np.bincount(item, minlength=len(self.ids)) >= self.need)[item]
        at, item, k = at[often], item[often], k[often]
        if not len(item):
            return []
        step = (at - self.place[k] + len(codes)) // (self.width[item] // 2)  # of a positive diagonal
        # A diagonal lies in the band that begins in its half and in the one that begins half a band before.
        # Each q-gram of an item (k) counts once in a band, however often the text repeats it there.
        key = np.unique((step << 32) | k)
        step, item = key >> 32, self.item[key & 0xFFFFFFFF]
        band = np.sort(item * (1 << 33) + step)
        edge = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
        band, count = band[edge], np.diff(np.append(edge, len(band)))
        # A band is two halves. A q-gram in both halves counts twice here, which can only keep a band too many.
        follows = np.zeros(len(band), np.int64)
        follows[:-1] = np.where(band[1:] == band[:-1] + 1, count[1:], 0)
        before = np.append(True, band[1:] != band[:-1] + 1)  # its first half is empty: the band one earlier
        band = np.concatenate([band, band[before] - 1])
        count = np.concatenate([count + follows, count[before]])
        order = np.argsort(band, kind="stable")
        band, count = band[order], count[order]
        who, step = band >> 33, band & ((1 << 33) - 1)
        good = count >= self.need[who]
        out, half = [], self.width // 2
        for i, s in zip(who[good].tolist(), step[good].tolist(), strict=True):
            first, last = s * int(half[i]) - len(codes), (s + 2) * int(half[i]) - 1 - len(codes)
            if out and out[-1][0] == i and out[-1][2] >= first - 1:
                out[-1] = (i, out[-1][1], last)
            else:
                out.append((i, first, last))
        return out

    def words(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, place) of the items below Q characters that are whole words of the text."""
        if not self.tiny:
            return
        starts = [0, *(m.end() for m in re.finditer(" ", text)), len(text) + 1]
        for n in self.tiny_words:
            for a, z in zip(starts, starts[n:], strict=False):
                if z - 1 - a < Q:
                    for i in self.tiny.get(text[a:z - 1], ()):
                        yield i, a

    def align(self, codes: np.ndarray, i: int, first: int, last: int) -> tuple[int, int, int] | None:
        """Fewest edits of item i within the diagonals first .. last (and its budget beside them), and the region."""
        e = int(self.edits[i])
        return banded(self.codes[i], codes, first - e, last + e, e)


def banded(item: np.ndarray, text: np.ndarray, first: int, last: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``item`` on the diagonals ``first`` .. ``last``; None over ``most`` edits.

    Cell k of a row is the text place row + first + k: a step down keeps the diagonal, a text character left out of
    the item moves right, an item character left out of the text moves left. Either end of the text is free.
    """
    m, n, w = len(item), len(text), last - first + 1
    far = most + 1
    k = np.arange(w)
    place = first + k
    cost = np.where((place >= 0) & (place <= n), 0, far).astype(np.int64)
    start = place.copy()
    padded = np.concatenate([np.full(max(0, -first), 0xFFFFFFFF, np.uint32), text,
                             np.full(max(0, m + last + 2 - n), 0xFFFFFFFF, np.uint32)])
    base = max(0, -first)
    for r in range(m):
        row = padded[base + first + r:base + first + r + w]
        diag = cost + (row != item[r])
        left = np.append(cost[1:], far) + 1  # the item's character has no match
        take = left < diag
        new = np.where(take, left, diag)
        begin = np.where(take, np.append(start[1:], 0), start)
        # Text characters inside: cost rises by one per step to the right.
        rise = np.minimum.accumulate(new - k)
        run = rise + k
        source = np.maximum.accumulate(np.where(new - k == rise, k, 0))
        begin = np.where(run < new, begin[source], begin)
        inside = (place + r + 1 >= 0) & (place + r + 1 <= n)
        cost, start = np.where(inside, np.minimum(run, far), far), begin
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(start[best]), m + first + best


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int, least_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normal items in blocks of bounded size, as the table is read row by row."""
    held, size = [], 0
    for r in benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        t = normal(r["t"])
        if len(t) < max(1, least_chars):
            continue
        if held and size + len(t) > block_chars:
            yield held
            held, size = [], 0
        held.append((r["i"], t))
        size += len(t)
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits, item_chars): places of items in texts, in characters of the normal text."""
    batch_rows(docs.sparkSession)
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_chars, least_chars):
        found = _scan(docs, Items(block, rate), id_col, text_col)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], SCHEMA)
    return out


SCHEMA = "doc_id long, item_id long, `start` long, `end` long, edits int, item_chars int"


def find(items: Items, text: str | None) -> list[tuple[int | None, int, int, int, int]]:
    """(item id, start, end, edits, item characters) of every place found in a text."""
    text = normal(text)
    codes = _codes(text)
    out = [(items.ids[i], at, at + len(items.codes[i]), 0, len(items.codes[i])) for i, at in items.words(text)]
    for i, first, last in items.bands(codes):
        if items.edits[i] == 0:
            at, m = text.find(items.texts[i], max(0, first)), len(items.codes[i])
            while 0 <= at <= last:
                out.append((items.ids[i], at, at + m, 0, m))
                at = text.find(items.texts[i], at + 1)
            continue
        exact = text.find(items.texts[i], max(0, first), max(0, last) + len(items.codes[i]))
        if exact >= 0:  # no alignment is better
            out.append((items.ids[i], exact, exact + len(items.codes[i]), 0, len(items.codes[i])))
        elif (hit := items.align(codes, i, first, last)) is not None:
            edits, start, end = hit
            out.append((items.ids[i], start, end, edits, len(items.codes[i])))
    return out


def _scan(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, *hit) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for hit in find(items, t)]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            d, i, start, end, edits, chars = (pa.array(c, k) for c, k in zip(cols, kinds, strict=True))
            yield pa.RecordBatch.from_arrays([d, i, start, end, edits, chars], ["doc_id", "item_id", "start", "end", "edits", "item_chars"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def contaminated(text: Column, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE,
                 block_chars: int = BLOCK_CHARS, least_chars: int = LEAST_CHARS) -> Column:
    """Whether a text holds any item, as a column: for filters that keep a document's other columns as they are."""
    out = F.lit(False)
    for block in _blocks(benchmark, item_col, item_text_col, block_chars, least_chars):
        items = Items(block, rate)

        @F.pandas_udf("boolean")
        def has(texts, items=items):
            return texts.map(lambda t: bool(find(items, t)))
        out = out | has(text)
    return out
