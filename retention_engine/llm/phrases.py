"""Phrase collocation mining after Toivonen: a sample proposes, full passes count exactly, border failures extend.

A text (A-Z lower-cased) is cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, a piece into words ``[^\\x20\\x09]+``; a phrase is
a run of words inside a piece. Everything is per language. Phrases of each length that reach a lowered count in a
sample of the documents are *proposed*. A pass over all documents counts every word, and every longer phrase both of
whose parts that are one word shorter are proposed: these are the proposals and their negative border. A phrase that
reaches ``least`` in the full count without having been proposed is a border failure: it is proposed now, and another
pass counts the phrases that thereby have two proposed parts and had not before. The passes end when no failure is
left; as a phrase is never more frequent than its parts, every frequent phrase has then been counted, whatever the
sample was. The sample (every document whose hash falls into ``share``) decides the number of passes, not the result.

Proposals are kept as one bitmap a length, ``2 ** bits`` cells of the phrases' hashes, whatever the size of the corpus;
that is all that is collected and broadcast. Two phrases in one cell only make the passes count more than they need:
counts are kept under the phrase itself, and a phrase's cell is the same wherever it stands, so that it is counted in
one pass, whole. Texts are tokenised in slices (a long one is cut between pieces) and counted slice by slice before
they are shuffled, and by Spark before the exchange, so a phrase that all documents have costs one row a task.

Nulls and edge cases: a null language is ``und``, a null or empty text has no words. Rows that repeat count each. An
empty table, or one without frequent phrases, gives an empty result. Other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.queues import top_k_per_group
from ..session import materialize
from .common import batch_rows, leave_memos, mix, slices, split_words, text_buffers

#: Fixed values of the contract: what ends a piece, and what else ends a word.
PIECE_ENDS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
LEAST, WORDS, SCALE, CONTAINED_PERCENT, TOP = 10, 3, 1_000_000, 50, 2000
#: Share of the documents in the sample, and binary logarithm of a bitmap's cells (2 MB a length; some millions of
#: proposals keep it sparse, a larger corpus is given more).
SHARE, BITS = 0.25, 24
#: Bytes of text handled at once, and phrases written out at once.
SLICE_BYTES, CHUNK = 1 << 20, 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in PIECE_ENDS]] = True
_WORD = ~_ENDS
_WORD[[ord(c) for c in BLANKS]] = False


@dataclass
class Bitmap:
    """A set of cells; ``in`` for arrays of phrase hashes."""
    words: np.ndarray
    bits: int

    def has(self, hashes: np.ndarray) -> np.ndarray:
        cell = hashes >> np.uint64(64 - self.bits)
        return (self.words[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _cut_long(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets with further ones behind piece ends inside long rows, and the row of each part."""
    long_rows = np.flatnonzero(np.diff(off) > SLICE_BYTES)
    cuts = []
    for r in long_rows:
        ends = np.flatnonzero(_ENDS[data[off[r]:off[r + 1]]]) + off[r] + 1
        at = off[r]
        while off[r + 1] - at > SLICE_BYTES:
            k = np.searchsorted(ends, at + SLICE_BYTES, side="right")
            k = k - 1 if k and ends[k - 1] > at else k
            if k == len(ends) or ends[k] >= off[r + 1]:
                break
            at = ends[k]
            cuts.append(at)
    parts = np.sort(np.concatenate([off, np.array(cuts, np.int64)]))
    return parts, np.searchsorted(off, parts[:-1], side="right") - 1


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given byte runs one after the other, and their offsets."""
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    return data[np.repeat(start - off[:-1], length) + np.arange(off[-1])], off


def _hashes(word_hash: np.ndarray, seed: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Hash of the run of 1 to ``longest`` words from each word on, with its language's seed."""
    m = len(word_hash)
    first = mix(word_hash ^ mix(seed + _STEP))
    out = {1: first}
    for k in range(2, longest + 1):
        n = max(m - k + 1, 0)
        out[k] = mix(out[k - 1][:n] * _STEP + first[m - n:] + np.array(k, np.uint64))
    return out


def _languages(lang: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct languages, the code of each row and the seed of each code."""
    names = lang.fill_null("und").dictionary_encode()
    seeds = np.array([zlib.crc32(v.encode()) for v in names.dictionary.to_pylist()] or [0], np.uint64)
    return names.dictionary.cast(pa.string()), names.indices.to_numpy(zero_copy_only=False), seeds


def _count(lang: pa.Array, text: pa.Array, longest: int, wanted: Callable) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of one batch, slice by slice. ``wanted(words, valid, hashes)`` picks the places to count,
    ``hashes`` and ``valid`` by number of words."""
    names, codes, seeds = _languages(lang)
    data, off = text_buffers(text)
    parts, row = _cut_long(data, off)
    a = 0
    while a < len(parts) - 1:
        b = max(a + 1, int(np.searchsorted(parts, parts[a] + SLICE_BYTES, side="right")) - 1)
        some, rel = data[parts[a]:parts[b]], parts[a:b + 1] - parts[a]
        w = split_words(some, rel, _WORD, lower=True)
        code = codes[row[a:b]][w.doc] if len(w.doc) else np.zeros(0, codes.dtype)
        a = b
        m = len(w.doc)
        if m == 0:
            continue
        start, end = rel[w.doc] + w.start, rel[w.doc] + w.end
        passed = np.zeros(len(some) + 1, np.int64)
        np.cumsum(_ENDS[some], out=passed[1:])
        joined = (w.doc[1:] == w.doc[:-1]) & (passed[start[1:]] == passed[end[:-1]])
        hashes, valid = _hashes(w.hash, seeds[code], longest), {1: np.ones(m, bool)}
        for k in range(2, longest + 1):
            n = max(m - k + 1, 0)
            valid[k] = valid[k - 1][:n] & joined[m - 1 - n:]
        # the words with one space behind each, so that a phrase is a run of bytes
        length = end - start
        spaced, at = _gather(_LOWER[np.append(some, np.uint8(32))], start, length + 1)
        spaced[at[1:] - 1] = 32
        for k in range(1, longest + 1):
            places = np.flatnonzero(wanted(k, valid, hashes))
            for c in range(0, len(places), CHUNK):
                i = places[c:c + CHUNK]
                body, ends = _gather(spaced, at[i], at[i + k] - 1 - at[i])
                strings = pa.LargeStringArray.from_buffers(len(i), pa.py_buffer(ends), pa.py_buffer(body)).cast(pa.string())
                t = pa.table({"lang": code[i], "phrase": strings}).group_by(["lang", "phrase"], use_threads=False).aggregate([([], "count_all")])
                yield _rows(names.take(t["lang"].combine_chunks()), t["phrase"].combine_chunks(), t["count_all"].combine_chunks())
        seen, n = np.unique(code, return_counts=True)  # all words of a language: a phrase of no words
        yield _rows(names.take(pa.array(seen)), pa.array([""] * len(seen)), pa.array(n.astype(np.int64)))


def _rows(lang: pa.Array, phrase: pa.Array, n: pa.Array) -> pa.RecordBatch:
    """Language and phrase as one key (a phrase has no tab), which is cheaper to shuffle than two."""
    return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(lang, phrase, "\t"), n], names=["key", "n"])


def _pass(docs: DataFrame, longest: int, wanted: Callable, least: int, name: str) -> DataFrame:
    """(lang, words, phrase, n) of the phrases that one pass picks and finds ``least`` times or more, written."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_memos()
        for batch in batches:
            yield from _count(batch.column(0), batch.column(1), longest, wanted)
    counts = docs.mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = counts.where((F.col("n") >= least) | F.endswith("key", F.lit("\t")))
    phrase = F.substring_index("key", "\t", -1)
    words = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    return materialize(counts.select(F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)").alias("lang"),
                                     words.alias("words"), phrase.alias("phrase"), "n"), name)


def _cells(bits: int, words: int) -> Callable:
    """Bits to set, by the bitmap's 64-bit word, for phrases of so many words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, codes, seeds = _languages(batch.column(0))
            data, off = text_buffers(batch.column(1))
            w = split_words(data, off, _WORD, lower=False)
            cell = _hashes(w.hash, seeds[codes][w.doc], words)[words][w.first[:-1]] >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays([pa.array((cell >> np.uint64(6)).view(np.int64)),
                                              pa.array((np.uint64(1) << (cell & np.uint64(63))).view(np.int64))], names=["at", "v"])
    return run


def _bitmap(phrases: DataFrame, words: int, bits: int, old: Bitmap | None = None) -> Bitmap:
    """The cells of the phrases of so many words, added to ``old``; at most ``2 ** (bits - 6)`` rows are collected."""
    cells = phrases.where(F.col("words") == words).select("lang", "phrase").mapInArrow(_cells(bits, words), "at long, v long")
    rows = cells.groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()
    out = old.words.copy() if old is not None else np.zeros(1 << max(bits - 6, 0), np.uint64)
    out[rows["at"].to_numpy()] |= rows["v"].to_numpy().view(np.uint64)
    return Bitmap(out, bits)


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, words: int = WORDS,
                     share: float = SHARE, bits: int = BITS) -> DataFrame:
    """(lang, words, phrase, n) of all phrases of 1 to ``words`` words found ``least`` times or more, and a row of no words
    (words = 0, phrase '') for each language with the number of its words. Counts are exact."""
    spark = docs.sparkSession
    batch_rows(spark)
    docs = docs.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    levels = range(1, words)  # lengths that can be part of a longer phrase
    lowered = max(1, int(least * share))
    drawn = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = _pass(drawn, words - 1, lambda k, valid, hashes: valid[k], lowered, "phrases-sample") if words > 1 else None
    now = {k: _bitmap(sample, k, bits) for k in levels}
    before: dict[int, Bitmap] | None = None
    found = None
    while True:
        sent = spark.sparkContext.broadcast((now, before))

        def wanted(k, valid, hashes, sent=sent):
            new, old = sent.value
            if k == 1:
                return valid[1] if old is None else np.zeros(len(valid[1]), bool)
            n = len(valid[k])
            both = lambda maps: (has := maps[k - 1].has(hashes[k - 1]))[:n] & has[1:n + 1]
            out = valid[k] & both(new)
            return out if old is None else out & ~both(old)

        got = _pass(docs, words, wanted, least, "phrases-pass")
        sent.destroy()
        # words are counted by the first pass only; so is their total
        got = got if before is None else got.where(F.col("words") > 0)
        found = got if found is None else found.unionByName(got)
        grown = {k: _bitmap(got, k, bits, now[k]) for k in levels}
        if all(np.array_equal(grown[k].words, now[k].words) for k in levels):
            return found.select("lang", "words", "phrase", "n")
        before, now = now, grown


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, words: int = WORDS,
                 top: int = TOP, contained_percent: int = CONTAINED_PERCENT, share: float = SHARE, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by the score of their weakest cut.

    The score of a cut is floor(1,000,000 * a * a / (l * r)) in 38-digit decimals (exact for counts below 10 ** 16).
    Phrases that stand inside a longer one with ``contained_percent`` of their count are dropped."""
    counts = materialize(frequent_phrases(docs, lang_col, text_col, least, words, share, bits), "phrases")
    parts = counts.where(F.col("words").between(1, words - 1)).select("lang", "phrase", "n")
    cands = counts.where(F.col("words") >= 2).select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cands.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    score = F.expr(f"(cast(a AS decimal(19, 0)) * a * {SCALE}) div (cast(l AS decimal(19, 0)) * r)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.expr("flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), i -> array_join(slice(w, i, s), ' '))))")
    holders = (cands.where(F.col("words") >= 3).select("lang", F.explode(inner).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("inside")))
    kept = (scored.join(holders, ["lang", "phrase"], "left")
            .where(F.col("inside").isNull() | (100 * F.col("inside") < contained_percent * F.col("a")))
            .select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score")))
    best = top_k_per_group(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, salt_col="phrase")
    totals = counts.where(F.col("words") == 0).select("lang", "n")
    return best.join(totals, "lang").select("lang", F.col("queue_rank").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The collocations of two and three words in DuckDB SQL, over ``documents``, from the counts of all phrases."""
    return rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
p AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM s),
g AS (SELECT lang, i, w, unnest(range(1, least(3, len(w) - i + 1) + 1)) AS k FROM p),
c AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
t AS (SELECT lang, count(*) AS n FROM p GROUP BY lang),
x AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, k AS size FROM c WHERE k >= 2),
y AS (SELECT *, unnest(range(1, size)) AS k FROM x),
z AS (SELECT y.lang, y.phrase, a, y.k, u.f AS l, v.f AS r, ({SCALE}::HUGEINT * a * a) // (u.f::HUGEINT * v.f) AS score FROM y
      JOIN c u ON u.lang = y.lang AND u.phrase = array_to_string(w[1:y.k], ' ')
      JOIN c v ON v.lang = y.lang AND v.phrase = array_to_string(w[y.k + 1:], ' ')),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, phrase, max(a) AS inside FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM x WHERE size = 3) GROUP BY ALL),
q AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE inside IS NULL OR 100 * inside < {CONTAINED_PERCENT} * a)
SELECT q.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM q JOIN t USING (lang) WHERE rank <= {TOP}
"""
