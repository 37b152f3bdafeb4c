"""Token ids of whole texts, with a memo of space-separated pieces.

The vocabulary's pre-tokenizer begins a new unit at a single space or line feed that has other characters on both
sides, so the ids of a text are the ids of its pieces between them, one after another (a piece keeps the space or
line feed before it). Short pieces repeat, whole texts rarely do: each worker keeps the ids of the short pieces it
has met (a bounded memo, cut back to the shortest when full) and hands only new ones to the tokenizers library. The pieces of
many texts are told apart by Arrow and looked up once each, and their ids are put together by one gather. Texts where that law need not
hold (runs of white space, white space at an end, any other white space, a token added to the vocabulary such as an
end-of-text mark) are encoded whole. Ids are those of the library as it is: such a mark in a text has its own id.
"""
from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
MEMO_PIECES = 400_000
#: Longest piece kept after its batch, and kept when the memo is full. Longer ones rarely come again.
KEEP_CHARS, KEEP_CHARS_FULL = 9, 7
#: Characters of the texts that are encoded together, one text at least; pieces handed to the library as one text.
CHARS = 1 << 21
JOINED = 64
_encoders: dict[tuple[str, int], Encoder] = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def in_pieces(t: str) -> bool:
    """Whether the ids of this text are those of its pieces."""
    return (t[0] not in " \n" and t[-1] not in " \n" and not any(x in t for x in _RUNS)
            and not any(x in t for x in _OTHER))


class Encoder:
    """Encodes texts to uint32 id arrays. ``path`` is a tokenizer file of a byte-level BPE vocabulary."""

    def __init__(self, path: str, memo: int = MEMO_PIECES):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        added = [x.content for x in self.tok.get_added_tokens_decoder().values()]
        vocabulary = self.tok.get_vocab()
        #: Which ids stand for bytes that begin with a space or line feed (as the byte-level alphabet writes them).
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for x, i in vocabulary.items() if x[0] in "\u0120\u010a"]] = True
        #: Finds an added token in a text; matches nothing where the vocabulary has none.
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.memo: dict[str, bytes] = {}
        self.ends = dict(zip(",.", self._ids([",", "."]), strict=True))
        self.size = memo

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece (with its space or line feed in front). Many go to the library as one text: a piece's first
        token begins with its space or line feed, and none of its others does."""
        texts = ["".join(pieces[a:a + JOINED]) for a in range(0, len(pieces), JOINED)]
        got = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(got), np.uint32)
        at = np.flatnonzero(self.begins[ids])
        if not pieces or len(at) != len(pieces):  # the second: a vocabulary of another kind
            return self._ids(pieces)
        data, cuts = ids.tobytes(), (4 * at).tolist()
        return [data[x:y] for x, y in zip(cuts, [*cuts[1:], len(data)], strict=True)]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text is empty."""
        out: list[np.ndarray] = []
        some: list[str | None] = []
        chars = 0
        for t in texts:
            if some and chars + len(t or "") > CHARS:
                out += self._encode(some)
                some, chars = [], 0
            some.append(t)
            chars += len(t or "")
        return out + self._encode(some)

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        plain = [bool(t) and in_pieces(t) and not self.added.search(t) for t in texts]
        in_parts = iter(self._encode_in_pieces([t for t, p in zip(texts, plain, strict=True) if p]))
        whole = iter(self._ids([t for t, p in zip(texts, plain, strict=True) if t and not p]))
        none = np.zeros(0, np.uint32)
        return [next(in_parts) if p else np.frombuffer(next(whole), np.uint32) if t else none for t, p in zip(texts, plain, strict=True)]

    def _encode_in_pieces(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that are those of their pieces; each different piece is looked up once."""
        if not texts:
            return []
        memo = self.memo
        if len(memo) > self.size:
            kept = {x: ids for x, ids in memo.items() if len(x) <= KEEP_CHARS_FULL}
            memo.clear()
            if len(kept) <= self.size // 2:
                memo.update(kept)
        joined = "\n".join(["", *texts]).replace("\n", " \n")
        pieces = pc.split_pattern(pa.array([joined], pa.large_string()), " ")[0].values.slice(1).dictionary_encode()
        index, different = pieces.indices.to_numpy(), pieces.dictionary.to_pylist()
        got = list(map(memo.get, different))
        new = [x for x, ids in zip(different, got, strict=True) if ids is None]
        # A comma or full stop behind a letter is a unit of its own, which ends the piece.
        stems = {x: x[:-1] for x in new if x[-1] in ",." and x[-2:-1].isalpha()}
        fresh = [x for x in {stems.get(x, x) for x in new} if x not in memo]
        memo.update(zip(fresh, self._ids_of_pieces([x if x[0] == "\n" else " " + x for x in fresh]), strict=True))
        for x, stem in stems.items():
            memo[x] = memo[stem] + self.ends[x[-1]]
        got = [memo[x] if ids is None else ids for x, ids in zip(different, got, strict=True)]
        for x in (*fresh, *stems):
            if len(x) > KEEP_CHARS:
                memo.pop(x, None)
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        first = np.cumsum(size) - size
        many = size[index]
        end = np.cumsum(many)
        ids = np.frombuffer(b"".join(got), np.uint32)[np.repeat(first[index] - end + many, many) + np.arange(end[-1])]
        cuts = end[np.cumsum([1 + t.count(" ") + t.count("\n") for t in texts]) - 1].tolist()
        # The first piece of a text was given a line feed (one id) in front.
        return [ids[a + 1:z] for a, z in zip([0, *cuts[:-1]], cuts, strict=True)]


def encoder(path: str, memo: int = MEMO_PIECES) -> Encoder:
    """The worker's encoder for this file; it and its memo live as long as the worker."""
    key = (path, memo)
    if key not in _encoders:
        _encoders[key] = Encoder(path, memo)
    return _encoders[key]
