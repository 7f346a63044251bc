"""Pre-tokens of byte-level BPE tokenizers, found in numpy for many texts at once.

The tokenizer's own pre-tokenizer says which class (letter, number, space, other) a
code point has; runs of a class, the space before a run, and contractions then follow
the published pattern of this tokenizer family:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from tunefeed.llm.arrow_text import begins, strings

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
#: Distinct pre-tokens whose ids a worker remembers.
MEMO = 800_000


@lru_cache(maxsize=4)
def load(path: str) -> ByteTokenizer:
    """The tokenizer of a file; one per worker process."""
    return ByteTokenizer(path)


class ByteTokenizer:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        before = made.get("pre_tokenizer") or {}
        if made.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self._class = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self._forget()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def has_special(self, data: np.ndarray) -> bool:
        raw = data.tobytes()
        return any(s in raw for s in self.special)

    def _classes(self, points: np.ndarray) -> np.ndarray:
        found = self._class[points]
        if (found == UNKNOWN).any():
            pieces = self.library.pre_tokenizer.pre_tokenize_str
            for point in np.unique(points[found == UNKNOWN]).tolist():
                joined = [len(pieces(before + chr(point))) == 1 for before in ("a", "1", "!")]
                self._class[point] = joined.index(True) if any(joined) else SPACE
            found = self._class[points]
        return found

    def pretokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins of all pre-tokens (they leave no gaps), and each text's range of them."""
        if not data.size:
            return np.zeros(0, np.int64), np.zeros(offsets.size, np.int64)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        kind = self._classes(points)
        first = begins(offsets, data.size)[at]
        last = np.append(first[1:], True)
        run = first.copy()
        run[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        start = run.copy()
        start[:-1] |= space[:-1] & ~space[1:] & ~last[:-1]
        glued = np.zeros_like(run)
        glued[1:] = run[1:] & ~first[1:] & ~space[1:] & (points[:-1] == 0x20)
        start &= ~glued
        self._contractions(points, kind, run, last, start)
        start = at[start]
        return start, np.searchsorted(start, offsets)

    @staticmethod
    def _contractions(points, kind, run, last, start) -> None:
        size = points.size
        for i in np.flatnonzero((points == 0x27) & run & start & ~last).tolist():
            if not run[i + 1] or kind[i + 1] != LETTER:
                continue
            one = points[i + 1]
            two = points[i + 2] if i + 2 < size and not last[i + 1] else 0
            if one in (0x73, 0x74, 0x6D, 0x64):  # s t m d
                end = i + 2
            elif (one, two) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):  # re ve ll
                end = i + 3
            else:
                continue
            start[i + 1] = False
            if end < size and kind[end] == LETTER and not last[end - 1]:
                start[end] = True

    def coded(self, data: np.ndarray, start: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Distinct pre-tokens, and the number of its own for each pre-token."""
        whole = strings(data, start, np.append(start[1:], data.size)) if start.size else pa.array([], pa.binary())
        coded = whole.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def ids(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of pre-tokens without special strings: ids, and each one's begin and size."""
        if len(self._memo) + len(pretokens) > MEMO:
            self._forget()
        memo = self._memo
        new = [p for p in pretokens if p not in memo]
        if new:
            lists = self.encode([p.decode() for p in new])
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))
            first, at = len(memo), self._end[len(memo)]
            while at + flat.size > self._flat.size:
                self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
            while first + len(new) >= self._end.size:
                self._end = np.concatenate([self._end, np.zeros_like(self._end)])
            self._flat[at : at + flat.size] = flat
            self._end[first + 1 : first + 1 + len(new)] = at + np.cumsum(size)
            memo.update(zip(new, range(first, first + len(new)), strict=True))
        place = np.fromiter(map(memo.__getitem__, pretokens), np.int64, len(pretokens))
        return self._flat, self._end[place], self._end[place + 1] - self._end[place]

    def _forget(self) -> None:
        """Empty the memo: pre-token -> place; ``_end[place]`` .. ``_end[place + 1]`` in ``_flat``."""
        self._memo: dict[bytes, int] = {}
        self._flat = np.zeros(1 << 16, np.uint32)
        self._end = np.zeros(1 << 14, np.int64)
