"""License scans: fuzzy search for short notices.

* A text is read as its words (lower-cased A-Z, the bytes of ``ALPHANUMERIC``) with one space
  between two, so line breaks, comment signs and punctuation inside a notice do not matter.
* A notice may differ in ``edits`` characters at most (inserted, deleted or replaced). Cut into
  ``edits + 1`` pieces, one piece at least then stands in the text as it is (pigeonhole). One
  automaton finds all pieces of all notices.
* A piece found at x, which begins at o in its notice, tells that the notice begins within
  ``edits`` characters of x - o. At each beginning of a word there, bounded-error matching of the
  regex library says whether the notice stands, with how many edits and up to which word's end.
* Every place without edits is reported. Of places with edits that overlap a better one of the
  same notice (fewer edits, then the earlier one), only the better one is.

Null text: empty, so no words and no findings. Very long texts are read whole, one at a time.
Repeated rows: each is scanned by itself. Ties between ends of equally many edits are the regex
library's to break, always in the same way. Empty table: no rows. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.llm.arrow_text import ALPHANUMERIC, LOWER, slices, text_bytes, words


@dataclass(frozen=True)
class Notice:
    label: str
    #: Lower-case words with one space between two.
    text: str
    edits: int
    #: A place without edits is one of the phrases that are always reported as base.
    base: bool = False
    #: Words that must stand in the place as they are; for short notices.
    whole: tuple[str, ...] = ()


# Opening words of well-known licenses.
NOTICES = (
    Notice("mit", "mit license", 1, True, ("mit",)),
    Notice("apache", "apache license", 1, True),
    Notice("gpl", "general public license", 2, True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "this program is free software you can redistribute it and or modify it", 6),
    Notice("lgpl", "lesser general public license", 2),
    Notice("agpl", "affero general public license", 2),
    Notice("bsd", "bsd license", 1, whole=("bsd",)),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("cc", "creative commons attribution", 2),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
    Notice("zlib", "altered source versions must be plainly marked as such", 4),
)

FINDING = "struct<notice:int,label:string,base:boolean,edits:int,similarity:double,word:long,n_words:long,begin:long,end:long>"
_ARROW = pa.list_(
    pa.struct(
        [
            ("notice", pa.int32()),
            ("label", pa.string()),
            ("base", pa.bool_()),
            ("edits", pa.int32()),
            ("similarity", pa.float64()),
            ("word", pa.int64()),
            ("n_words", pa.int64()),
            ("begin", pa.int64()),
            ("end", pa.int64()),
        ]
    )
)


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of the notice, of nearly equal length, and where they begin."""
    borders = [len(notice.text) * i // (notice.edits + 1) for i in range(notice.edits + 2)]
    return [(a, notice.text[a:b]) for a, b in zip(borders, borders[1:])]


class Scanner:
    """Finds the places of all notices in a text of words joined by single spaces."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            if notice.edits >= len(notice.text):
                raise ValueError(f"notice {notice.text!r} is too short for {notice.edits} edits")
            for begin, piece in seeds(notice):
                pieces.setdefault(piece, []).append((i, begin))
        self.seeds = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.seeds.add_word(piece, (len(piece), where))
        if pieces:
            self.seeds.make_automaton()
        # The end of a place must be a word's end; the best match from its beginning on counts.
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.text)}){{e<={n.edits}}}(?![^ ])") for n in notices]

    def places(self, text: str) -> list[tuple[int, int, int, int]]:
        """(begin, end, notice, edits) of the places, in order."""
        begins: list[set[int]] = [set() for _ in self.notices]
        if not self.notices or not text:
            return []
        for last, (size, where) in self.seeds.iter(text):
            for i, offset in where:
                near = last + 1 - size - offset
                for at in range(max(near - self.notices[i].edits, 0), near + self.notices[i].edits + 1):
                    if at == 0 or text[at - 1 : at] == " ":
                        begins[i].add(at)
        found = []
        for i, own in enumerate(begins):
            if own:
                found += [(a, b, i, e) for e, a, b in self._best(self._verified(text, i, own))]
        return sorted(found)

    def _verified(self, text: str, i: int, begins: set[int]) -> Iterator[tuple[int, int, int]]:
        notice, size = self.notices[i], len(self.notices[i].text)
        for at in begins:
            if text.startswith(notice.text, at) and text[at + size : at + size + 1] in ("", " "):
                yield 0, at, at + size
                continue
            match = self.patterns[i].match(text, at, at + size + notice.edits + 1)
            if match and match.end() > at and not set(notice.whole) - set(match.group().split(" ")):
                yield sum(match.fuzzy_counts), at, match.end()

    @staticmethod
    def _best(places: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        taken: list[tuple[int, int]] = []
        longest, out = 0, []
        for edits, begin, end in sorted(places):
            if edits:
                i = bisect_left(taken, (begin - longest, 0))
                near = taken[i : bisect_left(taken, (end, 0))]
                if any(b > begin for _, b in near):
                    continue
            insort(taken, (begin, end))
            longest = max(longest, end - begin)
            out.append((edits, begin, end))
        return out


@lru_cache(maxsize=4)
def _scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def _findings(scanner: Scanner, data: np.ndarray, joined: str, start: np.ndarray, stop: np.ndarray) -> list[dict]:
    """The places in one text: words counted from 0, spans in code points of the text itself."""
    places = scanner.places(joined)
    if not places:
        return []
    # Code points before each byte: all bytes that do not continue one.
    points = np.zeros(data.size + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    out, at, word = [], 0, 0
    for begin, end, i, edits in places:
        word += joined.count(" ", at, begin)
        at = begin
        n = joined.count(" ", begin, end) + 1
        notice = scanner.notices[i]
        out.append(
            {
                "notice": i,
                "label": notice.label,
                "base": notice.base and not edits,
                "edits": edits,
                "similarity": 1 - edits / len(notice.text),
                "word": word,
                "n_words": n,
                "begin": int(points[start[word]]),
                "end": int(points[stop[word + n - 1]]),
            }
        )
    return out


def _scan(scanner: Scanner, column: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    raw, offsets = text_bytes(column)
    data = LOWER[raw]
    start, stop, bounds = words(data, offsets, ALPHANUMERIC)
    out: list[list[dict]] = []
    # The bytes of words and one behind each, which becomes a space.
    inside = ALPHANUMERIC[data]
    keep = inside.copy()
    keep[stop[stop < data.size]] = True
    blank = np.where(inside, data, np.uint8(0x20))
    for i in range(len(column)):
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            out.append([])
            continue
        lo, hi = start[a], stop[b - 1]
        joined = blank[lo:hi][keep[lo:hi]].tobytes().decode()
        begin = offsets[i]
        out.append(_findings(scanner, raw[begin : offsets[i + 1]], joined, start[a:b] - begin, stop[a:b] - begin))
    return np.diff(bounds), out


def find_notices(
    df: DataFrame, notices: tuple[Notice, ...] = NOTICES, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_words`` and ``findings`` (array of the places, in order) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(notices)
        for part in slices(batches, 1):
            n, found = _scan(scanner, part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(found, _ARROW)], ["key", "n_words", "findings"]
            )

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_words long, findings array<{FINDING}>"
    return df.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def _labels(findings: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(findings, lambda f: f["label"]))), ",")


def notice_summary(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``find_notices``: base places (all, without edits), first and last of their
    words, labels of the base and of all findings, and the best finding's similarity (0: none)."""
    base = F.filter("findings", lambda f: f["base"])
    at = F.transform(base, lambda f: f["word"])
    score = F.coalesce(F.array_max(F.transform("findings", lambda f: f["similarity"])), F.lit(0.0))
    return found.select(
        key,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("findings")).alias("labels"),
        score.alias("score"),
        F.size("findings").cast("long").alias("n_findings"),
    )
