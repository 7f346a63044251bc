"""Language-model scores of documents: a word-count base, and context mixing.

The corpus is cut into slices once (texts packed, with the slice's distinct words), written
to the shared folder, so that every later pass sees the same slices.

* Base: words are counted per block of slices. A block's distinct words are dealt to groups by
  their crc32, packed; a group sums its words over all blocks and gives each block the counts
  of its own back. A word is in a block's words once, so no word is hot, and there are as many
  groups as the words need: ``GROUP_WORDS`` in each, about.
* Context mixing (``context_mixing``; A-Z lower-cased here too): each block has its distinct
  n-grams, with counts in training documents, cut into parts by context. A part's n-grams of
  all blocks meet and are summed up: exact counts, which grow with the corpus and are on no
  driver. Gate weights and the adaptive map are learned from one training document in eight,
  against counts without those: groups of parts run online passes, and weights are averaged
  between passes by the groups' masses. The final counts hold all training documents. Codes
  made from counts take many times the counts' room, so each pass makes them anew.
* Scoring: a part works out each of its n-grams once and gives every block the probabilities
  of its own; a block adds them up. Only the counts of contexts of one and two bytes (all
  there can be: 34 MB), weights and map are sent to tasks.

Held-out documents (``remainder`` of crc32 of the key's text modulo ``folds``) add nothing
to any count, table or weight. A null key counts as remainder 0. A null text is an empty
one: one end token, and the probability of ending at once. Empty table: no rows. Without
training documents the model is uniform and no token is known. Repeated rows count and
come back once each. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefeed.llm import context_mixing as mixing
from tunefeed.llm.arrow_text import LOWER, SPACED, slices, strings, text_bytes, words
from tunefeed.session import shared_path

SLICE = 4 << 20
#: Bytes of text from which on slices are a block, with one list of distinct words and n-grams.
BLOCK = 24 << 20
#: Distinct words, counted once for each block that has them, that a group sums up, about; and the least groups.
GROUP_WORDS = 1 << 20
GROUPS = 16
#: Online passes over the n-grams that weights are learned from.
PASSES = 2
#: Slices whose share of n-grams is one group that weights are learned from, about.
SLICES = 16
#: N-grams whose counts a task works out at once, about.
PART_ROWS = 200_000

_FIT, _MIX, _HELD_OUT = 0, 1, 2
#: Stands for the end of a text; no word has white space.
_END = b"\n"


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens (the end last), the token of each place, and each text's begin."""
    data = LOWER[data]
    start, stop, bounds = words(data, offsets, SPACED)
    coded = strings(data[SPACED[data]], start, stop).dictionary_encode()
    end = len(coded.dictionary)
    begin = bounds + np.arange(bounds.size)
    codes = np.full(int(begin[-1]), end, np.int64)
    keep = np.ones(codes.size, bool)
    keep[begin[1:] - 1] = False
    codes[keep] = coded.indices.to_numpy(zero_copy_only=False)
    terms = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([_END], pa.binary())])
    return terms, codes, begin[:-1]


def _merged(terms: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """Distinct terms of several slices, and the place there of each slice's own."""
    coded = pa.concat_arrays(terms).dictionary_encode()
    places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, np.split(places, np.cumsum([len(t) for t in terms])[:-1])


def _slices(df: DataFrame, key: str, text: str, folds: int, remainder: int) -> DataFrame:
    """One row per slice. Neighbours of ``BLOCK`` bytes or so have one block number, one list of distinct
    terms, and one of distinct n-grams by part, with their counts in training documents; the
    block's last row has them, and ``words``, the number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counted, number, size = [], [], TaskContext.get().partitionId() << 33, 0

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def rows() -> Iterator[pa.RecordBatch]:
            terms, places = _merged([b[-2] for b in block])
            total = np.zeros(len(terms), np.int64)
            for place, b in zip(places, block, strict=True):
                total[place] += b[-1]
            own, count = _together(counted)
            by, cuts = _by_part(own)
            own, count = mixing.keyed(mixing.unkeyed(own[by])), count[by].astype(np.int64)
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            grams = pa.array([_packed(own[a:b]) if b > a else None for a, b in spans], pa.binary())
            times = pa.array([_packed(count[a:b]) if b > a else None for a, b in spans], pa.binary())
            for nth, (keys, roles, sizes, texts, *_) in enumerate(block):
                last = nth == len(block) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([nth]),
                        one(keys),
                        *(pa.array([b], pa.binary()) for b in (roles, sizes, texts)),
                        one(terms if last else terms[:0]),
                        one(pa.array(total if last else total[:0])),
                        one(grams if last else grams[:0]),
                        one(times if last else times[:0]),
                        pa.array([len(terms) if last else 0]),
                    ],
                    ["block", "nth", "keys", "roles", "sizes", "texts", "terms", "counts", "grams", "times", "words"],
                )

        for part in slices(batches, 2, SLICE):
            data, offsets = text_bytes(part.column(2))
            role = part.column(1).to_numpy(zero_copy_only=False)
            terms, codes, begin = _tokens(data, offsets)
            trained = np.repeat(role != _HELD_OUT, np.diff(np.append(begin, codes.size)))
            count = np.bincount(codes[trained], minlength=len(terms))
            packed = zstandard.compress(data.tobytes(), 3)
            block.append((part.column(0), role.astype(np.uint8).tobytes(), np.diff(offsets).astype("<i8").tobytes(), packed, terms, count))
            counted.append(_counted(data, offsets, role))
            if len(counted) > 4:
                counted = [_together(counted)]
            size += data.size
            if size >= BLOCK:
                yield from rows()
                block, counted, number, size = [], [], number + 1, 0
        if block:
            yield from rows()

    crc = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0))
    role = F.when(crc % folds == remainder, _HELD_OUT).when(F.floor(crc / folds) % 8 == 0, _MIX).otherwise(_FIT)
    kind = df.schema[key].dataType.simpleString()
    schema = f"block long, nth long, keys array<{kind}>, roles binary, sizes binary, texts binary, terms array<binary>, counts array<long>, grams array<binary>, times array<binary>, words long"
    cut = df.select(F.col(key).alias("key"), role.cast("int").alias("role"), F.col(text).alias("text")).mapInArrow(run, schema)
    path = shared_path(df.sparkSession, "slices")
    cut.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _unpacked(sizes: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))])
    raw = zstandard.decompress(texts, max_output_size=max(1, int(offsets[-1])))
    return np.frombuffer(raw, np.uint8), offsets


def _summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(keys, kind="stable")
    keys, rows = keys[by], rows[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if keys.size else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(rows, first, axis=0, dtype=rows.dtype) if keys.size else rows


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[mixing.firsts(keys)]


def _packed(values: np.ndarray) -> bytes | None:
    """Numbers (a row, or rows of several) as compressed bytes, all first bytes first."""
    if not values.size:
        return None
    return zstandard.compress(np.ascontiguousarray(values.reshape(values.shape[0], -1)).view(np.uint8).T.tobytes(), 3)


def _opened(blob: bytes | None, kind: type, columns: int = 1) -> np.ndarray:
    """What ``_packed`` was given, in ``columns`` columns."""
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8) if blob else np.zeros(0, np.uint8)
    flat = np.ascontiguousarray(raw.reshape(columns * np.dtype(kind).itemsize, -1).T).view(kind)
    return flat[:, 0] if columns == 1 else flat


def _counted(data: np.ndarray, offsets: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a slice, ``ordered``, and how often documents of the roles _FIT and _MIX have them."""
    own, bounds = mixing.grams(data, offsets)
    # One sort: the role stands below the n-gram.
    own = mixing.ordered(own)
    own <<= np.uint64(2)
    own |= np.repeat(role.astype(np.uint8), np.diff(bounds))
    own.sort()
    first = mixing.firsts(own)
    times, own = np.diff(np.append(first, own.size)), own[first]
    key, kind = own >> np.uint64(2), own & np.uint64(3)
    at = mixing.firsts(key)
    place, count = np.repeat(np.arange(at.size), np.diff(np.append(at, own.size))), np.zeros((at.size, 2), np.uint32)
    for column in (_FIT, _MIX):
        count[place[kind == column], column] = times[kind == column]
    return key[at], count


def _together(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return counted[0] if len(counted) == 1 else _summed(*(np.concatenate([c[i] for c in counted]) for i in (0, 1)))


def _by_part(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``ordered`` n-grams in the order of their parts, and where each part begins there."""
    part = mixing.parts_of(own).astype(np.uint8)
    by = np.argsort(part, kind="stable")
    return by, np.searchsorted(part[by].astype(np.int64), np.arange(mixing.PARTS + 1))


def _dealt(terms: pa.Array, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of terms in the order of their groups, and where each group begins there."""
    group = np.fromiter(map(zlib.crc32, terms.to_numpy(zero_copy_only=False)), np.int64, len(terms)) % groups
    by = np.argsort(group, kind="stable")
    return by, np.searchsorted(group[by], np.arange(groups + 1))


class _Places:
    """Places of numbers among distinct ones, by hashing: argsort and search take several times as long."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.width = keys, int(2 * keys.size + 1).bit_length()
        self.table = np.full(1 << self.width, -1, np.int32)
        left, at = np.arange(keys.size, dtype=np.int32), self._home(keys)
        while left.size:
            free = self.table[at] < 0
            self.table[at[free]] = left[free]
            lost = self.table[at] != left
            left, at = left[lost], self._next(at[lost])

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.width)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.width) - 1)

    def of(self, asked: np.ndarray) -> np.ndarray:
        """All of ``asked`` must be there."""
        return np.concatenate([self._of(asked[low : low + (1 << 20)]) for low in range(0, asked.size, 1 << 20)])

    def _of(self, asked: np.ndarray) -> np.ndarray:
        at = self._home(asked)
        out = self.table[at]
        wrong = np.flatnonzero(self.keys[out] != asked)
        at = at[wrong]
        while wrong.size:
            at = self._next(at)
            out[wrong] = self.table[at]
            still = self.keys[out[wrong]] != asked[wrong]
            wrong, at = wrong[still], at[still]
        return out


def _added(rows: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of a part, and their counts, over all blocks."""
    held, waiting, n = (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)), [], 0
    for grams, times in rows:
        waiting.append((_opened(grams, np.uint64), _opened(times, np.int64, 2)))
        n += waiting[-1][0].size
        if n > max(held[0].size, 1 << 20):
            every = [held, *waiting]
            held, waiting, n = _summed(*(np.concatenate([e[i] for e in every]) for i in (0, 1))), [], 0
    every = [held, *waiting]
    return _summed(*(np.concatenate([e[i] for e in every]) for i in (0, 1)))


def _long_codes(keys: np.ndarray, count: np.ndarray, rows: int, asked: np.ndarray | None = None) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Pieces of a part's sorted n-grams that hold whole contexts of three bytes, with their
    n-grams (of those, the ``asked``) and the longer orders' codes under ``count``."""
    begins = np.append(np.flatnonzero(np.diff(keys >> np.uint64(32), prepend=np.uint64(0))), keys.size) if keys.size else np.zeros(1, np.int64)
    low = 0
    while low < keys.size:
        # At least one context, and no more than ``rows`` n-grams if that is possible.
        at = max(np.searchsorted(begins, low + rows, side="right") - 1, np.searchsorted(begins, low, side="right"))
        piece = slice(low, int(begins[at]))
        gram, some = mixing.unkeyed(keys[piece]), None if asked is None else asked[piece]
        if some is None or some.any():
            yield piece, gram if some is None else gram[some], np.stack([mixing.node_codes(gram, count[piece], o, some) for o in mixing.LONG])
        low = piece.stop


def _merged_parts(parts: DataFrame) -> DataFrame:
    """One row per part: its n-grams with counts in all training documents, and in those that
    weights are learned from."""

    def merge(group: pa.Table) -> pa.Table:
        keys, count = _added(zip(*(group.column(c).to_pylist() for c in ("grams", "times")), strict=True))
        every = {"grams": keys, "times": count[:, 0] + count[:, 1], "mix": count[:, 1]}
        return pa.table({"part": group.column("part")[:1], **{n: pa.array([_packed(v)], pa.binary()) for n, v in every.items()}})

    path, spark = shared_path(parts.sparkSession, "grams"), parts.sparkSession
    found = parts.select(F.posexplode(F.arrays_zip("grams", "times")).alias("part", "own")).select("part", "own.*").filter("grams IS NOT NULL")
    merged = found.groupBy("part").applyInArrow(merge, "part int, grams binary, times binary, mix binary")
    merged.write.parquet(path)
    return spark.read.parquet(path)


def _short_tables(merged: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Slots of orders 1 and 2 without, and with, the documents that weights are learned from."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, times, mix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                every = _opened(times, np.int64)
                counts = np.stack([every - _opened(mix, np.int64), every], axis=1)
                last, sums = _summed(mixing.unkeyed(_opened(grams, np.uint64)) & np.uint64(0xFFFFFF), counts)
                yield pa.RecordBatch.from_arrays([pa.array(last.view(np.int64)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["last", "f", "e"])

    found = merged.select("grams", "times", "mix").mapInArrow(rows, "last long, f long, e long")
    # Three bytes: 2^24 rows at most, whatever the corpus.
    summed = found.groupBy("last").agg(F.sum("f").alias("f"), F.sum("e").alias("e")).filter("e > 0").toArrow()
    last, out = summed.column("last").to_numpy().view(np.uint64), ([], [])
    for tables, name in zip(out, ("f", "e"), strict=True):
        count = summed.column(name).to_numpy()
        for order in mixing.SHORT:
            table = np.zeros(1 << mixing.SLOT_BITS[order - 1], np.uint16)
            if last.size:
                table[mixing.slots(last, order)] = mixing.node_codes(last, count, order)
            tables.append(table)
    return out


def train(merged: DataFrame, groups: int) -> mixing.Model:
    """The model (longer orders' counts apart) of a table of parts."""
    spark = merged.sparkSession
    fit, every = _short_tables(merged)
    weights = mixing.new_weights()
    rows, sent = PART_ROWS, spark.sparkContext.broadcast(fit)
    own = merged.select(F.pmod("part", F.lit(groups)).alias("nth"), "part", "grams", "times", "mix")

    def opened(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """N-grams that weights are learned from, how often, and their codes without those."""
        for grams, times, mix in zip(*(table.column(c).to_pylist() for c in ("grams", "times", "mix")), strict=True):
            mix = _opened(mix, np.int64)
            for piece, gram, codes in _long_codes(_opened(grams, np.uint64), _opened(times, np.int64) - mix, rows, mix > 0):
                yield gram, mix[piece][mix[piece] > 0], codes

    def online(weights: np.ndarray) -> Callable[[pa.Table], pa.Table]:
        def passed(group: pa.Table) -> pa.Table:
            group, model = group.sort_by("part"), mixing.Model(sent.value, weights.copy())
            found = list(opened(group))
            if found:
                gram, mix, codes = (np.concatenate([f[i] for f in found], axis=-1) for i in range(3))
                by = np.random.default_rng(7).permutation(gram.size)
                model.learn(gram[by], mix[by], codes[:, :, by])
            mass = sum(int(f[1].sum()) for f in found)
            return pa.table({"nth": group.column("nth")[:1], "w": pa.array([model.weights.tobytes()], pa.binary()), "mass": [mass]})

        return passed

    for _ in range(PASSES):
        # A few hundred numbers from each group, of which there are no more than parts.
        learned = own.repartition(groups, "nth").groupBy("nth").applyInArrow(online(weights), "nth int, w binary, mass long").collect()
        learned = sorted((r for r in learned if r.mass), key=lambda r: r.nth)
        if learned:
            total = sum(np.frombuffer(r.w) * r.mass for r in learned)
            weights = (total / sum(r.mass for r in learned)).reshape(weights.shape)

    def refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = mixing.Model(sent.value, weights)
        ones, total = np.zeros(mixing.REFINED), np.zeros(mixing.REFINED)
        for batch in batches:
            for every_gram, every_mix, every_code in opened(batch):
                for low in range(0, every_gram.size, 1 << 16):
                    gram, mix, codes = every_gram[low : low + (1 << 16)], every_mix[low : low + (1 << 16)], every_code[:, :, low : low + (1 << 16)]
                    w = np.tile(mix, 8)
                    cell = model.map_cells(gram, model.logits(*model.inputs(gram, codes)))
                    ones += np.bincount(cell, weights=w * mixing.bits(gram).ravel(), minlength=mixing.REFINED)
                    total += np.bincount(cell, weights=w, minlength=mixing.REFINED)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(mixing.REFINED)), pa.array(ones), pa.array(total)], ["cell", "ones", "total"])

    ones, total = np.zeros(mixing.REFINED), np.zeros(mixing.REFINED)
    for r in own.mapInArrow(refined, "cell long, ones double, total double").groupBy("cell").agg(F.sum("ones").alias("o"), F.sum("total").alias("t")).collect():
        ones[r.cell], total[r.cell] = r.o, r.t
    return mixing.Model(every, weights, mixing.map_from(ones, total))


def _answers(parts: DataFrame, merged: DataFrame, model: mixing.Model) -> DataFrame:
    """block, part, probs: log10 of the probability of each of a block's n-grams."""
    sent, rows = parts.sparkSession.sparkContext.broadcast(model), PART_ROWS

    def answer(own: pa.Table, asked: pa.Table) -> pa.Table:
        keys, count = (_opened(own.column(c)[0].as_py(), kind) for c, kind in (("grams", np.uint64), ("times", np.int64)))
        each = np.zeros(keys.size, np.float32)
        for piece, gram, codes in _long_codes(keys, count, rows):
            each[piece] = sent.value.log10(gram, codes)
        probs = [_packed(each[np.searchsorted(keys, _opened(g, np.uint64))]) for g in asked.column("grams").to_pylist()]
        return pa.table({"block": asked.column("block"), "part": asked.column("part"), "probs": pa.array(probs, pa.binary())})

    asked = parts.select("block", F.posexplode("grams").alias("part", "grams")).filter("grams IS NOT NULL")
    return merged.select("part", "grams", "times").groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(answer, "block long, part int, probs binary")


def _word_counts(parts: DataFrame, groups: int) -> DataFrame:
    """block, place, counts: how often training documents have a block's terms, by group; and
    a group's tokens and distinct terms there, once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, terms, count in zip(*batch.columns, strict=True):
                terms, count = terms.values, count.values.to_numpy()
                by, cuts = _dealt(terms, groups)
                full = np.flatnonzero(np.diff(cuts))
                spans = [by[cuts[g] : cuts[g + 1]] for g in full]
                # No term has a space in it.
                spelled = terms.to_numpy(zero_copy_only=False)
                texts = [zstandard.compress(b" ".join(spelled[s]), 3) for s in spans]
                columns = [np.full(full.size, number.as_py()), full.astype(np.int32), pa.array(texts, pa.binary()), pa.array([_packed(count[s]) for s in spans], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "place", "terms", "counts"])

    def summed(group: pa.Table) -> pa.Table:
        spelled = [pa.array(zstandard.decompress(t).split(b" "), pa.binary()) for t in group.column("terms").to_pylist()]
        terms, places = _merged(spelled)
        total = np.zeros(len(terms), np.int64)
        for place, count in zip(places, group.column("counts").to_pylist(), strict=True):
            total[place] += _opened(count, np.int64)
        once = np.zeros((2, group.num_rows), np.int64)
        once[:, 0] = total.sum(), (total > 0).sum()
        counts = pa.array([_packed(total[p]) for p in places], pa.binary())
        return pa.table({"block": group.column("block"), "place": group.column("place"), "counts": counts, "tokens": once[0], "terms": once[1]})

    path, spark = shared_path(parts.sparkSession, "words"), parts.sparkSession
    own = parts.filter("words > 0").select("block", "terms", "counts").mapInArrow(cut, "block long, place int, terms binary, counts binary")
    own.repartition(groups, "place").groupBy("place").applyInArrow(summed, "block long, place int, counts binary, tokens long, terms long").write.parquet(path)
    return spark.read.parquet(path)


def score_documents(df: DataFrame, *, key: str = "doc_id", text: str = "text", folds: int = 5, remainder: int = 1) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    parts = _slices(df, key, text, folds, remainder)
    number, listed = parts.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    groups = max(GROUPS, listed // GROUP_WORDS)
    counts = _word_counts(parts, groups)
    total, distinct = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    merged = _merged_parts(parts)
    model = train(merged, max(1, min(mixing.PARTS, number // SLICES)))

    none = F.lit(None).cast("binary")
    answers = counts.select("block", "place", "counts", none.alias("probs"))
    answers = answers.unionAll(_answers(parts, merged, model).select("block", "part", none, "probs"))

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        block = block.sort_by("nth")
        packed = list(zip(*(block.column(c).to_pylist() for c in ("sizes", "texts")), strict=True))
        split = [_tokens(*_unpacked(*p)) for p in packed]
        terms, places = _merged([t for t, _, _ in split])
        found = np.zeros(len(terms), np.int64)
        spelled, probs = (known.filter(pc.field(c).is_valid()).sort_by("place").column(c).to_pylist() for c in ("counts", "probs"))
        found[_dealt(terms, groups)[0]] = np.concatenate([_opened(c, np.int64) for c in spelled])
        keys = np.zeros(0, np.uint64)
        for p in packed:
            keys = _distinct(np.concatenate([keys, _distinct(mixing.ordered(mixing.grams(*_unpacked(*p))[0]))]))
        each_gram, where = np.empty(keys.size, np.float32), _Places(keys)
        each_gram[_by_part(keys)[0]] = np.concatenate([_opened(p, np.float32) for p in probs])
        out = []
        for i, ((_, codes, begin), place) in enumerate(zip(split, places, strict=True)):
            count = found[place]
            each = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
            gram, bounds = mixing.grams(*_unpacked(*packed[i]))
            score = np.add.reduceat(each_gram[where.of(mixing.ordered(gram))].astype(np.float64), bounds[:-1])
            out.append(
                pa.table(
                    {
                        "key": block.column("keys")[i].values,
                        "held_out": np.frombuffer(block.column("roles")[i].as_py(), np.uint8) == _HELD_OUT,
                        "n_tokens": np.diff(np.append(begin, codes.size)),
                        "n_known": np.add.reduceat((count > 0)[codes].astype(np.int64), begin),
                        "train_tokens": np.full(begin.size, total, np.int64),
                        "base_score": np.add.reduceat(each[codes], begin),
                        "score": score,
                        "bits_per_byte": -score * np.log2(10) / np.diff(bounds),
                    }
                )
            )
        return pa.concat_tables(out)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    own = parts.select(F.col("block").alias("own"), "nth", "keys", "roles", "sizes", "texts").groupBy("own")
    return own.cogroup(answers.groupBy("block")).applyInArrow(run, schema).withColumnRenamed("key", key)
