"""A byte model by online logistic context mixing, in numpy over distinct n-grams.

A byte is eight binary decisions. For each, one predictor per context order (the last 1 to
6 bytes, with the bits decided so far) gives a probability from counts. The logits
are added up under weights that a gate selects: the longest order seen before, and how
often. The sum's probability is refined by an adaptive map over the decision and the logit.
As contexts end with the last six bytes, all n-grams of seven bytes that are equal have one
probability, so a text is evaluated once per distinct n-gram.

Counts are exact. Orders 1 and 2 have a slot for every decision there can be. The longer
orders' counts come from ``node_codes`` over sorted n-grams and grow with the corpus: all
n-grams with equal last three bytes of context are in one part, which has all it needs.
(``Model`` can hold a small corpus's longer orders in hashed tables too.)

A-Z count as a-z. Before the first byte and after the last stands the byte 0xFF, which no text has; its
probability after the last byte makes the score that of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tunefeed.llm.arrow_text import LOWER

ORDERS = (1, 2, 3, 4, 5, 6)
EDGE = 0xFF
#: Slots of an order's table: 2 to this power. Orders 1 and 2 have one for each decision.
SLOT_BITS = (16, 24, 21, 21, 21, 21)
#: The last three bytes choose one of so many parts (2 to this power).
PART_BITS = 8
PARTS = 1 << PART_BITS
SHORT, LONG = (1, 2), tuple(o for o in ORDERS if o >= 3)
GATES = (len(ORDERS) + 1) * 8
#: Logits that the adaptive map tells apart.
STEPS = 33
REFINED = 256 * STEPS

_LIMIT = 12.0
_LOGITS = ((np.arange(4096) - 2048) * (_LIMIT / 2048)).astype(np.float32)
#: A context seen so often has the next level.
_LEVELS = np.array([1, 2, 4, 8, 16, 64, 1024])


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of each byte and each end, the current byte lowest; and texts' ranges."""
    n, before = np.diff(offsets), ORDERS[-1]
    bounds = offsets + np.arange(offsets.size)
    # Each text with as many edges before it as the longest context has bytes, and one behind.
    full = np.full(int(bounds[-1]) + before * n.size, EDGE, np.uint8)
    begin = bounds[:-1] + before * np.arange(n.size)
    keep = np.ones(full.size, bool)
    keep[(begin[:, None] + np.arange(before)).ravel()] = False
    inside = keep.copy()
    inside[begin + before + n] = False
    full[inside] = LOWER[data]
    last = full.astype(np.uint32)
    last[1:] |= last[:-1] << np.uint32(8)
    last[2:] |= last[:-2] << np.uint32(16)
    out = last.astype(np.uint64)
    out[4:] |= (last[:-4] & np.uint32(0xFFFFFF)).astype(np.uint64) << np.uint64(32)
    return out[keep], bounds


def ordered(gram: np.ndarray) -> np.ndarray:
    """N-grams as numbers of 56 bits that sort by the last three bytes of context and the byte,
    then the bytes before."""
    out = gram & np.uint64(0xFFFFFFFF)
    out <<= np.uint64(24)
    out |= gram >> np.uint64(32)
    return out


def parts_of(order: np.ndarray) -> np.ndarray:
    """The part of each of such numbers."""
    return ((order >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PART_BITS)


def keyed(gram: np.ndarray) -> np.ndarray:
    """N-grams as numbers that sort by part, then as ``ordered`` does."""
    order = ordered(gram)
    return (parts_of(order) << np.uint64(56)) | order


def unkeyed(key: np.ndarray) -> np.ndarray:
    return ((key >> np.uint64(24)) & np.uint64(0xFFFFFFFF)) | ((key & np.uint64(0xFFFFFF)) << np.uint64(32))


def slots(gram: np.ndarray, order: int) -> np.ndarray:
    """Slot of each of the eight decisions of each n-gram: shape (8, n)."""
    width = SLOT_BITS[order - 1]
    context = (gram >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
    byte = gram & np.uint64(0xFF)
    out = np.empty((8, gram.size), np.int32)
    if order in SHORT:
        for i in range(8):
            out[i] = (context << np.uint64(8)) | np.uint64(1 << i) | (byte >> np.uint64(8 - i))
        return out
    hashed = context * np.uint64(0x9E3779B97F4A7C15) + np.uint64(order)
    hashed ^= hashed >> np.uint64(29)
    for i in range(8):
        node = np.uint64(1 << i) | (byte >> np.uint64(8 - i))
        mixed = (hashed + node * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out[i] = (mixed >> np.uint64(64 - width)).astype(np.int32)
    return out


def node_codes(gram: np.ndarray, count: np.ndarray, order: int, asked: np.ndarray | None = None) -> np.ndarray:
    """Packed exact counts of each of the eight decisions of each n-gram: shape (8, n).

    ``gram`` must hold all n-grams with the contexts of this order that it has; ``asked``
    chooses those to answer for.
    """
    own = gram & np.uint64((1 << 8 * (order + 1)) - 1)
    by = np.argsort(own)
    own = own[by]
    first = firsts(own)
    place = np.empty(own.size, np.int64)
    place[by] = np.repeat(np.arange(first.size), np.diff(np.append(first, own.size)))
    total, own = np.add.reduceat(count[by].astype(np.float64), first), own[first]
    out = np.empty((8, own.size), np.uint16)
    for i in range(8):
        runs = firsts(own >> np.uint64(8 - i))
        one = total * ((own >> np.uint64(7 - i)) & np.uint64(1))
        every, ones = np.add.reduceat(total, runs), np.add.reduceat(one, runs)
        out[i] = np.repeat(packed(every - ones, ones), np.diff(np.append(runs, own.size)))
    return out[:, place if asked is None else place[asked]]


def firsts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if values.size else np.zeros(0, np.int64)


def bits(gram: np.ndarray) -> np.ndarray:
    byte = (gram & np.uint64(0xFF)).astype(np.uint8)
    return np.stack([(byte >> (7 - i)) & 1 for i in range(8)]).astype(bool)


def packed(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Slots as 16 bits: level of the count above, logit below; 0 where nothing was seen.
    Counts are whole numbers; most are small, and looked up."""
    small = (zeros < _FEW) & (ones < _FEW)
    out = _SMALL[np.where(small, zeros * _FEW + ones, 0).astype(np.int64)]
    large = ~small
    out[large] = _coded(zeros[large], ones[large])
    return out


def _coded(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    total = zeros + ones
    logit = np.log((ones + 0.4) / (zeros + 0.4))
    step = np.clip(np.rint(logit * (2048 / _LIMIT)) + 2048, 0, 4095).astype(np.uint16)
    level = np.searchsorted(_LEVELS, total, side="right").astype(np.uint16)
    return np.where(total > 0, (level << 12) | step, 0).astype(np.uint16)


_FEW = 64
_SMALL = _coded(np.repeat(np.arange(_FEW), _FEW), np.tile(np.arange(_FEW), _FEW))


@dataclass
class Model:
    tables: list[np.ndarray]  # packed slots of each order
    weights: np.ndarray  # (gates, orders + 1)
    map: np.ndarray | None = None  # (256 * STEPS) probabilities of the adaptive map

    def inputs(self, gram: np.ndarray, long: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Logits (orders + 1, 8 n) of all decisions, and their gates.

        ``long``: codes of the longer orders (orders, 8, n); without them, tables have those.
        """
        out = np.empty((len(ORDERS) + 1, 8 * gram.size), np.float32)
        gate = np.zeros(8 * gram.size, np.uint8)
        for i, order in enumerate(ORDERS):
            if long is not None and order in LONG:
                code = long[LONG.index(order)].ravel()
            else:
                code = self.tables[i][slots(gram, order).ravel()]
            seen = code > 0
            out[i] = np.where(seen, _LOGITS[code & 0xFFF], 0)
            gate = np.where(seen, (8 * (i + 1) + (code >> 12)).astype(np.uint8), gate)
        out[-1] = 1
        return out, gate

    def logits(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        z = np.zeros(gate.size, np.float32)
        for k in range(inputs.shape[0]):
            z += self.weights[:, k].astype(np.float32)[gate] * inputs[k]
        return np.clip(z, -_LIMIT, _LIMIT)

    def learn(self, gram: np.ndarray, weight: np.ndarray, long: np.ndarray | None = None, batch: int = 4096, rate: float = 0.3) -> None:
        """One online pass: after each batch, a damped step for each gate in it. The weights
        left are the mean over the pass, as few n-grams have most of a batch's weight."""
        mean, batches = np.zeros_like(self.weights), 0
        for low in range(0, gram.size, batch):
            part = gram[low : low + batch]
            w = np.tile(weight[low : low + batch].astype(np.float64), 8)
            x, gate = self.inputs(part, None if long is None else long[:, :, low : low + batch])
            p = _squash(self.logits(x, gate))
            error, slope = w * (bits(part).ravel() - p), w * p * (1 - p)
            mass = np.bincount(gate, weights=w, minlength=GATES)
            for k in range(x.shape[0]):
                rise = np.bincount(gate, weights=error * x[k], minlength=GATES)
                curve = np.bincount(gate, weights=slope * x[k] * x[k], minlength=GATES)
                self.weights[:, k] += rate / 2 * rise / (curve + 0.01 * mass + 1.0)
            np.clip(self.weights, -2, 4, out=self.weights)
            mean, batches = mean + self.weights, batches + 1
        if batches:
            self.weights[:] = mean / batches

    def map_cells(self, gram: np.ndarray, z: np.ndarray) -> np.ndarray:
        byte = (gram & np.uint64(0xFF)).astype(np.int64)
        node = np.concatenate([(1 << i) | (byte >> (8 - i)) for i in range(8)])
        return node * STEPS + np.rint((z + _LIMIT) * ((STEPS - 1) / (2 * _LIMIT))).astype(np.int64)

    def log10(self, gram: np.ndarray, long: np.ndarray | None = None, block: int = 1 << 14) -> np.ndarray:
        """log10 of the probability of each n-gram's byte after its context."""
        out = np.empty(gram.size)
        for low in range(0, gram.size, block):
            part = gram[low : low + block]
            z = self.logits(*self.inputs(part, None if long is None else long[:, :, low : low + block]))
            p = _squash(z)
            if self.map is not None:
                p = (p + self.map[self.map_cells(part, z)]) / 2
            p = np.clip(p, 1e-6, 1 - 1e-6)
            chosen = np.where(bits(part).ravel(), p, 1 - p)
            out[low : low + block] = np.log10(chosen).reshape(8, -1).sum(axis=0)
        return out


def new_weights() -> np.ndarray:
    return np.full((GATES, len(ORDERS) + 1), 0.3) * np.array([1.0] * len(ORDERS) + [0.0])


def map_from(ones: np.ndarray, total: np.ndarray, prior: float = 8.0) -> np.ndarray:
    """Probabilities of the adaptive map from what fell into its cells."""
    start = np.tile(_squash(np.linspace(-_LIMIT, _LIMIT, STEPS)), 256)
    return (ones + prior * start) / (total + prior)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))
