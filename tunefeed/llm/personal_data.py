"""Personal data: fixed patterns, and a linear-chain conditional random field for the rest.

Patterns (email, ip, card with Luhn's check, phone with +) are looked for in the runs of
their own characters that hold what every match must hold (an @, three dots, twelve digits,
a +); a match cannot leave its run, so nothing is missed and other text is never searched.

The field labels tokens (letters, digits, single signs) B/I per kind or O from word shapes:
the token's, its neighbours' up to two away, and pairs of them, each with the space before.
It is trained from ``LABELLED``, a small table with marked spans, by gradient ascent on the
conditional likelihood (forward-backward), and decoded by Viterbi for many sequences at
once. A sequence is a stretch of tokens at most two away from a digit, an @ or a +; all four
kinds hold one of those. Its spans are added where they hold what
their kind must hold (``_RUNS``'s signs, or a count of digits) and touch no pattern's span.

Null text: empty. Empty table: no rows. Repeated rows each come back. Long texts are read
whole. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunefeed.llm.arrow_text import begins, slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    # What follows the part before the sign; that part is looked for backwards.
    "email": re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(rb"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]"),
}
_DIGITS = b"0123456789"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: Characters of a kind's matches; what a run must hold, and how often.
_RUNS = {
    "email": (_LETTERS + _DIGITS + b"._%+-@", b"@", 1),
    "ip": (_DIGITS + b".", b".", 3),
    "card": (_DIGITS + b" -", _DIGITS, 12),
    "phone": (_DIGITS + b" ().-+", b"+", 1),
}

#: Sentences with marked spans. People, numbers and hosts are made up; none stands in a test table.
LABELLED = """
Write to [email:anna.berg@post.example.org] or call [phone:(044) 348-7439] after six.
You can reach us at [phone:717-555-0134] or [phone:+9 (175) 389-4005] today
Her number is [phone:717.555.0119], his is [phone:(280) 200-6414]!
Tel. [phone:+44 20 7946 0958] and fax [phone:555-867-5309].
Call [phone:(415) 555-2671] now
CALL!! [phone:(415) 555-0199]!! NOW!!
[phone:212-555-0187] rang twice, then [phone:(212) 555 0187] did
ring [phone:(303) 555-0142]### or### else
The card [card:2913748824173401] was charged twice.
and the [card:6451162209773026] in an
Paid with [card:4881 2977 4717 0635] on Monday, not with [card:5500-0055-5555-5559].
of [card:9578939700196746] and
CARD!! [card:2207504949952929]!! OF!! THE!!
card [card:6054803462610582]$$$ was### used
[card:4863792511108453]
An amex [card:371449635398431] and a visa [card:4532756279624064].
use [card:4720 8634 5690 4856] again
Two of them: [card:4752596451892979] [card:3376685498596475] here
From [ip:10.0.0.7] to [ip:192.168.14.220] the route was down.
host [ip:85.10.244.176]!! is!! gone!!
login by [ip:173.177.21.12] failed at 12:30
und [ip:8.234.216.226]### auch
Mail [email:x.34@mail7.example.com] und [email:info@shop.example] bitte
de [email:marine.47@post4.example.net] et [email:le.93@mail0.example.com]### la
[email:a_b+c@host.example.net] wrote, [email:root@localhost] did not
Le 14 juillet 1789 et le 3 mai.
On 2024-01-31 at 12:30:45 the job ended after 3,200.50 seconds.
Version 2.0.1 came after 1.9, then 2.10.3 came.
See the License, Version 2.0. It is under CC BY-NC 4.0.
GNU General Public License, version 3.
Page 12 of 340, room 101, chapter 7.
It cost $1,200.50 or 999 euro in 2019.
The key token = "1AB79B18CCA2299B5EA48BBD566C273899B5B9B4" is secret
token = "9a5c6b16bfc488de18f949e2710484e7df563502" and
sha f7eee279b887351d596c4b8a482c521b0650ce50 of a file
ISBN 978-3-16-148410-0 and order 12345678 of 2020-11-05.
pi is 3.14159265358979 and e is 2.71828
10 000 000 people, 1 000 cars, 25 % more
He ran 100 m in 9.58 s, 200 m in 19.19 s.
serial 00112233445566778899001122334455 and 12345678901234567890123
build 20240131123045 on node 17, run 20240131
a + b = c, 1 + 1 = 2 and x+1 or 3-2
users @ home and @handle or @someone2
phone book 2021-2022, pages 555-560
ratio 16:9, score 3-2, 21-19 and 7-6
section 4.2.1, figure 3.7, table 12.
from 1914-1918 and 1939-1945 they
to. [card:4925202016420679] Ed it was
Anwh [card:0893405083415692] rely. Then
une, [card:3662792226857106] in the
| word | [card:4082871763912508] | other |
it.
Sta [card:5564289096737590] than [card:1990610168188756] The
orly. [card:1939020248335156] Nd. It
host.example.com [card:8969884853705223] On the
17.173 and [card:2713023661291018] are
Des [phone:+6 (197) 177-6545] [ip:40.97.166.54] du
the token = "52bbf683e7fb4bece614be008b374b9f1321a9d8" the that
or token = "260544d2c1e34694eeb01c0e5dccae54e054c201" From it
la token = "f20749855490fb26f430175d0db4d8678d27a016" of, on
token = "1abe1ef4e1c775dd5b46e82136381b6f540ad5f1"### el
| token = "9fc882cec24b770fa6a4c1d3d292e08e16628c0d" | of
hash d9ca738784731ec7d7ad47ac2d1bcaea866db1e2 and 55342a3d6cff0c9007d007952f4b3eb5142e66dd too
article 5 (3) of 2016/679 and 95/46
id 4711, id 1234567890, id 99
5 6 7 8 9 10 11 12 13 14 15 16
# 42 and no. 7; 1st, 2nd, 3rd
[email:tom@lab.example.edu]; [email:kim.lee@uni.example.ac.uk], 2 more
"""

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_SIGNS = b".@-()+/:,\"_%=#"
_SHAPES = 6 + 10 + len(_SIGNS) + 2  # letters, digits, signs, another sign, edge
_EDGE = 2 * _SHAPES - 1
_REACH = 2


def _table(inside: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(inside)] = True
    return out


_IS_DIGIT = _table(_DIGITS)
_IS_UPPER = _table(_LETTERS[:26])
_IS_LETTER = _table(_LETTERS + bytes(range(128, 256)))
_IS_SPACE = _table(b" \t\n\v\f\r")
_IS_KEY = _table(_DIGITS + b"@+")
_CLASS = np.where(_IS_LETTER, 1, np.where(_IS_DIGIT, 2, np.where(_IS_SPACE, 0, 3))).astype(np.int8)
_SIGN = np.full(256, 16 + len(_SIGNS), np.int64)
_SIGN[list(_SIGNS)] = 16 + np.arange(len(_SIGNS))


def _valid(kind: str, found: bytes) -> bool:
    digits = [c - 48 for c in found if 48 <= c <= 57]
    if kind == "ip":
        parts = [p.lstrip(b"0") for p in found.split(b".")]
        return all(len(p) <= 3 and int(p or b"0") <= 255 for p in parts)
    if kind == "card":
        double = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(double) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


_NUMBER = re.compile(rb"[0-9]+")


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """The leftmost match begins with all characters before its sign that may stand there: those
    of two signs never overlap, so the run is read once, however long."""
    upto = 0
    for m in _PATTERNS["email"].finditer(run):
        begin = max(run.rfind(b"@", upto, m.start()) + 1, upto)
        if begin < m.start():
            yield begin, m.end()
            upto = m.end()


def _addresses(run: bytes) -> Iterator[tuple[int, int]]:
    """Four numbers with a dot between two. If none begins with a number, none begins inside it."""
    found = [m.span() for m in _NUMBER.finditer(run)]
    i = 0
    while i + 3 < len(found):
        four = found[i : i + 4]
        if all(b[0] == a[1] + 1 for a, b in zip(four, four[1:])):
            yield four[0][0], four[3][1]
            i += 4
        else:
            i += 1


def _found(kind: str, run: bytes) -> Iterator[tuple[int, int]]:
    """Matches in a run of a kind's characters, leftmost first."""
    if kind == "email":
        return _emails(run)
    if kind == "ip":
        return _addresses(run)
    return (m.span() for m in _PATTERNS[kind].finditer(run))


def _running(flags: np.ndarray) -> np.ndarray:
    """How many flags stand before each place, and in all."""
    out = np.zeros(flags.size + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def pattern_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, number of the kind) in bytes, for all texts; sorted."""
    first = begins(offsets, data.size)
    out = []
    for number, kind in enumerate(KINDS):
        chars, needed, times = _RUNS[kind]
        mask = _table(chars)[data]
        start = mask.copy()
        start[1:] &= ~mask[:-1] | first[1:]
        stop = mask.copy()
        stop[:-1] &= ~mask[1:] | first[1:]
        start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
        held = _running(_table(needed)[data])
        enough = held[stop] - held[start] >= times
        for a, b in zip(start[enough].tolist(), stop[enough].tolist(), strict=True):
            run = data[a:b].tobytes()
            for begin, end in _found(kind, run):
                if _valid(kind, run[begin:end]):
                    out.append((a + begin, a + end, number))
    return sorted(out)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, shape (with the space before) and sequence (-1: none) of each token."""
    if not data.size:
        return (np.zeros(0, np.int64),) * 4
    first = begins(offsets, data.size)
    kind = _CLASS[data]
    new = first.copy()
    new[0] = True
    new[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == 3)
    start = np.flatnonzero(new)
    end = np.append(start[1:], data.size)
    token = kind[start] > 0
    spaced = first[start] | np.concatenate([[True], kind[start[:-1]] == 0])
    start, end, spaced = start[token], end[token], spaced[token]
    size, lead = end - start, data[start]
    upper = _running(_IS_UPPER[data])
    capitals = upper[end] - upper[start]
    letters = np.select([lead >= 128, capitals == 0, (capitals == size) & (size > 1), _IS_UPPER[lead]], [0, np.where(size > 2, 1, 2), 3, 4], 5)
    digits = 6 + np.searchsorted([2, 3, 4, 5, 9, 12, 16, 17, 20], size, side="right")
    shape = np.where(_IS_DIGIT[lead], digits, np.where(_IS_LETTER[lead], letters, _SIGN[lead]))
    text = np.searchsorted(offsets, start, side="right")
    key = np.flatnonzero(_IS_KEY[lead])
    near = np.zeros(start.size, bool)
    for d in range(-_REACH, _REACH + 1):
        at = key + d
        ok = (at >= 0) & (at < start.size)
        at, own = at[ok], key[ok]
        near[at[text[at] == text[own]]] = True
    begin = near.copy()
    begin[1:] &= ~near[:-1] | (text[1:] != text[:-1])
    return start, end, 2 * shape + spaced, np.where(near, np.cumsum(begin) - 1, -1)


def _windows(shape: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """Shapes at -2 .. +2 of each token of a sequence (the edge beyond its ends)."""
    out = np.full((2 * _REACH + 1, shape.size), _EDGE, np.int16)
    for d in range(-_REACH, _REACH + 1):
        low, high = max(0, -d), min(shape.size, shape.size - d)
        same = sequence[low + d : high + d] == sequence[low:high]
        out[d + _REACH, low:high] = np.where(same, shape[low + d : high + d], _EDGE)
    return out


class Field:
    """Weights of the features, and of transitions between labels."""

    def __init__(self) -> None:
        n = 2 * _SHAPES
        self.single = np.zeros((2 * _REACH + 1, n, len(LABELS)))
        self.pair = np.zeros((2, n * n, len(LABELS)))
        self.step = np.zeros((len(LABELS), len(LABELS)))
        inside = np.array([label[0] == "I" for label in LABELS])
        self.barred = np.zeros_like(self.step)
        for b in np.flatnonzero(inside):
            self.barred[:, b] = -1e4
            self.barred[[b - 1, b], b] = 0

    def _pairs(self, windows: np.ndarray) -> np.ndarray:
        n = 2 * _SHAPES
        here = windows[_REACH].astype(np.int64) * n
        return np.stack([here + windows[_REACH - 1], here + windows[_REACH + 1]])

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        out = sum(self.single[i][windows[i]] for i in range(windows.shape[0]))
        return out + sum(self.pair[i][p] for i, p in enumerate(self._pairs(windows)))

    def viterbi(
        self,
        emissions: np.ndarray | Callable[[np.ndarray], np.ndarray],
        begin: np.ndarray,
        length: np.ndarray,
        cells: int = 1 << 18,
        batch: int = 4096,
    ) -> np.ndarray:
        """Best labels of sequences begin[i] .. begin[i] + length[i], O before and after.

        ``emissions``: a row per place, or what gives the rows of places. Sequences are worked on
        together while they have ``cells`` places in all; of a longer one, the rows of so many places
        are there at a time. What remains of each place is one byte per label.
        """
        given = emissions if callable(emissions) else emissions.__getitem__
        labels = np.zeros(int((begin + length).max()) if length.size else 0, np.int8)
        step = self.step + self.barred
        order = np.argsort(-length, kind="stable")
        low = 0
        while low < order.size:
            ends = np.cumsum(length[order[low : low + batch]])
            high = low + max(int(np.searchsorted(ends, cells, side="right")), 1)
            own = order[low:high]
            self._decoded(given, begin[own], length[own], step, labels, cells)
            low = high
        return labels

    def _decoded(self, given: Callable, at: np.ndarray, size: np.ndarray, step: np.ndarray, labels: np.ndarray, cells: int) -> None:
        """Put the labels of some sequences, longest first, in their places."""
        width = int(size[0])
        active = np.searchsorted(-size, -np.arange(width), side="left")  # sequences longer than t
        row = np.concatenate([[0], np.cumsum(active)])
        back = np.zeros((int(row[-1]), len(LABELS)), np.int8)
        score, low = None, 0
        for t in range(width):
            n = int(active[t])
            if t == low:
                # The places of the times to come, as many as may be there at once.
                top = max(int(np.searchsorted(row, row[t] + cells, side="right")) - 1, t + 1)
                times = np.repeat(np.arange(t, top), active[t:top])
                place = at[np.arange(int(row[top] - row[t])) - np.repeat(row[t:top] - row[t], active[t:top])] + times
                rows, first, low = given(place), int(row[t]), top
            own = rows[int(row[t]) - first : int(row[t]) - first + n]
            if score is None:
                score = own + step[0]
                continue
            through = score[:n, :, None] + step
            back[row[t] : row[t] + n] = through.argmax(axis=1)
            score[:n] = through.max(axis=1) + own
        best = (score + step[:, 0]).argmax(axis=1)
        for t in range(width - 1, -1, -1):
            n = int(active[t])
            labels[at[:n] + t] = best[:n]
            best[:n] = back[row[t] : row[t] + n][np.arange(n), best[:n]]

    def gradient(self, windows: np.ndarray, gold: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Log-likelihood of gold labels and its slope, by forward-backward."""
        emissions, step = self.emissions(windows), self.step + self.barred
        width, n, k = int(length.max()), length.size, len(LABELS)
        valid = np.arange(width) < length[:, None]
        at = np.where(valid, begin[:, None] + np.arange(width), 0)
        e = emissions[at]
        alpha = np.zeros((width, n, k))
        alpha[0] = e[:, 0] + step[0]
        for t in range(1, width):
            now = np.logaddexp.reduce(alpha[t - 1][:, :, None] + step, axis=1) + e[:, t]
            alpha[t] = np.where(valid[:, t, None], now, alpha[t - 1])
        log_z = np.logaddexp.reduce(alpha[-1] + step[:, 0], axis=1)
        beta = np.tile(step[:, 0], (n, 1))
        expected, moves = np.zeros_like(emissions), np.zeros_like(step)
        for t in range(width - 1, -1, -1):
            on = valid[:, t]
            expected[at[on, t]] = np.exp(alpha[t] + beta - log_z[:, None])[on]
            if t:
                ahead = e[:, t] + beta
                both = np.exp(alpha[t - 1][:, :, None] + step + ahead[:, None, :] - log_z[:, None, None])
                moves += both[on].sum(axis=0)
                beta = np.where(on[:, None], np.logaddexp.reduce(step + ahead[:, None, :], axis=2), beta)
        moves[0] += expected[begin].sum(axis=0)
        moves[:, 0] += expected[begin + length - 1].sum(axis=0)
        real = np.zeros_like(step)
        last = begin + length - 1
        inner = np.setdiff1d(np.arange(gold.size), begin)
        np.add.at(real, (gold[inner - 1], gold[inner]), 1)
        np.add.at(real, (0, gold[begin]), 1)
        np.add.at(real, (gold[last], 0), 1)
        slope = -expected
        slope[np.arange(gold.size), gold] += 1
        singles = np.zeros_like(self.single)
        for i in range(windows.shape[0]):
            np.add.at(singles[i], windows[i], slope)
        pairs = np.zeros_like(self.pair)
        for i, p in enumerate(self._pairs(windows)):
            np.add.at(pairs[i], p, slope)
        path = emissions[np.arange(gold.size), gold].sum() + (real * step).sum()
        return float(path - log_z.sum()), [singles, pairs, real - moves]


def _labelled(table: str) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    texts, spans = [], []
    for line in table.strip().splitlines():
        text, own = "", []
        for plain, kind, value in re.findall(r"([^\[]*)(?:\[(\w+):([^\]]*)\])?", line):
            text += plain
            if kind:
                own.append((len(text), len(text) + len(value), KINDS.index(kind)))
                text += value
        texts.append(text)
        spans.append(own)
    return texts, spans


def train_field(table: str = LABELLED, rounds: int = 120, decay: float = 0.02) -> Field:
    """A field that has learned the labelled table."""
    texts, spans = _labelled(table)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    start, end, shape, sequence = _tokens(data, offsets)
    gold = np.zeros(start.size, np.int64)
    for base, own in zip(offsets.tolist(), spans, strict=False):
        for a, b, kind in own:
            inside = np.flatnonzero((start >= base + a) & (end <= base + b))
            gold[inside] = 2 + 2 * kind
            gold[inside[0]] = 1 + 2 * kind
    used = sequence >= 0
    windows, gold, sequence = _windows(shape[used], sequence[used]), gold[used], sequence[used]
    length = np.bincount(sequence)
    begin = np.cumsum(length) - length
    field = Field()
    weights = [field.single, field.pair, field.step]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for i in range(1, rounds + 1):
        _, slopes = field.gradient(windows, gold, begin, length)
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            g = g - decay * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
    return field


def field_spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, number of the kind) in bytes of what the field marks; sorted."""
    start, end, shape, sequence = _tokens(data, offsets)
    used = np.flatnonzero(sequence >= 0)
    if not used.size:
        return []
    start, end, sequence = start[used], end[used], sequence[used]
    length = np.bincount(sequence)
    windows = _windows(shape[used], sequence)
    labels = field.viterbi(lambda at: field.emissions(windows[:, at]), np.cumsum(length) - length, length)
    first = np.flatnonzero(labels % 2 == 1)
    out = []
    for i in first.tolist():
        j = i
        while j + 1 < labels.size and labels[j + 1] == labels[i] + 1 and sequence[j + 1] == sequence[i]:
            j += 1
        out.append((int(start[i]), int(end[j]), int(labels[i] - 1) // 2))
    return out


def _plausible(kind: int, found: bytes) -> bool:
    digits = sum(48 <= c <= 57 for c in found)
    if KINDS[kind] == "email":
        return b"@" in found[1:-1]
    if KINDS[kind] == "ip":
        return _PATTERNS["ip"].fullmatch(found) is not None and _valid("ip", found)
    low, high = (13, 19) if KINDS[kind] == "card" else (7, 15)
    return low <= digits <= high and not re.search(rb"[^0-9 ()+./-]", found)


def all_spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list]:
    """Patterns' spans, and those with the field's spans that touch none of them."""
    base = pattern_spans(data, offsets)
    taken = np.zeros(data.size + 1, np.int32)
    for a, b, _ in base:
        taken[a] += 1
        taken[b] -= 1
    covered = _running(np.cumsum(taken, dtype=np.int32)[:-1] > 0)
    more = [s for s in field_spans(field, data, offsets) if covered[s[1]] == covered[s[0]] and _plausible(s[2], data[s[0] : s[1]].tobytes())]
    return base, sorted([*base, *more])


def _by_text(spans: list, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Spans of each text that has any, in code points."""
    if not spans:
        return {}
    points = _running((data & 0xC0) != 0x80)
    out: dict[int, list] = {}
    for (a, b, kind), text in zip(spans, (np.searchsorted(offsets, [s[0] for s in spans], side="right") - 1).tolist(), strict=True):
        base = points[offsets[text]]
        out.setdefault(text, []).append((int(points[a] - base), int(points[b] - base), kind))
    return out


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def find_personal_data(df: DataFrame, field: Field | None = None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone (by the patterns), base_sha256, spans, n_added."""
    sent = df.sparkSession.sparkContext.broadcast(field or train_field())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            data, offsets = text_bytes(part.column(1))
            base, every = (_by_text(s, data, offsets) for s in all_spans(sent.value, data, offsets))
            rows = range(part.num_rows)
            counts = [pa.array([sum(s[2] == k for s in base.get(i, ())) for i in rows], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(_written(base.get(i, [])).encode()).hexdigest() for i in rows]
            spans = [_written(every.get(i, [])) for i in rows]
            added = pa.array([len(every.get(i, ())) - len(base.get(i, ())) for i in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), *counts, pa.array(digest), pa.array(spans), added], names)

    names = ["key", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    schema = f"key {df.schema[key].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long"
    return df.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def mask_personal_data(df: DataFrame, field: Field | None = None, *, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by ``<KIND>``; a null text stays null."""
    sent = df.sparkSession.sparkContext.broadcast(field or train_field())
    names = df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            column = part.column(at)
            data, offsets = text_bytes(column)
            out = column.to_pylist()
            for i, spans in _by_text(all_spans(sent.value, data, offsets)[1], data, offsets).items():
                pieces, upto = [], 0
                for a, b, kind in sorted(spans):
                    if b <= upto:
                        continue  # inside the span before
                    pieces += [out[i][upto : max(a, upto)], f"<{KINDS[kind].upper()}>"]
                    upto = b
                out[i] = "".join([*pieces, out[i][upto:]])
            columns = list(part.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, df.schema)
