"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the 2 to 4 byte n-grams of a text (A-Z lower-cased, a space at both ends),
hashed into 2^16 buckets. A text is the mean of its subwords' embeddings; a linear softmax
gives the languages. Embeddings and softmax are trained together by stochastic gradient
descent in numpy, on a sample of about ``SAMPLE`` labelled rows spread evenly over the
languages (chosen by hash of the row and its place; the bound does not grow with the data).
One sampled row in four is kept from training: these set the temperature that makes scores
probabilities, and the score below which a prediction is rejected. It is calibrated from two
sides: the odds of the least sure right answer, lowered by a margin, as no rightly identified text is to
go; and the scores of one sampled text in eight with its bytes in random order, which is in no language.
Where nearly all of those score lower, the threshold lies between the two; else it is the first.

For prediction, bucket and softmax are multiplied out to one row of logits per bucket, and
every whole text is read once, in slices, without a shuffle.

Null text or no letter in the text: ``und`` with score 0, rejected. Nothing to learn from:
``und`` with score 0 too, but only texts without a letter are rejected.
A null key counts as remainder 0 and a null label as no label. Empty table: no rows. Ties
go to the first language in order. Repeated rows each come back. Only the named columns are
read; label and key are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefeed.llm.arrow_text import LOWER, slices, text_bytes

SIZES = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE = 4000
EPOCHS = 6
UNKNOWN = "und"
#: The least odds of a right answer are divided by this much.
MARGIN = 10.0
#: Share of texts in no language that are to be below the threshold, if that can be.
SCRAMBLED = 0.95
#: One sampled text in so many is scrambled.
SCRAMBLED_OF = 8


def _framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with one space between, before and after; begin and end of each with its spaces."""
    n = np.diff(offsets)
    begin = offsets[:-1] + np.arange(n.size)
    out = np.full(data.size + n.size + 1, 0x20, np.uint8)
    out[np.arange(data.size) + 1 + np.repeat(np.arange(n.size), n)] = LOWER[data]
    return out, begin, begin + n + 2


def _buckets(framed: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram at each place."""
    code = np.zeros(max(framed.size - size + 1, 0), np.uint64)
    for i in range(size):
        code |= framed[i : framed.size - size + 1 + i].astype(np.uint64) << np.uint64(8 * i)
    code = (code + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(48)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their shares."""
    framed, begin, end = _framed(data, offsets)
    each = [_buckets(framed, n) for n in SIZES]
    out = []
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        found, count = np.unique(np.concatenate([c[b : max(e - n + 1, b)] for n, c in zip(SIZES, each, strict=True)]), return_counts=True)
        out.append((found, count / max(count.sum(), 1)))
    return out


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = (LOWER[data] >= ord("a")) & (LOWER[data] <= ord("z"))
    total = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)).tolist():
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # (buckets, languages)
    temperature: float
    threshold: float

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language (-1: none) and its calibrated probability."""
        rows = offsets.size - 1
        letter = has_letter(data, offsets)
        if not self.languages:
            return np.full(rows, -1), np.zeros(rows)
        framed, begin, end = _framed(data, offsets)
        total, count = np.zeros((rows, len(self.languages))), np.zeros(rows)
        for n in SIZES:
            bucket = _buckets(framed, n)
            start = np.minimum(begin, bucket.size)
            stop = np.maximum(np.minimum(end - n + 1, bucket.size), start)
            count += stop - start
            for j in range(len(self.languages)):
                run = np.concatenate([[0.0], np.cumsum(self.logits[:, j][bucket], dtype=np.float64)])
                total[:, j] += run[stop] - run[start]
        p = _softmax(total / np.maximum(count, 1)[:, None] / self.temperature)
        best = p.argmax(axis=1)
        return np.where(letter, best, -1), np.where(letter, p[np.arange(rows), best], 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _threshold(sure: np.ndarray, junk: np.ndarray) -> float:
    """From the scores of right answers and of texts in no language."""
    if not sure.size:
        return 0.0
    least = min(float(sure.min()), 1 - 1e-9)
    odds = least / (1 - least) / MARGIN
    low = odds / (1 + odds)
    high = float(np.quantile(junk, SCRAMBLED)) if junk.size else low
    return (low + high) / 2 if high < low else low


def fit(
    examples: list[tuple[np.ndarray, np.ndarray]],
    labels: list[str],
    seed: int = 5,
    scrambled: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> LanguageModel:
    """Train on (buckets, shares) of texts; a quarter of a random order calibrates, with
    ``scrambled`` texts, of which nothing is learned."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    target = np.searchsorted(languages, labels)
    order = rng.permutation(len(labels))
    learned, kept = (order[len(order) // 4 :], order[: len(order) // 4]) if len(order) >= 8 else (order, order)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = np.zeros((DIMENSIONS, len(languages)), np.float32)
    batch = 32
    steps = EPOCHS * -(-learned.size // batch)
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(learned)
        for low in range(0, learned.size, batch):
            rows = shuffled[low : low + batch]
            rate = 8.0 * (1 - step / steps)
            step += 1
            bucket = np.concatenate([examples[i][0] for i in rows])
            share = np.concatenate([examples[i][1] for i in rows]).astype(np.float32)
            begin = np.cumsum([0, *(examples[i][0].size for i in rows[:-1])])
            mean = np.add.reduceat(embedding[bucket] * share[:, None], begin, axis=0)
            error = _softmax(mean @ softmax)
            error[np.arange(rows.size), target[rows]] -= 1
            error /= rows.size
            back = error @ softmax.T
            softmax -= rate / 4 * (mean.T @ error)
            owner = np.repeat(np.arange(rows.size), [examples[i][0].size for i in rows])
            np.subtract.at(embedding, bucket, rate * back[owner] * share[:, None])
    table = (embedding @ softmax).astype(np.float32)


    def logits(texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.stack([(table[b] * s[:, None]).sum(axis=0) for b, s in texts])

    z = logits([examples[i] for i in kept])
    grid = np.geomspace(0.02, 5, 60)
    loss = [-np.log(_softmax(z / t)[np.arange(kept.size), target[kept]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    right = p.argmax(axis=1) == target[kept]
    junk = _softmax(logits(scrambled) / temperature).max(axis=1) if scrambled else np.zeros(0)
    return LanguageModel(languages, table, temperature, _threshold(p.max(axis=1)[right], junk))


def train(df: DataFrame, *, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """A model of the labelled rows of ``df``."""
    named = [F.col(text).alias("text"), F.col(label).cast("string").alias("label")]
    # By the row's place too: of copies of a text no more are drawn than of other texts.
    place = F.xxhash64(F.lit(11), F.col(text), F.monotonically_increasing_id()).alias("lot")
    labelled = df.select(*named, place).filter("text IS NOT NULL AND label IS NOT NULL")
    counts = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not counts:
        return fit([], [])
    each = max(50, sample // len(counts))
    share = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col("label") == name, F.lit(min(1.0, each / n))).otherwise(share)
    draw = F.shiftrightunsigned("lot", 11) / float(1 << 53)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            data, offsets = text_bytes(part.column(0))
            rows = np.flatnonzero(has_letter(data, offsets)).tolist()
            found, labels = features(data, offsets), part.column(1).to_pylist()
            out = [(labels[i], *found[i]) for i in rows]
            for i in rows:
                if found[i][0].sum() % SCRAMBLED_OF == 0:
                    text = data[offsets[i] : offsets[i + 1]].copy()
                    np.random.default_rng(text.size).shuffle(text)
                    out.append((None, *features(text, np.array([0, text.size]))[0]))
            columns = [
                pa.array([o[0] for o in out], pa.string()),
                pa.array([o[1].astype(np.int32) for o in out], pa.list_(pa.int32())),
                pa.array([o[2].astype(np.float32) for o in out], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["label", "buckets", "shares"])

    # Rows without a label are scrambled.
    schema = "label string, buckets array<int>, shares array<float>"
    drawn = labelled.filter(draw < share).select("text", "label").mapInArrow(run, schema)
    # About ``sample`` rows of at most one entry per bucket each.
    rows = drawn.toArrow().combine_chunks()
    if not rows.num_rows:
        return fit([], [])
    labels = rows.column("label").to_pylist()
    lists = [rows.column(c).chunk(0) for c in ("buckets", "shares")]
    bounds = lists[0].offsets.to_numpy()
    bucket, share = (x.values.to_numpy(zero_copy_only=False) for x in lists)
    texts = [(bucket[a:b], share[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    # An order that does not depend on which task came first.
    order = sorted(range(len(texts)), key=lambda i: (texts[i][0].size, int(texts[i][0].sum(dtype=np.int64)), labels[i] or ""))
    plain, mixed = ([i for i in order if (labels[i] is None) == none] for none in (False, True))
    return fit([texts[i] for i in plain], [labels[i] for i in plain], scrambled=[texts[i] for i in mixed])


def identify(df: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """All columns of ``df`` with lang_pred, score and rejected; columns so named are replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*sent.value.languages, UNKNOWN]
        for part in slices(batches, kept.index(text)):
            data, offsets = text_bytes(part.column(kept.index(text)))
            best, score = sent.value.predict(data, offsets)
            rejected = (best < 0) | (score < sent.value.threshold)
            if not sent.value.languages:
                rejected = ~has_letter(data, offsets)
            out = [pa.array([names[i] for i in best.tolist()], pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*part.columns, *out], [*kept, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema)
    return df.select(*kept).mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(key: str, folds: int = 4, remainder: int = 2):
    """Column: the key's text falls into the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % folds == remainder


def languages(df: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """key, held_out, lang_pred, score, rejected of each row, learned from the other folds."""
    model = train(df.filter(~held_out(key)), text=text, label=label)
    asked = df.select(F.col(key).alias(key), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return identify(asked, model).drop("text")
