"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` stores the postings of all training tokens: one row per block of documents
with its terms and, for each term, the sorted positions at which it stands, packed into one
value, so that the JVM carries a block through as it is and never unpacks it. A search sends
the test windows to every block. A window whose terms all have postings in the block starts
from its rarest term: those positions, less the term's offset in the window, are the
candidates, and the offset-adjusted lists of the other terms, rarest first, are intersected
with them. What is left are exact matches; ``proximity_matches`` asks for all terms of a
window within a span, in any order, instead. Positions leave a gap between documents, so no
match runs from one into the next.

The index is cut by documents, so building and searching need no shuffle, and a common
word's postings are spread over all blocks. Test items are cut into windows in tasks: items of
one text are one class, and windows are distinct. They are sent in groups of about
``GROUP_WINDOWS`` distinct windows, with their classes; more of them mean more passes over the index,
not a larger broadcast. Classes found become items again by a join.

Null texts have no words. A null item id counts for hits, but is in no list of items. Items
with the same id are one item. Empty tables give empty results, or documents without hits.
Repeated documents are documents of their own. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefeed.llm.arrow_text import ALPHANUMERIC, LOWER, ragged_index, slices, strings, text_bytes, words
from tunefeed.session import shared_path

#: Consecutive words of an item that must occur.
WINDOW = 10
#: Distinct windows that one pass sends to the executors, about.
GROUP_WINDOWS = 1 << 17
#: Numbers of contaminated rows that may be sent to all tasks.
SENT = 1 << 20


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms, the term of each word, and each text's range of words."""
    data = LOWER[data]
    start, stop, bounds = words(data, offsets, ALPHANUMERIC)
    coded = strings(data, start, stop).dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds


def _packed(terms: pa.Array, count: np.ndarray, step: np.ndarray) -> bytes:
    """Terms, length and steps of the list of each; bytes of numbers lowest of all first."""
    size = pc.binary_length(terms).to_numpy(zero_copy_only=False)
    planes = [np.asarray(x).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in (size, count, step)]
    spelled = text_bytes(terms)[0].tobytes()
    return struct.pack("<qqq", len(spelled), len(terms), step.size) + pa.compress(b"".join([spelled, *planes]), codec="zstd", asbytes=True)


def _unpacked(data: pa.Buffer) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    chars, terms, steps = struct.unpack_from("<qqq", data)
    flat = np.frombuffer(pa.decompress(data[24:], chars + 4 * (2 * terms + steps), codec="zstd"), np.uint8)

    def numbers(begin: int, n: int) -> np.ndarray:
        return np.ascontiguousarray(flat[begin : begin + 4 * n].reshape(4, n).T).view("<i4").ravel().astype(np.int64)

    ends = np.cumsum(numbers(chars, terms))
    spelled = strings(flat[:chars], np.concatenate([[0], ends[:-1]]) if terms else ends, ends)
    return spelled, numbers(chars + 4 * terms, terms), numbers(chars + 8 * terms, steps)


def build_index(df: DataFrame, path: str | None = None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the postings of all words of ``text`` to ``path`` (default: the shared folder)."""
    path = path or shared_path(df.sparkSession, "postings")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            terms, codes, bounds = _terms(*text_bytes(part.column(1)))
            rows = np.diff(bounds)
            position = np.arange(codes.size) + np.repeat(np.arange(rows.size), rows)
            by = np.argsort(codes, kind="stable")
            count = np.bincount(codes, minlength=len(terms))
            begin = np.cumsum(count) - count
            # Positions as steps from the one before in the same list: they compress well.
            step = position[by].astype(np.int32)
            step[1:] = np.where(np.diff(codes[by]) == 0, np.diff(step), step[1:])

            def one(values: pa.Array) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_arrays(
                [
                    one(part.column(0)),
                    one(pa.array(rows.astype(np.int32))),
                    pa.array([_packed(terms, count, step)], pa.binary()),
                ],
                ["keys", "sizes", "postings"],
            )

    kind = df.schema[key].dataType.simpleString()
    schema = f"keys array<{kind}>, sizes array<int>, postings binary"
    out = df.select(key, text).mapInArrow(run, schema)
    # A block's number lives in the stored row, so every later read agrees on it.
    out.withColumn("block", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


class _Block:
    """Postings of one stored block: ``listed`` has term * width + position, sorted."""

    def __init__(self, row: pa.RecordBatch, i: int) -> None:
        self.keys = row.column("keys")[i].values
        self.sizes = row.column("sizes")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
        # Between two documents a place stays free.
        self.firsts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.terms, self.count, step = _unpacked(row.column("postings")[i].as_buffer())
        self.begin = np.cumsum(self.count) - self.count
        self.width = int(self.sizes.sum() + self.sizes.size + 1)
        run = np.cumsum(step)
        before = np.where(self.begin > 0, run[self.begin - 1], 0) if run.size else self.begin
        self.position = run - np.repeat(before, self.count)
        self.listed = self.position + np.repeat(np.arange(self.count.size) * self.width, self.count)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        asked = term * self.width + position
        at = np.minimum(np.searchsorted(self.listed, asked), self.listed.size - 1)
        return (self.listed[at] == asked) & (position >= 0) & (position < self.width)

    def known(self, test: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows with all terms in this block, their terms here, and the lists' lengths."""
        found = pc.index_in(test["terms"], value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        inside = np.arange(test["windows"].shape[1]) < test["sizes"][:, None]
        here = np.where(inside, found[test["windows"]], 0)
        windows = np.flatnonzero(((here >= 0) | ~inside).all(axis=1))
        here, inside = here[windows], inside[windows]
        return windows, here, np.where(inside, self.count[here], np.iinfo(np.int64).max)

    def anchors(self, here: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each place of each window's rarest term: the window's row, and the position."""
        rows = np.arange(here.shape[0])
        rarest = here[rows, length.argmin(axis=1)]
        n = self.count[rarest]
        return np.repeat(rows, n), self.position[ragged_index(self.begin[rarest], n)]

    def phrases(self, test: dict) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur, and the position at which each occurrence begins."""
        windows, here, length = self.known(test)
        if not windows.size:
            return windows, windows
        order = np.argsort(length, axis=1, kind="stable")
        row, at = self.anchors(here, length)
        at = at - order[row, 0]
        for j in range(1, here.shape[1]):
            offset = order[row, j]
            good = (offset >= test["sizes"][windows[row]]) | self.has(here[row, offset], at + offset)
            row, at = row[good], at[good]
        return windows[row], at

    def near(self, test: dict, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose terms all stand within size + slack words, and where a span begins."""
        windows, here, length = self.known(test)
        if not windows.size:
            return windows, windows
        row, anchor = self.anchors(here, length)
        span = test["sizes"][windows[row]] + slack
        doc = np.searchsorted(self.firsts, anchor, side="right") - 1
        low = np.repeat(anchor, span) - ragged_index(np.zeros(row.size, np.int64), span)
        row, doc, span = np.repeat(row, span), np.repeat(doc, span), np.repeat(span, span)
        good = low >= self.firsts[doc]
        row, low, span, doc = row[good], low[good], span[good], doc[good]
        for j in range(here.shape[1]):
            term = here[row, j]
            at = np.searchsorted(self.listed, term * self.width + low)
            next_ = self.listed[np.minimum(at, self.listed.size - 1)] - term * self.width
            end = np.minimum(low + span, self.firsts[doc] + self.sizes[doc])
            good = (j >= test["sizes"][windows[row]]) | ((at < self.listed.size) & (next_ >= low) & (next_ < end))
            row, low, span, doc = row[good], low[good], span[good], doc[good]
        return windows[row], low


def _classes(items: DataFrame, item: str, text: str) -> DataFrame:
    """``class`` (a number), ``text`` and ``items`` of the distinct texts, written. A null item is in no list."""
    plain = items.select(F.col(item).alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL")
    path = shared_path(items.sparkSession, "items")
    same = plain.groupBy("text").agg(F.collect_set("item").alias("items"))
    same.withColumn("class", F.monotonically_increasing_id()).write.parquet(path)
    return items.sparkSession.read.parquet(path)


def _windows(classes: DataFrame, size: int) -> tuple[str, int]:
    """Where the distinct windows are written, in parts, with the classes of each; number of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            terms, codes, bounds = _terms(*text_bytes(part.column(1)))
            spelled = terms.cast(pa.string()).to_pylist()
            for name, a, b in zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = [spelled[c] for c in codes[a:b].tolist()]
                found = {" ".join(own[i : i + size]) for i in range(max(1, len(own) - size + 1) if own else 0)}
                yield pa.RecordBatch.from_pydict({"window": pa.array(sorted(found), pa.string()), "class": pa.array([name] * len(found), pa.int64())})

    spark = classes.sparkSession
    cut, path = shared_path(spark, "windows"), shared_path(spark, "window-parts")
    each = classes.select("class", "text").mapInArrow(run, "window string, class long")
    each.groupBy("window").agg(F.collect_set("class").alias("classes")).write.parquet(cut)
    windows = spark.read.parquet(cut)
    parts = 1 + windows.count() // GROUP_WINDOWS
    windows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts))).write.partitionBy("part").parquet(path)
    return path, parts


def _groups(spark: SparkSession, classes: DataFrame, size: int) -> Iterator[dict]:
    """Test windows, in groups of bounded size, and the classes of each."""
    path, parts = _windows(classes, size)
    every = spark.read.schema("window string, classes array<long>, part int").parquet(path)
    for i in range(parts):
        table = every.filter(F.col("part") == i).select("window", "classes").toArrow().combine_chunks()
        column = table.column("window")
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        split = pc.split_pattern(column, " ")
        coded = split.values.dictionary_encode()
        sizes = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        windows = np.zeros((len(split), size), np.int64)
        windows[np.arange(size) < sizes[:, None]] = coded.indices.to_numpy(zero_copy_only=False)
        yield {"terms": coded.dictionary.cast(pa.binary()), "windows": windows, "sizes": sizes, "classes": table.column("classes").to_pylist()}


def _search(index: DataFrame, classes: DataFrame, size: int, schema: str, columns: list[str], of_block) -> DataFrame:
    """Rows that ``of_block(block, number, test)`` yields for all blocks and groups of windows."""
    context = index.sparkSession.sparkContext
    parts = []
    for test in _groups(index.sparkSession, classes, size):
        sent = context.broadcast(test)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    number = batch.column("block")[i].as_py()
                    yield from of_block(_Block(batch, i), number, sent.value)

        parts.append(index.select(*columns).mapInArrow(run, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


COLUMNS = ["block", "keys", "sizes", "postings"]


def _matches(index: DataFrame, items: DataFrame, item: str, text: str, size: int, find) -> DataFrame:
    key_kind = index.schema["keys"].dataType.elementType.simpleString()
    classes = _classes(items, item, text)

    def of_block(block: _Block, number: int, test: dict) -> Iterator[pa.RecordBatch]:
        window, at = find(block, test)
        doc = np.searchsorted(block.firsts, at, side="right") - 1
        rows = {
            (d, name, a - int(block.firsts[d]), n)
            for w, d, a, n in zip(window.tolist(), doc.tolist(), at.tolist(), test["sizes"][window].tolist(), strict=True)
            for name in test["classes"][w]
        }
        if rows:
            docs, names, begins, lengths = zip(*sorted(rows), strict=True)
            # One row per document and match, told apart by its place where keys repeat.
            yield pa.RecordBatch.from_pydict(
                {
                    "key": block.keys.take(pa.array(docs)),
                    "block": [number] * len(docs),
                    "place": list(docs),
                    "class": list(names),
                    "begin": list(begins),
                    "words": list(lengths),
                }
            )

    schema = f"key {key_kind}, block long, place long, class long, begin long, words long"
    found = _search(index, classes, size, schema, COLUMNS, of_block)
    named = found.join(classes.select("class", F.explode("items").alias("item")), "class")
    # Items of one id but several texts are one item.
    return named.select("key", "block", "place", "item", "begin", "words").distinct().drop("block", "place")


def phrase_matches(index: DataFrame, items: DataFrame, *, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """key, item, begin, words: each place where a window of an item stands word for word."""
    return _matches(index, items, item, text, size, lambda block, test: block.phrases(test))


def proximity_matches(
    index: DataFrame, items: DataFrame, *, slack: int = 5, item: str = "item_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """The same for windows whose terms all stand within words + slack words, in any order."""
    return _matches(index, items, item, text, size, lambda block, test: block.near(test, slack))


def contamination(index: DataFrame, items: DataFrame, *, key: str = "doc_id", item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256 and contaminated of each indexed document."""
    item_kind = items.schema[item].dataType.simpleString()

    def of_block(block: _Block, number: int, test: dict) -> Iterator[pa.RecordBatch]:
        window, at = block.phrases(test)
        if not window.size:
            return
        edge = np.zeros(block.width + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + test["sizes"][window], -1)
        hit = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
        begin, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(~hit[1:] & hit[:-1])
        names: dict[int, set] = {}
        for w, d in set(zip(window.tolist(), (np.searchsorted(block.firsts, at, side="right") - 1).tolist(), strict=True)):
            names.setdefault(d, set()).update(test["classes"][w])
        ranges: dict[int, list] = {d: [] for d in names}
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            d = int(np.searchsorted(block.firsts, a, side="right")) - 1
            ranges[d].append({"a": a, "b": b})
        docs = sorted(names)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * len(docs), pa.int64()),
                pa.array(docs, pa.int32()),
                pa.array([ranges[d] for d in docs], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                pa.array([sorted(names[d]) for d in docs], pa.list_(pa.int64())),
            ],
            ["block", "place", "ranges", "classes"],
        )

    if item_kind not in ("bigint", "int", "smallint", "tinyint", "string"):
        raise TypeError("item ids are integers or strings")
    classes = _classes(items, item, text)
    schema = "block long, place int, ranges array<struct<a:int,b:int>>, classes array<long>"
    path, spark = shared_path(index.sparkSession, "hits"), index.sparkSession
    # Few rows, dealt to few tasks: a file of each task that searched would be nearly empty.
    _search(index, classes, size, schema, COLUMNS, of_block).repartition("block").write.parquet(path)
    hits = spark.read.parquet(path)
    # A document has one row per group of windows at most.
    named = hits.select("block", "place", F.explode("classes").alias("class")).distinct().join(classes.select("class", "items"), "class")
    strings_ = F.col("items").cast("array<string>")
    lists = named.groupBy("block", "place").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(strings_)))).alias("items"))
    spans = hits.groupBy("block", "place").agg(F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"))
    hits = spans.join(lists, ["block", "place"], "left")
    docs = index.select("block", F.posexplode(F.arrays_zip("keys", "sizes")).alias("place", "doc"))
    joined = docs.join(hits, ["block", "place"], "left")
    n_hit = F.coalesce(_covered(F.col("ranges")), F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("doc.keys").alias(key),
        F.col("doc.sizes").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(df: DataFrame, items: DataFrame, *, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows of ``df`` in which no window of an item stands.

    Rows are numbered in a written copy, so repeated or null keys do not matter.
    """
    spark = df.sparkSession
    path = shared_path(spark, "numbered")
    df.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    found = contamination(build_index(rows, key="__row", text=text), items, key="__row", item=item, size=size)
    hit = shared_path(spark, "contaminated")
    found.filter("contaminated").select("__row").write.parquet(hit)
    gone = spark.read.parquet(hit)
    # While they are few, the texts stay where they are.
    few = gone.count() <= SENT
    return rows.join(F.broadcast(gone) if few else gone, "__row", "left_anti").select(df.columns)


def _covered(ranges: Column) -> Column:
    """Length of the union of sorted ranges."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def add(s: Column, r: Column) -> Column:
        more = F.greatest(F.lit(0), r["b"] - F.greatest(r["a"], s["upto"]))
        return F.struct((s["n"] + more).alias("n"), F.greatest(s["upto"], r["b"]).alias("upto"))

    return F.aggregate(ranges, start, add, lambda s: s["n"])
