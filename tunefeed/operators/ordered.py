"""Numbering and look-back over ordered rows, without a single-task window.

Rows are computed once and written; what is written is ranged by all keys
(``repartitionByRange``: any orderable type, every key counts), sorted and written
again. A row's place in that table, partition and row, then is a fact that every
later read agrees on; what a partition needs from those before it (how many rows
there are, or the last value) comes from a table with one row per partition, or
per group and partition.

Rows in the order of the files they come from need no sort: their place in their
split, and the rows of the splits before, are counted while they are written.
"""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.session import shared_path

ROWS_PER_BUCKET = 1_000_000
# Bounds what the driver and a broadcast hold: one number or row per bucket.
MAX_BUCKETS = 100_000
_PLACE = "__place"
_BUCKET = "__bucket"
_OFFSET = "__offset"
_FILE = "__file"
_BLOCK = "__block"
_SPLIT = "__split"
# Splits that are sent to all tasks: 16 bytes each.
MAX_SPLITS = 1_000_000
_LOT = "__lot"
# Rows that key_bound draws, and keys between which it counts, in one round.
_SAMPLE = 1024
_PIVOTS = 64


def number_rows(
    df: DataFrame,
    keys: list[str],
    out: str = "p",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    keep_below: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add the dense 0-based position of each row in key order (NULLs last).

    Keys are of any orderable type. Rows with equal keys get positions of their
    own, in an order that is fixed once the call returns. The input is computed
    once and written to the shared folder, and shuffled and written from there;
    ``stored`` says that it is a table as it was written, which needs no copy.

    With ``keep_below`` only positions under it are kept: ``key_bound`` looks for the
    end of their keys, and rows beyond it are neither shuffled nor written; a bound on
    the leading key goes to the scan.
    """
    if keep_below is not None:
        df = _bounded(df, keys, keep_below, rows_per_bucket)
    ranged = _ranged(df if stored else _stored(df), keys, rows_per_bucket)
    sizes = ranged.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).orderBy(_BUCKET).collect()
    starts = list(itertools.accumulate((r["n"] for r in sizes), initial=0))[:-1]
    # At most MAX_BUCKETS rows of two numbers.
    offsets = df.sparkSession.createDataFrame(
        pa.table(
            {
                _BUCKET: pa.array([r[_BUCKET] for r in sizes], pa.int64()),
                _OFFSET: pa.array(starts, pa.int64()),
            }
        )
    )
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.join(F.broadcast(offsets), _BUCKET).withColumn(out, F.col(_OFFSET) + row)
    if keep_below is not None:
        numbered = numbered.filter(F.col(out) < keep_below)
    return numbered.drop(_BUCKET, _OFFSET, _PLACE)


def number_file_rows(df: DataFrame, out: str = "p", keep_below: int | None = None) -> DataFrame:
    """Add the dense 0-based position of each row in file order: by the files' paths, and in
    a file by line (or row).

    ``df`` comes straight from a file reader (JSON lines, text, CSV, Parquet, ...); filters and
    other columns may stand between, no shuffle. Lines that give no row, such as blank ones, do
    not count. The rows are computed and written once, each with its split, file and offset;
    rows per split are then added up in the order of the splits, of which the driver holds one
    row each, and tasks two numbers each while they are ``MAX_SPLITS`` at most. With ``keep_below`` files beyond that position are not read again after a count.
    """
    split = [F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK)]
    if keep_below is not None:
        counts = df.select(*split).groupBy(_FILE).agg(F.count(F.lit(1)).alias("n")).orderBy(_FILE)
        last, before = None, 0
        for r in counts.collect():  # one row per file
            last, before = r[_FILE], before + r["n"]
            if before >= keep_below:
                break
        if last is not None:
            df = df.filter(F.col("_metadata.file_path") <= last)
    rows = _stored(df.select("*", *split, F.monotonically_increasing_id().alias(_PLACE)))
    splits = rows.groupBy(_FILE, _BLOCK).agg(F.min(_PLACE).alias("first"), F.count(F.lit(1)).alias("n"))
    ordered = splits.withColumn(_SPLIT, F.xxhash64(_FILE, _BLOCK)).orderBy(_FILE, _BLOCK).collect()
    starts = list(itertools.accumulate((r["n"] for r in ordered), initial=0))[:-1]
    # A split is known by a hash, so that its row is two numbers; if two had one, by its name.
    hashes = [r[_SPLIT] for r in ordered]
    named = len(set(hashes)) < len(hashes)
    columns = {_SPLIT: pa.array(hashes, pa.int64())}
    if named:
        columns = {_FILE: pa.array([r[_FILE] for r in ordered]), _BLOCK: pa.array([r[_BLOCK] for r in ordered], pa.int64())}
    shift = pa.array([s - r["first"] for s, r in zip(starts, ordered)], pa.int64())
    offsets = df.sparkSession.createDataFrame(pa.table({**columns, _OFFSET: shift}))
    if len(ordered) <= MAX_SPLITS:
        offsets = F.broadcast(offsets)
    keyed = rows if named else rows.withColumn(_SPLIT, F.xxhash64(_FILE, _BLOCK))
    numbered = keyed.join(offsets, list(columns)).withColumn(out, F.col(_OFFSET) + F.col(_PLACE))
    if keep_below is not None:
        numbered = numbered.filter(F.col(out) < keep_below)
    return numbered.drop(_FILE, _BLOCK, _SPLIT, _PLACE, _OFFSET)


def _stored(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bounded(df: DataFrame, keys: list[str], keep_below: int, rows_per_bucket: int) -> DataFrame:
    """The rows up to ``key_bound``."""
    bound = key_bound(df, keys, keep_below, max(keep_below // 8, rows_per_bucket // 10))
    if bound is None:
        return df
    ends = [_literal(df.schema[k].dataType, v) for k, v in zip(keys, bound)]
    below = df.filter(_key(keys) <= _key_of(ends))
    if bound[0] is not None:
        below = below.filter(F.col(keys[0]) <= ends[0])
    return below


def key_bound(df: DataFrame, keys: list[str], wanted: int, slack: int) -> list[str | None] | None:
    """Keys, as text, that at least ``wanted`` rows are not above; None when that needs all rows.

    Selection without a sort: pivots from a sample of the rows still in question, a count of
    the rows between them, and again within the two pivots that ``wanted`` lies between, until no
    more than ``slack`` rows too many are below, or rows of one key are all that is left. Only the
    key columns are read, nothing is shuffled but counts, and nothing is written.
    """
    kinds = [df.schema[k].dataType for k in keys]
    if any(isinstance(k, (T.StructType, T.ArrayType, T.VariantType)) for k in kinds):
        return None
    rows = df.select(*keys)
    inside = rows.count()
    if inside <= wanted + slack:
        return None
    low: list[Column] | None = None
    high: list[str | None] | None = None
    within, under = rows, 0  # under: rows at or below ``low``
    while under + inside > wanted + slack:
        # By row, not by key: common keys come up as often as they are common.
        lot = F.xxhash64(F.monotonically_increasing_id(), F.lit(inside))
        texts = [_plain(rows, k).alias(f"k{i}") for i, k in enumerate(keys)]
        drawn = within.withColumn(_LOT, lot).orderBy(_LOT).limit(_SAMPLE).orderBy(*_ascending(keys))
        sample = [tuple(r) for r in drawn.select(*texts).collect()]
        pivots = _pivots(sample, (wanted - under) / inside)
        bounds = [[_literal(kind, v) for kind, v in zip(kinds, p)] for p in pivots]
        place = _place_among(_key(keys), [_key_of(b) for b in bounds])
        counted = dict(within.groupBy(place.alias("i")).count().collect())
        i, before = 0, under
        while before + counted.get(i, 0) < wanted and i < len(pivots):
            before, i = before + counted.get(i, 0), i + 1
        if counted.get(i, 0) == inside and (i == len(pivots) or list(pivots[i]) == high):
            break  # one key, or the sample could not tell the rows apart
        under, inside = before, counted.get(i, 0)
        low = bounds[i - 1] if i else low
        high = list(pivots[i]) if i < len(pivots) else high
        within = rows
        if low is not None:
            within = within.filter(_key(keys) > _key_of(low))
        if high is not None:
            within = within.filter(_key(keys) <= _key_of([_literal(kind, v) for kind, v in zip(kinds, high)]))
    return high


def _pivots(sample: list[tuple], share: float) -> list[tuple]:
    """Distinct keys out of a sorted sample: some all over it, and those around ``share`` of it."""
    half = _PIVOTS // 2
    middle = int(share * len(sample))
    chosen = {*range(0, len(sample), max(len(sample) // half, 1)), *range(middle - half // 2, middle + half // 2)}
    picked = [sample[i] for i in sorted(chosen) if 0 <= i < len(sample)]
    return [p for i, p in enumerate(picked) if not i or p != picked[i - 1]]


def _place_among(key: Column, bounds: list[Column], first: int = 0) -> Column:
    """How many bounds a key is above, by halving."""
    if not bounds:
        return F.lit(first)
    half = len(bounds) // 2
    above = _place_among(key, bounds[half + 1 :], first + half + 1)
    return F.when(key > bounds[half], above).otherwise(_place_among(key, bounds[:half], first))


def _key(keys: list[str]) -> Column:
    """A struct that compares as ``_ascending`` sorts."""
    return _key_of([F.col(k) for k in keys])


def _key_of(values: list[Column]) -> Column:
    return F.struct(*[c for v in values for c in (F.isnull(v), v)])


def _plain(df: DataFrame, key: str) -> Column:
    """A key as text from which ``_literal`` makes the same value again."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key).cast("string")
    return F.hex(key) if isinstance(kind, T.BinaryType) else F.col(key).cast("string")


def _literal(kind: T.DataType, text: str | None) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(text).cast("bigint"))
    return F.unhex(F.lit(text)) if isinstance(kind, T.BinaryType) else F.lit(text).cast(kind)


def number_within(
    df: DataFrame,
    group: list[str],
    order: list[str],
    out: str,
    max_group_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the 1-based position of each row in its group, in ``order``."""
    split = _split_groups(df, group, order, max_group_rows)
    if split is None:
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(*_ascending(order)))
        return df.withColumn(out, nth.cast("bigint"))
    window = Window.partitionBy(*group, _BUCKET).orderBy(_PLACE)
    before = Window.partitionBy(*group).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy(*group, _BUCKET)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*group, _BUCKET, F.sum("n").over(before).alias(_OFFSET))
    )
    numbered = split.withColumn(out, F.row_number().over(window))
    return (
        _join_cells(numbered, offsets, group)
        .withColumn(out, F.coalesce(_OFFSET, F.lit(0)) + F.col(out))
        .drop(_BUCKET, _OFFSET, _PLACE)
    )


def previous_within(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    out: str,
    max_group_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``value`` of the preceding row of the same group, NULL on the first."""
    split = _split_groups(df, group, order, max_group_rows)
    if split is None:
        return df.withColumn(
            out, F.lag(value).over(Window.partitionBy(*group).orderBy(*_ascending(order)))
        )
    window = Window.partitionBy(*group, _BUCKET).orderBy(_PLACE)
    tails = (
        split.groupBy(*group, _BUCKET)
        .agg(F.max_by(value, _PLACE).alias("tail"))
        .select(
            *group,
            _BUCKET,
            F.lag("tail").over(Window.partitionBy(*group).orderBy(_BUCKET)).alias(_OFFSET),
        )
    )
    looked = split.withColumn(out, F.lag(value).over(window)).withColumn(
        "__first", F.row_number().over(window) == 1
    )
    return (
        _join_cells(looked, tails, group)
        .withColumn(out, F.when(F.col("__first"), F.col(_OFFSET)).otherwise(F.col(out)))
        .drop(_BUCKET, _OFFSET, _PLACE, "__first")
    )


def _split_groups(
    df: DataFrame, group: list[str], order: list[str], max_group_rows: int
) -> DataFrame | None:
    """None when no group is larger than ``max_group_rows``: a plain window will
    do. Else the rows ranged by group and order, so that no range is much larger
    than the limit. Rows without a group key are a group like others.
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    biggest = counts.agg(F.max("n")).first()[0]
    if biggest is None or biggest <= max_group_rows:
        return None
    return _ranged(_stored(df), [*group, *order], max_group_rows)


def _join_cells(df: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """Bring one value per (group, bucket) to rows that already lie that way."""
    names = {c: f"__cell_{i}" for i, c in enumerate([*group, _BUCKET])}
    cells = cells.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(cells, same, "left").drop(*names.values())


def _ranged(df: DataFrame, keys: list[str], rows_per_bucket: int) -> DataFrame:
    """A written table's rows as another, with ``__bucket``, which never falls as the
    keys rise, and ``__place``, which rises with them.

    The borders come from a sample that Spark takes; they shift bucket sizes only.
    Rows with equal keys are told apart by where they were read, so they spread too.
    """
    shuffle_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_BUCKETS, max(shuffle_tasks, math.ceil(df.count() / rows_per_bucket)))
    ascending = [*_ascending(keys), F.col(_PLACE)]
    path = shared_path(df.sparkSession, "ordered")
    (
        df.withColumn(_PLACE, F.monotonically_increasing_id())
        .repartitionByRange(n, *ascending)
        .sortWithinPartitions(*ascending)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    stored = df.sparkSession.read.parquet(path)
    return stored.withColumn(_BUCKET, F.shiftright(_PLACE, 33))


def _ascending(keys: list[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]
