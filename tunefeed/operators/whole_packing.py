"""Packing without cuts: whole rows into blocks, best fit, longest first.

Best fit looks at lengths only, and there are at most ``max_length`` of them. So the plan is made on
the number of rows of each rank and length: rows of one length go, as many at once as fit, into all
blocks that have the same room left. The plan says for each length which run of its rows, counted
in the order of their positions, goes into which run of blocks. Rows get their number within their
rank and length, and look up the rest; no task holds a rank or a length as a whole.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefeed.operators.ordered import ROWS_PER_BUCKET, number_within

#: A run of rows of one length: number of its first row, rows a block takes, first block, where in it.
Run = tuple[int, int, int, int]


def plan_blocks(counts: dict[int, int], max_length: int) -> tuple[dict[int, list[Run]], int]:
    """Runs of each length, and the number of blocks, for ``counts`` rows of each length."""
    runs: dict[int, list[Run]] = defaultdict(list)
    # Blocks by the room left: (first block, how many) of those with equal room.
    open_blocks: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    blocks = 0
    for length in sorted((x for x in counts if x > 0), reverse=True):
        left, done = counts[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = open_blocks[room].pop()
                if not open_blocks[room]:
                    rooms.pop(i)
            else:
                room, first, n = max_length, blocks, -(-left // (max_length // length))
                blocks += n
            each = room // length
            # Best fit goes on with a block while it has room, as no other has less.
            full, rest = min(n, left // each), left % each if left // each < n else 0
            used = full + bool(rest)
            runs[length].append((done, each, first, max_length - room))
            moved = [(first, full, room - each * length), (first + full, bool(rest), room - rest * length), (first + used, n - used, room)]
            for begin, number, after in moved:
                if number and after:
                    if after not in open_blocks or not open_blocks[after]:
                        insort(rooms, after)
                    open_blocks[after].append((begin, number))
            done += full * each + rest
            left -= full * each + rest
    if counts.get(0):
        blocks = max(blocks, 1)
        runs[0].append((0, 1, 0, 0))
    return dict(runs), blocks


def pack_whole(
    df: DataFrame,
    max_length: int = 2048,
    position: str = "p",
    tokens: str = "n_tok",
    rank: str = "rank",
    max_class_rows: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``block`` and ``block_pos`` (where the row starts in it): blocks of each rank hold at most
    ``max_length`` tokens, and no row is cut.

    A row of more than ``max_length`` tokens is an error: cap first. A NULL count is 0; rows of 0
    tokens are dealt over the blocks. Early blocks hold the longest rows; ``epoch_order`` on block
    numbers mixes them. The driver holds one number per rank and length.
    """
    spark = df.sparkSession
    known = df.withColumn(tokens, F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint")))
    counts: dict[object, dict[int, int]] = defaultdict(dict)
    # Longer ones, of any length, are one class here.
    length = F.least(tokens, F.lit(max_length + 1)).alias("length")
    for r in known.groupBy(F.col(rank).alias("rank"), length).count().collect():
        counts[r["rank"]][r["length"]] = r["count"]
    too_long = sum(c.get(max_length + 1, 0) for c in counts.values())
    if too_long:
        raise ValueError(f"{too_long} rows have more than {max_length} tokens")
    rows = []
    for own, by_length in counts.items():
        runs, blocks = plan_blocks(by_length, max_length)
        rows += [(own, n, *map(list, zip(*r)), blocks) for n, r in runs.items()]
    names = ["firsts", "each", "blocks", "starts"]
    columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
    kind = pa.list_(pa.int64())
    plan = spark.createDataFrame(
        pa.table(
            {
                "__rank": pa.array(columns[0], pa.int64()),
                "__length": pa.array(columns[1], pa.int64()),
                **{f"__{n}": pa.array(c, kind) for n, c in zip(names, columns[2:6])},
                "__n_blocks": pa.array(columns[6], pa.int64()),
            }
        )
    )
    numbered = number_within(known, [rank, tokens], [position], "__nth", max_class_rows)
    same = F.col(rank).cast("bigint").eqNullSafe(F.col("__rank")) & (F.col(tokens) == F.col("__length"))
    joined = numbered.withColumn("__nth", F.col("__nth") - 1).join(plan, same)
    # The last run that begins at or before the row.
    run = F.size(F.filter("__firsts", lambda f: f <= F.col("__nth"))) - 1
    joined = joined.withColumn("__run", run)
    within = F.col("__nth") - F.get("__firsts", "__run")
    each = F.get("__each", "__run")
    block = F.get("__blocks", "__run") + F.call_function("div", within, each)
    block_pos = F.get("__starts", "__run") + F.pmod(within, each) * F.col(tokens)
    empty = F.col(tokens) == 0
    return joined.withColumns(
        {
            "block": F.when(empty, F.pmod("__nth", F.col("__n_blocks"))).otherwise(block).cast("bigint"),
            "block_pos": F.when(empty, F.lit(0)).otherwise(block_pos).cast("bigint"),
        }
    ).select(*df.columns, "block", "block_pos")
