"""Whole rows in blocks: nothing cut, nothing too full, and as few blocks as best fit makes."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tunefeed.operators.whole_packing import pack_whole, plan_blocks


def best_fit(lengths, size):
    """Blocks by best fit, row by row."""
    rooms = []
    for n in sorted((x for x in lengths if x), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= n]
        if fitting:
            i = min(fitting, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(size - n)
    return sorted(rooms)


def filled(runs, counts, size):
    """(block, begin, length) of every row, by the plan."""
    out = []
    for length, own in runs.items():
        for nth in range(counts[length]):
            first, each, block, start = [r for r in own if r[0] <= nth][-1]
            out.append((block + (nth - first) // each, start + (nth - first) % each * length, length))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_best_fit_row_by_row(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 7, 10, 64, 100])
    lengths = [rng.choice([rng.randint(1, size), max(1, size // 2), 1, size, max(1, size // 3)]) for _ in range(rng.randrange(200))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, blocks = plan_blocks(counts, size)
    places = filled(runs, counts, size)
    by_block = defaultdict(list)
    for block, begin, length in places:
        by_block[block].append((begin, begin + length))
    assert sorted(by_block) == list(range(blocks))
    for spans in by_block.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= size
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(size - max(e for _, e in s) for s in by_block.values()) == best_fit(lengths, size)


@pytest.mark.parametrize("limit", [10**6, 20])
def test_rows_follow_the_plan(spark, limit):
    rng = random.Random(3)
    rows = [(i, i % 3, rng.choice([0, 1, 5, 5, 5, 17, 30, 64, None])) for i in range(900)] + [(900, None, 9)]
    df = spark.createDataFrame(rows, "p long, rank long, n_tok int").withColumn("text", F.lit("t")).repartition(4)
    got = pack_whole(df, 64, max_class_rows=limit)
    assert got.columns == ["p", "rank", "n_tok", "text", "block", "block_pos"]
    by_block = defaultdict(list)
    collected = got.collect()
    assert sorted(r.p for r in collected) == list(range(901))
    for r in collected:
        if r.n_tok:
            by_block[r.rank, r.block].append((r.block_pos, r.block_pos + r.n_tok))
    for own in (0, 1, 2, None):
        lengths = [n for _, rank, n in rows if rank == own and n]
        blocks = [s for (rank, _), s in by_block.items() if rank == own]
        assert len(blocks) == len(best_fit(lengths, 64))
        assert {b for rank, b in by_block if rank == own} == set(range(len(blocks)))
        for spans in blocks:
            spans.sort()
            assert spans[0][0] == 0 and spans[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_edges(spark):
    kinds = "p long, rank long, n_tok long"
    assert pack_whole(spark.createDataFrame([], kinds)).collect() == []
    got = pack_whole(spark.createDataFrame([(0, 0, 0), (1, 0, None)], kinds), 8).collect()
    assert [(r.block, r.block_pos, r.n_tok) for r in got] == [(0, 0, 0), (0, 0, 0)]
    with pytest.raises(ValueError, match="2 rows have more than 8"):
        pack_whole(spark.createDataFrame([(0, 0, 9), (1, 0, 10**12), (2, 0, 8)], kinds), 8)
