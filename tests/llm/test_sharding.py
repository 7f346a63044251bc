from collections import Counter

import numpy as np

from tunefeed.llm.queries import op1_sharding
from tunefeed.llm.sharding import communication_matrix, shard_rows


def check(rows, total, shards):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == total
    assert [sizes[i] for i in range(shards)] == [total // shards + (i < total % shards) for i in range(shards)]
    for i in range(shards):
        assert sorted(r.slot for r in rows if r.shard == i) == list(range(sizes[i]))


def test_matrix_has_exact_sums_and_the_right_law():
    rows = [5, 0, 17, 1, 30]
    matrix = np.array([communication_matrix(rows, 4, seed) for seed in range(4000)])
    assert (matrix.sum(axis=2) == rows).all()
    assert (matrix.sum(axis=1) == [14, 13, 13, 13]).all()
    # Moments of the hypergeometric law, N=53, K=14, n=17.
    got = matrix[:, 2, 0]
    assert abs(got.mean() - 17 * 14 / 53) < 0.1
    assert abs(got.var() - 17 * (14 / 53) * (39 / 53) * (36 / 52)) < 0.2
    big = np.array(communication_matrix([10**10] * 6, 8, 1))
    assert (big.sum(axis=1) == 10**10).all() and (abs(big / 1.25e9 - 1) < 1e-3).all()


def test_edges(spark):
    rows = [(i % 3 or None, None if i % 2 else "x", i, "s") for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place int, shard string").repartition(7)
    out = shard_rows(df, 8)
    assert out.columns == ["doc_id", "text", "place", "shard", "slot"]
    got = out.collect()
    check(got, 101, 8)
    assert sorted(r.place for r in got) == list(range(101))
    check(shard_rows(df.limit(3), 8).collect(), 3, 8)
    assert shard_rows(df.limit(0), 8).collect() == []


def test_shuffle_is_uniform(spark, monkeypatch):
    monkeypatch.setattr("tunefeed.llm.sharding.RANGE_ROWS", 500)
    df = spark.range(20_000).repartitionByRange(9, "id")
    got = shard_rows(df, 4, seed=3).collect()
    check(got, 20_000, 4)
    ids = np.array([r.id for r in sorted(got, key=lambda r: (r.shard, r.slot))])
    # Any quarter of the new order holds about a quarter of any old quarter.
    table = np.histogram2d(np.arange(20_000), ids, bins=8)[0]
    assert ((table - 312.5) ** 2 / 312.5).sum() < 110  # chi square, 49 degrees of freedom
    assert abs(np.corrcoef(np.arange(20_000), ids)[0, 1]) < 0.03
    assert [r.id for r in sorted(shard_rows(df, 4, seed=4).collect(), key=lambda r: (r.shard, r.slot))] != ids.tolist()


def test_query_over_whole_table(spark):
    import zlib

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = op1_sharding(spark, "/root/testdata/sf0.01").collect()
    check(rows, len(docs), 8)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
