import numpy as np
import pytest

from tunefeed.llm import kmeans_tree
from tunefeed.llm.kmeans_tree import build_tree, nearest
from tunefeed.llm.queries import op8_nearest_neighbours


def brute(rows, every=20, top=20):
    out = {}
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    for i, v in zip(ids, vectors, strict=True):
        if i % every == 0:
            score = (vectors * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:top]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def lists(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        assert r.rank == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in own}) for q, own in want.items())
    return hit / sum(len(own) for own in want.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3).round(1)]) for i in range(60)] + [(i, [1.0, 0.0, 2.0]) for i in range(60, 130)]
    odd = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [nan, 1.0, 1.0]), (280, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (300, [1.0, 2.0]), (320, [])]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows + odd + rows[:2]], "vec_id long, embedding array<double>, leaf string, rank int")
    assert lists(nearest(df).collect()) == brute(rows)
    few = df.filter("vec_id < 5")
    assert lists(nearest(few).collect()) == brute(rows[:5])
    assert nearest(df.limit(0)).collect() == []
    assert nearest(df.filter("vec_id >= 200")).count() == 0


def test_hot_leaves_are_split_without_change(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(kmeans_tree, "CELL", 7)
    assert lists(nearest(df, every=5, recall=1.0).collect()).keys() == brute(rows, every=5).keys()
    assert recall(lists(nearest(df, every=5, recall=1.0).collect()), brute(rows, every=5)) > 0.9


def test_walk_takes_each_leaf_once_nearest_first():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(2000, 8))
    tree = build_tree(points, np.linalg.norm(points, axis=1).max(), 60)
    walk = tree.visits(points[0], tree.leaves)
    assert sorted(walk) == list(range(tree.leaves)) and tree.leaves > 30
    first = [tree.visits(p, 1)[0] for p in points[:200]]
    assert np.mean(np.array(first) == tree.leaf_of(points[:200])) > 0.3


def test_outliers_get_full_lists_too(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(20 * i + 1, (10 * np.eye(6)[i % 6] + rng.normal(size=6) / 50).tolist()) for i in range(900)]
    rows += [(20 * i, (rng.normal(size=6) * 30).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 4)
    got = lists(nearest(df, recall=0.3).collect())
    assert got.keys() == brute(rows).keys() and all(len(own) == 20 for own in got.values())


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_recall_on_the_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got, want = lists(op8_nearest_neighbours(spark, path).collect()), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.93
    exact = {q: dict(own) for q, own in want.items()}
    assert all(s == pytest.approx(exact[q][i], rel=1e-12) for q, own in got.items() for i, s in own if i in exact[q])
