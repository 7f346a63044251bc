"""Nearest neighbours by inner product on a hierarchical k-means tree.

* The tree is built on the driver from about ``SAMPLE`` vectors chosen by hash. Vectors get
  one more coordinate that makes all norms equal, so that nearest by distance is largest by
  inner product. Every vector of the table is then put into a leaf, by descent.
* A query walks the tree best bin first: a priority queue holds the branches seen so far by
  their centre's distance, and leaves are taken in the order in which they come off it.
* How many leaves: ``CALIBRATION`` vectors get their exact neighbours from all rows; the
  number of leaves is widened until the target share of those lies in the leaves visited.
  A query whose leaves hold too few rows takes further ones; empty leaves are passed over.
* Queries and vectors meet per branch of the root, in cells of bounded size: a branch's
  vectors, and its queries, are dealt over several cells. In a cell a query meets the
  vectors of its own leaves, one leaf after the other, and the cell hands on the query's
  best of them all.

Equal vectors are one entry with its smallest ids, as no list needs more of them, and equal
queries are searched for once, so a vector that a third of the rows share costs no more.

Vectors that are null, zero, of another length than most, or with null or non-finite parts
take no part, nor do rows with a null id or other rows with the query's id. With fewer
candidates, all come back. Ties: smaller id first. An empty table gives none; only the named
columns are read. Scores are float64 sums over the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunefeed.session import shared_path

SAMPLE = 20_000
CALIBRATION = 200
BRANCHES = 16
#: Vectors in a leaf, about, while the sample can tell leaves apart.
LEAF_ROWS = 256
#: Sampled vectors that a leaf has at least.
LEAF_SAMPLE = 8
#: Vectors, and queries, that meet in one cell, about.
CELL = 4096
RECALL = 0.98


@dataclass
class Tree:
    norm: float  # largest norm
    centres: list[np.ndarray] = field(default_factory=list)  # of a node's children
    children: list[list[int]] = field(default_factory=list)  # nodes (>= 0) or leaves (-1 - leaf)
    leaves: int = 0
    branch: list[int] = field(default_factory=list)  # of the root that a leaf is under

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(vectors.shape[0], np.int64)
        if not self.centres:
            return out
        todo = [(0, np.arange(vectors.shape[0]))]
        lifted = self.lifted(vectors)
        while todo:
            node, rows = todo.pop()
            nearest = _distances(lifted[rows], self.centres[node]).argmin(axis=1)
            for i, child in enumerate(self.children[node]):
                own = rows[nearest == i]
                if child < 0:
                    out[own] = -1 - child
                elif own.size:
                    todo.append((child, own))
        return out

    def visits(self, query: np.ndarray, most: int, rows: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first, and more until they hold ``least`` of
        ``rows`` (number in each leaf); then leaves without rows do not count."""
        if not self.centres:
            return [0]
        point = np.append(query * (self.norm / np.linalg.norm(query)), 0.0)
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < least):
            _, node = heapq.heappop(queue)
            if node < 0:
                if rows is None or rows[-1 - node]:
                    out.append(-1 - node)
                    held += 0 if rows is None else int(rows[-1 - node])
                continue
            for d, child in zip(_distances(point[None], self.centres[node])[0].tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (d, child))
        return out


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(axis=1) - 2 * points @ centres.T


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = points[rng.choice(points.shape[0], k, replace=False)]
    for _ in range(rounds):
        owner = _distances(points, centres).argmin(axis=1)
        for i in range(k):
            own = points[owner == i]
            if own.size:
                centres[i] = own.mean(axis=0)
    return np.unique(centres, axis=0)


def build_tree(sample: np.ndarray, norm: float, leaves: int, seed: int = 3) -> Tree:
    """A tree of about ``leaves`` leaves over the sample."""
    tree, rng = Tree(norm), np.random.default_rng(seed)
    size = max(LEAF_SAMPLE, -(-sample.shape[0] // max(leaves, 1)))
    lifted = tree.lifted(sample)

    def grow(points: np.ndarray, branch: int) -> int:
        k = min(BRANCHES, points.shape[0] // size)
        centres = _kmeans(points, k, rng) if k > 1 else points[:0]
        if centres.shape[0] < 2:
            tree.leaves += 1
            tree.branch.append(max(branch, 0))
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        owner = _distances(points, centres).argmin(axis=1)
        tree.children[node] = [grow(points[owner == i], i if branch < 0 else branch) for i in range(centres.shape[0])]
        return node

    if grow(lifted, -1) < 0:
        tree.centres, tree.children = [], []
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vec (array of doubles) of the rows that take part, repeats once."""
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = df.select(F.col(key).alias("id"), vec.alias("vec"), finite.alias("finite")).filter("id IS NOT NULL AND finite")
    rows = rows.filter(F.exists("vec", lambda x: x != 0)).select("id", "vec")
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0].n if sizes else 0)).distinct()


def _entries(rows: DataFrame, top: int) -> DataFrame:
    """One row per distinct vector: entry (its smallest id), vec, and its first ids."""
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("n", first).filter(F.col("n") <= top + 1)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "vec", "ids")


def _exact(entries: DataFrame, queries: np.ndarray, own: np.ndarray, top: int) -> list[list[int]]:
    """Leaves (column leaf) of each query's exact nearest entries but its own, with repeats by rank."""
    sent = entries.sparkSession.sparkContext.broadcast((queries, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, leaf = (batch.column(i).to_numpy() for i in (0, 1))
            score = sent.value[0] @ _matrix(batch.column(2)).T
            score[sent.value[1][:, None] == entry] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :top]
            rows, at = np.repeat(np.arange(score.shape[0]), best.shape[1]), best.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(entry[at]), pa.array(leaf[at]), pa.array(score[rows, at])], ["query", "entry", "leaf", "score"]
            )

    found = entries.select("entry", "leaf", "vec").mapInArrow(run, "query long, entry long, leaf long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    out: list[list[int]] = [[] for _ in range(queries.shape[0])]
    for r in found.filter(F.col("score") > float("-inf")).withColumn("rank", rank).filter(F.col("rank") <= top).collect():
        out[r.query].append(r.leaf)
    return out


def calibrated_visits(tree: Tree, queries: np.ndarray, leaves: list[list[int]], recall: float, rows: np.ndarray | None = None) -> int:
    """Fewest leaves, doubled and then halved into, that hold the share ``recall``."""
    order = [{leaf: i for i, leaf in enumerate(tree.visits(q, max(tree.leaves, 1), rows))} for q in queries]
    place = np.array([order[i][leaf] for i, own in enumerate(leaves) for leaf in own])
    if not place.size:
        return 1
    visits = 1
    while (place < visits).mean() < recall:
        visits *= 2
    low, high = visits // 2, visits
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if (place < middle).mean() >= recall else (middle, high)
    return min(high, max(tree.leaves, 1))


def nearest(
    df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = 20, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each row whose key is
    divisible by ``every``."""
    spark = df.sparkSession
    path = shared_path(spark, "vectors")
    _vectors(df, key, vector).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    _entries(rows, top).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")

    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    count, longest = entries.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(1.0))).first()
    chosen = entries.filter(_draw() < SAMPLE / max(count, 1)).select("entry", "vec").toArrow()
    sample = _matrix(chosen.column("vec").combine_chunks()) if chosen.num_rows else np.zeros((0, 1))
    tree = build_tree(sample, longest, max(1, count // LEAF_ROWS))
    sent = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = sent.value.leaf_of(_matrix(batch.column(1)))
                branch = np.array(sent.value.branch or [0])[leaf]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(branch)], ["entry", "vec", "ids", "leaf", "branch"])

    entries.mapInArrow(place, "entry long, vec array<double>, ids array<long>, leaf long, branch long").write.parquet(f"{path}/leaves")
    indexed = spark.read.parquet(f"{path}/leaves")

    asked = rows.filter(F.col("id") % every == 0).join(entries.select("vec", "entry"), "vec").select(F.col("id").alias("query_id"), F.col("entry").alias("query"))
    asked.write.parquet(f"{path}/asked")
    asked = spark.read.parquet(f"{path}/asked")
    trial = entries.filter(_draw(29) < CALIBRATION / max(count, 1)).select("entry", "vec").toArrow()
    trial = trial if trial.num_rows else chosen[:CALIBRATION]
    points = _matrix(trial.column("vec").combine_chunks()) if trial.num_rows else sample
    # One number per leaf.
    held = np.zeros(max(tree.leaves, 1), np.int64)
    for r in indexed.groupBy("leaf").count().collect():
        held[r.leaf] = r["count"]
    visits = calibrated_visits(tree, points, _exact(indexed, points, trial.column("entry").to_numpy(), top) if count else [], recall, held)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch = sent.value.branch or [0]
        for batch in batches:
            own: list[dict[int, list[int]]] = []
            for q in _matrix(batch.column(1)) if batch.num_rows else ():
                own.append({})
                for leaf in sent.value.visits(q, visits, held, top + 1):
                    own[-1].setdefault(branch[leaf], []).append(leaf)
            rows = pa.array(np.repeat(np.arange(len(own)), [len(o) for o in own]))
            branches = pa.array([b for o in own for b in o], pa.int64())
            leaves = pa.array([o[b] for o in own for b in o], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), branches, leaves], ["query", "vec", "branch", "leaves"])

    distinct = asked.select("query").distinct()
    walked = distinct.join(entries.select(F.col("entry").alias("query"), "vec"), "query").select("query", "vec")
    walked = walked.mapInArrow(walk, "query long, vec array<double>, branch long, leaves array<long>")
    walked.write.parquet(f"{path}/walked")
    walked = spark.read.parquet(f"{path}/walked")
    found = _met(indexed, walked, top)

    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    kept = found.withColumn("n", best).filter(F.col("n") <= top + 1).select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = asked.join(kept, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= top)


def _draw(seed: int = 23) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "vec"), 11) / float(1 << 53)


def _met(indexed: DataFrame, walked: DataFrame, top: int) -> DataFrame:
    """query, entry, ids, score: each cell's best entries of each of its queries."""
    # Two numbers per branch; a root has BRANCHES of them at most.
    cells = indexed.groupBy("branch").count().select("branch", F.ceil(F.col("count") / CELL).cast("int").alias("rows_in"))
    asks = walked.groupBy("branch").count().select("branch", F.ceil(F.col("count") / CELL).cast("int").alias("asked_in"))
    grid = F.broadcast(cells.join(asks, "branch"))
    dealt = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    over = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = indexed.join(grid, "branch").select("branch", dealt("entry", "rows_in").alias("i"), over("asked_in").alias("j"), "entry", "vec", "ids", "leaf")
    right = walked.join(grid, "branch").select("branch", over("rows_in").alias("i"), dealt("query", "asked_in").alias("j"), "query", "vec", "leaves")

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return empty
        rows = rows.sort_by([("leaf", "ascending"), ("entry", "ascending")])
        vectors, queries = (_matrix(t.column("vec").combine_chunks()) for t in (rows, asked))
        leaf, entry = rows.column("leaf").to_numpy(), rows.column("entry").to_numpy()
        lists = asked.column("leaves").combine_chunks()
        visited = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
        visitor = np.repeat(np.arange(queries.shape[0]), np.diff(lists.offsets.to_numpy()))
        # Best so far of each query: score, and row of the vector (-1: none).
        score = np.full((queries.shape[0], top + 1), -np.inf)
        place = np.full((queries.shape[0], top + 1), -1, np.int64)
        for number in np.unique(visited):
            low, high = np.searchsorted(leaf, number), np.searchsorted(leaf, number, side="right")
            own = visitor[visited == number]
            if low == high:
                continue
            scores = np.concatenate([score[own], queries[own] @ vectors[low:high].T], axis=1)
            places = np.concatenate([place[own], np.broadcast_to(np.arange(low, high), (own.size, high - low))], axis=1)
            best = np.lexsort((np.where(places < 0, 0, entry[places]), -scores), axis=1)[:, : top + 1]
            score[own], place[own] = np.take_along_axis(scores, best, axis=1), np.take_along_axis(places, best, axis=1)
        q, n = np.nonzero(place >= 0)
        v = place[q, n]
        exact = (queries[q] * vectors[v]).sum(axis=1)
        ids = rows.column("ids").combine_chunks().take(pa.array(v))
        return pa.table({"query": asked.column("query").to_numpy()[q], "entry": entry[v], "ids": ids, "score": exact})

    empty = pa.table({"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})
    keys = ["branch", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query long, entry long, ids array<long>, score double")
