import math
from fractions import Fraction

import numpy as np
import pytest

from tunefeed.llm import whitening
from tunefeed.llm.whitening import centred, column_sums, covariance, polarised_sums, square_sums, whiten


@pytest.mark.parametrize("size", [1, 1 << 10, 1 << 30, 1 << 52, 1 << 61, 1 << 80])
def test_sums_are_exact_at_any_size(size):
    rng = np.random.default_rng(size % 1000)
    rows = [[int(rng.integers(-1000, 1000)) * size // 1000 for _ in range(5)] for _ in range(2100)]
    x = np.array(rows, np.int64 if size < 1 << 62 else object)
    assert column_sums(x) == [sum(c) for c in zip(*rows)]
    assert square_sums(x) == [sum(v * v for v in c) for c in zip(*rows)]
    n, sums = len(rows), column_sums(x)
    v = [[n * a - s for a, s in zip(r, sums)] for r in rows]
    assert centred(x, n, sums).tolist() == v
    cells = polarised_sums(centred(x, n, sums))
    want = [[sum(r[i] * r[j] for r in v) for j in range(5)] for i in range(5)]
    # Integers on both sides: the polarisation itself is exact.
    pairs = iter(cells[5:])
    for i in range(5):
        assert cells[i] == want[i][i]
        for j in range(i + 1, 5):
            assert next(pairs) - cells[i] - cells[j] == 2 * want[i][j]
    got = covariance(cells, 5, n)
    assert got[1, 3] == got[3, 1] == float(Fraction(want[1][3], n**3))


def brute(rows, scale=256):
    """Valid rows by id, and the fit list, in Python."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return kept, [list(x) for x in sorted({tuple(x) for _, x in kept})]


def check(got, rows):
    kept, fit = brute(rows)
    n, d = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    v = [[Fraction(a) - Fraction(s, n) for a, s in zip(x, sums)] for x in fit]
    cov = np.array([[float(sum(r[i] * r[j] for r in v) / n) for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == len(kept) * min(4, d)
    deviation = {}
    for i, x in kept:
        deviation.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(x, sums)))
    white = {}
    for r in got:
        assert r.n == n and int(r.deviation) in deviation[r.vec_id]
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9
        assert r.identity_error < 1e-9
        white[r.vec_id, r.component] = r.whitened
    # Over the fit list: mean 0, variance 1, and projections as of the matrix' own components.
    first = {tuple(x): i for i, x in reversed(kept)}
    basis = np.linalg.eigh(cov)
    for c in range(1, min(4, d) + 1):
        z = np.array([white[first[tuple(x)], c] for x in fit])
        assert abs(z.mean()) < 1e-9 and abs((z * z).mean() - 1) < 1e-9
        want = np.array([[float(a) for a in r] for r in v]) @ basis[1][:, -c] / math.sqrt(basis[0][-c])
        assert min(np.abs(z - want).max(), np.abs(z + want).max()) < 1e-6


def test_equal_to_exact_fractions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 16)
    rng = np.random.default_rng(5)
    scaled = rng.normal(size=(80, 6)) * [3, 2, 1.5, 1, 0.5, 0.2] + [0, 1, 40, 0, 0, -7]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(scaled)]
    rows += [(200 + i, rows[0][1]) for i in range(50)]  # copies count once for the fit
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, x string")
    got = whiten(df.repartition(5)).collect()
    check(got, rows)
    copies = {(r.component, r.whitened, r.deviation) for r in got if r.vec_id >= 200 or r.vec_id == 0}
    assert len(copies) == 4


def test_rows_that_take_no_part(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [2.0, -1.0, 0.5]), (3, [-1.0, 0.0, 0.25]), (4, None), (5, [1.0, None, 2.0]),
        (6, [float("nan"), 0.0, 0.0]), (7, [0.0, float("inf"), 0.0]), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (None, [0.5, 0.5, 0.5]), (11, [-0.0, 0.001, 7.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whiten(df).collect()
    kept = [r for r in rows if r[0] in (1, 2, 3, 10, 11, None)]
    check(got, kept)
    assert {r.vec_id for r in got} == {1, 2, 3, 10, 11, None}
    assert whiten(df.limit(0)).collect() == [] and whiten(df.filter("vec_id IN (4, 8)")).collect() == []
    # One distinct vector has no variance; of two, one component has.
    assert whiten(df.filter("vec_id IN (1, 10)")).collect() == []
    assert {r.component for r in whiten(df.filter("vec_id IN (1, 2, 10)")).collect()} == {1}


def test_large_entries(spark):
    rows = [(i, [1e12 * math.sin(i), 3e9 * math.cos(3 * i), 1e10 * (i % 7)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(whiten(df).collect(), rows)


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    got = whiten(rows).collect()
    kept, fit = brute([tuple(r) for r in rows.collect()])
    v = np.array(fit, float)
    values = np.linalg.eigvalsh(np.cov(v.T, bias=True))[::-1]
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {len(fit)}
    for r in got[:40]:
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9
