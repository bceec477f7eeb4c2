"""Whitening against numpy's own eigenvalues, and the factors and counts on matrices with ties."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sluiceway.llm import whitening


def brute(rows, number=16):
    """Covariance in fractions over the distinct vectors, eigenvectors by numpy."""
    xs = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    distinct = sorted(set(map(tuple, xs.values())))
    n, size = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(size)]
    moved = np.array([[n * x[k] - sums[k] for k in range(size)] for x in distinct], object)
    products = moved.T @ moved
    covariance = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in products])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:number], vectors[:, ::-1][:, :number]
    deviations = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in xs.items()}
    white = {i: (np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]) @ vectors) / np.sqrt(values) for i, x in xs.items()}
    return n, deviations, white, values / np.trace(covariance)


def compare(spark, rows, found, number=16):
    n, deviations, white, explained = brute(rows, number)
    got = {}
    for r in found:
        assert r.n == n and r.deviation == deviations[r.vec_id] and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        got[r.vec_id, r.component] = r.whitened
    assert len(got) == len(rows) * len(explained)
    for k in range(len(explained)):
        ours = np.array([got[i, k + 1] for i, _ in rows])
        theirs = np.array([white[i][k] for i, _ in rows])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < 1e-7


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((20, 20)) * np.linspace(3, 0.5, 20)
    rows = [(k, (rng.standard_normal(20) @ mixed).astype(np.float32).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # a vector of very many copies
    odd = [(2000, None), (2001, [None] * 20), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20), (2004, []), (2005, [1.0]), (2006, [3e38] * 20)]
    frame = vectors(spark, rows + odd).repartition(5).selectExpr("*", "1 x", "2 n", "'a' component")
    found = whitening.whitened(frame).collect()
    compare(spark, rows, found)
    assert {r.component for r in found} == set(range(1, 17))


def test_given_vectors_equal_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    compare(spark, rows, whitening.whitened(table).collect())


def test_few_components(spark):
    rows = [(k, [float(k % 7), float(k % 3), 0.0]) for k in range(21)]
    found = whitening.whitened(vectors(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    compare(spark, rows, found, 2)
    for none in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        empty = whitening.whitened(vectors(spark, none))
        assert empty.count() == 0 and len(empty.columns) == 7
    copies = vectors(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [2.0, 9.0])])
    assert sorted((r.vec_id is None, r.n) for r in whitening.whitened(copies).collect()) == [(False, 2), (True, 2), (True, 2)]


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(2**40 + k), float(-(k**2))]) for k in range(30)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    n = 30
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(x[k] for x in xs) for k in range(2)]
    want = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in enumerate(xs)}
    assert all(r.deviation == want[r.vec_id] for r in found)
    beyond = [(k, [float(k * 2**40)]) for k in range(3)]
    found = whitening.whitened(spark.createDataFrame(beyond, "vec_id bigint, embedding array<double>")).collect()
    assert {r.deviation for r in found} == {0, None}


@pytest.mark.parametrize("seed", range(6))
def test_factors_count_and_solve(seed):
    rng = np.random.default_rng(seed)
    for size in (1, 2, 5, 30):
        matrix = rng.standard_normal((size, size))
        matrix = matrix + matrix.T
        if seed % 2:
            np.fill_diagonal(matrix, 0.0)  # needs pivots of two rows
        values = np.linalg.eigvalsh(matrix)
        for shift in (values[:-1] + values[1:]) / 2 if size > 1 else [values[0] - 1]:
            factors = whitening.Factors(matrix - shift * np.eye(size))
            assert factors.negative() == (values < shift).sum()
            right = rng.standard_normal(size)
            assert np.allclose((matrix - shift * np.eye(size)) @ factors.solve(right), right)


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [1] * 6, [1e6, 1, 1e-3, 0, 0, 0], [3, 3 + 1e-9, 2, 1, 0.5, 0.1], [7, 6, 5, 4, 3, 2]])
def test_leading_with_ties(values):
    turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))
    matrix = turn @ np.diag(np.array(values, float)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, columns = whitening.leading(matrix, 4)
    want = np.sort(values)[::-1][:4]
    want = want[want > 0]
    assert np.allclose(found, want, rtol=1e-9, atol=1e-9 * max(values))
    assert np.allclose(columns.T @ columns, np.eye(len(want)), atol=1e-9)
    assert np.linalg.norm(matrix @ columns - columns * found) < 1e-10 * max(values)
