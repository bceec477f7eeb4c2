"""Whitening of vectors: exact covariance, eigenvalues isolated by counting, projection on the leading ones.

Spark sums the covariance of the distinct vectors in whole numbers: vectors are centred at the whole
number next to the mean, and what that differs from the mean is taken off exactly. Sums of whole numbers do not
depend on the order of tasks, so a task that runs again changes no digit. Only matrices as wide as the
vectors reach the driver, whatever the number of rows; intermediate tables are written to the shared folder.

The number of negative pivots of the factors L D L' of V - s I is the number of eigenvalues below s. Such
counts halve an interval until it holds one eigenvalue; Rayleigh quotient iteration then converges
cubically, and two more counts on either side of the result certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
#: Entries whose scaled value a double no longer gives in whole numbers are as unusable as infinite ones.
LARGEST = 2**53
LONG = 2**63
#: Rows that are multiplied at a time; at most this many fit one product of exact doubles.
ROWS = 4_096
#: Bunch and Kaufman's constant, which bounds the growth of the factors.
ALPHA = (1 + 17**0.5) / 8


class Factors:
    """L D L' of a symmetric matrix with pivots of one or two rows, chosen as Bunch and Kaufman do."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, np.float64)
        n = len(a)
        self.order = np.arange(n)
        self.lower = np.eye(n)
        self.blocks: list[np.ndarray] = []
        tiny = np.finfo(np.float64).eps * max(np.abs(a).max(initial=0.0), np.finfo(np.float64).tiny) * 1e-3
        k = 0
        while k < n:
            size = self._pivot(a, k)
            block = a[k : k + size, k : k + size].copy()
            if size == 1 and abs(block[0, 0]) < tiny:
                block[0, 0] = tiny  # an eigenvalue at the shift counts as above it
            rest = a[k + size :, k : k + size]
            multipliers = np.linalg.solve(block, rest.T).T
            a[k + size :, k + size :] -= multipliers @ rest.T
            self.lower[k + size :, k : k + size] = multipliers
            self.blocks.append(block)
            k += size

    def _pivot(self, a: np.ndarray, k: int) -> int:
        """Brings a good pivot to place ``k`` and gives its size."""
        column = np.abs(a[k + 1 :, k])
        if not len(column):
            return 1
        at = k + 1 + int(column.argmax())
        largest, here = column.max(), abs(a[k, k])
        if largest == 0 or here >= ALPHA * largest:
            return 1
        across = np.abs(a[k:, at]).copy()
        across[at - k] = 0
        if here * across.max() >= ALPHA * largest**2:
            return 1
        if abs(a[at, at]) >= ALPHA * across.max():
            self._swap(a, k, at)
            return 1
        self._swap(a, k + 1, at)
        return 2

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            # Settled columns of L move along; from this pivot on it is still the identity.
            settled = sum(len(block) for block in self.blocks)
            self.lower[[i, j], :settled] = self.lower[[j, i], :settled]

    def negative(self) -> int:
        """Eigenvalues below zero, by Sylvester's law of inertia."""
        count = 0
        for block in self.blocks:
            if len(block) == 1:
                count += int(block[0, 0] < 0)
            elif (determinant := block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]) < 0:
                count += 1
            else:
                count += 2 * int(block[0, 0] + block[1, 1] < 0 and determinant > 0)
        return count

    def solve(self, right: np.ndarray) -> np.ndarray:
        x = right[self.order].astype(np.float64)
        n = len(x)
        for k in range(n):
            x[k + 1 :] -= np.multiply.outer(self.lower[k + 1 :, k], x[k])
        k = 0
        for block in self.blocks:
            x[k : k + len(block)] = np.linalg.solve(block, x[k : k + len(block)])
            k += len(block)
        for k in range(n - 1, -1, -1):
            x[k] -= self.lower[k + 1 :, k] @ x[k + 1 :]
        back = np.empty_like(x)
        back[self.order] = x
        return back


def _above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues at or above ``shift``."""
    return len(matrix) - Factors(matrix - shift * np.eye(len(matrix))).negative()


def leading(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Only eigenvalues that are positive beyond rounding come out, so there may be fewer than asked for.
    Eigenvalues closer than rounding can tell apart are one cluster: counts give its size, and inverse
    iteration on as many vectors its space. The largest entry of each vector is positive.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((size, 0))
    blur = 8 * size * np.finfo(np.float64).eps * scale
    intervals = _intervals(matrix, min(number, size), blur, 2 * scale)
    values, vectors = [], np.zeros((size, 0))
    for low, high, first, last in intervals:
        found = None
        if first == last:
            found = _refined(matrix, low, high, first, vectors, blur)
        value, vector = found if found else _cluster(matrix, low, high, last - first + 1, vectors)
        values.extend(np.atleast_1d(value).tolist())
        vectors = np.column_stack([vectors, vector])
    vectors = vectors[:, :number]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.array(values[:number]), vectors * signs


def _intervals(matrix: np.ndarray, number: int, blur: float, top: float) -> list[tuple[float, float, int, int]]:
    """``low, high, first, last``: intervals from the top that hold the eigenvalues numbered first to last."""
    positive = _above(matrix, blur)
    waiting, done = [(blur, top, positive, 0)], []
    while waiting:
        low, high, upto, beyond = waiting.pop()
        if upto == beyond or beyond >= number:
            continue
        if upto - beyond == 1 or high - low <= blur:
            done.append((low, high, beyond + 1, upto))
            continue
        middle = (low + high) / 2
        count = min(max(_above(matrix, middle), beyond), upto)
        waiting += [(low, middle, upto, count), (middle, high, count, beyond)]
    return sorted(done, key=lambda interval: interval[2])


def _refined(matrix, low, high, number, before, blur):
    """The single eigenvalue of an interval by Rayleigh quotient iteration; None if counts do not certify it."""
    eye, start = np.eye(len(matrix)), np.random.default_rng(number).standard_normal(len(matrix))
    bottom, top = low, high
    for _ in range(60):
        middle = (bottom + top) / 2
        x = _apart(start, before)
        for _ in range(2):
            x = _apart(Factors(matrix - middle * eye).solve(x), before)
        value = x @ matrix @ x
        for _ in range(12):
            if not low - blur <= value <= high + blur:
                break
            if np.linalg.norm(matrix @ x - value * x) <= blur / 64:
                break
            x = _apart(Factors(matrix - value * eye).solve(x), before)
            value = x @ matrix @ x
        exact = np.linalg.norm(matrix @ x - value * x) <= blur
        if exact and low - blur <= value <= high + blur and _above(matrix, value - 2 * blur) >= number > _above(matrix, value + 2 * blur):
            return value, x
        if top - bottom <= blur:
            return None
        bottom, top = (middle, top) if _above(matrix, middle) >= number else (bottom, middle)
    return None


def _apart(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Unit vector without any part along the vectors found before."""
    x = x / np.linalg.norm(x)
    for _ in range(2):
        x = x - before @ (before.T @ x)
    return x / np.linalg.norm(x)


def _cluster(matrix, low, high, size, before):
    """Eigenvalues and vectors of a cluster: inverse iteration on a space, then its Rayleigh quotients."""
    middle = (low + high) / 2
    factors = Factors(matrix - middle * np.eye(len(matrix)))
    space = np.random.default_rng(size).standard_normal((len(matrix), size))
    for _ in range(6):
        for _ in range(2):
            space = space - before @ (before.T @ space)
            space, _ = np.linalg.qr(space)
        space = factors.solve(space)
    space = space - before @ (before.T @ space)
    space, _ = np.linalg.qr(space)
    inner, turn = np.linalg.eigh(space.T @ matrix @ space)
    return inner[::-1], space @ turn[:, ::-1]


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """``vec_id`` and ``x``, the scaled whole numbers, of rows that can be whitened.

    Vectors that are null, hold nulls, infinite or undefined entries, or entries beyond ``LARGEST`` are
    left out, and so are those whose length is not the most frequent one (of equals the longest).
    """
    wide = F.transform(vector, lambda c: c.cast("double"))
    known = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < LARGEST))
    kept = rows.where(F.col(vector).isNotNull()).select("vec_id", wide.alias("x")).where(known)
    lengths = kept.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    length = lengths[0]["length"] if lengths else 0
    whole = F.transform("x", lambda c: F.floor(c * SCALE).cast("bigint") + F.lit(OFFSET).cast("bigint"))
    return kept.where(F.size("x") == length).select("vec_id", whole.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """Entries of the sum of ``part`` over all rows; tasks add up their own, Spark the tasks'.

    What comes to the driver has as many entries as ``part`` gives, however many rows there are.
    """
    whole = kind.startswith("decimal")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                x = _matrix(batch.column(0).slice(begin, ROWS))
                summed = part(x).ravel()
                summed = summed.astype(object) if whole else summed
                total = summed if total is None else total + summed
        if total is not None:
            values = [Decimal(int(v)) for v in total] if whole else total
            kinds = pa.decimal128(38, 0) if whole else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(values, kinds)], ["entry", "value"])

    parts = rows.select("x").mapInArrow(add, f"entry bigint, value {kind}")
    found = parts.groupBy("entry").agg(F.sum("value").alias("value")).collect()
    return [row["value"] for row in sorted(found, key=lambda row: row["entry"])]


def _products(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """X'X of whole numbers around a centre, exact: in doubles or longs where these suffice."""
    moved = x - np.array(centre, np.int64)
    largest = int(np.abs(moved).max(initial=0))
    if largest**2 * len(x) < LARGEST:
        moved = moved.astype(np.float64)
    elif largest**2 * len(x) >= LONG:
        moved = moved.astype(object)
    return moved.T @ moved


class Spectrum:
    """Count and sums of the distinct vectors, and the leading components of their covariance."""

    def __init__(self, fit: DataFrame, number: int):
        counted = _summed(fit, lambda x: np.r_[len(x), x.astype(object).sum(axis=0)], "decimal(38,0)")
        self.n = int(counted[0]) if counted else 0
        self.sums = [int(s) for s in counted[1:]]
        size = len(self.sums)
        self.values, self.vectors, self.trace = np.zeros(0), np.zeros((size, 0)), 0.0
        if not size:
            return
        # Nearest whole number to each mean; what is left of the mean is taken off the products as a fraction.
        centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        left = [Fraction(s, self.n) - c for s, c in zip(self.sums, centre)]
        products = _summed(fit, lambda x: _products(x, centre), "decimal(38,0)")
        exact = [[Fraction(int(products[i * size + j]), self.n) - left[i] * left[j] for j in range(size)] for i in range(size)]
        self.covariance = np.array([[float(v) for v in row] for row in exact])
        self.trace = float(sum(exact[i][i] for i in range(size)))
        self.values, self.vectors = leading(self.covariance, number)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on the components, each over the root of its eigenvalue."""
        whole, part = np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n / self.n for s in self.sums])
        return ((x - whole) - part) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``n x - S`` of each row, exact; None where a long cannot hold it."""
        sums = np.array(self.sums, object)
        bound = max(int(np.abs(x).max(initial=0)), 1)
        if 2 * self.n * bound < LONG:
            moved = self.n * x - sums.astype(np.int64)
            if int(np.abs(moved).max(initial=0)) ** 2 * max(len(sums), 1) < LONG:
                return (moved * moved).sum(axis=1).tolist()
        moved = self.n * x.astype(object) - sums
        return [v if v < LONG else None for v in (moved * moved).sum(axis=1).tolist()]

    def identity_error(self, fit: DataFrame) -> float:
        """Largest entry by which the covariance of the whitened distinct vectors differs from the identity."""
        count = len(self.values)
        means = np.array(_summed(fit, lambda x: self.whitened(x).sum(axis=0), "double")) / self.n

        def part(x: np.ndarray) -> np.ndarray:
            centred = self.whitened(x) - means
            return centred.T @ centred

        found = np.array(_summed(fit, part, "double")).reshape(count, count) / self.n
        return float(np.abs(found - np.eye(count)).max())


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and leading component: its coordinate with unit variance.

    Columns: ``vec_id, component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation`` (the sum of
    squares of ``n x - S``; null if beyond a long), ``whitened``, ``explained`` (share of the whole variance)
    and ``identity_error``. Vectors as ``usable`` has them; those that repeat count once in the covariance and
    each get their rows, so a null or repeated ``vec_id`` does too. Components without variance do not
    exist: an empty table, a single vector and vectors without entries give no rows. Other columns are not
    read. Eigenvalues that tie are numbered in one order for all rows.
    """
    scratch = Scratch(rows.sparkSession, "whitening")
    known = scratch.keep(usable(rows, vector), "known")
    fit = scratch.keep(known.select("x").distinct(), "fit")
    spectrum = Spectrum(fit, components)
    count = len(spectrum.values)
    if not count:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    error = spectrum.identity_error(fit)
    explained = spectrum.values / spectrum.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                some = batch.slice(begin, ROWS)
                x = _matrix(some.column(1))
                size = len(x)
                repeated = pa.array(np.repeat(np.arange(size), count))
                columns = [
                    some.column(0).take(repeated),
                    pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                    pa.array(np.full(size * count, spectrum.n), pa.int64()),
                    pa.array(spectrum.deviations(x), pa.int64()).take(repeated),
                    pa.array(spectrum.whitened(x).ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in SCHEMA.split(", ")])

    return known.select("vec_id", "x").mapInArrow(project, SCHEMA)
