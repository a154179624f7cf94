"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers (``floor(1024 c) + 100000``), so sums over any number of rows are exact and
do not depend on the order of tasks. Entries are centred by the rounded mean before they are multiplied;
the rest of the mean (less than one) is taken off the summed products, exactly. The covariance that the driver sees
is a d x d table, whatever the number of rows.

Its leading eigenpairs come from spectrum slicing. The inertia of V - s I, read off the pivots of an
LDLT factorisation, says how many eigenvalues exceed s. Bisection on that count isolates the j-th
largest one, Rayleigh quotient iteration converges to it cubically, and counts on both sides of the result
certify that it is number j. Eigenvalues that no shift can tell apart share an interval; their vectors
are made orthogonal to each other.

Defined results:

* vectors that are null, empty, or hold null or non-finite entries are dropped;
* the dimension is the most frequent length (the shorter one of a tie); vectors of other lengths are
  dropped too, since they have no covariance with the rest;
* entries beyond +-2**52 after scaling are held there;
* components whose eigenvalue is not above rounding (d * 2**-52 * trace) cannot be scaled to one and are
  not returned, so equal vectors, a single vector and an empty table give no rows;
* ``deviation`` is null where it passes 2**63 - 1; ``deviation_exact`` still has it, as decimal(38,0), and is
  null only beyond 38 digits;
* null and repeated vec_id are returned as they are, row by row; other columns are not read.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.common import stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
_HELD = float(1 << 52)
_EPS = 2.0**-52

#: Rows that are multiplied at once.
BATCH = 4096

_WIDE = pa.decimal128(38, 0)
_DIGITS = 10**38
_HALF = 10**18


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and whole-number matrices of the usable vectors of a list column, one for each length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = pc.list_flatten(column)
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False))
    ends = np.cumsum(lengths)
    places, matrices = [], []
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = values[(ends[rows] - length)[:, None] + np.arange(length)]
        good = np.isfinite(matrix).all(axis=1)
        with np.errstate(over="ignore"):
            scaled = np.floor(matrix[good] * SCALE)
        matrices.append(np.clip(scaled, -_HELD, _HELD).astype(np.int64) + SHIFT)
        places.append(rows[good])
    return places, matrices


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers without rounding: int64, or Python's numbers where those are too small."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, len(a))
    if largest < 1 << 53:
        return (a.astype(np.float64).T @ b.astype(np.float64)).astype(np.int64)
    return a.astype(object).T @ b.astype(object)


def _wide(values) -> pa.Array:
    return pa.array([decimal.Decimal(int(v)) if abs(v) < _DIGITS else None for v in values], _WIDE)


def vector_sums(vectors: DataFrame) -> DataFrame:
    """(length, i, n, total): rows and exact sums of each dimension, for each length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for matrix in whole_vectors(batch.column(0))[1]:
                if len(matrix):
                    n, total = sums.get(matrix.shape[1], (0, 0))
                    ones = np.ones((len(matrix), 1), dtype=np.int64)
                    sums[matrix.shape[1]] = (n + len(matrix), total + exact_product(ones, matrix)[0].astype(object))
                    if len(sums) > 64:  # lengths may be many; the shuffle adds them up
                        yield from flush(sums)
        yield from flush(sums)

    def flush(sums: dict) -> Iterator[pa.RecordBatch]:
        for length, (n, total) in sums.items():
            arrays = [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), _wide(total)]
            yield pa.RecordBatch.from_arrays(arrays, names=["length", "i", "n", "total"])
        sums.clear()

    parts = vectors.mapInArrow(add, "length int, i int, n long, total decimal(38,0)")
    return parts.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


def product_sums(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """(i, j, high, low) for i <= j: exact sums, high * 10**18 + low, of products of the entries less ``centre``."""
    upper = np.triu_indices(len(centre))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre),) * 2, dtype=object)
        for batch in batches:
            for matrix in whole_vectors(batch.column(0))[1]:
                if matrix.shape[1] == len(centre):
                    for first in range(0, len(matrix), BATCH):
                        part = matrix[first : first + BATCH] - centre
                        total = total + exact_product(part, part)
        halves = [_wide(total[upper] // _HALF), _wide(total[upper] % _HALF)]
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *halves], names=["i", "j", "high", "low"])

    parts = vectors.mapInArrow(add, "i int, j int, high decimal(38,0), low decimal(38,0)")
    return parts.groupBy("i", "j").agg(*(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("high", "low")))


# --- eigenpairs of a small symmetric matrix ----------------------------------------------------


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``: positive pivots of LDLT with Bunch and Kaufman's pivoting."""
    a = v - shift * np.eye(len(v))
    alpha = (1 + 17**0.5) / 8
    k, positive, n = 0, 0, len(a)
    while k < n:
        step, pivot = 1, k
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        if most > 0 and abs(a[k, k]) < alpha * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() >= alpha * most * most:
                pass
            elif abs(a[r, r]) >= alpha * row.max():
                pivot = r
            else:
                step, pivot = 2, r
        to = k + step - 1
        if pivot != to:
            a[[to, pivot], k:] = a[[pivot, to], k:]
            a[k:, [to, pivot]] = a[k:, [pivot, to]]
        block, column = a[k : k + step, k : k + step].copy(), a[k + step :, k : k + step].copy()
        if step == 1:
            d = block[0, 0]
            positive += d > 0
            if d != 0:
                a[k + 1 :, k + 1 :] -= np.outer(column[:, 0] / d, column[:, 0])
        else:  # a 2 x 2 pivot is indefinite: one eigenvalue of each sign
            positive += 1
            a[k + 2 :, k + 2 :] -= column @ np.linalg.solve(block, column.T)
        k += step
    return int(positive)


def _orthogonal(y: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in found:
            y = y - (q @ y) * q
    return y / np.linalg.norm(y)


def _solve(v: np.ndarray, shift: float, y: np.ndarray) -> np.ndarray:
    for nudge in (0.0, _EPS, 4 * _EPS):
        try:
            x = np.linalg.solve(v - (shift + nudge) * np.eye(len(v)), y)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all() and np.linalg.norm(x) > 0:
            return x / np.linalg.norm(x)
    return y


def _isolate(v: np.ndarray, j: int, low: float, high: float, width: float) -> tuple[float, float, bool]:
    """An interval with eigenvalue number j (from 1, falling) alone in it, or with all that equal it."""
    above_low, above_high = count_above(v, low), count_above(v, high)
    while above_low - above_high > 1 and high - low > width:
        middle = (low + high) / 2
        above = count_above(v, middle)
        if above >= j:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high, above_low - above_high == 1


def _iterate(v: np.ndarray, low: float, high: float, found: list[np.ndarray], steps: int = 12) -> tuple[float, np.ndarray, bool]:
    """Rayleigh quotient iteration from the middle of an interval, away from the vectors already found.

    ``v`` has a trace of 1. Gives the value, its vector and whether the residual is down to rounding.
    """
    shift = (low + high) / 2
    rounding = 2 * len(v) * _EPS
    x = _orthogonal(np.random.default_rng(len(found)).standard_normal(len(v)), found)
    for _ in range(3):
        x = _orthogonal(_solve(v, shift, x), found)
    for _ in range(steps):
        value = float(x @ v @ x)
        nearer = _orthogonal(_solve(v, value, x), found) if low <= value <= high else _orthogonal(_solve(v, shift, x), found)
        better = float(nearer @ v @ nearer)
        before, after = np.linalg.norm(v @ x - value * x), np.linalg.norm(v @ nearer - better * nearer)
        if before <= rounding and after >= before:
            break
        x = nearer
    value = float(x @ v @ x)
    return value, x, bool(np.linalg.norm(v @ x - value * x) <= rounding)


def leading_pairs(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as rows. Stops at rounding.

    Raises ``ArithmeticError`` if the counts do not confirm a number.
    """
    d = len(v)
    trace = float(np.trace(v))
    least = d * _EPS * trace
    if d == 0 or not trace > 0:
        return np.zeros(0), np.zeros((0, d))
    unit = v / trace  # eigenvalues in [0, 1]
    width = 8 * d * _EPS
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for j in range(1, min(k, d) + 1):
        if count_above(unit, least / trace) < j:
            break
        low, high, alone = _isolate(unit, j, -width, 1 + width, width)
        value, x, settled = _iterate(unit, low, high, vectors)
        while alone and high - low > width and not (settled and low <= value <= high):
            # It left for a neighbour, or stands between two: halve the interval round number j and start again.
            middle = (low + high) / 2
            low, high = (middle, high) if count_above(unit, middle) >= j else (low, middle)
            value, x, settled = _iterate(unit, low, high, vectors)
        if not count_above(unit, value - width) >= j > count_above(unit, value + width):
            raise ArithmeticError(f"eigenvalue {j} could not be confirmed")
        values.append(value)
        vectors.append(x)
    order = np.argsort(-np.array(values), kind="stable") if values else []
    return np.array(values)[order] * trace if values else np.zeros(0), np.array(vectors)[order] if values else np.zeros((0, d))


# --- the fitted transformation ------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Exact mean (``centre`` whole, ``rest`` below one) and the leading eigenpairs of n vectors."""

    n: int
    totals: tuple[int, ...]
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, matrix: np.ndarray) -> np.ndarray:
        """Whitened rows of whole vectors."""
        centred = (matrix - self.centre).astype(np.float64) - self.rest
        return centred @ (self.components / np.sqrt(self.values)[:, None]).T

    def deviations(self, matrix: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)**2, exact."""
        rest = [t - self.n * int(c) for t, c in zip(self.totals, self.centre)]
        part = matrix - self.centre
        # n z - r, squared and summed: n**2 sum(z z) - 2 n sum(z r) + sum(r r), each part whole
        largest = int(np.abs(part).max(initial=0))
        if largest**2 * len(rest) < 1 << 62 and largest * self.n * len(rest) < 1 << 62:
            squares = (part * part).sum(axis=1).tolist()
            crossed = (part @ np.array(rest, dtype=np.int64)).tolist()
        else:
            wide = part.astype(object)
            squares, crossed = (wide * wide).sum(axis=1).tolist(), (wide @ np.array(rest, dtype=object)).tolist()
        own = sum(r * r for r in rest)
        return [self.n**2 * s - 2 * self.n * c + own for s, c in zip(squares, crossed)]


def fit_whitening(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Learn from all usable vectors (one list column); None when there is none.

    The driver collects one row for each dimension and each pair of dimensions.
    """
    sums = stored(vector_sums(vectors), "vector_sums")
    most = sums.where("i = 0").orderBy(F.desc("n"), "length").first()
    if most is None:
        return None
    rows = sums.where(F.col("length") == most["length"]).orderBy("i").collect()
    n, totals = int(most["n"]), tuple(int(r["total"]) for r in rows)
    whole = [(2 * t + n) // (2 * n) for t in totals]
    centre = np.array(whole, dtype=np.int64)
    rest = [t - n * c for t, c in zip(totals, whole)]
    v = np.zeros((len(totals),) * 2)
    for r in product_sums(vectors, centre).collect():
        i, j = r["i"], r["j"]
        exact = Fraction(n * (int(r["high"]) * _HALF + int(r["low"])) - rest[i] * rest[j], n * n)
        v[i, j] = v[j, i] = float(exact)
    values, components = leading_pairs(v, k)
    return Whitening(n, totals, centre, np.array([float(Fraction(r, n)) for r in rest]), values, components, float(np.trace(v)))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of (covariance of the whitened vectors less the identity), measured on all rows."""
    k = len(model.values)
    size = k * k + k  # products, and the sums: vectors are centred before they are projected, so these are rounding

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for matrix in whole_vectors(batch.column(0))[1]:
                if matrix.shape[1] == len(model.centre):
                    for first in range(0, len(matrix), BATCH):
                        white = model.project(matrix[first : first + BATCH])
                        total += np.concatenate([(white.T @ white).ravel(), white.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["i", "total"])

    rows = vectors.mapInArrow(add, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(size)
    for r in rows:
        total[r["i"]] = r["total"]
    mean = total[k * k :] / model.n
    covariance = total[: k * k].reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


OUT = "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, k: int = COMPONENTS, *, vector: str = "embedding") -> DataFrame:
    """One row for each usable vector and component; ``vec_id`` must be whole numbers."""
    vectors = embeddings.select(vector)
    model = fit_whitening(vectors, k)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], OUT)
    error = identity_error(vectors, model)
    found = len(model.values)
    explained = model.values / model.trace
    limit = (1 << 63) - 1

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            places, matrices = whole_vectors(batch.column(1))
            for place, matrix in zip(places, matrices):
                if matrix.shape[1] != len(model.centre):
                    continue
                for first in range(0, len(matrix), BATCH):
                    part = matrix[first : first + BATCH]
                    deviations = model.deviations(part)
                    times = np.repeat(np.arange(len(part)), found)
                    rows = len(part) * found
                    arrays = [
                        ids.take(pa.array(place[first : first + BATCH][times])).cast(pa.int64()),
                        pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(rows, model.n, dtype=np.int64)),
                        pa.array([x if x <= limit else None for x in deviations], pa.int64()).take(pa.array(times)),
                        _wide(deviations).take(pa.array(times)),
                        pa.array(model.project(part).ravel()),
                        pa.array(np.tile(explained, len(part))),
                        pa.array(np.full(rows, error)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in OUT.split(", ")])

    return embeddings.select("vec_id", vector).mapInArrow(apply, OUT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
