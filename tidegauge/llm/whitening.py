"""Whitening of embeddings along their leading components, found by slicing the spectrum.

Spark sums the vectors and their centred products; the driver gets one covariance matrix. There the
inertia of shifted matrices, read off their LDL' factors, counts the eigenvalues above a shift:
bisection isolates each leading one, Rayleigh quotient iteration converges to it cubically, and
counts on both sides of the result certify its number. Spark then projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

#: An eigenvalue below this share of the trace is rounding, and no component.
LEAST_SHARE = 1e-13


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``, by the inertia of LDL'.

    Pivots are single or double (Bunch and Kaufman), so that indefinite matrices factor stably. A
    pivot that is exactly zero counts as not above.
    """
    a = matrix - shift * np.eye(len(matrix))
    n, k, count = len(a), 0, 0
    bound = (1 + 17 ** 0.5) / 8
    while k < n:
        rest = np.abs(a[k + 1:, k])
        below = rest.max() if len(rest) else 0.0
        double = False
        if abs(a[k, k]) < bound * below:
            other = k + 1 + int(rest.argmax())
            row = np.abs(a[other, k:])
            row[other - k] = 0
            if abs(a[k, k]) * row.max() >= bound * below ** 2:
                pass
            elif abs(a[other, other]) >= bound * row.max():
                _swap(a, k, other)
            else:
                _swap(a, k + 1, other)
                double = True
        if double:
            pivot, columns = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            determinant = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] * pivot[1, 0]
            count += 1 if determinant < 0 else 2 * bool(pivot[0, 0] + pivot[1, 1] > 0)
            a[k + 2:, k + 2:] -= columns @ np.linalg.solve(pivot, columns.T)
            k += 2
        else:
            pivot = a[k, k]
            count += bool(pivot > 0)
            if pivot:
                column = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(column, column / pivot)
            k += 1
    return count


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, tiny: float) -> np.ndarray:
    """The direction of (matrix - shift)^-1 vector."""
    eye = np.eye(len(matrix))
    while True:
        try:
            found = np.linalg.solve(matrix - shift * eye, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            shift += tiny
            tiny *= 2
            continue
        length = np.linalg.norm(found)
        if np.isfinite(length) and length > 0:
            return found / length
        shift += tiny
        tiny *= 2


def leading(matrix: np.ndarray, count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a positive semidefinite matrix, falling, and unit
    eigenvectors in rows; fewer where the rest is rounding. Their numbering is certified by counts.

    Equal eigenvalues get an orthonormal basis of what they share.
    """
    n, trace = len(matrix), float(np.trace(matrix))
    if not n or not trace > 0:
        return np.empty(0), np.empty((0, n))
    scaled = matrix / trace
    size = float(np.abs(scaled).sum(axis=1).max())
    near = 8 * np.finfo(float).eps * size
    counts: dict[float, int] = {}

    def over(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(scaled, shift)
        return counts[shift]

    draw = np.random.default_rng(seed)
    values, vectors = [], []
    count = min(count, over(LEAST_SHARE))
    counts[size * 1.01] = 0  # no eigenvalue exceeds the largest sum of a row's sizes
    for j in range(1, count + 1):
        low = max(s for s, c in counts.items() if c >= j)
        high = min(s for s, c in counts.items() if c < j)
        basis = np.array(vectors).reshape(-1, n)
        while True:
            # Narrow until (low, high] holds this eigenvalue alone, or as many as cannot be told apart.
            while over(low) - over(high) > 1 and high - low > near:
                middle = (low + high) / 2
                low, high = (middle, high) if over(middle) >= j else (low, middle)
            found, value = draw.standard_normal(n), (low + high) / 2
            for _ in range(3):  # a start inside the interval
                found -= basis.T @ (basis @ found)
                found = _solved(scaled, value, found / np.linalg.norm(found), near)
            alone = over(low) - over(high) == 1
            for _ in range(12):
                value = float(found @ scaled @ found)
                if not low <= value <= high and alone:
                    break
                if np.linalg.norm(scaled @ found - value * found) <= near / 4:
                    break
                found = _solved(scaled, value, found, near)
                if not alone:
                    found -= basis.T @ (basis @ found)
                    found /= np.linalg.norm(found)
            found -= basis.T @ (basis @ found)
            found /= np.linalg.norm(found)
            value = float(found @ scaled @ found)
            slack = near + float(np.linalg.norm(scaled @ found - value * found))
            if over(value - slack) >= j > over(value + slack) or high - low <= near:
                break
            middle = (low + high) / 2  # converged to a neighbour: halve and begin again
            low, high = (middle, high) if over(middle) >= j else (low, middle)
        values.append(value * trace)
        vectors.append(found)
    return np.array(values), np.array(vectors).reshape(-1, n)


@dataclass
class Model:
    """What was fitted: ``n`` distinct vectors, sums, components with eigenvalues, their share."""

    n: int
    sums: list[int]
    values: list[float] = field(default_factory=list)
    components: list[list[float]] = field(default_factory=list)
    explained: list[float] = field(default_factory=list)
    identity_error: float | None = None


def whole(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``vec_id`` and ``x``, the vector in whole numbers, of rows whose entries are all finite."""
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        "v IS NOT NULL AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity'))"
    ).select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _added(frame: DataFrame, width: int, kind: str, partial) -> dict[int, list]:
    """Rows of numbers by place, summed over all partitions.

    ``partial`` makes (place, row) pairs of an iterator of matrices; a place's rows are added in a
    stream, after one shuffle of a few rows from each task. What comes to the driver is a sum.
    """
    arrow = pa.list_(pa.float64() if kind == "double" else pa.int64())

    def batch(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([list(r) for r in sums.values()], arrow)], ["place", "row"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield batch(partial(_matrix(b.column(0), width) for b in batches if b.num_rows))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for place, row in zip(rows.column(0).to_pylist(), rows.column(1)):
                own = row.values.to_numpy(zero_copy_only=False)
                sums[place] = sums[place] + own if place in sums else own.copy()
        yield batch(sums)

    schema = f"place int, row array<{kind}>"
    rows = frame.select("x").mapInArrow(first, schema).repartition("place").mapInArrow(second, schema)
    return {r.place: r.row for r in rows.collect()}


def fit(fit_list: DataFrame, width: int, components: int) -> Model:
    """The model of the distinct vectors ``x`` of one width in ``fit_list``."""

    def sums(matrices: Iterator[np.ndarray]) -> dict[int, np.ndarray]:
        # Halves of 32 bits, so that no sum overflows.
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for x in matrices:
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        return {0: np.array([n]), 1: high, 2: low}

    found = _added(fit_list, width, "long", sums)
    n = found[0][0] if found else 0
    if not n:
        return Model(0, [0] * width)
    model = Model(n, [(h << 32) + c for h, c in zip(found[1], found[2])])
    mean = np.array([float(Fraction(s, n)) for s in model.sums])

    def products(matrices: Iterator[np.ndarray]) -> dict[int, np.ndarray]:
        total = np.zeros((width, width))
        for x in matrices:
            centred = x - mean
            total += centred.T @ centred
        return dict(enumerate(total))

    found = _added(fit_list, width, "double", products)
    covariance = np.array([found[i] for i in range(width)]).reshape(width, width) / n
    values, vectors = leading((covariance + covariance.T) / 2, components)
    model.values, model.components = values.tolist(), vectors.tolist()
    model.explained = (values / np.trace(covariance)).tolist() if len(values) else []
    k, project = len(values), _projector(mean, values, vectors)

    def whitened(matrices: Iterator[np.ndarray]) -> dict[int, np.ndarray]:
        total, mean_sum = np.zeros((k, k)), np.zeros(k)
        for x in matrices:
            w = project(x)
            total += w.T @ w
            mean_sum += w.sum(axis=0)
        return {**dict(enumerate(total)), k: mean_sum}

    if k:
        found = _added(fit_list, width, "double", whitened)
        centre = np.array(found[k]) / n  # rounding: the rows were centred before
        second = np.array([found[i] for i in range(k)]) / n - np.outer(centre, centre)
        model.identity_error = float(np.abs(second - np.eye(k)).max())
    return model


def _projector(mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
    weights = vectors.T / np.sqrt(values)
    return lambda x: (x - mean) @ weights


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n*x - S)^2, exact; none where it is beyond 64 bits."""
    centre = np.array(sums, float)
    largest = max(np.abs(x * float(n)).max(initial=0), np.abs(centre).max(initial=0))
    if 4 * largest ** 2 * max(x.shape[1], 1) < 2.0 ** 62:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 1 << 63 else None for d in found]


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, components: int = 4
) -> tuple[DataFrame, Model]:
    """``vec_id``, ``deviation`` and ``whitened`` of the rows that take part, and the fitted model.

    An entry c counts as the whole number floor(scale * c). The model is fitted to the distinct
    vectors of the whole table; ``whitened`` has a value for each leading component, of unit variance
    over those, and ``deviation`` is the exact squared distance of n times the vector from the sum
    of all (null beyond 64 bits).

    Rows take no part whose vector is null or holds a null or a value that is not finite. Rows
    without id take part, equal rows and ids each for itself. Shorter vectors are continued with zeros.
    Components whose eigenvalue is rounding are left out, so equal vectors have none; equal eigenvalues
    share any basis. Other columns are not looked at. No rows give no rows.
    """
    rows = whole(vectors, vec_id, vector, scale)
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", _filled(F.col("x"), width))
    # Read three times; written, it need not be made again where an executor is lost.
    fit_list = stored(rows.select("x").distinct(), "fit-list")
    model = fit(fit_list, width, components)
    mean = np.array([float(Fraction(s, max(model.n, 1))) for s in model.sums])
    k, n, sums = len(model.values), model.n, model.sums
    project = _projector(mean, np.array(model.values), np.array(model.components).reshape(k, width))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            found = project(x) if k else np.empty((len(x), 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(_deviations(x, n, sums), pa.int64()),
                pa.array(list(found), pa.list_(pa.float64())),
            ], ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"vec_id {kind}, deviation long, whitened array<double>"), model


def _filled(x: Column, width: int) -> Column:
    short = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))
    return F.when(F.size(x) < width, short).otherwise(x)
