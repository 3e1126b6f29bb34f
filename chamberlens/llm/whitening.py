"""Whitening of embeddings by the leading components of their covariance.

Spark makes the list of distinct integer vectors, its exact sums and its covariance; the
matrix, whose size is the square of the dimension and does not grow with the table, is
taken apart on the driver by spectrum slicing. The inertia of V - s*I, read off the pivots
of its LDLᵀ factors, tells how many eigenvalues exceed s: bisection on that count isolates
the k-th largest eigenvalue, Rayleigh quotient iteration finishes it at cubic speed, and
two more counts, just below and just above, certify that it is the k-th.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from chamberlens.llm.top_k import usable
from chamberlens.session import discard, materialize

#: Entries turned into doubles at once, whatever the size of an Arrow batch.
ENTRIES = 1 << 22
EPS = float(np.finfo(float).eps)
RESULT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """Components of the distinct integer vectors. ``vectors`` holds one unit eigenvector
    a row; where ``values`` is zero within rounding, that component has no whitened form."""

    scale: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    @property
    def whole(self) -> np.ndarray:
        """Which components have variance beyond rounding noise."""
        return self.values > len(self.sums) * EPS * self.trace


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every entry, as a long; beyond its range, the range's end."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def fit_whitening(vectors: DataFrame, vector_col: str = "embedding", scale: int = 256, components: int = 4) -> Whitening | None:
    """The leading components over each distinct integer vector once.

    Vectors that are null or hold a null or an entry that is not finite take no part. The
    dimension is the most frequent length among the distinct vectors (of equally frequent
    ones, the smaller); others take no part in the fit. None when nothing is left, or
    when the vectors are empty. Fewer dimensions than ``components`` give as many.

    The distinct vectors are written to the shared folder for three passes and removed.
    Tasks send one matrix of dimension x dimension each, which Spark sums.
    """
    x = vectors.where(usable(F.col(vector_col))).select(integers(F.col(vector_col), scale).alias("x"))
    fit_list, path = materialize(x.distinct(), "fit-list")
    try:
        sizes = fit_list.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
        if sizes is None or sizes["d"] == 0:
            return None
        d, n = sizes["d"], sizes["count"]
        fit_list = fit_list.where(F.size("x") == d)
        sums = _exact_sums(fit_list, d)
        mean = np.array([float(Fraction(s, n)) for s in sums])
        covariance = _summed(fit_list, _products(mean, np.eye(d)), d) / n
        covariance = (covariance + covariance.T) / 2
        values, basis = leading_pairs(covariance, min(components, d))
        model = Whitening(scale, n, tuple(sums), values, basis, float(np.trace(covariance)), 0.0)
        used = model.whole
        if not used.any():
            return model
        task = _products(mean, (basis[used] / np.sqrt(values[used])[:, None]).T)
        error = np.abs(_summed(fit_list, task, int(used.sum())) / n - np.eye(int(used.sum()))).max()
        return Whitening(scale, n, tuple(sums), values, basis, model.trace, float(error))
    finally:
        discard(vectors.sparkSession, path)


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector and component: the id, ``component`` (from 1, by falling
    eigenvalue), ``n`` (distinct vectors fitted), ``deviation`` (the exact sum over the
    dimensions of (n * x - S) squared), ``whitened`` (x less the mean, projected on the
    component, over the root of its eigenvalue), ``explained`` (the eigenvalue's share of
    the trace) and ``identity_error`` (of the whitened fit list's covariance).

    Rows that took no part in the fit for a null or an entry that is not finite are left
    out. A vector of another length than the model's keeps its rows, with ``deviation``
    and ``whitened`` null. So has ``whitened`` a component without variance, as when all
    vectors are equal; ``explained`` is null if there is no variance at all, and
    ``deviation`` where it exceeds 38 digits. Ids may be null or repeat; other columns are
    ignored. Without a model there are no rows.
    """
    ready = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), integers(F.col(vector_col), model.scale if model else 1).alias("x")
    )
    kind = ready.schema["id"].dataType.simpleString()
    if model is None:
        return ready.where("false").selectExpr(f"id AS `{id_col}`", *[f"CAST(NULL AS {t}) AS {c}" for c, t in _result_types()])
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    return ready.mapInArrow(_projected(shared), f"id {kind}, {RESULT}").withColumnRenamed("id", id_col)


def _result_types() -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in RESULT.split(", ")]


# Passes over the fit list


def _blocks(x: pa.Array, d: int) -> Iterator[np.ndarray]:
    """The vectors of an Arrow column, all of length d, as matrices of bounded size."""
    flat = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    step = max(1, ENTRIES // d)
    for at in range(0, len(flat), step):
        yield flat[at : at + step]


def _exact_sums(fit_list: DataFrame, d: int) -> list[int]:
    """Sums per dimension. A task adds the halves of 32 bits apart, so nothing overflows."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for x in _blocks(batch.column(0), d):
                high += (x >> 32).sum(0)
                low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low)], names=["i", "high", "low"])

    parts = fit_list.mapInArrow(halves, "i int, high bigint, low bigint")
    totals = parts.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")])
    return [(int(r["high"]) << 32) + int(r["low"]) for r in totals.orderBy("i").collect()]


def _products(mean: np.ndarray, onto: np.ndarray):
    """Task that centres its vectors, projects them and multiplies them with each other."""
    d, k = onto.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        plain = d == k and np.array_equal(onto, np.eye(d))
        for batch in batches:
            for x in _blocks(batch.column(0), d):
                centred = x - mean
                projected = centred if plain else centred @ onto
                total += projected.T @ projected
        rows = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), rows], names=["i", "products"])

    return work


def _summed(fit_list: DataFrame, task, k: int) -> np.ndarray:
    """The tasks' matrices added up by Spark."""
    cells = fit_list.mapInArrow(task, "i int, products array<double>").select("i", F.posexplode("products").alias("j", "v"))
    total = np.zeros((k, k))
    for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    return total


def _projected(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        d, k, mean = len(model.sums), len(model.values), model.mean
        roots = np.where(model.whole, np.sqrt(np.maximum(model.values, 0)), 1.0)
        explained = [v / model.trace if model.trace > 0 else None for v in model.values.tolist()]
        squares = sum(s * s for s in model.sums)
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            fits = pc.equal(pc.list_value_length(vectors), d)
            whitened = [None] * len(ids) * k
            deviations = [None] * len(ids)
            places = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
            at = 0
            for x in _blocks(vectors.filter(fits), d):
                y = (x - mean) @ model.vectors.T / roots
                norm, along = _exact_dots(x, model.sums)
                for row, q, b, projected in zip(places[at : at + len(x)], norm, along, y.tolist()):
                    deviations[row] = _digits(model.n * (model.n * q - 2 * b) + squares)
                    for j in range(k):
                        if model.whole[j]:
                            whitened[row * k + j] = projected[j]
                at += len(x)
            every = np.repeat(np.arange(len(ids)), k)
            size = len(every)
            columns = [
                ids.take(pa.array(every)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                pa.array([model.n] * size, pa.int64()),
                pa.array(deviations, pa.decimal128(38, 0)).take(pa.array(every)),
                pa.array(whitened, pa.float64()),
                pa.array(explained * len(ids), pa.float64()),
                pa.array([model.identity_error] * size, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *[c for c, _ in _result_types()]])

    return work


def _exact_dots(x: np.ndarray, sums: tuple[int, ...]) -> tuple[list[int], list[int]]:
    """x·x and x·S of every row as Python integers, in longs where those cannot overflow."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if most * max(most, *map(abs, sums)) * len(sums) >= 2**62:
        x, weights = x.astype(object), np.array(sums, object)
    else:
        weights = np.array(sums, np.int64)
    return [int(v) for v in (x * x).sum(1)], [int(v) for v in (x * weights).sum(1)]


def _digits(value: int) -> Decimal | None:
    return Decimal(value) if value < 10**38 else None


# Spectrum slicing


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` exceed ``shift``: the positive
    pivots of the LDLᵀ factors of matrix - shift * I, with pivots of order one and two
    chosen from the whole rest (Bunch and Parlett)."""
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        size = np.abs(rest)
        diagonal = size.diagonal().copy()
        np.fill_diagonal(size, 0.0)
        p, (q, r) = int(diagonal.argmax()), np.unravel_index(int(size.argmax()), size.shape)
        if diagonal[p] == 0 and size[q, r] == 0:
            return positive
        if diagonal[p] >= 0.6404 * size[q, r]:  # (1 + sqrt(17)) / 8 bounds the growth of the rest
            pivot = [p]
            positive += bool(rest[p, p] > 0)
        else:
            pivot = [int(q), int(r)]
            positive += 1  # a pivot of order two has one eigenvalue of either sign
        left = np.delete(np.arange(len(rest)), pivot)
        side = rest[np.ix_(left, pivot)]
        rest = rest[np.ix_(left, left)] - side @ np.linalg.solve(rest[np.ix_(pivot, pivot)], side.T)
    return positive


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and a unit eigenvector
    a row. Raises ArithmeticError if the counts do not certify a number."""
    d = len(matrix)
    size = float(np.abs(matrix).sum(1).max())
    if size == 0:
        return np.zeros(k), np.eye(d)[:k]
    slack = 8 * d * EPS * size
    values, basis = np.zeros(k), np.zeros((k, d))
    counts = {-size - slack: d, size + slack: 0}
    for number in range(1, k + 1):
        low = max(s for s, n in counts.items() if n >= number)
        high = min(s for s, n in counts.items() if n < number)
        value = None
        while value is None:
            n_low, n_high = counts[low], counts[high]
            isolated = n_low == number and n_high == number - 1
            if isolated or high - low <= slack:
                value, vector = _refined(matrix, low, high, basis[: number - 1], size)
                if not (above(matrix, value + slack) < number <= above(matrix, value - slack)):
                    value = None
                    if high - low <= slack:
                        raise ArithmeticError(f"eigenvalue {number} could not be certified")
            if value is None:
                middle = (low + high) / 2
                counts[middle] = above(matrix, middle)
                low, high = (middle, high) if counts[middle] >= number else (low, middle)
        values[number - 1], basis[number - 1] = value, vector
    return values, basis


def _refined(matrix: np.ndarray, low: float, high: float, found: np.ndarray, size: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval, at right angles to the
    vectors already found. The first steps keep the middle as shift until the quotient
    lies in the interval."""
    d = len(matrix)
    vector = _unit(np.random.default_rng(len(found)).standard_normal(d), found)
    shift, quotient = (low + high) / 2, None
    for step in range(60):
        vector = _unit(_solved(matrix, shift, vector, size), found)
        quotient = float(vector @ matrix @ vector)
        if np.linalg.norm(matrix @ vector - quotient * vector) <= 2 * EPS * size:
            break
        if step >= 2 and low <= quotient <= high:
            shift = quotient
    return quotient, vector


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, size: float) -> np.ndarray:
    for nudge in (0.0, EPS, 4 * EPS, 64 * EPS):
        try:
            solved = np.linalg.solve(matrix - (shift + nudge * size) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
            continue
        if np.isfinite(solved).all():
            return solved / np.abs(solved).max()
    return vector


def _unit(vector: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - found.T @ (found @ vector)
        vector = vector / np.linalg.norm(vector)
    return vector
