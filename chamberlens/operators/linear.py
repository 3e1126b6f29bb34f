"""Least squares on every prefix of the ranked variables, from one pass over the rows.

Each task keeps, per fold, the means and central products of its rows; Spark merges them
to one small table per fold. Training moments are those of the other folds put together,
and sweeping one variable after the other (Goodnight 1979) turns them into the
coefficients of all nested fits at once. A second pass over the left-out rows gives the
absolute errors, which no moments tell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

#: A pivot below this share of its variable's own sum of squares is rounding noise.
SINGULAR = 1e-10


@dataclass
class Moments:
    """Number, means and central products of rows (x1, ..., xp, y)."""

    n: float
    means: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> "Moments":
        means = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
        centred = rows - means
        return cls(len(rows), means, centred.T @ centred)

    def with_(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not n:
            return self
        offset = other.means - self.means
        products = self.products + other.products + np.outer(offset, offset) * (self.n * other.n / n)
        return Moments(n, self.means + offset * (other.n / n), products)


def nested_coefficients(moments: Moments) -> np.ndarray:
    """(size, coefficient): row n - 1 has the fit on the first n variables, zeros beyond.

    A variable that those before it determine gets no coefficient.
    """
    p = len(moments.means) - 1
    swept = moments.products.copy()
    found = np.zeros((p, p))
    used: list[int] = []
    for k in range(p):
        pivot = swept[k, k]
        if pivot > SINGULAR * moments.products[k, k]:
            row = swept[k] / pivot
            column = swept[:, k].copy()
            swept = swept - np.outer(column, row)
            swept[k], swept[:, k] = row, -column / pivot
            swept[k, k] = 1 / pivot
            used.append(k)
        found[k, used] = swept[used, p]
    return found


class NestedLeastSquares:
    """Plain least squares with intercept, for :func:`select.cumulative_selection`."""

    def __init__(self, target: str = "quality", features: str = "features"):
        self.target, self.features = target, features

    def prefix_metrics(self, dataset: DataFrame, fold: str, folds: list[int], sizes: list[int]) -> list[list[dict[str, float]]]:
        """r2, mae and rmse on each left-out fold, for the first n features of each size n.

        Rows with a null or NaN count nowhere. A left-out fold without rows has an r2 of 1
        and no errors, as there is nothing to miss.
        """
        rows = dataset.select(
            F.col(fold).cast("int").alias("fold"),
            F.concat(vector_to_array(self.features), F.array(F.col(self.target).cast("double"))).alias("row"),
        ).where(F.forall("row", lambda v: v.isNotNull() & ~F.isnan(v)))
        moments = fold_moments(rows)
        if not moments:
            return [[{"r2": 1.0, "mae": math.nan, "rmse": math.nan} for _ in folds] for _ in sizes]
        width = len(next(iter(moments.values())).means)
        nothing = Moments(0, np.zeros(width), np.zeros((width, width)))
        fits = {}
        for i in folds:
            training = nothing
            for other, held in sorted(moments.items()):
                training = training.with_(held) if other != i else training
            fits[i] = (training.means, nested_coefficients(training))
        absolute = _absolute_errors(rows, fits)
        found = []
        for size in sizes:
            scores = []
            for i in folds:
                means, coefficients = fits[i]
                held = moments.get(i, nothing)
                v = np.append(coefficients[size - 1], -1.0)
                sse = float(v @ held.products @ v + held.n * (v @ (held.means - means)) ** 2)
                sst = float(held.products[-1, -1])
                r2 = 1 - sse / sst if sst > 0 else float(sse == 0)
                mean = absolute[i][size - 1] / held.n if held.n else math.nan
                scores.append({"r2": r2, "mae": float(mean), "rmse": math.sqrt(max(sse, 0.0) / held.n) if held.n else math.nan})
            found.append(scores)
        return found


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def fold_moments(rows: DataFrame) -> dict[int, Moments]:
    """Moments per fold of (fold, row): one pass over the rows."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            values = _matrix(batch.column(1), batch.num_rows)
            for i in np.unique(fold).tolist():
                found = Moments.of(values[fold == i])
                held[i] = held[i].with_(found) if i in held else found
        for i, m in held.items():
            yield pa.RecordBatch.from_pydict({"fold": pa.array([i], pa.int32()), "n": [float(m.n)], "means": [m.means.tolist()], "products": [m.products.ravel().tolist()]})

    def merged(group: pa.Table) -> pa.Table:
        total = None
        for r in sorted(group.to_pylist(), key=lambda r: (r["means"], r["n"])):
            width = len(r["means"])
            found = Moments(r["n"], np.array(r["means"]), np.array(r["products"]).reshape(width, width))
            total = found if total is None else total.with_(found)
        return pa.table({"fold": group.column("fold").slice(0, 1), "n": [total.n], "means": [total.means.tolist()], "products": [total.products.ravel().tolist()]})

    schema = "fold int, n double, means array<double>, products array<double>"
    found = rows.mapInArrow(per_task, schema).groupBy("fold").applyInArrow(merged, schema).collect()  # one row per fold
    return {r["fold"]: Moments(r["n"], np.array(r["means"]), np.array(r["products"]).reshape(len(r["means"]), -1)) for r in found}


def _absolute_errors(rows: DataFrame, fits: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """Per left-out fold, the sum of absolute errors of every nested fit."""
    shared = rows.sparkSession.sparkContext.broadcast(fits)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            values = _matrix(batch.column(1), batch.num_rows)
            for i, (means, coefficients) in shared.value.items():
                centred = values[fold == i] - means
                errors = np.abs(centred[:, :-1] @ coefficients.T - centred[:, -1:]).sum(axis=0)
                held[i] = held.get(i, 0) + errors
        for i, errors in held.items():
            size = np.arange(len(errors), dtype=np.int32)
            yield pa.RecordBatch.from_pydict({"fold": pa.array(np.full(len(errors), i, np.int32)), "size": pa.array(size), "error": pa.array(errors)})

    summed = rows.where(F.col("fold").isin(*fits)).mapInArrow(per_task, "fold int, size int, error double").groupBy("fold", "size").agg(F.sum("error").alias("error"))
    found = {i: np.zeros(len(coefficients)) for i, (_, coefficients) in fits.items()}
    for r in summed.collect():  # folds x variables
        found[r["fold"]][r["size"]] = r["error"]
    return found
