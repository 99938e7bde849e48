"""Preference models of several samples, fitted together by Newton rounds on aggregated normal equations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks that add the sums of all other tasks; the driver gets one row per model of each.
ADDING_TASKS = 16

#: A task holds one matrix of this width squared per model.
MAX_FEATURES = 2_048

SUMS_SCHEMA = "model int, sums array<double>"


@dataclass(frozen=True)
class NestedFit:
    """One linear model per fraction, and the sums behind them; rows of the arrays are fractions."""

    fractions: tuple[float, ...]
    pairs: np.ndarray
    weights: np.ndarray
    gradient: np.ndarray
    difference_sums: np.ndarray
    square_sums: np.ndarray
    passes: int

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per fraction and feature; the size is a model parameter."""
        rows = [
            (f, i, int(self.pairs[k]), float(self.weights[k, i]), float(self.gradient[k, i]))
            + (float(self.difference_sums[k, i]), float(self.square_sums[k, i]))
            for k, f in enumerate(self.fractions)
            for i in range(self.weights.shape[1])
        ]
        schema = (
            "fraction double, feature int, train_pairs long, weight double, gradient double, "
            "difference_sum double, square_sum double"
        )
        return spark.createDataFrame(rows, schema)


def _sums_of_rows(weights: np.ndarray):
    """Per task and model: rows, loss, gradient and curvature at the weights, as one array."""
    models, width = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((models, 2 + width + width * width))
        for batch in batches:
            x = batch.column("difference").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            member = batch.column("member").to_numpy()
            for k in range(models):
                inside = x[(member >> k) & 1 == 1]
                margin = inside @ weights[k]
                wrong = np.exp(-np.logaddexp(0.0, margin))
                curved = inside * (wrong * (1.0 - wrong))[:, None]
                sums[k, 0] += len(inside)
                sums[k, 1] += np.logaddexp(0.0, -margin).sum()
                sums[k, 2 : 2 + width] -= wrong @ inside
                sums[k, 2 + width :] += (curved.T @ inside).ravel()
        yield _sum_rows(sums)

    return run


def _sum_rows(sums: np.ndarray) -> pa.RecordBatch:
    values = pa.ListArray.from_arrays(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1], sums.ravel())
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), values], names=["model", "sums"])


def _added(models: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((models, size))
        for batch in batches:
            values = batch.column("sums").flatten().to_numpy().reshape(-1, size)
            np.add.at(sums, batch.column("model").to_numpy(), values)
        yield _sum_rows(sums)

    return run


def _pass(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """One pass over the rows for all models."""
    models, width = weights.shape
    size = 2 + width + width * width
    sums = rows.mapInArrow(_sums_of_rows(weights), SUMS_SCHEMA)
    sums = sums.repartition(ADDING_TASKS).mapInArrow(_added(models, size), SUMS_SCHEMA)
    total = np.zeros((models, size))
    for row in sums.collect():
        total[row["model"]] += np.array(row["sums"])
    return total


def _membership(fractions: Sequence[float], column: str) -> Column:
    """Bit k is set if the row is in the sample of fraction k."""
    bits = [F.when(F.array_contains(column, float(f)), 1 << k).otherwise(0) for k, f in enumerate(fractions)]
    return sum(bits[1:], bits[0]).cast("long")


def fit_nested(
    sampled: DataFrame,
    fractions: Sequence[float],
    width: int,
    reg_param: float,
    max_passes: int = 50,
    tolerance: float = 1e-10,
) -> NestedFit:
    """Bradley-Terry weights for every fraction, each pass over the rows serving all of them.

    ``sampled`` has ``difference`` (an array of ``width`` numbers) and ``fractions`` (those whose sample holds the
    row). A model minimises mean(log(1 + exp(-w.x))) + reg_param / 2 * |s * w|^2, where s is the root mean square of a
    feature in its sample, so that turning a pair around or rescaling a feature changes nothing. A pass returns the
    sums at one weight vector per model; a Newton step that does not lower the objective is halved. Rounds end
    when no gradient (per scaled feature) exceeds ``tolerance``, and that gradient is part of the result. A fraction
    without rows and a feature without values have weight 0.
    """
    fractions = tuple(float(f) for f in fractions)
    if not 0 < len(fractions) < 63:
        raise ValueError("1 to 62 fractions")
    if not 0 < width <= MAX_FEATURES:
        raise ValueError(f"1 to {MAX_FEATURES} features")
    rows = sampled.select("difference", _membership(fractions, "fractions").alias("member")).where("member <> 0")
    models = len(fractions)
    at_zero = _pass(rows, np.zeros((models, width)))
    pairs = at_zero[:, 0]
    n = np.maximum(pairs, 1.0)
    first, second = _moments(at_zero, width)
    squares = 4.0 * np.diagonal(second, axis1=1, axis2=2)
    scale = np.sqrt(squares / n[:, None])
    unit = np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)

    point, step = np.zeros((models, width)), np.zeros((models, width))
    best = np.full(models, np.inf)
    gradient = np.zeros((models, width))
    open_models = np.ones(models, bool)
    sums, passes = at_zero, 1
    while True:
        trial = point + step
        raw_gradient, raw_curvature = _moments(sums, width)
        value = sums[:, 1] / n + reg_param / 2 * (trial**2).sum(axis=1)
        for k in np.flatnonzero(open_models):
            if not value[k] <= best[k] + 1e-14 * abs(best[k]):
                step[k] /= 2
                open_models[k] = bool(np.abs(step[k]).max() > 1e-15)
                continue
            point[k], best[k] = trial[k], value[k]
            gradient[k] = raw_gradient[k] * unit[k] / n[k] + reg_param * point[k]
            open_models[k] = bool(np.abs(gradient[k]).max() > tolerance)
            if open_models[k]:
                curvature = raw_curvature[k] * unit[k][:, None] * unit[k] / n[k] + reg_param * np.eye(width)
                step[k] = -np.linalg.lstsq(curvature, gradient[k], rcond=None)[0]
        step[~open_models] = 0.0
        if not open_models.any() or passes >= max_passes:
            break
        sums = _pass(rows, (point + step) * unit)
        passes += 1
    return NestedFit(fractions, pairs.astype(np.int64), point * unit, gradient, -2.0 * first, squares, passes)


def _moments(sums: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return sums[:, 2 : 2 + width], sums[:, 2 + width :].reshape(-1, width, width)
