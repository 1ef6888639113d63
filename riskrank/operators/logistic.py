"""Logistic regression for all penalties and strengths of a grid at once.

Inputs are standardised.  Every step is one pass over the training rows, in which each task adds up loss, gradient and
Hessian of all grid points, so a grid takes as many Spark jobs as its slowest point alone.  The step itself, a proximal
Newton step with coordinate descent where there is an absolute penalty, is a small problem of features x features.  A
step that does not lower a point's objective is halved in the next pass, while the other points go on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

#: Numbers of all Hessians together that a task holds at once; grids beyond it are fitted in parts.
HESSIAN_NUMBERS = 4_000_000


@dataclass
class LogisticView:
    """A fitted point: weights on standardised inputs, and what standardises them."""

    coefficients: list[float]
    intercept: float
    means: list[float]
    scales: list[float]
    steps: int = 0

    def raw(self) -> tuple[list[float], float]:
        """Weights and intercept on the inputs as they come."""
        weights = [w / s for w, s in zip(self.coefficients, self.scales)]
        return weights, self.intercept - sum(w * m for w, m in zip(weights, self.means))


def _inputs(batch: pa.RecordBatch, features: int) -> np.ndarray:
    columns = [batch.column(f"x{i}") for i in range(features)]
    if any(c.null_count for c in columns):
        raise ValueError("NULL in a feature column")
    return np.stack([c.to_numpy(zero_copy_only=False) for c in columns]) if columns else np.zeros((0, batch.num_rows))


def _sums(train: DataFrame, weights: np.ndarray, means: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Per point: loss, gradient and Hessian (flat) summed over all rows."""
    points, width = weights.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((points, 1 + width + width * width))
        for batch in batches:
            x = np.ones((width, batch.num_rows))
            x[:-1] = (_inputs(batch, width - 1) - means[:, None]) / scales[:, None]
            y = batch.column("y").to_numpy()
            for i, z in enumerate(weights @ x):
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                total[i, 0] += np.sum(np.logaddexp(0.0, z) - y * z)
                total[i, 1:1 + width] += x @ (p - y)
                total[i, 1 + width:] += ((x * (p * (1 - p))) @ x.T).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(points), pa.int32()), pa.array([t.tobytes() for t in total])],
                                         names=["point", "sums"])

    def merge(key, table):
        total = sum(np.frombuffer(b) for b in sorted(table.column("sums").to_pylist()))
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])],
                                    names=["point", "sums"])

    schema = "point int, sums binary"
    found = train.mapInArrow(add, schema).groupBy("point").applyInArrow(merge, schema).collect()  # one row per point
    return np.stack([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["point"])])


def _direction(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """The step that minimises the quadratic model of the loss with both penalties; the last weight has none."""
    width = len(w)
    ridge = np.full(width, l2)
    ridge[-1] = 0.0
    curve = hessian + np.diag(ridge + 1e-12 * (1.0 + np.trace(hessian) / width))
    slope = gradient + ridge * w
    if l1 == 0.0:
        return -np.linalg.solve(curve, slope)
    d, pull, diagonal = np.zeros(width), np.zeros(width), np.diag(curve).copy()
    for _ in range(2000):
        most = 0.0
        for i in range(width):
            old, b = d[i], slope[i] + pull[i] - curve[i, i] * d[i]
            if i == width - 1:
                new = -b / diagonal[i]
            else:
                at = w[i] - b / diagonal[i]
                new = np.sign(at) * max(abs(at) - l1 / diagonal[i], 0.0) - w[i]
            if new != old:
                d[i] = new
                pull += curve[:, i] * (new - old)
                most = max(most, abs(new - old))
        if most < 1e-12:
            break
    return d


def fit_points(train: DataFrame, features: int, points: Sequence[tuple[float, float]], max_iter: int = 100,
               tolerance: float = 1e-9) -> list[LogisticView]:
    """One fit for each (strength, share of the absolute penalty); strengths weigh against the mean loss.

    `train` has `y` (0 or 1) and `x0`, `x1`, ... (double) and is read once per step.
    """
    numbers = [f"x{i}" for i in range(features)]
    row = train.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in numbers],
                    *[F.stddev_samp(c).alias(f"s_{c}") for c in numbers]).first()
    n, means = row["n"], np.array([row[f"m_{c}"] or 0.0 for c in numbers])
    scales = np.array([row[f"s_{c}"] or 0.0 for c in numbers])
    scales[scales == 0.0] = 1.0
    at_once = max(1, HESSIAN_NUMBERS // (features + 1) ** 2)
    out = []
    for start in range(0, len(points), at_once):
        out += _fit_part(train, n, means, scales, points[start:start + at_once], max_iter, tolerance)
    return out


def _fit_part(train, n, means, scales, points, max_iter, tolerance) -> list[LogisticView]:
    width = len(means) + 1
    best = np.zeros((len(points), width))
    tried, step = best.copy(), np.zeros_like(best)
    lowest, steps = np.full(len(points), np.inf), [0] * len(points)
    live = list(range(len(points)))
    for _ in range(max_iter):
        sums = _sums(train, tried[live], means, scales) / max(n, 1)
        going = []
        for i, s in zip(live, sums):
            strength, share = points[i]
            l1, l2 = strength * share, strength * (1.0 - share)
            w = tried[i, :-1]
            objective = s[0] + l1 * np.abs(w).sum() + 0.5 * l2 * (w * w).sum()
            steps[i] += 1
            if objective > lowest[i] + 1e-13 * (1.0 + abs(lowest[i])):
                step[i] /= 2.0  # too far
            else:
                gained, lowest[i], best[i] = lowest[i] - objective, objective, tried[i]
                step[i] = _direction(best[i], s[1:1 + width], s[1 + width:].reshape(width, width), l1, l2)
                if gained < 1e-14 * (1.0 + abs(objective)) and np.abs(step[i]).max() < 1e-6:
                    continue
            if np.abs(step[i]).max() > tolerance * (1.0 + np.abs(best[i]).max()):
                tried[i] = best[i] + step[i]
                going.append(i)
        live = going
        if not live:
            break
    return [LogisticView(best[i, :-1].tolist(), float(best[i, -1]), means.tolist(), scales.tolist(), steps[i])
            for i in range(len(points))]


def score_points(views: dict[str, LogisticView], features: DataFrame, columns: Sequence[str],
                 keys: Sequence[str]) -> DataFrame:
    """(keys, model_id, probability) of all points in one pass over the features."""
    wide = features.select(*keys, *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.select(*keys).schema.fields)
    settings = [(m, *v.raw()) for m, v in views.items()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _inputs(batch, len(columns))
            for model_id, weights, intercept in settings:
                z = np.full(batch.num_rows, intercept)
                for w, values in zip(weights, x):  # in this order for every row, so equal rows score the same
                    z += w * values
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(j) for j in range(len(keys))), pa.array([model_id] * batch.num_rows, pa.string()),
                     pa.array(p)], names=[*keys, "model_id", "probability"])

    return wide.mapInArrow(score, f"{schema}, model_id string, probability double")


_SAVED = "coefficients array<double>, intercept double, means array<double>, scales array<double>, steps int"


def save_point(view: LogisticView, spark: SparkSession, path: str) -> None:
    row = [(view.coefficients, view.intercept, view.means, view.scales, view.steps)]
    spark.createDataFrame(row, _SAVED).coalesce(1).write.mode("overwrite").parquet(f"{path}/logistic")


def load_point(spark: SparkSession, path: str) -> LogisticView | None:
    """A saved point, or nothing where none was saved."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/logistic")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return LogisticView(*spark.read.parquet(f"{path}/logistic").first())
