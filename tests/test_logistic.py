"""Logistic regressions of a grid in one go: optimality, agreement with single fits, and passes over the data."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest

from riskrank.operators import logistic
from riskrank.operators.logistic import LogisticView, fit_points
from riskrank.operators.modeling import (
    expand_grid, fit_grid, fit_logistic, load_model, logistic_model, plain_rows, register_model, save_models, score_models,
)
from tests.helpers import rows

GRID = {"LogisticRegression": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.001, 0.01, 0.1, 1, 10, 100],
                               "l1_ratio": [0.5], "max_iter": [1000]}}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)) * [1, 10, 0.1, 1] + [0, 5, 0, 2]
    x[:, 3] = x[:, 0] + 0.1 * rng.normal(size=500)
    y = (x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=500) > 0.7).astype(int)
    data = [(0, i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "split_id int, entity_id long, a double, b double, c double, d double, label int").repartition(5)


COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def fitted(matrix):
    return fit_grid(matrix, COLUMNS, expand_grid(GRID))


def test_every_point_is_optimal(matrix, fitted):
    """Gradients vanish, or stay within the absolute penalty where a weight is zero."""
    found = matrix.toPandas()
    x, y = found[COLUMNS].to_numpy(), found["label"].to_numpy()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    assert len(fitted) == 24 and {m.fit_status for m in fitted} == {"ok"}
    zeros = 0
    for m in fitted:
        w, b = np.array(m.fitted.coefficients), m.fitted.intercept
        p = 1 / (1 + np.exp(-(z @ w + b)))
        l1 = m.spark_params["regParam"] * m.spark_params["elasticNetParam"]
        slope = z.T @ (p - y) / len(y) + m.spark_params["regParam"] * (1 - m.spark_params["elasticNetParam"]) * w
        assert abs(np.mean(p - y)) < 1e-7
        assert np.abs(slope[w != 0] + l1 * np.sign(w[w != 0])).max(initial=0.0) < 1e-6
        assert np.abs(slope[w == 0]).max(initial=0.0) <= l1 + 1e-9
        zeros += (w == 0).sum()
    assert zeros > 5


def test_a_grid_equals_single_fits(matrix, fitted):
    grid = expand_grid(GRID)
    for i in (0, 3, 8, 14, 17, 20):
        alone = fit_grid(matrix, COLUMNS, [grid[i]])[0].fitted
        assert alone.coefficients == pytest.approx(fitted[i].fitted.coefficients, abs=1e-6)
        assert alone.intercept == pytest.approx(fitted[i].fitted.intercept, abs=1e-6)


def test_close_to_spark_ml(matrix, fitted):
    register_model("SparkLogistic", lambda rows, **kw: logistic_model(rows, **kw))
    for kind in ("l2", "elasticnet"):
        grid = {"SparkLogistic": {"penalty": [kind], "C": [0.1], "l1_ratio": [0.5], "max_iter": [1000]}}
        other = fit_grid(matrix, COLUMNS, expand_grid(grid))[0].fitted.stages[-1].coefficients
        mine = next(m for m in fitted if m.kwargs["penalty"] == kind and m.kwargs["C"] == 0.1).fitted
        assert mine.coefficients == pytest.approx(list(other), abs=1e-3)


def test_passes_do_not_grow_with_the_points(matrix, monkeypatch):
    passes, sums = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *a: passes.append(len(a[1])) or sums(*a))
    grid = expand_grid(GRID)
    fit_logistic(matrix, COLUMNS, grid, 500)
    together = len(passes)
    assert passes[0] == 19  # without a penalty, strengths are one point
    assert together == max(m.fitted.steps for m in grid)
    monkeypatch.setattr(logistic, "HESSIAN_NUMBERS", 50)  # a few points at once
    parts = expand_grid(GRID)
    fit_logistic(matrix, COLUMNS, parts, 500)
    assert [m.fitted.coefficients for m in parts] == [pytest.approx(m.fitted.coefficients, abs=1e-7) for m in grid]


def test_a_step_too_far_is_halved(spark):
    """Newton's method alone runs away from zero on these rows."""
    rng = random.Random(0)
    data = [(i, float(i % 2), (1.0 if i % 2 else -1.0) * 10 ** rng.uniform(0, 3)) for i in range(60)] + [(99, 1.0, -2.0)]
    train = spark.createDataFrame(data, "rid long, y double, x0 double")
    for strength, share in ((1e-4, 0.0), (1e-4, 1.0)):
        point = fit_points(train, 1, [(strength, share)])[0]
        z = (np.array([r[2] for r in data]) - point.means[0]) / point.scales[0]
        y = np.array([r[1] for r in data])
        p = 1 / (1 + np.exp(-(z * point.coefficients[0] + point.intercept)))
        w = point.coefficients[0]
        slope = (z * (p - y)).mean() + strength * ((1 - share) * w + share * np.sign(w))
        assert abs(slope) < 1e-6 and point.steps < 60


def test_constant_columns_and_separable_rows(spark):
    data = [(i, float(i > 20), float(i), 3.0) for i in range(40)]
    train = spark.createDataFrame(data, "rid long, y double, x0 double, x1 double")
    point = fit_points(train, 2, [(0.0, 0.0)], max_iter=25)[0]
    assert point.coefficients[1] == 0.0 and point.coefficients[0] > 5 and np.isfinite(point.intercept)


def test_saved_and_scored(spark, matrix, fitted, tmp_path):
    some = fitted[::7]
    save_models(some, str(tmp_path))
    loaded = [load_model(str(tmp_path), m) for m in some]
    assert all(isinstance(m.fitted, LogisticView) for m in loaded)
    names = ["model_id", "entity_id", "probability"]
    before = rows(score_models(some, matrix, COLUMNS), *names)
    assert rows(score_models(loaded, matrix.repartition(3), COLUMNS), *names) == before
    assert len(before) == 500 * len(some) and all(0 < p < 1 for *_, p in before)


def test_bad_points_are_reported(matrix):
    grid = expand_grid({"LogisticRegression": {"penalty": ["l2", "l9"], "C": [1.0, -1.0]}, "a.LogisticRegression": {"dual": [True]}})
    found = [m.fit_status.split(":")[0] for m in fit_grid(matrix, COLUMNS, grid)]
    assert found == ["ok", "ValueError", "KeyError", "ValueError", "TypeError"]
    broken = matrix.selectExpr("split_id", "entity_id", "if(entity_id > 9, a, null) as a", "label")
    assert "NULL" in fit_grid(broken, ["a"], grid[:1])[0].fit_status


def test_rows_keep_their_number(matrix):
    a = sorted(r["rid"] for r in plain_rows(matrix, COLUMNS).collect())
    assert a == sorted(r["rid"] for r in plain_rows(matrix.repartition(2), COLUMNS).collect()) and len(set(a)) == 500
    assert json.dumps(a)
