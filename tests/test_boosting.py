"""Boosted trees against a plain version, all models of a grid together."""

from __future__ import annotations

import random

import numpy as np
import pytest

from riskrank.operators import trees
from riskrank.operators.modeling import (
    expand_grid, feature_importance, fit_boosted, fit_grid, load_model, save_models, score_models,
)
from riskrank.operators.trees import Family, boost
from tests.helpers import rows
from tests.test_trees import frame, jobs_of, sample


def plain_leaves(x, r, h, depth, min_leaf):
    """Sets of rows with their Newton steps, by trying every split."""
    best = None
    for f in range(x.shape[1]) if depth else ():
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            low = x[:, f] <= a
            if min(low.sum(), (~low).sum()) < min_leaf:
                continue
            score = r[low].sum() ** 2 / low.sum() + r[~low].sum() ** 2 / (~low).sum()
            if best is None or score > best[0] + 1e-12:
                best = (score, low)
    if best is None:
        return np.full(len(r), r.sum() / h.sum())
    out = np.empty(len(r))
    for side in (best[1], ~best[1]):
        out[side] = plain_leaves(x[side], r[side], h[side], depth - 1, min_leaf)
    return out


def plain_boost(x, y, rounds, rate, depth, min_leaf):
    f = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        f = f + rate * plain_leaves(x, y - p, p * (1 - p), depth, min_leaf)
    return 1 / (1 + np.exp(-f))


GRID = {"GradientBoostingClassifier": {"n_estimators": [1, 4], "learning_rate": [0.1, 0.5], "max_depth": [1, 3],
                                       "min_samples_leaf": [1, 10], "max_features": [None]}}


@pytest.fixture(scope="module")
def data():
    return sample(11, n=130)


@pytest.fixture(scope="module")
def fitted(spark, data):
    return fit_grid(frame(spark, data), ["c0", "c1", "c2"], expand_grid(GRID))


def test_against_the_plain_version(spark, data, fitted):
    matrix = frame(spark, data)
    found = {(r["model_id"], r["entity_id"]): r["probability"] for r in score_models(fitted, matrix, ["c0", "c1", "c2"]).collect()}
    x, y = np.array([r[:-1] for r in data]), np.array([r[-1] for r in data], float)
    assert len({m.fitted.family for m in fitted}) == 8 and len(fitted) == 16
    for m in fitted:
        k = m.kwargs
        want = plain_boost(x, y, k["n_estimators"], k["learning_rate"], k["max_depth"], k["min_samples_leaf"])
        assert [found[m.model_id, i] for i in range(len(data))] == pytest.approx(want.tolist(), abs=1e-9)


def test_the_same_wherever_nodes_are_split(spark, data):
    train = spark.createDataFrame([(i * 7919, float(r[-1]), *r[:-1]) for i, r in enumerate(data)],
                                  "rid long, y double, x0 double, x1 double, x2 double").repartition(4)
    families = [Family("a", trees=2, max_depth=3, rate=0.3), Family("b", trees=1, max_depth=2, min_leaf=9, rate=0.3)]
    whole, start = boost(train, families, 3)
    parts, again = boost(train, families, 3, small=30)
    names = ["family", "tree", "node", "depth", "n", "feature", "threshold"]
    assert rows(whole, *names) == rows(parts, *names) and start == again
    assert [r[0] for r in rows(parts, "wy")] == pytest.approx([r[0] for r in rows(whole, "wy")], abs=1e-9)


def test_rounds_are_shared_and_subsampled(spark, data):
    matrix = frame(spark, data)
    grid = expand_grid({"GradientBoostingClassifier": {"n_estimators": [1, 2, 3], "subsample": [0.5], "max_depth": [2]}})
    fit_boosted(matrix, ["c0", "c1", "c2"], grid)
    assert len({m.fitted.family for m in grid}) == 1
    nodes = grid[0].fitted.nodes
    per_tree = {r["tree"]: r["n"] for r in nodes.where("depth = 0").collect()}
    assert set(per_tree) == {0, 1, 2} and all(35 < n < 95 for n in per_tree.values()) and len(set(per_tree.values())) > 1
    more = jobs_of(spark, lambda: fit_boosted(matrix, ["c0"], expand_grid(GRID)))
    one = jobs_of(spark, lambda: fit_boosted(matrix, ["c0"], expand_grid({"GradientBoostingClassifier": {
        "n_estimators": [4], "max_depth": [1]}})))
    assert more <= one + 2


def test_saved_parts_and_importances(spark, data, fitted, tmp_path, monkeypatch):
    matrix, columns = frame(spark, data), ["c0", "c1", "c2"]
    some = fitted[8:12]
    names = ["model_id", "entity_id", "probability"]
    before = rows(score_models(some, matrix, columns), *names)
    save_models(some, str(tmp_path))
    loaded = [load_model(str(tmp_path), m) for m in some]
    assert rows(score_models(loaded, matrix, columns), *names) == before
    monkeypatch.setattr(trees, "BROADCAST_NODES", 20)  # several passes, added up before the logistic function
    after = rows(score_models(some, matrix, columns), *names)
    assert [r[:2] for r in after] == [r[:2] for r in before]
    assert [r[2] for r in after] == pytest.approx([r[2] for r in before], abs=1e-12)
    sums = {}
    for r in feature_importance(some, columns, spark).collect():
        sums[r["model_id"]] = sums.get(r["model_id"], 0) + r["importance"]
        assert r["importance"] >= 0
    assert list(sums.values()) == pytest.approx([1.0] * 4)


def test_bad_settings(spark):
    matrix = frame(spark, sample(3, n=20))
    grid = expand_grid({"GradientBoostingClassifier": {"n_estimators": [0, 1], "loss": ["x"]}}) + expand_grid(
        {"GradientBoostingClassifier": {"subsample": [0.0, 1], "n_estimators": [1]}})
    assert [m.fit_status.split(":")[0] for m in fit_grid(matrix, ["c0"], grid)] == ["TypeError", "TypeError", "ValueError", "ok"]


def test_certain_rows_stay_finite(spark):
    rng = random.Random(2)
    data = [(float(i), rng.random(), int(i > 10)) for i in range(30)]
    matrix = frame(spark, data)
    grid = expand_grid({"GradientBoostingClassifier": {"n_estimators": [12], "learning_rate": [1.0], "max_depth": [2]}})
    scores = score_models(fit_grid(matrix, ["c0", "c1"], grid), matrix, ["c0", "c1"]).collect()
    assert all(0 <= r["probability"] <= 1 for r in scores) and {round(r["probability"]) for r in scores} == {0, 1}
