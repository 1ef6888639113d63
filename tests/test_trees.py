"""Exact trees against a plain recursive version, and the same trees wherever nodes are split."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskrank.operators import trees
from riskrank.operators.modeling import (
    expand_grid, feature_importance, fit_grid, fit_trees, load_model, save_models, score_models,
)
from riskrank.operators.trees import Family, TreeView, feature_count, grow, grow_small
from tests.helpers import rows


def plain_tree(data, depth=0, max_depth=None, min_split=2, min_leaf=1, least_weight=0.0):
    """Nested (feature, threshold, lower, upper) or a share, by trying every split of every feature."""
    n, p = len(data), sum(r[-1] for r in data)
    share = p / n
    if n < min_split or p in (0, n) or max_depth is not None and depth >= max_depth:
        return share
    best = None
    for f in range(len(data[0]) - 1):
        values = sorted({r[f] for r in data})
        for a, b in zip(values, values[1:]):
            low = [r for r in data if r[f] <= a]
            high = [r for r in data if r[f] > a]
            if min(len(low), len(high)) < max(min_leaf, least_weight):
                continue
            pl, ph = sum(r[-1] for r in low), sum(r[-1] for r in high)
            score = pl * pl / len(low) + ph * ph / len(high)
            if best is None or score > best[0]:
                best = (score, f, a + (b - a) / 2, low, high)
    if best is None:
        return share
    rules = (depth + 1, max_depth, min_split, min_leaf, least_weight)
    return (best[1], best[2], plain_tree(best[3], *rules), plain_tree(best[4], *rules))


def plain_score(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def sample(seed, n=120, features=3, values=9):
    rng = random.Random(seed)
    return [(*(float(rng.randrange(values)) for _ in range(features)), rng.randrange(2)) for _ in range(n)]


def frame(spark, data):
    width = len(data[0]) - 1
    names = ", ".join(f"c{i} double" for i in range(width))
    return spark.createDataFrame([(0, i, *r) for i, r in enumerate(data)], f"split_id int, entity_id long, {names}, label int")


@pytest.mark.parametrize("rules", [{}, {"max_depth": 3}, {"min_split": 11}, {"min_leaf": 6}, {"least_weight": 9.0}])
def test_small_nodes_against_the_plain_version(rules):
    for seed in range(4):
        data = sample(seed)
        x, y = np.array([r[:-1] for r in data]).T, np.array([float(r[-1]) for r in data])
        family = Family("f", max_depth=rules.get("max_depth"), min_split=rules.get("min_split", 2),
                        min_leaf=rules.get("min_leaf", 1))
        found = {r[0]: r for r in grow_small(family, 1, 0, x, np.ones(len(y)), y, rules.get("least_weight", 0.0))}

        def nested(node):
            _, _, n, _, positive, _, feature, threshold, _, lower, upper = found[node]
            return positive / n if feature < 0 else (feature, threshold, nested(lower), nested(upper))

        assert nested(1) == plain_tree(data, **rules)


@pytest.mark.parametrize("small", [7, 40, 10_000])
def test_the_same_trees_wherever_nodes_are_split(spark, small):
    data = sample(5, n=90)
    train = spark.createDataFrame([(i * 7919, float(r[-1]), *r[:-1]) for i, r in enumerate(data)],
                                  "rid long, y double, x0 double, x1 double, x2 double").repartition(6)
    families = [Family("plain"), Family("heavy", min_weight=0.08), Family("leafy", min_leaf=4, max_depth=5),
                Family("forest", trees=4, bootstrap=True, max_features=1)]
    found = sorted(tuple(r) for r in grow(train, families, 3, small).collect())
    # nodes keep their names, splits and gains; only the place of the split differs
    assert found == sorted(tuple(r) for r in grow(train.repartition(2), families, 3, 10_000).collect())
    assert len({r[1] for r in found if r[0] == "forest"}) == 4


def test_a_grid_of_views_equals_single_fits(spark):
    data = sample(7, n=150)
    matrix = frame(spark, data)
    columns = ["c0", "c1", "c2"]
    grid = expand_grid({"DecisionTreeClassifier": {"max_depth": [1, 4, None], "min_samples_split": [2, 30],
                                                   "min_weight_fraction_leaf": [0.0, 0.05]},
                        "RandomForestClassifier": {"n_estimators": [2, 5], "max_depth": [2, None],
                                                   "max_features": ["sqrt", None], "min_samples_split": [2, 20]}})
    together = fit_grid(matrix, columns, grid)
    assert {m.fit_status for m in together} == {"ok"} and len({id(m.fitted.nodes) for m in together}) == 1
    assert len({m.fitted.family for m in together}) == 4
    scores = rows(score_models(together, matrix, columns), "model_id", "entity_id", "probability")
    for i in (0, 5, 11, 14, 19, 27):
        alone = fit_grid(matrix, columns, [grid[i]])
        mine = rows(score_models(alone, matrix, columns), "model_id", "entity_id", "probability")
        assert mine == [s for s in scores if s[0] == grid[i].model_id]
    for m in together[:12]:
        k = m.kwargs
        tree = plain_tree(data, max_depth=k["max_depth"], min_split=k["min_samples_split"],
                          least_weight=k["min_weight_fraction_leaf"] * len(data))
        assert [s[2] for s in scores if s[0] == m.model_id] == pytest.approx([plain_score(tree, r) for r in data])


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, "count")
    work()
    spark.sparkContext.setJobGroup("", "")
    return len(tracker.getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_models(spark):
    matrix = frame(spark, sample(2, n=60)).cache()
    few = expand_grid({"DecisionTreeClassifier": {"max_depth": [2]}})
    many = expand_grid({"DecisionTreeClassifier": {"max_depth": [1, 2, 5, 10, 50, 100, None], "min_samples_split": [2, 5, 10],
                                                   "min_weight_fraction_leaf": [0.0, 0.01, 0.05]}})
    assert len(many) == 63
    assert jobs_of(spark, lambda: fit_trees(matrix, ["c0", "c1"], many)) <= jobs_of(
        spark, lambda: fit_trees(matrix, ["c0", "c1"], few))


def test_forests_over_several_broadcasts(spark, monkeypatch):
    matrix = frame(spark, sample(3))
    columns = ["c0", "c1", "c2"]
    models = fit_grid(matrix, columns, expand_grid({"RandomForestClassifier": {"n_estimators": [3, 9], "max_depth": [None]}}))
    whole = rows(score_models(models, matrix, columns), "model_id", "entity_id", F.round("probability", 12))
    monkeypatch.setattr(trees, "BROADCAST_NODES", 150)
    assert rows(score_models(models, matrix, columns), "model_id", "entity_id", F.round("probability", 12)) == whole
    monkeypatch.setattr(trees, "BROADCAST_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        score_models(models, matrix, columns)


def test_bootstrap_weights_are_poisson():
    rid = np.arange(200_000, dtype=np.int64)
    w = trees._weights(Family("f", bootstrap=True), 3, rid)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (w != trees._weights(Family("f", bootstrap=True), 4, rid)).mean() > 0.5


def test_importances_and_saved_trees(spark, tmp_path):
    rng = random.Random(1)
    data = [(float(a := rng.random()), rng.random(), 3.0, int(a > 0.4)) for _ in range(200)]
    matrix = frame(spark, data)
    columns = ["c0", "c1", "c2"]
    models = fit_grid(matrix, columns, expand_grid({"DecisionTreeClassifier": {"max_depth": [None]},
                                                    "RandomForestClassifier": {"n_estimators": [4], "max_features": [None]}}))
    found = {(r["model_id"], r["feature"]): r["importance"] for r in feature_importance(models, columns, spark).collect()}
    assert found[models[0].model_id, "c0"] == 1.0 and found[models[0].model_id, "c2"] == 0.0
    assert sum(v for (m, _), v in found.items() if m == models[1].model_id) == pytest.approx(1.0)
    save_models(models, str(tmp_path))
    loaded = [load_model(str(tmp_path), m) for m in models]
    assert all(isinstance(m.fitted, TreeView) for m in loaded)
    names = ["model_id", "entity_id", "probability"]
    assert rows(score_models(loaded, matrix, columns), *names) == rows(score_models(models, matrix, columns), *names)


def test_bad_settings_and_bad_data_are_reported(spark):
    matrix = frame(spark, sample(4, n=30))
    grid = expand_grid({"DecisionTreeClassifier": {"max_depth": [2], "min_samples_split": [1, 2]},
                        "RandomForestClassifier": {"splitter": ["x"]}})
    assert [m.fit_status.split(":")[0] for m in fit_grid(matrix, ["c0"], grid)] == ["ValueError", "ok", "TypeError"]
    broken = matrix.withColumn("c0", F.when(F.col("entity_id") > 3, F.col("c0")))
    assert "NULL" in fit_grid(broken, ["c0"], grid)[1].fit_status
    constant = fit_grid(matrix.withColumn("c0", F.lit(1.0)), ["c0"], [grid[1]])
    share = score_models(constant, matrix, ["c0"]).select("probability").distinct().collect()
    assert [r["probability"] for r in share] == [matrix.agg(F.avg("label")).first()[0]]


def test_feature_counts():
    assert [feature_count(s, 50) for s in ("auto", "sqrt", "log2", None, 0.5, 3)] == [7, 7, 5, None, 25, 3]


def test_thresholds_lie_between_the_values():
    assert trees._between(1.0, 2.0) == 1.5
    a = 1.0
    b = np.nextafter(a, 2.0)
    assert a <= trees._between(a, b) < b
