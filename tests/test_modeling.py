from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskrank.operators.modeling import (
    expand_grid, feature_importance, fit_grid, load_model, logistic_model, model_table, register_model, save_models,
    score_baselines, score_models, tree_model,
)
from tests.helpers import rows

GRID = {
    "x.LogisticRegression": {"penalty": ["l1", "l2", "none"], "C": [1.0], "max_iter": [30]},
    "y.DecisionTreeClassifier": {"max_depth": [2, None], "min_samples_split": [2], "min_weight_fraction_leaf": [0.0]},
    "y.RandomForestClassifier": {"n_estimators": [5], "max_depth": [2], "max_features": ["auto", None]},
    "y.GradientBoostingClassifier": {"n_estimators": [3], "learning_rate": [0.1], "subsample": [1], "max_depth": [1],
                                     "min_samples_leaf": [1], "max_features": ["log2"]},
    "z.RankBaseline": {"column": ["a", "b"], "sort": ["desc"]},
    "z.Unknown": {"p": [1]},
}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(8)
    data = []
    for i in range(300):
        a, b = rng.random(), rng.random()
        label = None if i % 5 == 0 else int(a + 0.2 * rng.random() > 0.6)
        data.append((0, i, a, b, label))
    return spark.createDataFrame(data, "split_id int, entity_id long, a double, b double, label int")


@pytest.fixture(scope="module")
def fitted(matrix):
    return fit_grid(matrix, ["a", "b"], expand_grid(GRID), parallelism=3)


def test_grid_is_a_product_with_stable_ids():
    models = expand_grid({"m.A": {"x": [1, 2], "y": [None, "s"]}, "m.B": {}})
    assert [m.kwargs for m in models] == [{"x": 1, "y": None}, {"x": 1, "y": "s"}, {"x": 2, "y": None}, {"x": 2, "y": "s"}, {}]
    assert [m.model_id for m in models] == [m.model_id for m in expand_grid({"m.A": {"x": [1, 2], "y": [None, "s"]}, "m.B": {}})]
    assert len({m.model_id for m in models}) == 5


def test_every_grid_point_has_a_status(spark, fitted):
    table = model_table(spark, fitted)
    assert table.count() == len(expand_grid(GRID))
    failed = table.where("fit_status <> 'ok'").collect()
    assert [r["model_class"] for r in failed] == ["z.Unknown"] and "KeyError" in failed[0]["fit_status"]
    deep = table.where("model_kwargs like '%\"max_depth\": null%'").first()
    assert '"maxDepth": null' in deep["spark_params"]


def test_scores(matrix, fitted):
    scores = score_models(fitted, matrix, ["a", "b"], models_per_pass=3)
    assert scores.count() == 300 * 8
    assert scores.where("probability < 0 or probability > 1 or probability is null").isEmpty()
    assert scores.select("model_id", "entity_id").distinct().count() == 2400
    again = score_models(fitted, matrix.repartition(7), ["a", "b"], models_per_pass=16)
    names = ["model_id", "entity_id", F.round("probability", 9)]
    assert rows(scores, *names) == rows(again, *names)
    by_class = {m.model_id: m.kind for m in fitted}
    means = matrix.join(scores, "entity_id").where("label is not null").groupBy("model_id").agg(
        F.avg(F.when(F.col("label") == 1, F.col("probability"))).alias("p"),
        F.avg(F.when(F.col("label") == 0, F.col("probability"))).alias("n")).collect()
    assert all(r["p"] > r["n"] for r in means if by_class[r["model_id"]] != "GradientBoostingClassifier")


def _rare(spark, groups=10, rows=4000):
    """Groups with few positives each: 0.5 % to 3.2 %."""
    data = [(0, g * rows + i, float(g), int(i < rows * (5 + 3 * g) // 1000)) for g in range(groups) for i in range(rows)]
    return spark.createDataFrame(data, "split_id int, entity_id long, g double, label int")


def test_trees_rank_rare_labels(spark):
    rare = _rare(spark).cache()
    models = fit_grid(rare, ["g"], expand_grid({
        "DecisionTreeClassifier": {"max_depth": [5]}, "RandomForestClassifier": {"n_estimators": [5], "max_depth": [5]}}))
    rates = {r["g"]: r["rate"] for r in rare.groupBy("g").agg(F.avg("label").alias("rate")).collect()}
    scores = score_models(models, rare, ["g"]).join(rare, ["split_id", "entity_id"])
    found = {(r["model_id"].split("_")[0], r["g"]): r["p"] for r in
             scores.groupBy("model_id", "g").agg(F.max("probability").alias("p")).collect()}
    assert all(found["DecisionTreeClassifier", g] == pytest.approx(rate) for g, rate in rates.items())
    assert len({found["RandomForestClassifier", g] for g in rates}) >= 8
    assert feature_importance(models, ["g"], spark).where("importance < 0.99").isEmpty()


def test_one_class_is_a_reported_failure(spark):
    rows = [(0, i, float(i), 0) for i in range(50)]
    data = spark.createDataFrame(rows, "split_id int, entity_id long, g double, label int")
    models = fit_grid(data, ["g"], expand_grid({"DecisionTreeClassifier": {"max_depth": [2]}, "LogisticRegression": {},
                                                "RankBaseline": {"column": ["g"]}}))
    assert [m.fit_status == "ok" for m in models] == [False, False, True] and "classes" in models[0].fit_status


def test_depths_beyond_spark_ml(spark):
    """A tree that needs 40 levels: every level splits one more power of two off."""
    rows = [(0, i, float(2.0 ** i), i % 2) for i in range(42)]
    data = spark.createDataFrame(rows, "split_id int, entity_id long, x double, label int")
    grid = expand_grid({"DecisionTreeClassifier": {"max_depth": [None, 100, 35, 3]}})
    models = fit_grid(data, ["x"], grid)
    assert [m.fit_status for m in models] == ["ok"] * 4
    found = {(r["model_id"], r["entity_id"]): r["probability"] for r in score_models(models, data, ["x"]).collect()}
    for m in models:
        kept = min(m.kwargs["max_depth"] or 42, 41)
        left = [i % 2 for i in range(kept, 42)]
        assert [found[m.model_id, i] for i in range(42)] == [i % 2 if i < kept else sum(left) / len(left) for i in range(42)]


def test_registered_spark_trees_beyond_the_limit_are_refused(spark):
    register_model("SparkTree", lambda rows, **kw: tree_model("DecisionTreeClassifier", **kw))
    rows = [(0, i, float(2.0 ** i), i % 2) for i in range(42)]
    data = spark.createDataFrame(rows, "split_id int, entity_id long, x double, label int")
    shallow = spark.createDataFrame(rows[:8], data.schema)
    grid = expand_grid({"SparkTree": {"max_depth": [None, 100, 3]}})
    assert [m.fit_status == "ok" for m in fit_grid(shallow, ["x"], grid)] == [True, True, True]
    for m in fit_grid(data, ["x"], grid):
        deep = m.fitted is None
        assert deep == ("cannot be grown" in m.fit_status) and not (deep and m.kwargs["max_depth"] == 3)


def test_baseline_scores(matrix, fitted):
    scores = score_baselines(fitted, matrix)
    assert scores.count() == 600
    top = scores.where("rank = 1").collect()
    best = {c: matrix.orderBy(F.col(c).desc()).first()["entity_id"] for c in ("a", "b")}
    assert {r["entity_id"] for r in top} == set(best.values()) and all(r["probability"] == 1.0 for r in top)


def test_importances(spark, fitted):
    found = feature_importance(fitted, ["a", "b"], spark)
    assert found.count() == 2 * 10
    assert found.where("importance < 0").isEmpty()
    kinds = {m.model_id: m for m in fitted}
    for r in found.groupBy("model_id").pivot("feature", ["a", "b"]).max("importance").collect():
        model = kinds[r["model_id"]]
        if model.is_baseline:
            assert (r["a"], r["b"]) == ((1.0, 0.0) if model.kwargs["column"] == "a" else (0.0, 1.0))
        elif model.kind == "LogisticRegression":
            assert r["a"] > r["b"]


def test_missing_features_fail_the_fit_but_not_the_grid(spark, matrix):
    broken = matrix.withColumn("a", F.when(F.col("entity_id") > 5, F.col("a")))
    models = fit_grid(broken, ["a", "b"], expand_grid({"DecisionTreeClassifier": {"max_depth": [2]}, "RankBaseline": {"column": ["a"]}}))
    assert models[0].fit_status != "ok" and models[0].fitted is None
    assert models[1].fit_status == "ok"
    assert score_models(models, matrix, ["a", "b"]).count() == 0


def test_baseline_on_an_unknown_column_is_reported(matrix):
    grid = {"RankBaseline": {"column": ["a", "nowhere"], "sort": ["asc", "up"]}}
    models = fit_grid(matrix, ["a", "b"], expand_grid(grid))
    assert [m.fit_status == "ok" for m in models] == [True, False, False, False]
    assert score_baselines(models, matrix).select("model_id").distinct().count() == 1


def test_saved_models_score_the_same(matrix, fitted, tmp_path):
    chosen = [m for m in fitted if m.fitted is not None][:4]
    save_models(chosen, str(tmp_path))
    loaded = [load_model(str(tmp_path), m) for m in chosen]
    names = ["model_id", "entity_id", F.round("probability", 9)]
    assert rows(score_models(chosen, matrix, ["a", "b"]), *names) == rows(score_models(loaded, matrix, ["a", "b"]), *names)


def test_parameter_mapping(spark):
    scaler, model = logistic_model(200, penalty="elasticnet", C=0.5, l1_ratio=0.3)
    assert model.getRegParam() == pytest.approx(0.01) and model.getElasticNetParam() == 0.3
    assert not model.getStandardization() and scaler.getWithMean() and scaler.getWithStd()
    assert logistic_model(10, penalty="none")[1].getRegParam() == 0.0
    tree = tree_model("DecisionTreeClassifier", max_depth=100, min_samples_split=5)[0]
    assert tree.getMaxDepth() == 30 and tree.getMinInstancesPerNode() == 3
    forest = tree_model("RandomForestClassifier", n_estimators=7, max_features="log2", min_samples_leaf=4)[0]
    assert forest.getNumTrees() == 7 and forest.getFeatureSubsetStrategy() == "log2" and forest.getMinInstancesPerNode() == 4
    boost = tree_model("GradientBoostingClassifier", n_estimators=9, learning_rate=0.5, subsample=0.1, max_features=None)[0]
    assert (boost.getMaxIter(), boost.getStepSize(), boost.getSubsamplingRate()) == (9, 0.5, 0.1)
    assert boost.getFeatureSubsetStrategy() == "all"
    with pytest.raises(ValueError):
        tree_model("Other")


def test_registered_class(matrix):
    register_model("Stump", lambda rows, **kw: tree_model("DecisionTreeClassifier", max_depth=1, **kw))
    models = fit_grid(matrix, ["a"], expand_grid({"my.Stump": {"min_samples_leaf": [5]}}))
    assert models[0].fit_status == "ok" and models[0].fitted.stages[-1].depth <= 1


def test_regularised_logistic_matches_a_direct_solution(spark):
    """One standardised feature: compare with Newton's method on the same objective."""
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.normal(size=400) * 3 + 5
    y = (x + rng.normal(size=400) * 3 > 5).astype(int)
    df = spark.createDataFrame([(0, i, float(a), int(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "split_id int, entity_id long, x double, label int")
    model = fit_grid(df, ["x"], expand_grid({"LogisticRegression": {"penalty": ["l2"], "C": [0.01], "max_iter": [200]}}))[0]
    z = (x - x.mean()) / x.std(ddof=1)
    w = np.zeros(2)
    design = np.stack([z, np.ones_like(z)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = 0.01 * design.T @ (p - y) + np.array([w[0], 0])
        hess = 0.01 * (design * (p * (1 - p))[:, None]).T @ design + np.diag([1, 0])
        w -= np.linalg.solve(hess, grad)
    assert model.fitted.coefficients[0] == pytest.approx(w[0], rel=1e-6)
