from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from riskrank.operators.disparity import crosstab, fairness_disparity, importance_matrix, top_features
from riskrank.operators.selection import (
    base_rate_series, baseline_models, pr_curve, results_over_time, select_best_models, select_best_models_multi,
)
from tests.helpers import d, rows

RESULTS = "model_id string, model_class string, split_date date, num_labeled_rows long, precision_score_at_600 double, " \
          "num_labeled_samples_at_600 double, `precision_score_at_1.0` double"


@pytest.fixture()
def results(spark):
    return spark.createDataFrame([
        ("a", "x.Tree", d("2020-01-01"), 300, 0.5, 80.0, 0.1), ("a", "x.Tree", d("2021-01-01"), 300, 0.1, 80.0, 0.2),
        ("b", "x.RankBaseline", d("2020-01-01"), 300, 0.2, 80.0, 0.1), ("b", "x.RankBaseline", d("2021-01-01"), 300, 0.3, 90.0, 0.2),
        ("c", "x.Tree", d("2020-01-01"), 300, 0.9, 10.0, 0.1), ("c", "x.Tree", d("2021-01-01"), 300, 0.9, 100.0, 0.2),
        ("d", "x.Tree", d("2021-01-01"), 300, 0.2, 75.0, 0.2),
    ], RESULTS)


def test_best_models(results):
    metric = "precision_score_at_600"
    assert rows(select_best_models(results, metric, "min", 5), "position", "model_id", "value") == [
        (1, "b", 0.2), (2, "d", 0.2), (3, "a", 0.1), (4, "c", -1.0)]
    assert rows(select_best_models(results, metric, "average", 1), "model_id") == [("a",)]
    assert rows(select_best_models(results, metric, "last", 2), "model_id", "value") == [("b", 0.3), ("c", 0.9)]
    assert rows(select_best_models(results, metric, "min", 1, min_support=0), "model_id") == [("c",)]
    with pytest.raises(ValueError):
        select_best_models(results, metric, "median")


def test_best_models_over_a_grid_keeps_repeats(results):
    got = select_best_models_multi(results, ["precision_score_at_600"], ["min", "last", "average"], 2)
    assert rows(got, "criterion", "position", "model_id") == [
        ("average", 1, "a"), ("average", 2, "b"), ("last", 1, "c"), ("last", 2, "b"), ("min", 1, "b"), ("min", 2, "d")]


def test_baselines_series_and_rates(results):
    assert rows(baseline_models(results)) == [("b",)]
    series = results_over_time(results, ["precision_score_at_600", "precision_score_at_1.0"])
    assert series.count() == 14
    assert [r["split_date"] for r in series.collect()] == sorted(r["split_date"] for r in series.collect())
    assert rows(base_rate_series(results)) == [(d("2020-01-01"), 0.1), (d("2021-01-01"), 0.2)]
    assert rows(base_rate_series(results, 0.02)) == [(d("2020-01-01"), 0.02), (d("2021-01-01"), 0.02)]
    scaled = base_rate_series(results, metric="num_labeled_samples_at_600")
    assert rows(scaled) == [(d("2020-01-01"), pytest.approx(0.2)), (d("2021-01-01"), pytest.approx(0.4))]


def test_pr_curve(spark):
    long = spark.createDataFrame([
        (0, "m", "precision_score", "0.1", "float", 0.5), (0, "m", "recall_score", "0.1", "float", 0.2),
        (0, "m", "precision_score", "600", "int", 0.4), (0, "m", "recall_score", "600", "int", 0.6)],
        "split_id int, model_id string, metric string, k string, k_type string, value double")
    assert rows(pr_curve(long, "float")) == [(0, "m", 0.1, 0.5, 0.2)]
    assert rows(pr_curve(long, "int")) == [(0, "m", 600.0, 0.4, 0.6)]
    with pytest.raises(ValueError):
        pr_curve(long, "text")


def test_crosstab(spark):
    x = [1.0, 2.0, 4.0, 9.0, None]
    features = spark.createDataFrame([(0, i, v, 7) for i, v in enumerate(x)], "split_id int, entity_id long, x double, same int")
    flags = spark.createDataFrame([(0, "m", i, int(i >= 2)) for i in range(5)],
                                  "split_id int, model_id string, entity_id long, flag int")
    got = {r["feature"]: r for r in crosstab(features, flags, ["x", "same"], flag="flag").collect()}
    mean, std = statistics.mean(x[:4]), statistics.stdev(x[:4])
    assert (got["x"]["positive_mean"], got["x"]["negative_mean"]) == (6.5, 1.5)
    assert got["x"]["normalized_difference"] == pytest.approx(abs((6.5 - mean) / std - (1.5 - mean) / std))
    assert got["same"]["normalized_difference"] == 0.0


def test_disparity(spark):
    flags = spark.createDataFrame([(0, "m", i, int(i in (1, 2, 5, 6, 7))) for i in range(1, 12)]
                                  + [(0, "none", i, 0) for i in range(1, 12)],
                                  "split_id int, model_id string, entity_id long, `prediction_at_0.1` int")
    income = {1: 80.0, 2: 75.0, 3: 90.0, 4: 100.0, 5: 10.0, 6: 20.0, 7: 30.0, 8: 40.0, 9: None, 10: 85.0}
    features = spark.createDataFrame([(0, i, v) for i, v in income.items()], "split_id int, entity_id long, income double")
    label = {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 0, 7: 0, 8: 1, 9: 1, 11: 1}
    labels = spark.createDataFrame([(0, i, y) for i, y in label.items()] + [(0, 10, None)], "split_id int, entity_id long, label int")
    rich = F.col("income") >= 75
    args = dict(flag="prediction_at_0.1", feature="income", positive=rich, negative=~rich)
    # rich 1-4: flagged 1 (hit), 2 (miss), positives 1 and 3; poor 5-8: flagged 5 (hit), 6, 7, positives 5 and 8
    tpr = rows(fairness_disparity(flags, features, labels, metric="tpr", **args))
    assert tpr == [(0, "m", 0.5, 0.5, 1.0), (0, "none", 0.0, 0.0, None)]
    fdr = {r["model_id"]: r for r in fairness_disparity(flags, features, labels, metric="fdr", **args).collect()}
    assert fdr["m"]["fdr"] == pytest.approx(0.5 / (2 / 3)) and fdr["none"]["fdr"] is None
    with pytest.raises(ValueError):
        fairness_disparity(flags, features, labels, metric="other", **args)


def test_top_features(spark):
    importances = spark.createDataFrame([("m", "d008", 0.3), ("m", "x", 0.3), ("m", "y", None), ("n", "x", 1.0), ("n", "d008", 0.0)],
                                        "model_id string, feature string, importance double")
    assert rows(top_features(importances, 2)) == [
        ("m", 1, "d008", "Lead", 0.3), ("m", 2, "x", "x", 0.3), ("n", 1, "x", "x", 1.0), ("n", 2, "d008", "Lead", 0.0)]
    assert rows(top_features(importances, 1, {"x": "X!"}), "display_name") == [("X!",), ("d008",)]
    assert rows(importance_matrix(importances, ["n", "m"])) == [("d008", 0.0, 0.3), ("x", 1.0, 0.3), ("y", None, None)]
