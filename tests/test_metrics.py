from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskrank.functions.expressions import named
from riskrank.operators.metrics import metric_names, metrics_at_k, metrics_long, register_metric, results_table
from riskrank.operators.ranking import rank_scores, top_k_flags
from tests.helpers import rows

METRICS = ["sklearn.metrics.precision_score", "sklearn.metrics.recall_score", "num_labeled_samples"]
KS = [3, 0.05, 0.5, 1.0]


def _population(seed=1, n=200):
    rng = random.Random(seed)
    return [(s, m, i, rng.randrange(8) / 8, rng.choice([None, 0, 1]))
            for s in (0, 1) for m in ("a", "b") for i in range(n)]


def _brute(data, k):
    order = sorted(data, key=lambda r: (-r[3], r[2]))
    n = int(len(order) * k) if isinstance(k, float) else k
    flagged = [r for r in order[:n] if r[4] is not None]
    hits, positives = sum(r[4] for r in flagged), sum(r[4] or 0 for r in order)
    return (hits / len(flagged) if flagged else 0.0, hits / positives if positives else 0.0, float(len(flagged)))


def test_metrics_match_brute_force(spark):
    data = _population()
    scores = spark.createDataFrame([r[:4] for r in data], "split_id int, model_id string, entity_id long, probability double")
    labels = spark.createDataFrame([(s, i, y) for s, m, i, _, y in data if m == "a" and y is not None],
                                   "split_id int, entity_id long, label int")
    by_label = {(s, i): y for s, m, i, _, y in data if m == "a"}
    wide = metrics_at_k(rank_scores(scores), labels, METRICS, KS).collect()
    assert len(wide) == 4
    for r in wide:
        mine = [(s, m, i, p, by_label[s, i]) for s, m, i, p, _ in data if (s, m) == (r["split_id"], r["model_id"])]
        assert r["num_labeled_rows"] == sum(x[4] is not None for x in mine)
        for k in KS:
            got = tuple(r[f"{m}_at_{k}"] for m in ("precision_score", "recall_score", "num_labeled_samples"))
            assert got == pytest.approx(_brute(mine, k))


def test_zero_denominators_and_unlabeled_groups(spark):
    ranked = spark.createDataFrame([(0, "m", 1, 1, 2, None), (0, "m", 2, 2, 2, 0), (1, "m", 1, 1, 1, None)],
                                   "split_id int, model_id string, entity_id long, rank long, group_rows long, label int")
    got = metrics_at_k(ranked, None, METRICS, [1])
    assert rows(got) == [(0, "m", 1, 0.0, 0.0, 0.0), (1, "m", 0, 0.0, 0.0, 0.0)]


def test_flags_agree_with_metrics(spark):
    data = _population(4)
    scores = spark.createDataFrame(data, "split_id int, model_id string, entity_id long, probability double, label int")
    ranked = rank_scores(scores)
    flags = top_k_flags(ranked, KS).where("label is not null")
    support = flags.groupBy("split_id", "model_id").agg(*[
        F.sum(named(f"prediction_at_{k}")).cast("double").alias(f"num_labeled_samples_at_{k}") for k in KS])
    wide = metrics_at_k(ranked, None, METRICS, KS)
    names = ["split_id", "model_id", *[named(f"num_labeled_samples_at_{k}") for k in KS]]
    assert rows(support, *names) == rows(wide, *names)


def test_long_form_and_results(spark):
    wide = spark.createDataFrame([(0, "m", 10, 0.03125, 0.5)],
                                 "split_id int, model_id string, num_labeled_rows long, `precision_score_at_0.1` double, precision_score_at_50 double")
    names = metric_names(["x.precision_score"], [0.1, 50])
    assert names == ["precision_score_at_0.1", "precision_score_at_50"]
    assert rows(metrics_long(wide, ["model_id"], names)) == [
        ("m", "precision_score", "0.1", "float", 0.03125), ("m", "precision_score", "50", "int", 0.5)]
    models = spark.createDataFrame([("m", "a.B", "{}")], "model_id string, model_class string, model_kwargs string")
    got = results_table(wide, models, names)
    assert rows(got) == [("m", "a.B", "{}", 0, 10, 0.0312, 0.5)]  # half to even


def test_own_metric(spark):
    register_metric("false_flags", lambda flagged, label: F.sum((flagged & (label == 0)).cast("int")))
    ranked = spark.createDataFrame([(0, "m", 1, 1, 2, 0), (0, "m", 2, 2, 2, 1)],
                                   "split_id int, model_id string, entity_id long, rank long, group_rows long, label int")
    assert rows(metrics_at_k(ranked, None, ["false_flags"], [1, 2]), "false_flags_at_1", "false_flags_at_2") == [(1, 1)]
    with pytest.raises(KeyError):
        metrics_at_k(ranked, None, ["unknown"], [1])
