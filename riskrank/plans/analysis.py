"""Post-hoc analysis of a finished experiment, as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import named
from riskrank.operators.disparity import crosstab, fairness_disparity, importance_matrix, top_features
from riskrank.operators.metrics import metrics_long
from riskrank.operators.selection import (
    base_rate_series, baseline_models, pr_curve, results_over_time, select_best_models,
)
from riskrank.plans.experiment import Experiment
from riskrank.presets import MIN_SUPPORT
from riskrank.session import broadcast_if_small
from riskrank.sources.sinks import write_csv


def run_analysis(
    experiment: Experiment,
    *,
    metric: str = "precision_score_at_600",
    n_models: int = 5,
    n_features: int = 12,
    group_feature: str | None = "mean_county_income",
    group_threshold: float = 75000,
    base_rate: str | float = "precision_score_at_1.0",
    include_baselines: bool = True,
    importances_of: str = "first",
    min_support: float = MIN_SUPPORT,
    display: Mapping[str, str] | None = None,
    output: str | None = None,
) -> dict[str, DataFrame]:
    """Series over time, best models, precision/recall curves, top features, cross-tabs, disparity.

    The experiment may have just run or be loaded from its tables.
    Curves, cross-tabs and disparity are taken from the latest test split; the
    cross-tabs and curves of the best models and, unless told otherwise, of the
    baselines.  Feature importances are of the models of the `first` repeat, or of
    the `last`.  Groups are told apart by `group_feature`, unless that is None.  With `output` every table is also exported as CSV.
    """
    if group_feature is not None and group_feature not in experiment.feature_columns:
        raise ValueError(f"{group_feature!r} is no feature of the experiment; group_feature=None leaves disparity out")
    support = f"num_labeled_samples_at_{metric.rsplit('_', 1)[-1]}"
    results = experiment.results.where(F.col("role") == "test")
    best = select_best_models(results, metric, "min", n_models, min_support=min_support)
    chosen = best.select("model_id")
    if include_baselines:
        chosen = chosen.union(baseline_models(results)).distinct()
    chosen = broadcast_if_small(chosen, experiment.grid_size, 64)
    last = max((s for s in experiment.splits if s.role == "test"), key=lambda s: s.label_start)
    latest = F.col("split_id") == last.split_id
    features = experiment.features.where(latest)
    labels = experiment.labels.where(latest)
    flags = experiment.predictions.where(latest)
    flag = f"prediction_at_{metric.rsplit('_at_', 1)[-1]}"
    last_results = results.where(F.col("repeat") == last.repeat).withColumn("split_id", F.lit(last.split_id))
    picked = last_results.join(chosen, "model_id", "left_semi")
    curve_names = [c for c in experiment.metric_columns if not c.startswith("num_labeled_samples")]
    shown = last.repeat if importances_of == "last" else min(s.repeat for s in experiment.splits)
    importances = experiment.importances.where(F.col("repeat") == shown).select("model_id", "feature", "importance").join(
        chosen, "model_id", "left_semi")

    tables = {
        "results_over_time": results_over_time(results, [metric, support]),
        "best_models": best,
        "best_results_over_time": results_over_time(
            results.join(best.select("model_id"), "model_id", "left_semi"), [metric, support]),
        "base_rate": base_rate_series(results, base_rate, metric=metric),
        "pr_curve": pr_curve(metrics_long(picked, ["split_id", "model_id"], curve_names), "float"),
        "top_features": top_features(importances, n_features, display),
        "crosstab": crosstab(features, flags.join(chosen, "model_id", "left_semi"),
                             experiment.feature_columns, flag=flag),
    }
    if group_feature is not None:
        rich = F.col(group_feature) >= group_threshold
        for name in ("fdr", "tpr"):
            tables[f"disparity_{name}"] = fairness_disparity(
                flags, features, labels, flag=flag, feature=group_feature,
                positive=rich, negative=~rich, metric=name,
            ).join(last_results.select("model_id", "model_class", named(metric).alias(metric)),
                "model_id")
    if output is not None:
        for name, df in tables.items():
            write_csv(df, f"{output}/{name}")
    return tables


def all_importances(experiment: Experiment, repeat: int) -> DataFrame:
    """Every feature's importance with one column per model of the repeat's grid."""
    of_repeat = experiment.importances.where(F.col("repeat") == repeat)
    ids = [r.model_id for r in experiment.models.where(
        (F.col("repeat") == repeat) & (F.col("fit_status") == "ok")).select("model_id").collect()]
    return importance_matrix(of_repeat, ids)
