"""Results over time and model selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrank.functions.expressions import named, short_class
from riskrank.presets import MIN_SUPPORT

_CRITERIA = ("min", "average", "last")


def results_over_time(
    results: DataFrame, metrics: Sequence[str], *, date: str = "split_date"
) -> DataFrame:
    """Long series (model, class, date, metric, value) of an experiment, by date."""
    long = results.select("model_id", short_class(F.col("model_class")).alias("model_class"), date,
                          *[named(m).cast("double").alias(m) for m in metrics])
    return (long.unpivot(["model_id", "model_class", date], [named(m) for m in metrics], "metric", "value")
            .orderBy(date, "model_id", "metric"))


def _support_name(metric: str) -> str:
    return f"num_labeled_samples_at_{metric.rsplit('_', 1)[-1]}"


def _reduced(column: str, date: str, criterion: str) -> Column:
    if criterion == "min":
        return F.min(named(column))
    if criterion == "average":
        return F.avg(named(column))
    if criterion == "last":
        return F.max_by(named(column), date)
    raise ValueError(f"unknown criterion {criterion!r}")


def select_best_models_multi(
    results: DataFrame,
    metrics: Sequence[str],
    criteria: Sequence[str],
    n: int = 1,
    *,
    min_support: float = MIN_SUPPORT,
    date: str = "split_date",
) -> DataFrame:
    """The n best models for every metric and criterion, repeats kept.

    Each metric is reduced over time by its minimum, average or last value, and so
    is the number of labeled rows flagged at the same k; a model whose reduced
    support is below `min_support` gets -1.  Ties go to the smaller model id.
    All reductions come from one aggregation.
    """
    aggregates, entries = [], []
    for metric in metrics:
        for criterion in criteria:
            name = f"{metric}|{criterion}"
            value = _reduced(metric, date, criterion).cast("double")
            support = _reduced(_support_name(metric), date, criterion)
            aggregates.append(F.when(support < min_support, F.lit(-1.0)).otherwise(value).alias(name))
            entries.append(F.struct(F.lit(metric).alias("metric"), F.lit(criterion).alias("criterion"),
                                    named(name).alias("value")))
    per_model = results.groupBy("model_id").agg(*aggregates)
    long = per_model.select("model_id", F.explode(F.array(*entries)).alias("_e")).select("model_id", "_e.*")
    order = Window.partitionBy("metric", "criterion").orderBy(F.col("value").desc(), "model_id")
    return (long.withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= n)
            .select("metric", "criterion", "position", "model_id", "value"))


def select_best_models(
    results: DataFrame,
    metric: str,
    criterion: str = "min",
    n: int = 5,
    *,
    min_support: float = MIN_SUPPORT,
    date: str = "split_date",
) -> DataFrame:
    """The n best models by one metric reduced over time; see the multi form."""
    return select_best_models_multi(results, [metric], [criterion], n, min_support=min_support, date=date)


def baseline_models(results: DataFrame) -> DataFrame:
    """Ids of the models that are rank baselines."""
    return (results.where(short_class(F.col("model_class")) == "RankBaseline")
            .select("model_id").distinct())


def pr_curve(metrics: DataFrame, kind: str = "float", *, group: Sequence[str] = ("split_id", "model_id")) -> DataFrame:
    """(k, precision, recall) points per group, for counts (`int`) or proportions (`float`).

    `metrics` is the long form (group, metric, k, k_type, value).
    """
    if kind not in ("int", "float"):
        raise ValueError("kind must be 'int' or 'float'")
    points = metrics.where(F.col("k_type") == kind)

    def value(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    return (points.groupBy(*group, F.col("k").cast("double").alias("k"))
            .agg(value("precision_score").alias("precision"), value("recall_score").alias("recall"))
            .orderBy(*group, "k"))


def base_rate_series(
    results: DataFrame,
    base_rate: str | float = "precision_score_at_1.0",
    *,
    metric: str = "precision_score_at_600",
    date: str = "split_date",
) -> DataFrame:
    """The base rate per date: a constant, or a results column of the first model.

    For a support metric with a count k the rate is scaled by k over the number of
    labeled rows.
    """
    if not isinstance(base_rate, str):
        return results.select(date).distinct().withColumn("base_rate", F.lit(float(base_rate)))
    rate = F.min_by(named(base_rate), "model_id")
    if metric.startswith("num_labeled_samples_at_") and "." not in metric:
        k = float(metric.rsplit("_", 1)[-1])
        rate = F.lit(k) / F.min_by("num_labeled_rows", "model_id") * rate
    return results.groupBy(date).agg(rate.alias("base_rate")).orderBy(date)
