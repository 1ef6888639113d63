"""Metrics at k on partially labeled rankings, and the results table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import named, ratio_or_zero
from riskrank.operators.ranking import cutoff
from riskrank.session import join_large

# a metric maps (flagged, label) columns of one labeled row to an aggregate
Metric = Callable[[Column, Column], Column]


def _hits(flagged: Column, label: Column) -> Column:
    return F.sum((flagged & (label == 1)).cast("int"))


def _precision(flagged: Column, label: Column) -> Column:
    return ratio_or_zero(_hits(flagged, label), F.sum(flagged.cast("int")))


def _recall(flagged: Column, label: Column) -> Column:
    return ratio_or_zero(_hits(flagged, label), F.sum((label == 1).cast("int")))


def _support(flagged: Column, label: Column) -> Column:
    return F.coalesce(F.sum(flagged.cast("int")).cast("double"), F.lit(0.0))


_METRICS: dict[str, Metric] = {
    "precision_score": _precision,
    "recall_score": _recall,
    "num_labeled_samples": _support,
}


def register_metric(name: str, metric: Metric) -> None:
    """Make a metric name usable in `metrics_at_k`."""
    _METRICS[name] = metric


def metric_names(metrics: Sequence[str], ks: Sequence[int | float]) -> list[str]:
    return [f"{m.rsplit('.', 1)[-1]}_at_{k}" for m in metrics for k in ks]


def metrics_at_k(
    ranked: DataFrame,
    labels: DataFrame | None,
    metrics: Sequence[str],
    ks: Sequence[int | float],
    *,
    group: Sequence[str] = ("split_id", "model_id"),
    keys: Sequence[str] = ("split_id", "entity_id"),
) -> DataFrame:
    """Wide metrics per group: `{metric}_at_{k}` and `num_labeled_rows`.

    Every row is ranked, but only rows labeled 0 or 1 count.  One aggregation with
    partial sums computes all metrics at all k from the rank; no flags are stored.
    `labels` joins on `keys`; None when `ranked` already carries `label`.
    A metric whose denominator is 0 is 0, and a group without labels keeps its row.
    """
    if labels is not None:
        ranked = join_large(ranked, labels.select(*keys, "label"), keys)
    known = F.coalesce(F.col("label").isin(0, 1), F.lit(False))
    label = F.when(known, F.col("label"))
    columns = []
    for m in metrics:
        build = _METRICS[m.rsplit(".", 1)[-1]]
        for k in ks:
            flagged = known & (F.col("rank") <= cutoff(k, F.col("group_rows")))
            columns.append(build(flagged, label))
    aliased = [c.alias(n) for c, n in zip(columns, metric_names(metrics, ks))]
    return ranked.groupBy(*group).agg(F.sum(known.cast("int")).alias("num_labeled_rows"), *aliased)


def metrics_long(wide: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(ids, metric, k, k_type, value) from the wide columns; `k_type` is int or float."""
    long = wide.unpivot(list(ids), [named(n) for n in names], "name", "value")
    k = F.substring_index("name", "_at_", -1)
    return long.select(
        *ids, F.substring_index("name", "_at_", 1).alias("metric"), k.alias("k"),
        F.when(k.contains("."), "float").otherwise("int").alias("k_type"), "value")


def results_table(
    wide: DataFrame, models: DataFrame, names: Sequence[str], *, digits: int = 4
) -> DataFrame:
    """Metrics rounded half to even, with each model's class and arguments."""
    info = models.select("model_id", "model_class", "model_kwargs")
    rest = [c for c in wide.columns if c not in ("model_id", *names)]
    return wide.join(info, "model_id").select(
        "model_id", "model_class", "model_kwargs", *rest,
        *[F.bround(named(n), digits).alias(n) for n in names])
