"""Who gets flagged: feature cross-tabs, group disparity and top features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrank.functions.expressions import named, ratio
from riskrank.presets import CROSSTAB_EPSILON, FEATURE_NAMES
from riskrank.session import join_large


def crosstab(
    features: DataFrame,
    flags: DataFrame,
    feature_columns: Sequence[str],
    *,
    flag: str,
    keys: Sequence[str] = ("split_id", "entity_id"),
    group: Sequence[str] = ("split_id", "model_id"),
) -> DataFrame:
    """Per group and feature: means among flagged and unflagged rows and how far apart they are.

    The distance is the absolute difference of the two means, each standardised by
    the mean and sample deviation over all rows.  All features are aggregated side
    by side in one pass; only the small result is turned to rows.
    """
    joined = join_large(features.select(*keys, *feature_columns),
                        flags.select(*dict.fromkeys([*keys, *group]), named(flag).alias("_flag")), keys, "inner")
    flagged = F.col("_flag") == 1
    aggregates = []
    for c in feature_columns:
        aggregates += [
            F.avg(F.when(flagged, F.col(c))).alias(f"{c}|pos"),
            F.avg(F.when(~flagged, F.col(c))).alias(f"{c}|neg"),
            F.avg(c).alias(f"{c}|all"), F.stddev_samp(c).alias(f"{c}|std"),
        ]
    wide = joined.groupBy(*group).agg(*aggregates)

    def distance(c: str) -> Column:
        spread = named(f"{c}|std") + CROSSTAB_EPSILON
        return F.abs((named(f"{c}|pos") - named(f"{c}|all")) / spread
                     - (named(f"{c}|neg") - named(f"{c}|all")) / spread)

    entries = [F.struct(F.lit(c).alias("feature"), named(f"{c}|pos").alias("positive_mean"),
                        named(f"{c}|neg").alias("negative_mean"),
                        distance(c).alias("normalized_difference")) for c in feature_columns]
    return (wide.select(*group, F.explode(F.array(*entries)).alias("_e")).select(*group, "_e.*")
            .orderBy(*group, F.col("normalized_difference").desc(), "feature"))


def fairness_disparity(
    flags: DataFrame,
    features: DataFrame,
    labels: DataFrame,
    *,
    flag: str,
    feature: str,
    positive: Column,
    negative: Column,
    metric: str = "fdr",
    keys: Sequence[str] = ("split_id", "entity_id"),
    group: Sequence[str] = ("split_id", "model_id"),
) -> DataFrame:
    """Ratio of a rate between two groups of entities, per model.

    `positive` and `negative` are conditions on the feature that place an entity in
    group 1 or 0; entities in neither, or without feature or label, do not count.
    `tpr`: recall of group 1 over recall of group 0; `fdr`: the same for the false
    discovery rate.  An empty denominator gives NULL.
    """
    if metric not in ("tpr", "fdr"):
        raise ValueError("metric must be 'tpr' or 'fdr'")
    member = F.when(negative, 0).when(positive, 1)
    grouped = (features.select(*keys, feature).withColumn("_member", member)
               .where("_member is not null").drop(feature))
    known = join_large(grouped, labels.where("label is not null").select(*keys, "label"), keys, "inner")
    joined = join_large(flags.select(*dict.fromkeys([*keys, *group]), named(flag).alias("_flag")),
                        known, keys, "inner")

    def rate(g: int) -> Column:
        mine = F.col("_member") == g
        hits = F.sum(F.when(mine & (F.col("_flag") == 1) & (F.col("label") == 1), 1).otherwise(0))
        if metric == "tpr":
            return ratio(hits, F.sum(F.when(mine, F.col("label")).otherwise(0)))
        return 1.0 - ratio(hits, F.sum(F.when(mine & (F.col("_flag") == 1), 1).otherwise(0)))

    rates = joined.groupBy(*group).agg(rate(1).alias(f"{metric}_group1"), rate(0).alias(f"{metric}_group0"))
    return rates.withColumn(metric, ratio(F.col(f"{metric}_group1"), F.col(f"{metric}_group0")))


def top_features(
    importances: DataFrame, n: int = 12, display: Mapping[str, str] | None = None
) -> DataFrame:
    """The n most important features per model with readable names, ties by feature name."""
    names = FEATURE_NAMES if display is None else display
    order = Window.partitionBy("model_id").orderBy(F.col("importance").desc_nulls_last(), "feature")
    shown = F.col("feature")
    if names:
        lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
        shown = F.coalesce(F.try_element_at(lookup, F.col("feature")), F.col("feature"))
    return (importances.withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= n)
            .select("model_id", "position", "feature", shown.alias("display_name"), "importance"))


def importance_matrix(importances: DataFrame, model_ids: Sequence[str]) -> DataFrame:
    """All importances with one row per feature and one column per model."""
    return importances.groupBy("feature").agg(*[
        F.max(F.when(F.col("model_id") == m, F.col("importance"))).alias(m) for m in model_ids])
