"""A whole experiment: splits, features, labels, models, scores, metrics."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.functions.expressions import named
from riskrank.operators.cohorts import build_cohort, query_per_split, select_labels
from riskrank.operators.features import assemble_features, feature_block, source_table
from riskrank.operators.matrix import training_matrix
from riskrank.operators.metrics import metric_names, metrics_at_k, results_table
from riskrank.operators.modeling import (
    Model, expand_grid, feature_importance, fit_grid, model_table, save_models, score_baselines,
    score_models,
)
from riskrank.operators.ranking import rank_scores, top_k_flags
from riskrank.operators.splits import TimeSplit, splits_frame, temporal_splits
from riskrank.session import broadcast_if_small, cut_lineage, delete_path, entity_partitioning, scratch_scope
from riskrank.sources.sinks import write_csv, write_table

# a ranking pools all rows of one role of one repeat
EVALUATION = ("repeat", "role")
ROW = ("split_id", "entity_id")
#: Written by experiment, under the output folder.
TABLES = ("matrix", "splits", "model_info", "importances", "results", "predictions")


@dataclass
class Experiment:
    """What an experiment leaves behind; the written tables have `experiment_id`."""

    experiment_id: str
    splits: list[TimeSplit]
    matrix: DataFrame
    models: DataFrame
    predictions: DataFrame
    results: DataFrame
    importances: DataFrame
    feature_columns: list[str]
    metric_columns: list[str]
    grid_size: int

    @property
    def features(self) -> DataFrame:
        return self.matrix.drop("label")

    @property
    def labels(self) -> DataFrame:
        return self.matrix.select(*ROW, "label").where("label is not null")


def build_matrix(
    spark: SparkSession, cfg: Mapping, tables: Mapping[str, DataFrame], *, prefix: str = "",
    cohort_as_of: str = "test_label_end",
) -> tuple[list[TimeSplit], DataFrame]:
    """Splits, and features with labels of every train and test split, lazily.

    Tables are the given frames, or else catalog tables under `prefix`.  Without
    their own `query` in the config (SQL text, or a function of session and splits),
    cohort and labels use the one-pass operators on the events and labels tables.
    Labels are joined here, while both sides are still partitioned by entity, and
    travel with the rows from now on.
    """
    splits = temporal_splits(cfg["temporal_config"], cohort_as_of)
    cohort_query = cfg.get("cohort_config", {}).get("query")
    label_query = cfg.get("label_config", {}).get("query")
    constants = {"prefix": prefix}
    if callable(cohort_query):
        cohort = cohort_query(spark, splits)
    elif cohort_query:
        cohort = query_per_split(spark, cohort_query, splits, {"as_of_date": "as_of"}, constants)
    else:
        cohort = build_cohort(source_table(spark, tables, "semantic.{prefix}_events", prefix), splits)
    if callable(label_query):
        labels = label_query(spark, splits)
    elif label_query:
        labels = query_per_split(spark, label_query, splits,
                                 {"start_date": "label_start", "end_date": "label_end"}, constants)
    else:
        labels = select_labels(source_table(spark, tables, "semantic.{prefix}_labels", prefix), splits)
    blocks = [feature_block(spark, tables, splits, c, prefix=prefix) for c in cfg["feature_config"]]
    return splits, training_matrix(assemble_features(cohort, blocks, splits), labels)


def _roles(spark: SparkSession, splits: Sequence[TimeSplit], evaluate_on: Sequence[str]) -> DataFrame:
    plan = splits_frame(spark, splits).select("split_id", *EVALUATION)
    return broadcast_if_small(plan.where(F.col("role").isin(*evaluate_on)), len(splits), 64)


def run_experiment(
    spark: SparkSession,
    cfg: Mapping,
    tables: Mapping[str, DataFrame],
    *,
    experiment_id: str | None = None,
    output: str | None = None,
    evaluate_on: Sequence[str] = ("train", "test"),
    parallelism: int = 4,
    prefix: str = "",
    cohort_as_of: str = "test_label_end",
) -> Experiment:
    """Run an experiment config over the semantic tables.

    The matrix of all splits is built in one plan and written once; each repeat fits
    its grid on its training splits; then all repeats are scored, ranked and measured
    together.  A repeat's training splits are pooled into one ranking, its test split
    is another.  Predictions of the test splits keep unlabeled rows; metrics use
    labeled rows only.  With `output` the tables are written there by experiment and
    split, after whatever the same experiment left there is deleted; without it they go to the
    shared folder.  A model whose repeat has NULL features in a split to be scored is
    reported as failed, with the columns; the others and the baselines go on.
    """
    experiment_id = experiment_id or f"{cfg['version']}_{cfg['experiment_name']}"
    if output is None:
        return _run(spark, cfg, tables, experiment_id, output, evaluate_on, parallelism, prefix, cohort_as_of)
    if not re.fullmatch(r"[\w.-]+", experiment_id):
        raise ValueError(f"{experiment_id!r} cannot name a folder")
    for name in (*TABLES, "models"):
        delete_path(spark, f"{output}/{name}/experiment_id={experiment_id}")
    with scratch_scope(spark):  # everything lasting is under `output`
        return _run(spark, cfg, tables, experiment_id, output, evaluate_on, parallelism, prefix, cohort_as_of)


def _null_features(matrix: DataFrame, columns: Sequence[str]) -> dict[int, set[str]]:
    """The feature columns of each split that are NULL somewhere: splits x features."""
    found = matrix.groupBy("split_id").agg(*[F.max(named(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    return {r["split_id"]: {c for i, c in enumerate(columns) if r[f"c{i}"]} for r in found.collect()}


def _run(spark, cfg, tables, experiment_id, output, evaluate_on, parallelism, prefix, cohort_as_of) -> Experiment:

    def keep(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        df = df.withColumn("experiment_id", F.lit(experiment_id))
        if output is None:
            return cut_lineage(df)
        written = write_table(df, f"{output}/{name}", mode="replace_partitions",
                              partition_by=["experiment_id", *by])
        return written.where(F.col("experiment_id") == experiment_id)

    splits, matrix = build_matrix(spark, cfg, tables, prefix=prefix, cohort_as_of=cohort_as_of)
    feature_columns = [c for c in matrix.columns if c not in (*ROW, "label")]
    with entity_partitioning(spark):
        matrix = keep(matrix, "matrix", ["split_id"])
    ks, metrics = cfg["eval_config"]["k"], cfg["eval_config"]["metrics"]
    names = metric_names(metrics, ks)

    grid = expand_grid(cfg["model_config"])
    nulls = _null_features(matrix, feature_columns) if any(not m.is_baseline for m in grid) else {}
    scored, infos, importances, usable = [], [], [], []
    for repeat in sorted({s.repeat for s in splits}):
        ids = {role: [s.split_id for s in splits if s.repeat == repeat and s.role == role]
               for role in ("train", "test")}
        models = fit_grid(matrix.where(F.col("split_id").isin(ids["train"])), feature_columns, grid,
                          parallelism=parallelism)
        wanted = [i for role in evaluate_on for i in ids[role]]
        missing = sorted(set().union(*(nulls.get(i, set()) for i in wanted)))
        for m in models:
            if missing and m.fitted is not None:
                m.fitted, m.fit_status = None, f"ValueError: NULL features in a split to be scored: {missing}"
        if output is not None:
            save_models(models, f"{output}/models/experiment_id={experiment_id}/repeat={repeat}")
        infos.append(model_table(spark, models).withColumn("repeat", F.lit(repeat)))
        importances.append(feature_importance(models, feature_columns, spark).withColumn("repeat", F.lit(repeat)))
        usable.append({m.model_id for m in models if m.fit_status == "ok" and m.is_baseline})
        if any(m.fitted is not None for m in models):
            # written before ranking, which reads its input twice: once to sample ranges
            scored.append(cut_lineage(score_models(models, matrix.where(F.col("split_id").isin(wanted)),
                                                   feature_columns, keys=(*ROW, "label"))))

    roles, group = _roles(spark, splits, evaluate_on), [*EVALUATION, "model_id"]
    ranked = []
    if scored:
        scores = reduce(DataFrame.unionByName, scored)
        ranked.append(rank_scores(scores.join(roles, "split_id"), group=group, tiebreak=["split_id"]))
    baselines = [Model(m.model_id, m.model_class, m.kwargs, fit_status="ok")
                 for m in grid if any(m.model_id in u for u in usable)]
    if baselines:
        ranked.append(score_baselines(baselines, matrix.join(roles, "split_id"), group=EVALUATION,
                                      carry=["split_id", "label"], tiebreak=["split_id"]))
    if not ranked:
        raise ValueError("no model could be fitted")
    columns = [*EVALUATION, *ROW, "model_id", "probability", "rank", "group_rows", "label"]
    ranking = reduce(DataFrame.unionByName, [r.select(*columns) for r in ranked])

    models, found = reduce(DataFrame.unionByName, infos), reduce(DataFrame.unionByName, importances)
    if output is not None:
        keep(splits_frame(spark, splits), "splits")
        models, found = keep(models, "model_info"), keep(found, "importances")
    dates = {s.repeat: s.label_start for s in splits if s.role == "test"}
    date_of = F.create_map(*[x for r, d in dates.items() for x in (F.lit(r), F.lit(d))])
    results = (results_table(metrics_at_k(ranking, None, metrics, ks, group=group),
                             models.where("fit_status = 'ok'")
                             .select("model_id", "model_class", "model_kwargs").distinct(), names)
               .withColumn("split_date", date_of[F.col("repeat")])
               .select("model_id", "model_class", "model_kwargs", *EVALUATION, "split_date",
                       "num_labeled_rows", *[named(n) for n in names]))
    results = keep(results, "results")
    if output is not None:
        write_csv(results, f"{output}/results_csv/{experiment_id}")
    predictions = top_k_flags(ranking.where("role = 'test'").drop("label", "role"), ks)
    return Experiment(experiment_id, splits, matrix, models, keep(predictions, "predictions", ["split_id"]),
                      results, found, feature_columns, names, len(grid))


def load_experiment(spark: SparkSession, output: str, experiment_id: str) -> Experiment:
    """A finished experiment from its written tables, for analysis without fitting again."""
    def table(name: str) -> DataFrame:
        df = spark.read.parquet(f"{output}/{name}/experiment_id={experiment_id}")
        return df.withColumn("experiment_id", F.lit(experiment_id))

    matrix, results, models = table("matrix"), table("results"), table("model_info")
    fields = list(TimeSplit.__dataclass_fields__)
    # the split plan and the grid are config-sized
    splits = [TimeSplit(*r) for r in table("splits").select(*fields).orderBy("split_id").collect()]
    return Experiment(
        experiment_id, splits, matrix, models, table("predictions"), results, table("importances"),
        [c for c in matrix.columns if c not in (*ROW, "label", "experiment_id")],
        [c for c in results.columns if "_at_" in c], models.select("model_id").distinct().count())
