"""One query per operator, as `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import views as v
from riskrank.functions.expressions import named
from riskrank.operators.asof import asof_latest_version
from riskrank.operators.cleaning import clean_entities, clean_reports, link_geography, load_demographics
from riskrank.operators.cohorts import build_cohort, query_per_split, select_labels
from riskrank.operators.disparity import crosstab, fairness_disparity, importance_matrix, top_features
from riskrank.operators.features import (
    assemble_features, compile_features, days_since_features, feature_block, latest_record_asof,
    static_features, window_features,
)
from riskrank.operators.geography import geo_demographics
from riskrank.operators.imputation import impute
from riskrank.operators.matrix import labeled, training_matrix
from riskrank.operators.metrics import metric_names, metrics_at_k, metrics_long, results_table
from riskrank.operators.modeling import expand_grid, feature_importance, fit_grid, model_table, score_models
from riskrank.operators.panel import categorize_codes, densify, pivot_wide, reporting_panel
from riskrank.operators.ranking import assign_surrogate_ids, rank_baseline, rank_scores, top_k_flags
from riskrank.operators.rollups import rollup_events, rollup_labels
from riskrank.operators.selection import (
    base_rate_series, baseline_models, pr_curve, results_over_time, select_best_models,
    select_best_models_multi,
)
from riskrank.operators.splits import fan_out, splits_frame, temporal_splits, union_splits
from riskrank.plans.analysis import run_analysis
from riskrank.plans.experiment import run_experiment
from riskrank.plans.preprocessing import run_preprocessing, run_steps
from riskrank.session import cut_lineage, scratch_path
from riskrank.sources.readers import load_zip_density
from riskrank.sources.sinks import write_csv, write_table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__.removesuffix("_rows")] = fn
    return fn


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that summation order cannot show; decimals as doubles."""
    return df.select(*[F.round(named(c).cast("double"), digits).alias(c) if t.startswith(("double", "decimal"))
                       else named(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- ingest and clean

@query
def load_demographics_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = v.table(spark, sf, "customer")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    income = pivot_wide(customers, ["c_nationkey"], "c_mktsegment", "c_acctbal", segments)
    block_groups = customers.select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("county"))
    return _rounded(load_demographics(
        block_groups, income.withColumnRenamed("c_nationkey", "county"),
        {"c_custkey": "block_group", "c_acctbal": "total_pop"}, income_columns=segments), 4)


@query
def load_zip_density_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "density")
    source = v.table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal",
        F.round(F.col("c_acctbal") / (F.col("c_nationkey") + 1), 6).alias("density"))
    write_csv(source, path)
    return load_zip_density(spark, path)


@query
def link_geography_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers, nations = v.table(spark, sf, "customer"), v.table(spark, sf, "nation")
    block_groups = customers.select(F.col("c_custkey").alias("tract"), F.col("c_nationkey").alias("county"),
                                    "c_acctbal")
    link = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("tract"), F.col("c_nationkey").alias("county"), F.col("n_name").alias("zip"))
    return link_geography(block_groups, link)


@query
def clean_entities_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean_entities(v.versions(spark, sf), region_column="status", region="F",
                          columns=["entity_key", "received", "seq", "priority"],
                          rename={"priority": "land_type"})


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    evaluations, versions = v.evaluations(spark, sf), v.versions(spark, sf)
    return asof_latest_version(
        evaluations, versions, event_key="handler", event_ts="started",
        version_key="entity_key", version_ts="received",
        event_order=[F.col(c).asc_nulls_last() for c in v.EVALUATION_ORDER],
        version_order=[F.col("seq").desc()]).drop("handler")


@query
def asof_latest_version_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf)


@query
def asof_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Each other event with the user's latest view before it, on microseconds."""
    events = v.table(spark, sf, "events")
    views = events.where("event_type = 'view'").select(
        F.col("user_id").alias("viewer"), F.col("ts").alias("seen_at"), F.col("event_id").alias("view_id"))
    acts = events.where("event_type <> 'view'").select("user_id", "ts", "event_id", "event_type")
    return asof_latest_version(
        acts, views, event_key="user_id", event_ts="ts", version_key="viewer", version_ts="seen_at",
        event_order=[F.col("event_id").asc()], version_order=[F.col("view_id").desc()], spread=True)


@query
def clean_reports_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = v.table(spark, sf, "lineitem")
    entities = v.versions(spark, sf).where("status = 'F'")
    return clean_reports(lines, entities, report_key="l_orderkey", entity_key="seq",
                         columns=["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"],
                         lower=["l_returnflag"])


@query
def clean_reports_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    return clean_reports(v.table(spark, sf, "customer"), v.versions(spark, sf), report_key="c_custkey",
                         entity_key="entity_key", columns=["c_custkey", "c_mktsegment"],
                         lower=["c_mktsegment"], fan_out=True)


def _entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    return assign_surrogate_ids(v.versions(spark, sf).withColumnRenamed("entity_key", "id_number"), ["id_number"])


@query
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_ids(spark, sf)


@query
def event_ids(spark: SparkSession, sf: str) -> DataFrame:
    return assign_surrogate_ids(v.versions(spark, sf), ["entity_key", "received"])


# ---------------------------------------------------------------- semantic layer

_ROLLUP = dict(key="entity_key", version="received", event_date="started",
               known_dates=["started", "determined"], amount="amount")


def _rollup_inputs(spark: SparkSession, sf: str):
    inspections = cut_lineage(_matched(spark, sf).select(
        "entity_key", "received", "started", "determined", "found", "complaint", "amount"))
    return (inspections, _entity_ids(spark, sf),
            assign_surrogate_ids(inspections, ["entity_key", "received"]))


@query
def rollup_events_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rollup_events(*_rollup_inputs(spark, sf), **_ROLLUP, violation=F.col("found") == "Y",
                         complaint=F.col("complaint") == "Y")


@query
def rollup_labels_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rollup_labels(*_rollup_inputs(spark, sf), **_ROLLUP)


@query
def categorize_codes_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = v.table(spark, sf, "part").select("p_partkey", "p_brand")
    return categorize_codes(parts, "p_brand", exact=v.CODES, prefixes=v.CODE_PREFIXES, default="others")


def _customer_year_flags(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = v.table(spark, sf, "lineitem"), v.table(spark, sf, "orders")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", F.year("l_shipdate").alias("cycle"), "l_returnflag")
            .agg(F.sum("l_quantity").alias("tons")))


@query
def densify_rows(spark: SparkSession, sf: str) -> DataFrame:
    return densify(_customer_year_flags(spark, sf), "o_custkey", {"cycle": None, "l_returnflag": ["A", "N", "R"]},
                   "tons")


@query
def densify_many_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every order next to every status: a dimension of more values than one task holds."""
    orders = v.table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    return densify(orders, "o_orderstatus", {"o_orderkey": None}, "price")


@query
def pivot_wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_wide(_customer_year_flags(spark, sf), ["o_custkey", "cycle"], "l_returnflag", "tons",
                      ["A", "N", "R"])


@query
def reporting_panel_rows(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = v.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id_number"))
    return reporting_panel(
        v.reports(spark, sf), assign_surrogate_ids(suppliers, ["id_number"]), key="reporter", cycle="cycle",
        code="code", tons="tons", exact=v.CODES, prefixes=v.CODE_PREFIXES, default="others",
        categories=v.CATEGORIES)


@query
def geo_demographics_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = v.table(spark, sf, "customer")
    facilities = customers.select(F.col("c_custkey").alias("id_number"), F.col("c_nationkey").alias("zip_code"))
    placed = v.blocks(spark, sf)
    return geo_demographics(
        facilities, placed.drop("zip"), placed.drop("population"), v.density(spark, sf),
        v.county_income(spark, sf), assign_surrogate_ids(facilities, ["id_number"]))


# ---------------------------------------------------------------- splits, cohorts, features, labels

@query
def temporal_splits_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The split plan with the number of events in each feature and label window."""
    splits = temporal_splits(v.TEMPORAL)
    events = v.entity_events(spark, sf).select("event_id", "event_date", "knowledge_date")
    counts = [fan_out(events, splits, knowledge_date="knowledge_date", window=w).groupBy("split_id").agg(
        F.count(F.lit(1)).alias(f"{w}_events")) for w in ("feature", "label")]
    return splits_frame(spark, splits).join(counts[0], "split_id", "left").join(counts[1], "split_id", "left")


@query
def fan_out_rows(spark: SparkSession, sf: str) -> DataFrame:
    splits = temporal_splits(v.TEMPORAL)
    events = v.entity_events(spark, sf).select("entity_id", "event_id", "event_date", "knowledge_date")
    return fan_out(events, splits, knowledge_date="knowledge_date").select(
        "split_id", "entity_id", "event_id", "event_date")


@query
def build_cohort_rows(spark: SparkSession, sf: str) -> DataFrame:
    return build_cohort(v.order_events(spark, sf), temporal_splits(v.ORDER_TEMPORAL))


@query
def cohort_at_feature_end(spark: SparkSession, sf: str) -> DataFrame:
    return build_cohort(v.order_events(spark, sf), temporal_splits(v.ORDER_TEMPORAL, "feature_end"))


@query
def cohort_user_query(spark: SparkSession, sf: str) -> DataFrame:
    v.order_events(spark, sf).createOrReplaceTempView("semantic_v0_events")
    text = ("select entity_id from semantic_{prefix}_events where found_violation > 0 "
            "group by entity_id having min(event_date) <= date '{as_of_date}'")
    return query_per_split(spark, text, temporal_splits(v.ORDER_TEMPORAL), {"as_of_date": "as_of"}, {"prefix": "v0"})


@query
def select_labels_rows(spark: SparkSession, sf: str) -> DataFrame:
    return select_labels(v.entity_labels(spark, sf), temporal_splits(v.TEMPORAL))


@query
def select_labels_half_open(spark: SparkSession, sf: str) -> DataFrame:
    return select_labels(v.entity_labels(spark, sf), temporal_splits(v.TEMPORAL), half_open=True)


@query
def latest_record_asof_rows(spark: SparkSession, sf: str) -> DataFrame:
    return latest_record_asof(v.daily_panel(spark, sf), temporal_splits(v.TEMPORAL), date_col="event_date")


@query
def static_features_rows(spark: SparkSession, sf: str) -> DataFrame:
    return static_features(v.profiles(spark, sf), columns=["c_acctbal", "c_nationkey"])


WINDOW_BLOCK = {
    "prefix": "ev",
    "aggregates": [
        {"column_name": "found_violation", "metrics": ["sum", "avg", "count"],
         "time_windows": ["all", "7 days", "14 days"]},
        {"column_name": "penalty_amount", "metrics": ["sum", "min", "max"], "time_windows": ["all", "1 week"]},
        {"column_name": "penalty_amount", "metrics": ["stddev"], "time_windows": ["all"]},
        {"column_name": "event_date", "metrics": ["datediff"]},
    ],
}


@query
def window_features_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(window_features(v.entity_events(spark, sf), temporal_splits(v.TEMPORAL),
                                    compile_features(WINDOW_BLOCK)))


VALUE_BLOCK = {
    "prefix": "ev",
    "aggregates": [
        {"column_name": "penalty_amount", "metrics": ["median", "percentile_90", "mode", "count_distinct"],
         "time_windows": ["all", "1 week"]},
        {"column_name": "found_violation", "metrics": ["median", "sum"], "time_windows": ["all"]},
    ],
}


@query
def window_features_median(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the distribution of values, from counts of values per date cell."""
    found = window_features(v.entity_events(spark, sf), temporal_splits(v.TEMPORAL), compile_features(VALUE_BLOCK))
    modes = [c for c in found.columns if "_mode_" in c]
    return _rounded(found.withColumns({c: F.col(c).cast("double") for c in modes}))


@query
def days_since_features_rows(spark: SparkSession, sf: str) -> DataFrame:
    return days_since_features(v.entity_events(spark, sf), temporal_splits(v.TEMPORAL),
                               ["event_date", "knowledge_date"], prefix="ev")


@query
def impute_rows(spark: SparkSession, sf: str) -> DataFrame:
    splits = temporal_splits(v.TEMPORAL)
    cohort = build_cohort(v.entity_events(spark, sf), splits)
    panel = latest_record_asof(v.daily_panel(spark, sf), splits, date_col="event_date").drop("event_date")
    wide = cohort.join(panel, ["split_id", "entity_id"], "left").select(
        "split_id", "entity_id", *[F.col("day_value").alias(f"as_{n}") for n in ("zero", "mean", "min")],
        *[F.col("day_events").alias(f"as_{n}") for n in ("inf", "max", "avg")])
    return _rounded(impute(wide, {"as_zero": "zero", "as_mean": "mean", "as_min": "min_noflag",
                                  "as_inf": "inf", "as_max": "max", "as_avg": "avg_noflag"},
                           groups=len(splits)))


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    splits, tables = temporal_splits(v.TEMPORAL), v.semantic_tables(spark, sf)
    blocks = [feature_block(spark, tables, splits, c) for c in (v.STATIC_BLOCK, v.PANEL_BLOCK, v.EVENT_BLOCK)]
    return assemble_features(build_cohort(tables["events"], splits), blocks, splits)


@query
def assemble_features_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_matrix(spark, sf))


@query
def union_splits_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return union_splits([orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("F", "O", "P")])


@query
def training_matrix_rows(spark: SparkSession, sf: str) -> DataFrame:
    labels = select_labels(v.entity_labels(spark, sf), temporal_splits(v.TEMPORAL))
    matrix = training_matrix(_matrix(spark, sf), labels, discard=["c_nationkey", "day_events"])
    return _rounded(labeled(matrix).select("split_id", "entity_id", "c_acctbal", "day_value",
                                           "events_sum_penalty_amount", "events_days_since_event_date", "label"))


# ---------------------------------------------------------------- modeling

def _document_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return training_matrix(v.documents(spark, sf), v.document_labels(spark, sf))


def _fitted(spark: SparkSession, sf: str, *kinds: str):
    grid = {name: options for name, options in v.GRID.items() if not kinds or name.rsplit(".", 1)[-1] in kinds}
    return fit_grid(_document_matrix(spark, sf), v.DOCUMENT_FEATURES, expand_grid(grid))


@query
def fit_grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every grid point and whether it could be fitted."""
    return model_table(spark, _fitted(spark, sf)).select(
        "model_id", "model_class", "model_kwargs", (F.col("fit_status") == "ok").alias("fitted"))


@query
def score_models_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per model: rows scored, entities among them, and scores that are no probability."""
    scores = score_models(_fitted(spark, sf), v.documents(spark, sf), v.DOCUMENT_FEATURES)
    valid = F.col("probability").between(0, 1)
    return scores.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("scored"), F.countDistinct("entity_id").alias("entities"),
        F.sum(F.when(valid, 0).otherwise(1)).alias("invalid"))


@query
def fit_grid_many(spark: SparkSession, sf: str) -> DataFrame:
    """A grid of 52 trees and regressions fitted together: per model, rows scored and scores that are no probability."""
    models = fit_grid(_document_matrix(spark, sf), v.DOCUMENT_FEATURES, expand_grid(v.MANY_GRID))
    scores = score_models(models, v.documents(spark, sf), v.DOCUMENT_FEATURES)
    return scores.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("scored"), F.sum((~F.col("probability").between(0, 1)).cast("int")).alias("invalid"))


def _exact(spark: SparkSession, sf: str, *kinds: str):
    """Models of one 0/1 feature on the labeled documents."""
    grid = {name: options for name, options in v.EXACT_GRID.items() if name.rsplit(".", 1)[-1] in kinds}
    matrix = training_matrix(v.long_documents(spark, sf), v.document_labels(spark, sf))
    return fit_grid(matrix, ["is_long"], expand_grid(grid))


def _exact_scores(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    models = _exact(spark, sf, *kinds)
    names = F.create_map(*[F.lit(x) for m in models for x in (m.model_id, m.kind)])
    scores = score_models(models, v.long_documents(spark, sf), ["is_long"])
    return scores.select("entity_id", names[F.col("model_id")].alias("model"), "probability")


@query
def logistic_model_rows(spark: SparkSession, sf: str) -> DataFrame:
    scores = _exact_scores(spark, sf, "LogisticRegression")
    return scores.withColumn("probability", F.round("probability", 4))


@query
def tree_model_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_exact_scores(spark, sf, "DecisionTreeClassifier", "GradientBoostingClassifier"))


@query
def boosting_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Two and three rounds of boosting on one 0/1 feature: log-odds start, Newton steps in the leaves."""
    matrix = training_matrix(v.long_documents(spark, sf), v.document_labels(spark, sf))
    models = fit_grid(matrix, ["is_long"], expand_grid({"GradientBoostingClassifier": {
        "n_estimators": [2, 3], "learning_rate": [0.5], "max_depth": [1]}}))
    rounds = F.create_map(*[F.lit(x) for m in models for x in (m.model_id, m.kwargs["n_estimators"])])
    scores = score_models(models, v.long_documents(spark, sf), ["is_long"])
    return _rounded(scores.select("entity_id", rounds[F.col("model_id")].cast("long").alias("n_estimators"), "probability"))


def _tree_scores(spark: SparkSession, rows: DataFrame, options: dict[str, list]) -> DataFrame:
    """(entity_id, x, the options, probability) of decision trees on one feature, as fitted on the rows they score."""
    models = fit_grid(rows.withColumn("split_id", F.lit(0)), ["x"], expand_grid({"DecisionTreeClassifier": options}))
    values = spark.createDataFrame([(m.model_id, *m.kwargs.values()) for m in models],
                                   ", ".join(["model_id string", *[f"{k} long" for k in options]]))
    scores = score_models(models, rows, ["x"], keys=["entity_id", "x"])
    return _rounded(scores.join(F.broadcast(values), "model_id").drop("model_id"))


@query
def deep_tree_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that alternate along the feature: each level of the tree takes one more customer off its lower end."""
    customers = v.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_custkey").cast("double").alias("x"),
        (F.col("c_custkey") % 2).cast("int").alias("label"))
    return _tree_scores(spark, customers, {"max_depth": [3, 35, 50, 100]})


@query
def tree_best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The one split of a stump on order prices: thousands of values, and every gap between two of them is a candidate."""
    orders = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("entity_id"), F.col("o_totalprice").cast("double").alias("x"),
        (F.col("o_orderpriority") < "3").cast("int").alias("label"))
    return _tree_scores(spark, orders, {"max_depth": [1]})


@query
def tree_full_depth(spark: SparkSession, sf: str) -> DataFrame:
    """A tree without limits gives every value of the feature its own share of positives."""
    lines = v.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("entity_id"), F.col("l_quantity").cast("double").alias("x"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))
    found = _tree_scores(spark, lines, {"max_depth": [None]})
    return found.groupBy("x").agg(F.countDistinct("probability").alias("scores"), F.max("probability").alias("probability"))


@query
def tree_min_samples_split(spark: SparkSession, sf: str) -> DataFrame:
    """One supplier against all others: a leaf of one row is allowed as long as the node that is split is large enough."""
    suppliers = v.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entity_id"), (F.col("s_suppkey") == 1).cast("double").alias("x"),
        (F.col("s_suppkey") % 3 == 1).cast("int").alias("label"))
    return _tree_scores(spark, suppliers, {"max_depth": [None], "min_samples_split": [2, 10, 1_000_000_000]})


@query
def forest_order(spark: SparkSession, sf: str) -> DataFrame:
    """Which group of documents a forest ranks higher: its scores depend on the samples drawn, their order does not."""
    scores = _exact_scores(spark, sf, "RandomForestClassifier").join(v.long_documents(spark, sf), "entity_id")
    groups = scores.groupBy("is_long").agg(F.avg("probability").alias("score"),
                                           F.countDistinct("probability").alias("scores"))
    other = groups.select((1 - F.col("is_long")).alias("is_long"), F.col("score").alias("other"))
    return groups.join(other, "is_long").select("is_long", "scores", (F.col("score") > F.col("other")).alias("higher"))


@query
def feature_importance_rows(spark: SparkSession, sf: str) -> DataFrame:
    models = _exact(spark, sf, "LogisticRegression", "DecisionTreeClassifier", "RandomForestClassifier",
                    "GradientBoostingClassifier")
    names = F.create_map(*[F.lit(x) for m in models for x in (m.model_id, m.kind)])
    found = feature_importance(models, ["is_long"], spark)
    return found.select(names[F.col("model_id")].alias("model"), "feature", F.round("importance", 3).alias("importance"))


@query
def rank_baseline_rows(spark: SparkSession, sf: str) -> DataFrame:
    ranked = rank_baseline(v.documents(spark, sf), "n_chars", sort="desc")
    return _rounded(ranked.select("entity_id", "n_chars", "rank", "probability", "prediction"), 9)


@query
def rank_baseline_asc(spark: SparkSession, sf: str) -> DataFrame:
    ranked = rank_baseline(v.documents(spark, sf), "n_words", sort="asc")
    return _rounded(ranked.select("entity_id", "n_words", "rank", "probability", "prediction"), 9)


KS = [50, 0.01, 0.1, 1.0]
METRICS = ["precision_score", "recall_score", "num_labeled_samples"]


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    return top_k_flags(rank_scores(v.document_scores(spark, sf)), KS)


@query
def top_k_flags_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(spark, sf)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics_at_k(rank_scores(v.document_scores(spark, sf)), v.document_labels(spark, sf), METRICS, KS)


@query
def metrics_at_k_rows(spark: SparkSession, sf: str) -> DataFrame:
    names = metric_names(METRICS, KS)
    return _rounded(metrics_long(_metrics(spark, sf), ["split_id", "model_id", "num_labeled_rows"], names))


def _document_models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(f"by_{c}", "RankBaseline", f'{{"column": "{c}"}}') for c in ("n_chars", "n_words")],
        "model_id string, model_class string, model_kwargs string")


@query
def results_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    return results_table(_metrics(spark, sf), _document_models(spark), metric_names(METRICS, KS))


# ---------------------------------------------------------------- analysis

def _experiment(spark: SparkSession, sf: str):
    return run_experiment(spark, v.EXPERIMENT, v.semantic_tables(spark, sf))


@query
def results_over_time_rows(spark: SparkSession, sf: str) -> DataFrame:
    return results_over_time(_experiment(spark, sf).results.where("role = 'test'"), ["precision_score_at_50", "num_labeled_samples_at_50"])


@query
def select_best_models_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(select_best_models(_experiment(spark, sf).results.where("role = 'test'"), "precision_score_at_50", "average", 2,
                                       min_support=20))


@query
def select_best_models_multi_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(select_best_models_multi(
        _experiment(spark, sf).results.where("role = 'test'"), ["precision_score_at_50", "recall_score_at_0.1"],
        ["min", "average", "last"], 2, min_support=14))


@query
def baseline_models_rows(spark: SparkSession, sf: str) -> DataFrame:
    return baseline_models(_experiment(spark, sf).results)


@query
def crosstab_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(crosstab(v.documents(spark, sf), _flags(spark, sf), v.DOCUMENT_FEATURES,
                             flag="prediction_at_0.1"))


def _disparity(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    long = F.col("n_lines") >= 20
    return _rounded(fairness_disparity(
        _flags(spark, sf), v.documents(spark, sf), v.document_labels(spark, sf), flag="prediction_at_0.1",
        feature="n_lines", positive=long, negative=~long, metric=metric))


@query
def fairness_disparity_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _disparity(spark, sf, "fdr")


@query
def fairness_disparity_tpr(spark: SparkSession, sf: str) -> DataFrame:
    return _disparity(spark, sf, "tpr")


@query
def pr_curve_rows(spark: SparkSession, sf: str) -> DataFrame:
    names = metric_names(METRICS[:2], KS)
    return _rounded(pr_curve(metrics_long(_metrics(spark, sf), ["split_id", "model_id"], names), "float"))


@query
def pr_curve_int(spark: SparkSession, sf: str) -> DataFrame:
    names = metric_names(METRICS[:2], KS)
    return _rounded(pr_curve(metrics_long(_metrics(spark, sf), ["split_id", "model_id"], names), "int"))


@query
def base_rate_series_rows(spark: SparkSession, sf: str) -> DataFrame:
    results = _experiment(spark, sf).results.where("role = 'test'")
    rate = base_rate_series(results, "precision_score_at_1.0")
    scaled = base_rate_series(results, "precision_score_at_1.0", metric="num_labeled_samples_at_50")
    return _rounded(rate.join(scaled.withColumnRenamed("base_rate", "scaled_rate"), "split_date"))


@query
def top_features_rows(spark: SparkSession, sf: str) -> DataFrame:
    importances = _experiment(spark, sf).importances.where("repeat = 0").drop("repeat")
    return top_features(importances, 2)


@query
def importance_matrix_rows(spark: SparkSession, sf: str) -> DataFrame:
    importances = _experiment(spark, sf).importances.where("repeat = 0")
    names = {m.model_id: m.kwargs["column"] for m in expand_grid(v.EXPERIMENT["model_config"])}
    return importance_matrix(importances, list(names)).withColumnsRenamed(names)


# ---------------------------------------------------------------- pipelines

@query
def run_preprocessing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return run_preprocessing(v.raw_tables(spark, sf), v.DOMAIN, outputs=["events"])["events"]


@query
def run_preprocessing_labels(spark: SparkSession, sf: str) -> DataFrame:
    return run_preprocessing(v.raw_tables(spark, sf), v.DOMAIN, outputs=["labels"])["labels"]


@query
def run_preprocessing_reporting(spark: SparkSession, sf: str) -> DataFrame:
    return run_preprocessing(v.raw_tables(spark, sf), v.DOMAIN, outputs=["reporting"])["reporting"]


@query
def run_preprocessing_acs(spark: SparkSession, sf: str) -> DataFrame:
    return run_preprocessing(v.raw_tables(spark, sf), v.DOMAIN, outputs=["acs"])["acs"]


@query
def run_preprocessing_persisted(spark: SparkSession, sf: str) -> DataFrame:
    """The labels of the layer in the catalog, read back by name."""
    run_preprocessing(v.raw_tables(spark, sf), v.DOMAIN, outputs=["labels"], persist=True, prefix="kept")
    return spark.table("semantic.kept_labels")


@query
def run_steps_user_sql(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"v0_orders": v.table(spark, sf, "orders")}
    steps = [
        ("{prefix}_open", "select o_custkey, o_totalprice from {prefix}_orders where o_orderstatus = :status"),
        lambda session, made: {"v0_sums": made["v0_open"].groupBy("o_custkey").agg(
            F.sum("o_totalprice").alias("total"))},
        ("{prefix}_result", "select o_custkey, round(total, 2) as total from {prefix}_sums where total > :least"),
    ]
    return run_steps(spark, steps, tables, prefix="v0", status="O", least=100000.0)["v0_result"]


@query
def write_read_table(spark: SparkSession, sf: str) -> DataFrame:
    """Written by status, one partition replaced, read back."""
    path = scratch_path(spark, "orders")
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, path, mode="fail", partition_by=["o_orderstatus"])
    shipped = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice"))
    return write_table(shipped, path, mode="replace_partitions", partition_by=["o_orderstatus"])


@query
def run_experiment_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _experiment(spark, sf).results.drop("experiment_id")


@query
def run_experiment_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_experiment(spark, sf).predictions.drop("experiment_id"), 9)


@query
def run_experiment_models(spark: SparkSession, sf: str) -> DataFrame:
    """The same experiment with fitted models beside the baselines."""
    cfg = copy.deepcopy(v.EXPERIMENT)
    cfg["model_config"]["LogisticRegression"] = {"penalty": ["l2"], "C": [1.0], "max_iter": [20]}
    cfg["model_config"]["tree.DecisionTreeClassifier"] = {"max_depth": [3]}
    return run_experiment(spark, cfg, v.semantic_tables(spark, sf)).results.drop("experiment_id")


@query
def run_analysis_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-tabs and disparity from the analysis of the baseline experiment."""
    tables = run_analysis(_experiment(spark, sf), metric="precision_score_at_50", n_models=2,
                          group_feature="c_acctbal", group_threshold=5000, min_support=20)
    crosstabs = tables["crosstab"].where("feature in ('events_sum_penalty_amount', 'c_acctbal')")
    disparity = tables["disparity_tpr"].select("split_id", "model_id", F.lit("tpr").alias("feature"),
                                               F.col("tpr_group1").alias("positive_mean"),
                                               F.col("tpr_group0").alias("negative_mean"),
                                               F.col("tpr").alias("normalized_difference"))
    return _rounded(crosstabs.unionByName(disparity))


def _analysis_query(name: str):
    """A query of one table of the analysis of the baseline experiment."""
    def rows(spark: SparkSession, sf: str) -> DataFrame:
        tables = run_analysis(_experiment(spark, sf), metric="precision_score_at_50", n_models=2,
                              group_feature="c_acctbal", group_threshold=5000, min_support=20)
        return _rounded(tables[name], 4 if name == "crosstab" else 6)

    return rows


for _name in ("results_over_time", "best_models", "best_results_over_time", "base_rate", "pr_curve", "top_features",
              "crosstab", "disparity_fdr", "disparity_tpr"):
    QUERIES[f"run_analysis_{_name}"] = _analysis_query(_name)
