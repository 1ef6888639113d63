"""Plan properties of every registered query."""

from __future__ import annotations

import pytest

from bindings.queries import QUERIES
from riskrank.session import entity_partitioning
from tests.helpers import plan_of

SF = "/root/testdata/sf0.001"
# a global rank gathers one count per range, a top-n over models gathers models, a grid its bounded dimension values
GATHERED = {"entity_ids", "event_ids", "rollup_events", "rollup_labels", "reporting_panel", "densify", "geo_demographics",
            "rank_baseline", "rank_baseline_asc", "run_preprocessing", "run_preprocessing_labels",
            "run_preprocessing_reporting", "run_preprocessing_acs", "densify_many_values"}
#: User SQL meets the table of dates, a row per split, in a join on `<=`: that small table is broadcast.
LATERAL = {"cohort_user_query"}


# these fit models or run whole experiments; their parts are covered by the other queries
HEAVY = {"fit_grid", "score_models", "logistic_model", "tree_model", "forest_order", "feature_importance", "results_over_time",
         "select_best_models", "select_best_models_multi", "baseline_models", "base_rate_series", "top_features",
         "importance_matrix", "deep_tree_chain", "tree_best_threshold", "tree_full_depth", "tree_min_samples_split",
         "boosting_rounds", "fit_grid_many", "run_experiment", "run_experiment_predictions", "run_experiment_models"} | {n for n in QUERIES if n.startswith("run_analysis")}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in HEAVY])
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and ("NestedLoopJoin" not in plan or name in LATERAL)
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert "collect_set" not in plan
    if "SinglePartition" in plan:
        assert name in GATHERED, plan


def test_user_sql_reads_its_table_once(spark):
    plan = plan_of(QUERIES["cohort_user_query"](spark, SF))
    assert plan.count("FileScan") == 1 and plan.count("NestedLoopJoin") == 1
    assert "LocalTableScan" in plan[plan.index("BroadcastExchange IdentityBroadcastMode"):]


@pytest.mark.parametrize("name, columns", [
    ("window_features", "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>"),
    ("build_cohort", "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>"),
    ("pivot_wide", "struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>"),
])
def test_scans_read_only_needed_columns(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF))
    assert columns in plan.replace("...", "")


def test_split_dates_filter_the_scan(spark):
    plan = plan_of(QUERIES["window_features"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts,2024-01-27T00:00)" in plan


def test_matrix_joins_reuse_the_partitioning_by_entity(spark):
    matrix = QUERIES["training_matrix"]
    with entity_partitioning(spark):
        kept = plan_of(matrix(spark, SF)).count("Exchange hashpartitioning(split_id")
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    shuffled = plan_of(matrix(spark, SF)).count("Exchange hashpartitioning(split_id")
    assert kept == 1 and shuffled > 1  # the one left is the statistics per split
