"""Ready experiment configs: the full model grid, a smoke run, and an interpretable one."""

from __future__ import annotations

# --- fixed values: time plan, features and grids of the standard experiments ---
TEMPORAL = {
    "feature_start_time": "2001-01-01", "feature_duration": "10 years", "label_duration": "1 year",
    "feature_aod_interval": "1 year", "train_repeat_interval": "1 year", "num_train_repeat": 5,
}
WINDOWS = ["all", "1 year", "2 years", "5 years"]
DEMOGRAPHIC_COLUMNS = ["zip_population", "county_population", "zip_density_sq_miles", "mean_county_income"]
BASELINE_COLUMNS = ["events_sum_penalty_amount", "events_sum_found_violation", "events_days_since_event_date"]
METRICS = ["precision_score", "recall_score", "num_labeled_samples"]
PROPORTIONS = [0.01, 0.02, 0.03, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7,
               0.75, 0.8, 0.85, 0.9, 0.95, 1.0]
GRID = {
    "RankBaseline": {"column": BASELINE_COLUMNS},
    "LogisticRegression": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.001, 0.01, 0.1, 1, 10, 100],
                           "l1_ratio": [0.5], "max_iter": [1000]},
    "DecisionTreeClassifier": {"max_depth": [1, 2, 5, 10, 50, 100, None], "min_samples_split": [2, 5, 10, 20],
                               "min_weight_fraction_leaf": [0.0, 0.01, 0.025, 0.05]},
    "RandomForestClassifier": {"n_estimators": [100, 1000], "max_depth": [1, 2, 5, 10, 50, 100, None],
                               "max_features": ["auto", "sqrt", "log2", None], "min_samples_split": [2, 5, 10, 20]},
    "GradientBoostingClassifier": {"n_estimators": [100, 1000], "learning_rate": [0.01, 0.1, 0.5],
                                   "subsample": [0.1, 1], "min_samples_leaf": [1, 10], "max_depth": [1, 5, 10],
                                   "max_features": ["auto", "sqrt", "log2", None]},
}
SMOKE_GRID = {"RandomForestClassifier": {"n_estimators": [100], "max_depth": [1, 2], "max_features": ["auto"],
                                         "min_samples_split": [2, 10]}}
INTERPRETABLE_GRID = {"RandomForestClassifier": {"n_estimators": [100], "max_depth": [10], "max_features": ["log2"],
                                                 "min_samples_split": [5]}}


def _features(windows: list[str] | None, violation_average: str | None) -> list[dict]:
    """Demographics, the reporting panel, and event aggregates over the given windows."""
    def aggregate(column: str, metrics: list[str]) -> dict:
        return {"column_name": column, "metrics": metrics, **({"time_windows": list(windows)} if windows else {})}

    fills = {"sum": "zero", "datediff": "inf", **({"avg": violation_average} if violation_average else {})}
    return [
        {"prefix": "acs", "from_table": "semantic.{prefix}_acs", "table_type": "entity",
         "imputation": "mean_noflag", "columns": DEMOGRAPHIC_COLUMNS},
        {"prefix": "reporting", "from_table": "semantic.{prefix}_reporting", "table_type": "entity",
         "imputation": "zero_noflag", "event_date_column_name": "event_date"},
        {"prefix": "events", "from_table": "semantic.{prefix}_events", "table_type": "event",
         "event_date_column_name": "event_date", "knowledge_date_column_name": "knowledge_date",
         "imputation": fills,
         "aggregates": [
             aggregate("found_violation", ["sum", "avg"] if violation_average else ["sum"]),
             aggregate("citizen_complaint", ["sum"]),
             aggregate("penalty_amount", ["sum"]),
             {"column_name": "event_date", "metrics": ["datediff"]}]},
    ]


def _config(name: str, features: list[dict], grid: dict, metrics: list[str], ks: list) -> dict:
    return {"version": "v1", "experiment_name": name, "temporal_config": dict(TEMPORAL),
            "feature_config": features, "model_config": grid, "eval_config": {"metrics": metrics, "k": ks}}


def full_grid() -> dict:
    """651 models measured at 24 cut-offs."""
    return _config("model_grid", _features(WINDOWS, "zero_noflag"), GRID, METRICS, [600, *PROPORTIONS])


def smoke_run() -> dict:
    """Four small forests."""
    return _config("test_run", _features(WINDOWS, "zero"), SMOKE_GRID, METRICS, [600, 0.01, 1.0])


def interpretable() -> dict:
    """One forest on features without trailing windows, precision and support at 600."""
    return _config("interp", _features(None, None), INTERPRETABLE_GRID,
                   ["precision_score", "num_labeled_samples"], [600])
