from __future__ import annotations

import copy
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from riskrank import presets
from riskrank.operators.cohorts import build_cohort
from riskrank.operators.metrics import metric_names
from riskrank.operators.modeling import expand_grid
from riskrank.plans import configs
from riskrank.plans.analysis import all_importances, run_analysis
from riskrank.plans.experiment import build_matrix, load_experiment, run_experiment
from riskrank.plans.preprocessing import load_sources, run_preprocessing, run_steps
from riskrank.session import shared_dir
from riskrank.sources.sinks import write_table
from tests.helpers import d, rows


def _raw(spark):
    """A small made-up register in the raw tables' own column names."""
    rng = random.Random(6)
    versions, evaluations, reports = [], [], []
    for e in range(60):
        region = "NY" if e % 6 else "NJ"
        for v in range(rng.randrange(1, 4)):
            versions.append((f"h{e:03d}", region, d("2000-01-01") + timedelta(days=rng.randrange(2500)), v, f"{e % 7:05d}"))
        for _ in range(rng.randrange(0, 25)):
            day = d("2000-01-01") + timedelta(days=rng.randrange(3600))
            amount = rng.choice([None, 0.0, 100.0]) if rng.random() < 0.5 else None
            evaluations.append((f"h{e:03d}", day, rng.choice("YN"), rng.choice("YN"),
                                day + timedelta(days=rng.randrange(60)) if rng.random() < 0.4 else None, amount))
        for _ in range(rng.randrange(0, 12)):
            reports.append((f"h{e:03d}", str(rng.choice([2001, 2003, 2005])),
                            rng.choice(["D001", "F1_5", "D900", "K100", "ZZ", None]), rng.random() * 10, "Some TEXT"))
    entities = spark.createDataFrame(versions, "epa_handler_id string, activity_location string, receive_date date, "
                                               "handler_sequence_number int, location_zip_code string")
    for c in presets.ENTITY_COLUMNS:
        if c not in entities.columns:
            entities = entities.withColumn(c, F.lit(None).cast("string"))
    evals = spark.createDataFrame(evaluations, "handler_id string, evaluation_start_date date, found_violation_flag string, "
                                               "citizen_complaint_flag string, violation_determined_date date, final_amount double")
    for c in presets.EVALUATION_COLUMNS:
        if c not in evals.columns:
            evals = evals.withColumn(c, F.lit(None).cast("date" if c in presets.KNOWLEDGE_DATES else "string"))
    reps = spark.createDataFrame(reports, "handler_id string, report_cycle string, waste_code_group string, "
                                          "generation_tons double, waste_description string")
    for c in presets.REPORT_COLUMNS:
        if c not in reps.columns:
            reps = reps.withColumn(c, F.lit(None).cast("string"))
    zips = [(f"{z:05d}", "36", f"c{z % 3}", f"t{z}") for z in range(7)]
    census = spark.createDataFrame([("36", c, t, 100 + i) for i, (_, _, c, t) in enumerate(zips)],
                                   "state string, county string, tract string, B01003_001E int")
    demographics = census.withColumn("mean_county_income", F.when(F.col("county") == "c0", 90000.0).otherwise(50000.0))
    return {
        "entities": entities, "evaluations": evals, "reports": reps, "census": census, "demographics": demographics,
        "link": spark.createDataFrame([(s, c, t, z) for z, s, c, t in zips], "state string, county string, tract string, zip string"),
        "facilities": entities.select(F.col("epa_handler_id").alias("id_number"), F.col("location_zip_code").alias("zip_code")),
        "density": spark.createDataFrame([(z, 10, 2.0, 5.0) for z, *_ in zips],
                                         "zip string, population int, zip_area_sq_miles double, zip_density_sq_miles double"),
    }


CFG = {
    "version": "v1", "experiment_name": "small",
    "temporal_config": {"feature_start_time": "2000-01-01", "feature_duration": "4 years", "label_duration": "1 year",
                        "feature_aod_interval": "1 year", "train_repeat_interval": "1 year", "num_train_repeat": 2},
    "feature_config": [
        {"prefix": "acs", "from_table": "semantic.{prefix}_acs", "table_type": "entity", "imputation": "mean_noflag",
         "columns": ["zip_population", "county_population", "zip_density_sq_miles", "mean_county_income"]},
        {"prefix": "reporting", "from_table": "semantic.{prefix}_reporting", "table_type": "entity",
         "imputation": "zero_noflag", "event_date_column_name": "event_date"},
        {"prefix": "events", "from_table": "semantic.{prefix}_events", "table_type": "event",
         "event_date_column_name": "event_date", "knowledge_date_column_name": "knowledge_date",
         "imputation": {"sum": "zero", "avg": "zero_noflag", "datediff": "inf"},
         "aggregates": [
             {"column_name": "found_violation", "metrics": ["sum", "avg"], "time_windows": ["all", "1 year", "2 years"]},
             {"column_name": "penalty_amount", "metrics": ["sum"], "time_windows": ["all", "1 year"]},
             {"column_name": "event_date", "metrics": ["datediff"]}]},
    ],
    "model_config": {
        "models.RankBaseline": {"column": ["events_sum_penalty_amount", "events_days_since_event_date"]},
        "models.LogisticRegression": {"penalty": ["l2"], "C": [1.0], "max_iter": [10]},
        "tree.DecisionTreeClassifier": {"max_depth": [2]},
    },
    "eval_config": {"metrics": ["sklearn.metrics.precision_score", "sklearn.metrics.recall_score", "m.num_labeled_samples"],
                    "k": [10, 0.1, 1.0]},
}


@pytest.fixture(scope="module")
def semantic(spark):
    tables = run_preprocessing(_raw(spark))
    return {name: df.persist() for name, df in tables.items()}


@pytest.fixture(scope="module")
def output(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out"))


@pytest.fixture(scope="module")
def experiment(spark, semantic, output):
    return run_experiment(spark, CFG, semantic, output=output)


def test_semantic_layer(semantic):
    assert set(semantic) == {"events", "labels", "reporting", "acs"}
    assert semantic["events"].columns == ["entity_id", "event_id", "event_date", "knowledge_date", "found_violation",
                                          "citizen_complaint", "penalty_amount"]
    assert semantic["reporting"].columns == ["entity_id", "event_date", *presets.PANEL_CATEGORIES]
    events, labels = semantic["events"], semantic["labels"]
    assert rows(events, "event_id", "event_date") == rows(labels, "event_id", "event_date")
    ids = [r[0] for r in rows(events, "event_id")]
    assert ids == list(range(1, len(ids) + 1))
    assert events.where("knowledge_date < event_date").isEmpty()
    assert rows(events.where("penalty_amount > 0").select("event_id")) == rows(labels.where("label = 1").select("event_id"))


def test_experiment_tables(experiment):
    assert experiment.matrix.groupBy("split_id", "entity_id").count().where("count > 1").isEmpty()
    results = experiment.results
    assert results.count() == 4 * 2 * 2  # models x repeats x roles
    assert [c for c in results.columns if "_at_" in c] == [f"{m}_at_{k}" for m in ("precision_score", "recall_score", "num_labeled_samples")
                                    for k in (10, 0.1, 1.0)]
    everything = results.where("`recall_score_at_1.0` <> 1.0 and num_labeled_rows > 0").count()
    assert everything == 0
    assert results.where("`num_labeled_samples_at_1.0` <> num_labeled_rows").isEmpty()
    predictions = experiment.predictions
    per_model = predictions.groupBy("split_id", "model_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.sum("prediction_at_10").alias("flagged")).collect()
    assert len(per_model) == 8 and all(r["n"] == r["last"] and r["flagged"] == min(10, r["n"]) for r in per_model)
    assert predictions.where("probability < 0 or probability > 1").isEmpty()


def test_rerun_replaces_the_same_experiment(spark, semantic, tmp_path):
    cfg = copy.deepcopy(CFG)
    cfg["model_config"] = {"RankBaseline": {"column": ["events_sum_penalty_amount"]}}
    cfg["temporal_config"]["num_train_repeat"] = 1
    first = run_experiment(spark, cfg, semantic, output=str(tmp_path), evaluate_on=["test"], experiment_id="007")
    before = rows(first.results)
    other = run_experiment(spark, cfg, semantic, output=str(tmp_path), evaluate_on=["test"], experiment_id="other")
    again = run_experiment(spark, cfg, semantic, output=str(tmp_path), evaluate_on=["test"], experiment_id="007")
    assert rows(again.results) == before
    assert other.results.count() == 1 and spark.read.parquet(f"{tmp_path}/results").count() == 2


def test_rerun_with_less_leaves_nothing_behind(spark, semantic, tmp_path):
    cfg = copy.deepcopy(CFG)
    cfg["model_config"] = {"RankBaseline": {"column": ["events_sum_penalty_amount"]}}
    run_experiment(spark, cfg, semantic, output=str(tmp_path), experiment_id="e")
    cfg["temporal_config"]["num_train_repeat"] = 1
    cfg["feature_config"] = cfg["feature_config"][-1:]
    again = run_experiment(spark, cfg, semantic, output=str(tmp_path), experiment_id="e")
    loaded = load_experiment(spark, str(tmp_path), "e")
    planned = {s.split_id for s in again.splits}
    for made in (again, loaded):
        assert {r[0] for r in made.matrix.select("split_id").distinct().collect()} == planned
        assert {r[0] for r in made.predictions.select("split_id").distinct().collect()} == {
            s.split_id for s in again.splits if s.role == "test"}
        assert made.feature_columns == again.feature_columns
    with pytest.raises(ValueError):
        run_experiment(spark, cfg, semantic, output=str(tmp_path), experiment_id="a/b")


def test_nothing_is_left_in_the_shared_folder(spark, semantic, tmp_path):
    from pathlib import Path
    shared = Path(shared_dir(spark).removeprefix("file:"))
    cfg = copy.deepcopy(CFG)
    {n: df.count() for n, df in semantic.items()}
    before = set(shared.iterdir())
    made = run_experiment(spark, cfg, semantic, output=str(tmp_path))
    assert set(shared.iterdir()) == before and made.predictions.count() > 0 and made.importances.count() > 0


def test_null_features_fail_the_models_of_the_repeat_only(spark, semantic):
    cfg = copy.deepcopy(CFG)
    cfg["model_config"]["LogisticRegression"] = {"penalty": ["l2"], "max_iter": [5]}
    empty = semantic["reporting"].withColumns({c: F.lit(None).cast("double") for c in presets.PANEL_CATEGORIES[:1]})
    for block in cfg["feature_config"]:
        if block["prefix"] == "reporting":
            block["imputation"] = "mean"
    found = run_experiment(spark, cfg, dict(semantic, reporting=empty))
    status = {r["model_class"]: r["fit_status"] for r in found.models.collect()}
    assert status["models.RankBaseline"] == "ok" and status["LogisticRegression"] != "ok"
    assert found.results.where("model_class = 'models.RankBaseline'").count() > 0


def test_written_and_unwritten_runs_agree(spark, semantic, experiment):
    lazy = run_experiment(spark, CFG, semantic)
    names = sorted(c for c in lazy.results.columns if c not in ("experiment_id",))
    picked = [F.col(f"`{c}`") for c in names]
    base = F.col("model_class") == "models.RankBaseline"
    assert rows(lazy.results.where(base), *picked) == rows(experiment.results.where(base), *picked)


def test_loaded_experiment_is_analysed_alike(spark, experiment, output):
    loaded = load_experiment(spark, output, experiment.experiment_id)
    assert loaded.splits == experiment.splits and loaded.feature_columns == experiment.feature_columns
    assert loaded.metric_columns == experiment.metric_columns and loaded.grid_size == 4
    args = dict(metric="precision_score_at_10", n_models=2, min_support=0)
    one, other = run_analysis(experiment, **args), run_analysis(loaded, **args)
    for name, df in one.items():
        picked = [F.round(f"`{c}`", 9) if t == "double" else F.col(c) for c, t in df.dtypes]
        assert rows(df, *picked) == rows(other[name], *picked), name


def test_analysis(experiment, tmp_path):
    tables = run_analysis(experiment, metric="precision_score_at_10", n_models=2, min_support=0,
                          group_threshold=75000, output=str(tmp_path))
    assert set(tables) == {"results_over_time", "best_models", "best_results_over_time", "base_rate", "pr_curve",
                           "top_features", "crosstab", "disparity_fdr", "disparity_tpr"}
    assert tables["best_models"].count() == 2
    assert tables["results_over_time"].count() == 4 * 2 * 2
    chosen = {r[0] for r in tables["top_features"].select("model_id").distinct().collect()}
    assert len(chosen) >= 2
    assert tables["crosstab"].count() == len(chosen) * len(experiment.feature_columns)
    assert tables["pr_curve"].count() == len(chosen) * 2
    assert tables["disparity_tpr"].count() == 4
    assert (tmp_path / "crosstab").exists()
    assert all_importances(experiment, 0).count() == len(experiment.feature_columns)


def test_analysis_wants_a_known_group_feature(experiment):
    with pytest.raises(ValueError):
        run_analysis(experiment, metric="precision_score_at_10", group_feature="nowhere")
    without = run_analysis(experiment, metric="precision_score_at_10", min_support=0, group_feature=None)
    assert not any(name.startswith("disparity") for name in without)


def test_catalog_tables_and_own_queries(spark, semantic):
    """The same experiment from catalog tables, with the cohort and label queries spelled out."""
    spark.sql("create schema if not exists semantic")
    for name, df in semantic.items():
        write_table(df, f"semantic.v0_{name}", mode="replace")
    cfg = copy.deepcopy(CFG)
    cfg["model_config"] = {"RankBaseline": {"column": ["events_sum_penalty_amount"]}}
    cfg["cohort_config"] = {"query": """
        select entity_id from semantic.{prefix}_events
        group by entity_id having min(event_date) <= date '{as_of_date}'"""}
    cfg["label_config"] = {"query": """
        with seen as (select * from semantic.{prefix}_labels where knowledge_date <= date '{end_date}')
        select entity_id, max(label) as label from seen
        where event_date between date '{start_date}' and date '{end_date}' group by entity_id"""}
    own = run_experiment(spark, cfg, {}, prefix="v0")
    cfg["cohort_config"] = {"query": lambda session, splits: build_cohort(session.table("semantic.v0_events"), splits)}
    by_function = run_experiment(spark, cfg, {}, prefix="v0")
    assert rows(by_function.results) == rows(own.results)
    built_in = run_experiment(spark, dict(cfg, cohort_config={}, label_config={}), semantic)
    assert rows(own.results) == rows(built_in.results)
    names = [F.round(c, 6) if t == "double" else F.col(c) for c, t in own.matrix.dtypes]
    assert rows(own.matrix, *names) == rows(built_in.matrix, *names)


def test_landed_files(spark, tmp_path):
    header = "state,county,tract,block group," + ",".join(presets.CENSUS_NAMES)
    for i, county in enumerate(("001", "003")):
        (tmp_path / f"blocks_{county}.csv").write_text(f"{header}\n36,{county},t{i},1," + ",".join(["5"] * 10) + "\n")
    (tmp_path / "income.csv").write_text("county," + ",".join(presets.INCOME_QUINTILES) + "\n001,1,2,3,,6\n")
    (tmp_path / "density.csv").write_text("z,p,a,d\n501,1,2,3\n")
    made = load_sources(spark, [str(p) for p in tmp_path.glob("blocks_*.csv")], str(tmp_path / "income.csv"),
                        str(tmp_path / "density.csv"))
    assert rows(made["demographics"], "county", "block group", "total_pop", "edu_phd", "mean_county_income") == [
        ("001", "1", 5.0, 5.0, 3.0), ("003", "1", 5.0, 5.0, None)]
    assert rows(made["density"]) == [("00501", 1, 2.0, 3.0)]


def test_unfittable_experiment(spark, semantic):
    cfg = dict(CFG, model_config={"no.Such": {"x": [1]}})
    with pytest.raises(ValueError):
        run_experiment(spark, cfg, semantic)


def test_user_steps_see_earlier_tables(spark):
    made = run_steps(
        spark,
        [("{prefix}_big", "select * from numbers where id > :least"),
         lambda session, tables: {"v1_count": session.table("v1_big").selectExpr("count(*) as n")},
         ("{prefix}_answer", "select n + 1 as n from {prefix}_count")],
        {"numbers": spark.range(10).toDF("id")}, prefix="v1", least=6)
    assert rows(made["v1_answer"]) == [(4,)]


def test_standard_configs(spark, semantic):
    assert len(expand_grid(configs.full_grid()["model_config"])) == 3 + 24 + 112 + 224 + 288
    assert len(expand_grid(configs.smoke_run()["model_config"])) == 4
    assert len(expand_grid(configs.interpretable()["model_config"])) == 1
    evaluation = configs.full_grid()["eval_config"]
    assert len(metric_names(evaluation["metrics"], evaluation["k"])) == 72
    splits, matrix = build_matrix(spark, configs.full_grid(), semantic)
    assert len(splits) == 55
    assert len(matrix.columns) == 2 + 4 + 30 + 12 * 2 + 4 + 2 + 1
    _, plain = build_matrix(spark, configs.interpretable(), semantic)
    assert [c for c in plain.columns if c.startswith("events_")] == [
        f"events_{n}{flag}" for n in ("sum_found_violation", "sum_citizen_complaint", "sum_penalty_amount", "days_since_event_date")
        for flag in ("", "_impute_flag")]
    assert matrix.count() > 0


def test_persisted_layer_serves_experiments(spark, semantic):
    made = run_preprocessing(_raw(spark), persist=True, prefix="kept")
    assert set(made) == set(semantic)
    for name, df in made.items():
        assert df.count() == spark.table(f"semantic.kept_{name}").count() == semantic[name].count()
    cfg = copy.deepcopy(CFG)
    cfg["model_config"] = {"RankBaseline": {"column": ["events_sum_penalty_amount"]}}
    assert rows(run_experiment(spark, cfg, {}, prefix="kept").results) == rows(run_experiment(spark, cfg, semantic).results)


def test_only_wanted_outputs_are_planned(spark):
    raw = _raw(spark)
    del raw["evaluations"], raw["demographics"]  # a panel needs neither
    assert set(run_preprocessing(raw, outputs=["reporting"])) == {"reporting"}
    with pytest.raises(ValueError):
        run_preprocessing(raw, outputs=["event"])
