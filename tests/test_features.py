from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from riskrank.functions.dates import parse_interval, shift
from riskrank.operators.cohorts import build_cohort, query_per_split, select_labels
from riskrank.operators.features import (
    Block, assemble_features, compile_features, days_since_features, feature_block, latest_record_asof,
    static_features, window_features,
)
from riskrank.operators.matrix import labeled, training_matrix
from riskrank.operators.splits import fan_out, splits_frame, temporal_splits, union_splits
from tests.helpers import d, plan_of, rows

CFG = {"feature_start_time": "2020-01-31", "feature_duration": "4 months", "label_duration": "1 month",
       "feature_aod_interval": "1 month", "train_repeat_interval": "1 month", "num_train_repeat": 3}
SPLITS = temporal_splits(CFG)
CONFIG = {
    "prefix": "ev", "from_table": "semantic.{prefix}_events", "table_type": "event",
    "event_date_column_name": "event_date", "knowledge_date_column_name": "knowledge_date",
    "imputation": {"sum": "zero", "count": "zero_noflag", "avg": "mean", "datediff": "inf", "min": "min", "max": "max"},
    "aggregates": [
        {"column_name": "v", "metrics": ["sum", "count", "avg", "min", "max"],
         "time_windows": ["all", "1 month", "10 days"]},
        {"column_name": "event_date", "metrics": ["datediff"]},
    ],
}
SCHEMA = "entity_id long, event_date date, knowledge_date date, v int"


def _events(n=1500, seed=2):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = d("2020-01-15") + timedelta(days=rng.randrange(260))
        known = day + timedelta(days=rng.choice([0, 0, 1, 5, 40])) if rng.random() < 0.95 else None
        entity = 1 if rng.random() < 0.35 else rng.randrange(2, 40)
        out.append((entity, day, known, rng.choice([None, 0, 1, 2, 5])))
    return out


def _brute(events, metric, column, window, split):
    by_entity = {}
    for e, day, known, v in events:
        if split.feature_start <= day <= split.feature_end and known is not None and known <= split.feature_end:
            by_entity.setdefault(e, [])
            opening = None if window == "all" else shift(split.feature_end, -parse_interval(window))
            if opening is None or day > opening:
                by_entity[e].append((split.feature_end - day).days if column == "event_date" else v)
    out = {}
    for e, values in by_entity.items():
        values = [x for x in values if x is not None]
        if metric == "count":
            out[e] = len(values)
        elif not values:
            out[e] = None
        else:
            out[e] = {"sum": sum, "min": min, "max": max, "datediff": min,
                      "avg": lambda x: sum(x) / len(x)}[metric](values)
    return out


def test_window_features_match_brute_force(spark):
    events = _events()
    df = spark.createDataFrame(events, SCHEMA)
    features = compile_features(CONFIG)
    got = {(r["split_id"], r["entity_id"]): r for r in window_features(df, SPLITS, features).collect()}
    for split in SPLITS:
        for f in features:
            want = _brute(events, f.metric, f.column, f.window, split)
            found = {e: r[f.name] for (s, e), r in got.items() if s == split.split_id}
            assert found == pytest.approx(want), (split, f)


def test_metrics_that_do_not_combine_use_the_rows(spark):
    df = spark.createDataFrame(_events(), SCHEMA)
    config = {"prefix": "ev", "aggregates": [
        {"column_name": "v", "metrics": ["stddev", "sum"], "time_windows": ["all", "1 month"]}]}
    split = SPLITS[2]
    got = window_features(df, SPLITS, compile_features(config)).where(F.col("split_id") == split.split_id)
    seen = df.where(F.col("event_date").between(F.lit(split.feature_start), F.lit(split.feature_end))
                    & (F.col("knowledge_date") <= F.lit(split.feature_end)))
    want = seen.groupBy("entity_id").agg(F.round(F.stddev("v"), 9), F.sum("v"))
    assert rows(got, "entity_id", F.round("ev_stddev_v", 9), "ev_sum_v") == rows(want)


def test_feature_names():
    names = [f.name for f in compile_features({
        "prefix": "events", "imputation": {"sum": "zero"}, "aggregates": [
            {"column_name": "x", "metrics": ["sum"], "time_windows": ["all", "1 year"]},
            {"column_name": "x", "metrics": ["mean"]},
            {"column_name": "event_date", "metrics": ["datediff"]}]})]
    assert names == ["events_sum_x", "events_sum_x_1_year", "events_mean_x", "events_days_since_event_date"]


def test_window_boundaries(spark):
    split = temporal_splits(dict(CFG, feature_start_time="2020-01-01", feature_duration="2 months", num_train_repeat=1))[1]
    assert split.feature_end == d("2020-03-01")
    events = spark.createDataFrame([
        (1, d("2020-01-01"), d("2020-01-01"), 1),   # first day counts
        (1, d("2019-12-31"), d("2020-01-01"), 2),   # before the window
        (1, d("2020-03-01"), d("2020-03-01"), 4),   # last day counts
        (1, d("2020-02-28"), d("2020-03-02"), 8),   # known too late
        (1, d("2020-02-01"), d("2020-02-01"), 16),  # on the opening of '1 month': out
        (1, d("2020-02-02"), d("2020-02-02"), 32),  # just after it: in
        (2, d("2020-03-02"), d("2020-03-02"), 64),  # after the window
        (3, d("2020-02-02"), None, 128),            # never known
    ], SCHEMA)
    config = {"prefix": "e", "aggregates": [{"column_name": "v", "metrics": ["sum"], "time_windows": ["all", "1 month"]}]}
    got = window_features(events, [split], compile_features(config))
    assert rows(got) == [(1, 1, 1 + 4 + 16 + 32, 4 + 32)]


def test_later_knowledge_never_changes_features(spark):
    df = spark.createDataFrame(_events(), SCHEMA)
    features = compile_features(CONFIG)
    last = max(s.feature_end for s in SPLITS)
    late = spark.createDataFrame([(1, d("2020-02-20"), last + timedelta(days=1), 1000)], SCHEMA)
    before = window_features(df, SPLITS, features)
    after = window_features(df.union(late).orderBy(F.rand(4)), SPLITS, features)
    names = [c if t != "double" else F.round(c, 9) for c, t in before.dtypes]
    assert rows(before, *names) == rows(after, *names)


def test_hot_entity_is_reduced_before_the_fan_out(spark):
    df = spark.createDataFrame(_events(), SCHEMA)
    plan = plan_of(window_features(df, SPLITS, compile_features(CONFIG)))
    assert "Join" not in plan
    assert plan.count("Exchange") == 2  # the cells, then one entity per partition
    generate = plan.index("Generate explode(array(CASE")
    assert "partial_sum(v" in plan[generate:]  # summed below the fan-out


def test_fan_out(spark):
    events = _events(300)
    df = spark.createDataFrame(events, SCHEMA)
    got = fan_out(df, SPLITS, knowledge_date="knowledge_date")
    want = [(s.split_id, *e) for s in SPLITS for e in events
            if s.feature_start <= e[1] <= s.feature_end and e[2] is not None and e[2] <= s.feature_end]
    assert rows(got) == rows(spark.createDataFrame(want, "split_id int, " + SCHEMA))
    labels = fan_out(df, SPLITS, window="label")
    assert labels.count() == sum(s.label_start <= e[1] <= s.label_end for s in SPLITS for e in events)


def test_cohort(spark):
    df = spark.createDataFrame([(1, d("2020-02-01")), (1, d("2021-02-01")), (2, d("2020-07-31")), (3, d("2029-01-01"))],
                               "entity_id long, event_date date")
    got = build_cohort(df, SPLITS)
    want = [(s.split_id, e) for s in SPLITS for e, first in ((1, d("2020-02-01")), (2, d("2020-07-31"))) if first <= s.as_of]
    assert rows(got) == sorted(want)
    assert (0, 2) not in want and (SPLITS[-1].split_id, 2) in want


def test_labels(spark):
    split = SPLITS[0]
    first, last = split.label_start, split.label_end
    df = spark.createDataFrame([
        (1, first, first, 0), (1, last, last, 1),             # largest wins
        (2, last, last + timedelta(days=1), 1),               # known too late
        (3, first, first, 1),                                 # on the shared first day
        (4, first - timedelta(days=1), first, 1),             # before the window
        (5, first + timedelta(days=1), first + timedelta(days=1), None),
    ], "entity_id long, event_date date, knowledge_date date, label int")
    assert rows(select_labels(df, [split])) == [(0, 1, 1), (0, 3, 1), (0, 5, None)]
    assert rows(select_labels(df, [split], half_open=True)) == [(0, 1, 1), (0, 5, None)]


def test_user_queries(spark):
    spark.createDataFrame(_events(200), SCHEMA).createOrReplaceTempView("sem_v0_events")
    cohort = query_per_split(spark, "select entity_id from sem_{prefix}_events group by 1 having min(event_date) <= '{as_of_date}'",
                             SPLITS, {"as_of_date": "as_of"}, {"prefix": "v0"})
    assert rows(cohort) == rows(build_cohort(spark.table("sem_v0_events"), SPLITS))
    labels = query_per_split(
        spark, "with known as (select * from sem_{prefix}_events where knowledge_date <= '{end_date}') "
               "select entity_id, max(v) as label from known where event_date between '{start_date}' and '{end_date}' group by 1",
        SPLITS, {"start_date": "label_start", "end_date": "label_end"}, {"prefix": "v0"})
    assert rows(labels) == rows(select_labels(spark.table("sem_v0_events"), SPLITS, label="v"))


def test_latest_record(spark):
    rng = random.Random(9)
    records = [(rng.choice([1, 1, 1, 2, 3, 4]), d("2020-01-01") + timedelta(days=rng.randrange(300)), rng.randrange(5))
               for _ in range(300)]
    df = spark.createDataFrame(records, "entity_id long, event_date date, x int")
    got = latest_record_asof(df, SPLITS, date_col="event_date", tiebreak=[F.col("x").desc()])
    want = []
    for s in SPLITS:
        for e in {r[0] for r in records}:
            seen = [(day, x) for who, day, x in records if who == e and s.feature_start <= day <= s.feature_end]
            if seen:
                want.append((s.split_id, e, *max(seen)))
    assert rows(got, "split_id", "entity_id", "event_date", "x") == sorted(want)


def test_static_features(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (2, None, 1.0)], "entity_id long, county string, x double")
    assert rows(static_features(df)) == [(1, "a", 3.0), (2, None, 1.0)]
    assert static_features(df, columns=["x"]).columns == ["entity_id", "x"]
    assert static_features(df, keep_duplicates=True).count() == 3


def test_days_since(spark):
    df = spark.createDataFrame([(1, d("2020-02-01"), d("2020-02-03"), 1), (1, d("2020-02-10"), d("2020-02-11"), 1)], SCHEMA)
    got = days_since_features(df, SPLITS[:1], ["event_date", "knowledge_date"], prefix="ev")
    assert SPLITS[0].feature_end == d("2020-02-29")
    assert rows(got) == [(0, 1, 19, 18)]


def test_assembled_matrix_keeps_the_cohort_and_imputes(spark):
    events = spark.createDataFrame(_events(400), SCHEMA)
    profile = spark.createDataFrame([(e, float(e)) for e in range(1, 20)] + [(5, 99.0)], "entity_id long, size double")
    panel = spark.createDataFrame([(1, d("2020-02-20"), 7.0), (1, d("2020-03-20"), 8.0)],
                                  "entity_id long, event_date date, tons double")
    tables = {"events": events, "acs": profile, "reporting": panel}
    configs = [
        {"prefix": "acs", "from_table": "semantic.{prefix}_acs", "table_type": "entity", "imputation": "mean_noflag"},
        {"prefix": "rep", "from_table": "semantic.{prefix}_reporting", "table_type": "entity", "imputation": "zero",
         "event_date_column_name": "event_date"},
        CONFIG]
    cohort = build_cohort(events, SPLITS)
    matrix = assemble_features(cohort, [feature_block(spark, tables, SPLITS, c) for c in configs], SPLITS)
    assert rows(matrix, "split_id", "entity_id") == rows(cohort, "split_id", "entity_id")
    assert matrix.columns[:5] == ["split_id", "entity_id", "size", "tons", "tons_impute_flag"]
    assert "ev_sum_v_impute_flag" in matrix.columns and "ev_count_v_impute_flag" not in matrix.columns
    data = {(r["split_id"], r["entity_id"]): r for r in matrix.collect()}
    for s in SPLITS:
        members = [r for (i, _), r in data.items() if i == s.split_id]
        known = [min(e, 99.0) for (i, e) in data if i == s.split_id and e < 20]
        assert {round(r["size"], 9) for r in members if r["entity_id"] >= 20} <= {round(sum(known) / len(known), 9)}
        late = data.get((s.split_id, 1))
        want = 8.0 if s.feature_start <= d("2020-03-20") <= s.feature_end else (
            7.0 if s.feature_start <= d("2020-02-20") <= s.feature_end else 0.0)
        assert late["tons"] == want and late["tons_impute_flag"] == (0 if want else 1)
    assert max(r["ev_days_since_event_date"] for r in data.values()) == 100000000
    assert all(r["ev_avg_v"] is not None for r in data.values())


def test_training_matrix_does_not_fan_out(spark):
    features = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.6), (0, 2, 0.7)], "split_id int, entity_id long, x double")
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0)], "split_id int, entity_id long, label int")
    matrix = training_matrix(features, labels)
    assert rows(matrix) == [(0, 1, 0.5, 1), (0, 2, 0.7, None), (1, 1, 0.6, 0)]
    assert labeled(matrix).count() == 2
    assert training_matrix(features, labels, discard=["x"]).columns == ["split_id", "entity_id", "label"]


def test_union_splits_and_frame(spark):
    a = spark.createDataFrame([(1, "x")], "id long, s string")
    assert rows(union_splits([a, a.select("s", "id")])) == [(0, 1, "x"), (1, 1, "x")]
    assert splits_frame(spark, SPLITS).count() == len(SPLITS)


def test_timestamps_are_refused(spark):
    df = spark.createDataFrame(_events(3), SCHEMA).withColumn("event_date", F.col("event_date").cast("timestamp"))
    with pytest.raises(TypeError, match="expected a date"):
        window_features(df, SPLITS, compile_features(CONFIG))


def test_unknown_table_type(spark):
    with pytest.raises(ValueError):
        feature_block(spark, {"x": spark.range(1)}, SPLITS, {"prefix": "x", "from_table": "x", "table_type": "other"})


def test_block_defaults():
    assert Block(None, {}).spans is None
