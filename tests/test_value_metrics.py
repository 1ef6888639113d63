"""Medians, percentiles, modes and distinct counts of windows against plain Python, and plans without raw rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskrank.functions.dates import parse_interval, shift
from riskrank.operators.features import compile_features, window_features
from riskrank.operators.ranking import running_sums
from riskrank.operators.splits import temporal_splits
from tests.helpers import d, plan_of, rows

CFG = {"feature_start_time": "2020-01-31", "feature_duration": "4 months", "label_duration": "1 month",
       "feature_aod_interval": "1 month", "train_repeat_interval": "1 month", "num_train_repeat": 2}
SPLITS = temporal_splits(CFG)
METRICS = ["median", "percentile_90", "percentile_12", "mode", "count_distinct"]
BLOCK = {"prefix": "e", "aggregates": [
    {"column_name": "v", "metrics": [*METRICS, "sum", "approx_count_distinct", "kurtosis"], "time_windows": ["all", "1 month"]},
    {"column_name": "word", "metrics": ["mode", "nunique"]}]}


def _events(seed, n=900, hot=True):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = d("2020-01-01") + timedelta(days=rng.randrange(260))
        who = 1 if hot and rng.random() < 0.4 else rng.randrange(12)
        v = rng.choice([None, rng.randrange(6), rng.randrange(200)])
        out.append((who, day, day + timedelta(days=rng.choice([0, 0, 40])), v, rng.choice(["a", "b", None])))
    return out


def _common(values):
    return min(Counter(values).items(), key=lambda x: (-x[1], x[0]))[0] if values else None


def test_against_plain_python(spark):
    events = _events(1)
    frame = spark.createDataFrame(events, "entity_id int, event_date date, knowledge_date date, v int, word string").repartition(5)
    found = window_features(frame, SPLITS, compile_features(BLOCK))
    got = {(r["split_id"], r["entity_id"]): r.asDict() for r in found.collect()}
    seen = 0
    for s in SPLITS:
        for who in range(12):
            mine = [e for e in events if e[0] == who and s.feature_start <= e[1] <= s.feature_end and e[2] <= s.feature_end]
            assert ((s.split_id, who) in got) == bool(mine)
            if not mine:
                continue
            row = got[s.split_id, who]
            for window in ("all", "1 month"):
                suffix = "" if window == "all" else "_1_month"
                opening = None if window == "all" else shift(s.feature_end, -parse_interval(window))
                values = [e[3] for e in mine if e[3] is not None and (opening is None or e[1] > opening)]
                assert row[f"e_count_distinct_v{suffix}"] == row[f"e_approx_count_distinct_v{suffix}"] == len(set(values))
                assert row[f"e_mode_v{suffix}"] == _common(values)
                for name, share in (("median", 50), ("percentile_90", 90), ("percentile_12", 12)):
                    want = float(np.percentile(values, share)) if values else None
                    assert row[f"e_{name}_v{suffix}"] == (pytest.approx(want) if values else None)
                seen += bool(values)
            words = [e[4] for e in mine if e[4] is not None]
            assert row["e_mode_word"] == _common(words) and row["e_nunique_word"] == len(set(words))
    assert seen > 60


def test_raw_rows_are_not_spread(spark):
    frame = spark.createDataFrame(_events(2, 50), "entity_id int, event_date date, knowledge_date date, v int, word string")
    block = {"prefix": "e", "aggregates": [{"column_name": "v", "metrics": ["mode", "count_distinct"]}]}
    plan = plan_of(window_features(frame, SPLITS, compile_features(block)))  # before it runs
    assert "Expand" not in plan and plan.count("Generate") == 2
    assert "HashAggregate" in plan[plan.rindex("Generate"):]  # rows are counted by value before they are copied


def test_running_sums_over_ranges(spark):
    data = [(i % 3 if i % 2 else 7, i, i % 5) for i in range(400)]
    df = spark.createDataFrame(data, "g int, o int, n int")
    got = rows(running_sums(df, ["g"], ["o"], ["n"], partitions=9), "g", "o", "n", "n_upto", "n_all")
    want = []
    for g in {r[0] for r in data}:
        total = sum(r[2] for r in data if r[0] == g)
        up = 0
        for _, o, n in sorted(r for r in data if r[0] == g):
            up += n
            want.append((g, o, n, up, total))
    assert got == sorted(want)
    assert running_sums(df.withColumn("g", F.lit(None).cast("int")), ["g"], ["o"], ["n"]).agg(F.max("n_upto")).first()[0] == sum(
        r[2] for r in data)
