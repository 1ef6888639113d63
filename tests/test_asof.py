from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskrank.operators.asof import asof_latest_version, first_per_group
from tests.helpers import d, plan_of, rows


def _run(events, versions, **kw):
    return asof_latest_version(
        events, versions, event_key="handler", event_ts="started", version_key="key", version_ts="received",
        event_order=[F.col("note").asc_nulls_last()], version_order=[F.col("seq").desc()], **kw)


@pytest.mark.parametrize("spread", [False, True])
def test_edges(spark, spread):
    versions = spark.createDataFrame([
        ("a", d("2020-01-10"), 1), ("a", d("2020-02-10"), 2), ("a", d("2020-02-10"), 3), ("b", d("2020-03-01"), 4),
        (None, d("2020-01-01"), 5), ("c", None, 6)], "key string, received date, seq int")
    events = spark.createDataFrame([
        ("a", d("2020-01-09"), "before the first version"),
        ("a", d("2020-01-10"), "same day"),
        ("a", d("2020-02-09"), "day before the second"),
        ("a", d("2020-02-10"), "two versions that day"),
        ("a", d("2020-05-01"), "y"), ("a", d("2020-05-01"), "x"),
        ("unknown", d("2020-05-01"), "no versions"), (None, d("2020-05-01"), "no key"),
        ("c", d("2020-05-01"), "undated version"), ("b", None, "undated event")],
        "handler string, started date, note string")
    got = _run(events, versions, spread=spread)
    assert rows(got, "handler", "started", "note", "received", "seq") == [
        ("a", d("2020-01-10"), "same day", d("2020-01-10"), 1),
        ("a", d("2020-02-09"), "day before the second", d("2020-01-10"), 1),
        ("a", d("2020-02-10"), "two versions that day", d("2020-02-10"), 3),
        ("a", d("2020-05-01"), "x", d("2020-02-10"), 3),
    ]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_one_hot_key_on_fine_timestamps_matches_brute_force(spark, partitions):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)

    def stamp():
        return start + timedelta(microseconds=rng.randrange(10**9))

    versions = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}", stamp(), i) for i in range(900)]
    events = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(35)}", stamp(), f"n{i}") for i in range(1500)]
    got = _run(
        spark.createDataFrame(events, "handler string, started timestamp_ntz, note string"),
        spark.createDataFrame(versions, "key string, received timestamp_ntz, seq int"),
        spread=True, partitions=partitions)
    want = []
    for key, at, note in events:
        known = [(ts, seq) for k, ts, seq in versions if k == key and ts <= at]
        if known:
            ts, seq = max(known)
            want.append((key, at, note, ts, seq))
    assert rows(got, "handler", "started", "note", "received", "seq") == sorted(want)


def test_plan_pairs_nothing(spark):
    versions = spark.range(10).select(F.col("id").alias("key"), F.current_date().alias("received"), F.lit(1).alias("seq"))
    events = spark.range(10).select(F.col("id").alias("handler"), F.current_date().alias("started"), F.lit("").alias("note"))
    plan = plan_of(_run(events, versions))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert "WindowGroupLimit" in plan


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    picked = first_per_group(df, ["g"], [F.col("id").desc()])
    assert rows(picked) == [(0, 999), (1, 997), (2, 998)]
    assert "Partial" in plan_of(picked)


def test_timelines_are_spread_by_column_type(spark):
    fine = spark.createDataFrame([("a", datetime(2024, 1, 1, 5), 1)], "key string, received timestamp, seq int")
    events = spark.createDataFrame([("a", datetime(2024, 1, 1, 7), "x")], "handler string, started timestamp, note string")
    by_day = _run(events.withColumn("started", F.to_date("started")), fine.withColumn("received", F.to_date("received")))
    assert plan_of(by_day).count("rangepartitioning") == 0
    got = _run(events, fine)
    assert plan_of(got) != plan_of(_run(events, fine, spread=False))
    assert rows(got, "note", "seq") == rows(by_day, "note", "seq") == [("x", 1)]
