from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from dateutil.relativedelta import relativedelta
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskrank.functions.dates import Interval, date_cell, parse_date, parse_interval, shift
from riskrank.operators.splits import temporal_splits
from tests.helpers import d


@pytest.mark.parametrize("text, months, days", [
    ("2 years", 24, 0), ("2y", 24, 0), ("1 year", 12, 0), ("6 months", 6, 0), ("6m", 6, 0),
    ("14 days", 0, 14), ("5d", 0, 5), ("2 weeks", 0, 14), ("1 year 6 months 3 days", 18, 3), ("10 Years", 120, 0),
])
def test_parse_interval(text, months, days):
    assert parse_interval(text) == Interval(months, days)


@pytest.mark.parametrize("text", ["", "years", "3 hours", "5 minutes", "2 years ago"])
def test_parse_interval_rejects(text):
    with pytest.raises(ValueError):
        parse_interval(text)


def test_shift_clamps_at_month_end():
    assert shift(d("2024-01-31"), Interval(1)) == d("2024-02-29")
    assert shift(d("2024-02-29"), Interval(12)) == d("2025-02-28")
    assert shift(d("2024-03-31"), -Interval(1)) == d("2024-02-29")
    assert shift(d("2024-01-01"), -Interval(1, 1)) == d("2023-11-30")
    assert parse_date("2024-05-06") == date(2024, 5, 6)


@given(st.dates(date(1950, 1, 1), date(2100, 1, 1)), st.integers(-60, 60), st.integers(-400, 400))
def test_shift_is_calendar_arithmetic(day, months, days):
    assert shift(day, Interval(months, days)) == day + relativedelta(months=months, days=days)


@given(st.integers(0, 99), st.integers(0, 99), st.integers(0, 999))
def test_intervals_read_back(years, months, days):
    text = f"{years} years {months} months {days} days"
    assert parse_interval(text) == Interval(12 * years + months, days)


CFG = {"feature_start_time": "2001-01-01", "feature_duration": "10 years", "label_duration": "1 year",
       "feature_aod_interval": "1 year", "train_repeat_interval": "1 year", "num_train_repeat": 5}


def test_default_plan_has_ten_training_dates_per_repeat():
    splits = temporal_splits(CFG)
    assert len(splits) == 55
    train = [s for s in splits if s.repeat == 1 and s.role == "train"]
    assert [s.split for s in train] == list(range(10))
    assert {s.feature_start for s in train} == {d("2001-01-01")}
    assert train[0].feature_end == d("2003-01-01") and train[-1].feature_end == d("2012-01-01")
    assert all(s.label_start == s.feature_end for s in splits)
    test = next(s for s in splits if s.repeat == 1 and s.role == "test")
    assert (test.feature_start, test.feature_end) == (d("2003-01-01"), d("2013-01-01"))
    assert (test.label_start, test.label_end) == (d("2013-01-01"), d("2014-01-01"))
    assert {s.as_of for s in splits if s.repeat == 1} == {d("2014-01-01")}


def test_cohort_may_be_taken_at_feature_end():
    assert all(s.as_of == s.feature_end for s in temporal_splits(CFG, "feature_end"))
    with pytest.raises(ValueError):
        temporal_splits(CFG, "other")


def test_month_steps_accumulate_but_repeats_multiply():
    cfg = dict(CFG, feature_start_time="2023-10-31", feature_duration="5 months", label_duration="1 month",
               feature_aod_interval="1 month", train_repeat_interval="1 month", num_train_repeat=2)
    splits = temporal_splits(cfg)
    ends = [s.feature_end for s in splits if s.repeat == 0 and s.role == "train"]
    # each step starts from the clamped date before it
    assert ends == [d("2023-11-30"), d("2023-12-30"), d("2024-01-30"), d("2024-02-29"), d("2024-03-29")]
    # the start of repeat 1 is the first start plus one month
    assert [s.feature_end for s in splits if s.repeat == 1][0] == d("2023-12-30")


def test_date_cell_answers_comparisons_like_the_date(spark):
    rng = random.Random(3)
    days = [date(2020, 1, 1) + timedelta(days=rng.randrange(900)) for _ in range(400)]
    cuts = sorted({date(2020, 1, 1) + timedelta(days=rng.randrange(900)) for _ in range(21)})
    df = spark.createDataFrame([(x,) for x in days], "day date").withColumn("cell", date_cell(F.col("day"), cuts))
    for cut in cuts:
        wrong = df.where((F.col("day") >= F.lit(cut)) != (F.col("cell") >= F.lit(cut)))
        assert wrong.isEmpty()
    assert df.select("cell").distinct().count() <= len(cuts) + 1
