"""User SQL for all splits in one plan, and one run per set of dates where that cannot be."""

from __future__ import annotations

import pytest

from riskrank.operators import cohorts
from riskrank.operators.cohorts import query_per_split
from riskrank.operators.splits import temporal_splits
from tests.helpers import plan_of, rows

CFG = {"feature_start_time": "2020-01-31", "feature_duration": "4 months", "label_duration": "1 month",
       "feature_aod_interval": "1 month", "train_repeat_interval": "1 month", "num_train_repeat": 3}
SPLITS = temporal_splits(CFG)
DATES = {"start_date": "label_start", "end_date": "label_end"}


@pytest.fixture(scope="module")
def acts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("acts") / "t")
    spark.range(300).selectExpr("id % 40 as who", "date_add(date '2020-01-01', cast(id * 11 % 281 as int)) as day",
                                "id % 9 as v").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("acts")
    return "acts"


QUERIES = {
    "aggregate": "select who, max(v) as top from acts where day between '{start_date}' and date '{end_date}' group by who",
    "having": "select who from acts group by who having min(day) <= DATE '{end_date}'",
    "join": "select a.who, count(*) as n from acts a join acts b on a.who = b.who and a.day < b.day "
            "where b.day <= '{end_date}' group by a.who",
    "with": "with seen as (select * from acts where day <= '{end_date}') select distinct who from seen where v > 3;",
    "cast": "select who, day from acts where day > cast('{start_date}' as date) and day <= '{end_date}'",
}


def each_alone(spark, text, monkeypatch, dates=DATES):
    with monkeypatch.context() as m:
        m.setattr(cohorts, "_lateral", lambda *a: None)
        return query_per_split(spark, text, SPLITS, dates)


@pytest.mark.parametrize("name", list(QUERIES))
def test_one_plan_gives_what_single_runs_give(spark, acts, name, monkeypatch):
    text = QUERIES[name]
    dates = {k: a for k, a in DATES.items() if k in text}
    together = query_per_split(spark, text, SPLITS, dates)
    alone = each_alone(spark, text, monkeypatch, dates)
    scans = 2 if name == "join" else 1
    assert plan_of(together).count("FileScan") == scans < plan_of(alone).count("FileScan")
    assert together.columns == alone.columns and rows(together) == rows(alone) and together.count() > 0


@pytest.mark.parametrize("text", [
    "select who, 'until {end_date}' as note from acts where day <= '{end_date}'",  # a date inside a longer text
    "select who, row_number() over (order by day, who, v) as n from acts where day <= '{end_date}' limit 5",
])
def test_others_run_once_per_set_of_dates(spark, acts, text, monkeypatch):
    dates = {"end_date": "label_end"}
    together = query_per_split(spark, text, SPLITS, dates)
    assert rows(together) == rows(each_alone(spark, text, monkeypatch, dates))


def test_a_wrong_query_still_fails(spark, acts):
    with pytest.raises(Exception, match="nowhere"):
        query_per_split(spark, "select nowhere from acts where day <= '{end_date}'", SPLITS, {"end_date": "label_end"}).collect()


def test_names_with_clashes(spark, acts, monkeypatch):
    text = "select who as _ids2, day as split from acts where day <= '{end_date}'"
    assert rows(query_per_split(spark, text, SPLITS, {"end_date": "label_end"})) == rows(
        each_alone(spark, text, monkeypatch, {"end_date": "label_end"}))
