from __future__ import annotations

import pytest

from riskrank.operators.imputation import impute, parse_strategy
from tests.helpers import rows

SCHEMA = "split_id int, entity_id long, x double"


@pytest.fixture()
def data(spark):
    return spark.createDataFrame([
        (0, 1, 1.0), (0, 2, None), (0, 3, 4.0),
        (1, 1, 10.0), (1, 2, 10.0), (1, 3, None),
        (2, 1, None), (2, 2, None)], SCHEMA)


@pytest.mark.parametrize("strategy, fills", [
    ("zero", (0.0, 0.0, 0.0)), ("inf", (1e8, 1e8, 1e8)), ("mean", (2.5, 10.0, None)), ("avg", (2.5, 10.0, None)),
    ("min", (1.0, 10.0, None)), ("max", (4.0, 10.0, None))])
@pytest.mark.parametrize("flag", [True, False])
@pytest.mark.parametrize("groups", [None, 3])
def test_strategies(data, strategy, fills, flag, groups):
    got = impute(data, {"x": strategy if flag else strategy + "_noflag"}, groups=groups)
    assert got.columns == ["split_id", "entity_id", "x"] + (["x_impute_flag"] if flag else [])
    want = [(0, 1, 1.0, 0), (0, 2, fills[0], 1), (0, 3, 4.0, 0), (1, 1, 10.0, 0), (1, 2, 10.0, 0),
            (1, 3, fills[1], 1), (2, 1, fills[2], 1), (2, 2, fills[2], 1)]
    assert rows(got) == [w if flag else w[:3] for w in want]


def test_several_columns_and_untouched_ones(spark):
    df = spark.createDataFrame([(0, 1, None, None, "k"), (0, 2, 2, 3.0, None)], "split_id int, e long, a int, b double, c string")
    got = impute(df, {"a": "max", "b": "zero_noflag"})
    assert got.columns == ["split_id", "e", "c", "a", "a_impute_flag", "b"]
    assert rows(got) == [(0, 1, "k", 2, 1, 0.0), (0, 2, None, 2, 0, 3.0)]


def test_unknown_strategy():
    with pytest.raises(ValueError):
        parse_strategy("median")
