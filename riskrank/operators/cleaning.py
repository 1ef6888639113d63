"""Cleaning and linking of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import row_mean


def load_demographics(
    block_groups: DataFrame | Sequence[DataFrame],
    county_income: DataFrame,
    rename: Mapping[str, str],
    *,
    income_columns: Sequence[str],
    county: str = "county",
    income_name: str = "mean_county_income",
) -> DataFrame:
    """Rename survey codes and attach each county's mean over the income columns.

    Several frames (one per county file) are stacked by name.  NULL quintiles are
    skipped; counties without income keep their block groups with NULL.
    """
    if not isinstance(block_groups, DataFrame):
        block_groups = reduce(DataFrame.unionByName, block_groups)
    income = county_income.select(county, row_mean(income_columns).alias(income_name))
    return block_groups.withColumnsRenamed(dict(rename)).join(income, county, "left")


def link_geography(
    block_groups: DataFrame, link: DataFrame, on: Sequence[str] = ("tract", "county"), area: str = "zip"
) -> DataFrame:
    """Attach the postal area to every block group that has one."""
    return block_groups.join(link.select(*on, area), list(on))


def clean_entities(
    raw: DataFrame,
    *,
    region_column: str,
    region: str,
    columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Entity versions of one region, projected and renamed."""
    return (raw.where(F.col(region_column) == region)
            .select(*columns).withColumnsRenamed(dict(rename or {})))


def clean_reports(
    reports: DataFrame,
    entities: DataFrame,
    *,
    report_key: str,
    entity_key: str,
    columns: Sequence[str | Column],
    lower: Sequence[str] = (),
    fan_out: bool = False,
) -> DataFrame:
    """Reports of known entities, with some text columns in lower case.

    `fan_out=True` repeats a report once per version of its entity (an inner join
    to the versions); by default the versions only serve as a membership test.
    """
    keys = entities.select(F.col(entity_key).alias("_entity"))
    same = F.col(report_key) == F.col("_entity")
    joined = reports.join(keys, same) if fan_out else reports.join(keys.distinct(), same, "left_semi")
    return joined.select(*columns).withColumns({c: F.lower(c) for c in lower})
