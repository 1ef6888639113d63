"""Demographics of the place an entity is in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def geo_demographics(
    facilities: DataFrame,
    blocks: DataFrame,
    link: DataFrame,
    density: DataFrame,
    county_income: DataFrame,
    entity_ids: DataFrame,
) -> DataFrame:
    """Postal-area and county measures per entity.

    Inputs: facilities (id_number, zip_code); blocks (state, county, tract,
    population); link (state, county, tract, zip); density (zip, zip_area_sq_miles,
    zip_density_sq_miles); county_income (state, county, mean_county_income);
    entity_ids (id_number, id).  An area in several counties yields one row per
    county; areas without data keep the entity with NULLs.

    Each input is reduced to distinct areas or counties before any join, so the
    facility side meets each area once instead of once per block group.
    """
    income = county_income.select("state", "county", "mean_county_income").distinct()
    zip_totals = (
        blocks.join(income, ["state", "county"], "left")
        .join(link, ["state", "county", "tract"])
        .groupBy("zip")
        .agg(F.sum("population").alias("zip_population"),
             F.min("mean_county_income").alias("mean_county_income")))
    zip_density = density.select("zip", "zip_area_sq_miles", "zip_density_sq_miles").distinct()
    county_totals = blocks.groupBy("county").agg(F.sum("population").alias("county_population"))
    # the county comes from the totals, so a linked county without blocks stays NULL
    zip_county = (
        link.select("zip", F.col("county").alias("_county")).distinct()
        .join(county_totals, F.col("_county") == F.col("county"), "left")
        .select("zip", "county", "county_population").distinct())

    def on_zip(right: DataFrame, mark: str) -> DataFrame:
        return right.withColumnRenamed("zip", mark)

    placed = (
        facilities.select("id_number", "zip_code").distinct()
        .join(on_zip(zip_totals, "zip"), F.col("zip_code") == F.col("zip"), "left")
        .join(on_zip(zip_density, "_dz"), F.col("zip_code") == F.col("_dz"), "left")
        .join(on_zip(zip_county, "_cz"), F.col("zip_code") == F.col("_cz"), "left")
        .drop("zip_code", "_dz", "_cz").distinct())
    return placed.join(entity_ids, "id_number").select(
        F.col("id").alias("entity_id"), "zip", "zip_population", "county", "county_population",
        "zip_area_sq_miles", "zip_density_sq_miles", "mean_county_income")
