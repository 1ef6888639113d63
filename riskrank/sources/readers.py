"""Sources: landed files and user queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.presets import DENSITY_COLUMNS

_DENSITY_TYPES = ["string", "int", "double", "double"]


def load_zip_density(
    spark: SparkSession, path: str, columns: Sequence[str] = tuple(DENSITY_COLUMNS), width: int = 5
) -> DataFrame:
    """Headed CSV of area, population, size and density, under fixed names; area zero-padded."""
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(columns, _DENSITY_TYPES))
    df = spark.read.csv(path, schema=schema, header=True, enforceSchema=True)
    area = F.col(columns[0])
    padded = F.when(F.length(area) < width, F.lpad(area, width, "0")).otherwise(area)
    return df.withColumn(columns[0], padded)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    return spark.table(name).select(*columns)


def read_query(
    spark: SparkSession, query: str, *, replace: Mapping[str, str] | None = None, **values
) -> DataFrame:
    """A user's SELECT; `{name}` is replaced for table names, `:name` takes values."""
    for name, text in (replace or {}).items():
        query = query.replace("{" + name + "}", text)
    return spark.sql(query, args=values) if values else spark.sql(query)
