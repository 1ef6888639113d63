"""Catalog lookups."""

from __future__ import annotations

from pyspark.sql import SparkSession


def table_names(spark: SparkSession, schema: str, prefix: str = "", suffix: str = "") -> list[str]:
    """Sorted names of the schema's tables that start and end as asked."""
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return sorted(n for n in names if n.startswith(prefix) and n.endswith(suffix))


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns
