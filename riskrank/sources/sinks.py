"""Sinks: Parquet tables by path or catalog name, and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskrank.functions.expressions import named


def write_table(
    df: DataFrame, target: str, *, mode: str = "replace", partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write Parquet and return the written table.

    `replace` drops what is there, `fail` refuses an existing table, and
    `replace_partitions` replaces only the partitions present in `df`.  A target
    with a slash is a path, otherwise a catalog table.  Rows of a partitioned table
    are rebalanced first, so each partition becomes files of a sensible size
    whatever its share of the rows, instead of one file per task and partition.
    """
    spark = df.sparkSession
    spark_mode = {"replace": "overwrite", "fail": "errorifexists", "replace_partitions": "overwrite"}[mode]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").mode(spark_mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "replace_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        writer.save(target)
        return spark.read.schema(df.schema).parquet(target).select(*[named(c) for c in df.columns])
    if mode == "replace_partitions" and spark.catalog.tableExists(target):
        # insertInto matches by position and needs the table's own layout
        by_position = df.select(*[named(c) for c in spark.table(target).columns])
        by_position.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").insertInto(target)
    else:
        writer.saveAsTable(target)
    return spark.table(target)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def ensure_layers(spark: SparkSession, layers: Sequence[str]) -> None:
    """Create the named schemas (for example cleaned, semantic, results) if missing."""
    for name in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
