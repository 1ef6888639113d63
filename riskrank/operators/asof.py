"""As-of lookups: the latest version known when an event happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from riskrank.operators.ranking import place_rows


def first_per_group(df: DataFrame, group: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per group, the first in `order`.

    Spark keeps at most one row per group in every map task before the shuffle
    (`WindowGroupLimit`), so a group holding a third of the table sends one row
    per task, not all of its rows.
    """
    ranked = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rn", ranked).where("_rn = 1").drop("_rn")


def asof_latest_version(
    events: DataFrame,
    versions: DataFrame,
    *,
    event_key: str,
    event_ts: str,
    version_key: str,
    version_ts: str,
    event_order: Sequence[Column],
    version_order: Sequence[Column],
    spread: bool | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Per (key, event time): one event row with the latest version at or before it.

    Both sides are first reduced to one row per (key, time), then merged into one
    timeline per key on which the last version is carried forward, so no key ever
    pairs all its events with all its versions.  With dates a timeline is bounded
    by the calendar and stays in one task.  With anything finer it is not: timelines
    are cut into ranges of bounded size, the version is carried inside each, and the
    last one of a key handed from one range to the next.  `spread` overrides the choice.

    `event_order` / `version_order` decide among rows that share a key and a time.
    Events before the first version, and NULL keys or times, have no match.  A column
    that both sides have is the version's.
    """
    events = events.where(F.col(event_key).isNotNull() & F.col(event_ts).isNotNull())
    versions = versions.where(F.col(version_key).isNotNull() & F.col(version_ts).isNotNull())
    events = first_per_group(events, [event_key, event_ts], event_order)
    versions = first_per_group(versions, [version_key, version_ts], version_order)

    timeline = _merged(events, event_key, event_ts, versions, version_key, version_ts)
    if spread is None:
        kinds = {events.schema[event_ts].dataType, versions.schema[version_ts].dataType}
        spread = kinds != {DateType()}
    if spread:
        matched = _carry_over_ranges(timeline, partitions)
    else:
        along = Window.partitionBy("_key").orderBy("_ts", "_kind")
        matched = timeline.withColumn("_version", F.last("_version", ignorenulls=True).over(along))

    matched = matched.where((F.col("_kind") == 1) & F.col("_version").isNotNull())
    event_only = [c for c in events.columns if c not in versions.columns]
    return matched.select("_version.*", *[F.col("_event")[c].alias(c) for c in event_only])


def _merged(events, event_key, event_ts, versions, version_key, version_ts) -> DataFrame:
    """Versions (kind 0) and events (kind 1) as one set of timelines."""
    version_row, event_row = F.struct(*versions.columns), F.struct(*events.columns)
    version_type = versions.select(version_row.alias("s")).schema[0].dataType
    event_type = events.select(event_row.alias("s")).schema[0].dataType
    return versions.select(
        F.col(version_key).alias("_key"), F.col(version_ts).alias("_ts"), F.lit(0).alias("_kind"),
        version_row.alias("_version"), F.lit(None).cast(event_type).alias("_event"),
    ).unionByName(events.select(
        F.col(event_key).alias("_key"), F.col(event_ts).alias("_ts"), F.lit(1).alias("_kind"),
        F.lit(None).cast(version_type).alias("_version"), event_row.alias("_event"),
    ))


def _carry_over_ranges(timeline: DataFrame, partitions: int | None) -> DataFrame:
    placed = place_rows(timeline, [F.col("_key"), F.col("_ts"), F.col("_kind")], partitions)
    closing = placed.groupBy("_part", "_key").agg(
        F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_row"))).alias("_closing"))
    earlier = (Window.partitionBy("_key").orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    # only a key cut by a range border has an opening: fewer rows than ranges
    opening = closing.select(
        F.col("_part").alias("_in_part"), F.col("_key").alias("_in_key"),
        F.last("_closing", ignorenulls=True).over(earlier).alias("_opening"),
    ).where("_opening is not null")
    within = Window.partitionBy("_part", "_key").orderBy("_row")
    carried = placed.withColumn("_version", F.last("_version", ignorenulls=True).over(within))
    return carried.join(
        opening, (F.col("_part") == F.col("_in_part")) & (F.col("_key") == F.col("_in_key")), "left",
    ).withColumn("_version", F.coalesce("_version", "_opening"))
