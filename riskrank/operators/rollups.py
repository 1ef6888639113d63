"""Bitemporal rollups of inspections to one event per entity version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import any_flag


def _dated(
    inspections: DataFrame, key: str, version: str, event_date: str, known_dates: Sequence[str],
    measures: Sequence[Column],
) -> DataFrame:
    known = F.greatest(*known_dates) if len(known_dates) > 1 else F.col(known_dates[0])
    return inspections.groupBy(key, version).agg(
        F.max(event_date).alias("event_date"), F.max(known).alias("knowledge_date"), *measures)


def _with_ids(
    rolled: DataFrame, entity_ids: DataFrame, event_ids: DataFrame, key: str, version: str,
    measures: Sequence[str],
) -> DataFrame:
    entities = entity_ids.select(F.col("id_number").alias(key), F.col("id").alias("entity_id"))
    events = event_ids.select(key, version, F.col("id").alias("event_id"))
    return (rolled.join(entities, key).join(events, [key, version])
            .select("entity_id", "event_id", "event_date", "knowledge_date", *measures))


def rollup_events(
    inspections: DataFrame,
    entity_ids: DataFrame,
    event_ids: DataFrame,
    *,
    key: str,
    version: str,
    event_date: str,
    known_dates: Sequence[str],
    violation: Column,
    complaint: Column,
    amount: str,
) -> DataFrame:
    """One event per (entity, version): latest date, when all of it was known, and measures.

    The knowledge date is the latest of all listed dates over the group, ignoring
    NULLs.  `entity_ids` has (id_number, id); `event_ids` has (key, version, id).
    """
    rolled = _dated(inspections, key, version, event_date, known_dates, [
        any_flag(violation).alias("found_violation"),
        any_flag(complaint).alias("citizen_complaint"),
        F.coalesce(F.max(amount), F.lit(0)).alias("penalty_amount"),
    ])
    return _with_ids(rolled, entity_ids, event_ids, key, version,
                     ["found_violation", "citizen_complaint", "penalty_amount"])


def rollup_labels(
    inspections: DataFrame,
    entity_ids: DataFrame,
    event_ids: DataFrame,
    *,
    key: str,
    version: str,
    event_date: str,
    known_dates: Sequence[str],
    amount: str,
) -> DataFrame:
    """One label per (entity, version): 1 when the largest amount is above zero, else 0."""
    positive = F.when(F.max(amount) > 0, 1).otherwise(0).alias("label")
    rolled = _dated(inspections, key, version, event_date, known_dates, [positive])
    return _with_ids(rolled, entity_ids, event_ids, key, version, ["label"])
