"""Cohorts and labels for all splits in one pass."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.functions.dates import date_cell, next_day
from riskrank.operators.splits import (
    Span, TimeSplit, distinct_spans, known_cuts, require_dates, span_cuts, spread_over_spans, to_split_rows,
    visible_rows,
)


def build_cohort(
    events: DataFrame,
    splits: Sequence[TimeSplit],
    *,
    entity: str = "entity_id",
    event_date: str = "event_date",
) -> DataFrame:
    """(split_id, entity): entities with an event on or before the split's as-of date.

    One aggregation to each entity's first event date serves every split.
    """
    as_of: dict = {}
    for s in splits:
        as_of.setdefault(s.as_of, []).append(s.split_id)
    # a cohort looks back without limit: only the ends of these spans matter
    spans = [Span(day, day, tuple(ids)) for day, ids in sorted(as_of.items())]
    first = (events.where(F.col(event_date) <= F.lit(spans[-1].end)).groupBy(entity)
             .agg(F.min(event_date).alias("_first")))
    marks = [F.when(F.col("_first") <= F.lit(s.end), F.lit(i)) for i, s in enumerate(spans)]
    spread = first.withColumn("_span", F.explode(F.array(*marks))).where("_span is not null")
    return to_split_rows(spread.drop("_first"), spans)


def select_labels(
    labels: DataFrame,
    splits: Sequence[TimeSplit],
    *,
    entity: str = "entity_id",
    event_date: str = "event_date",
    knowledge_date: str = "knowledge_date",
    label: str = "label",
    half_open: bool = False,
) -> DataFrame:
    """(split_id, entity, label): the largest label dated and known within the label window.

    The window includes both ends, so the day it shares with the feature window
    counts twice; `half_open=True` leaves its first day to the features.
    """
    require_dates(labels, event_date, knowledge_date)
    spans = distinct_spans(splits, "label")
    if half_open:
        spans = [Span(next_day(s.start), s.end, s.split_ids) for s in spans]
    cells = (visible_rows(labels, spans, event_date, knowledge_date)
             .groupBy(entity,
                      date_cell(F.col(event_date), span_cuts(spans)).alias("_day"),
                      date_cell(F.col(knowledge_date), known_cuts(spans)).alias("_known"))
             .agg(F.max(label).alias("_label")))
    largest = (spread_over_spans(cells.repartition(entity), spans, "_day", "_known")
               .groupBy(entity, "_span").agg(F.max("_label").alias("label")))
    return to_split_rows(largest, spans)


def query_per_split(
    spark: SparkSession,
    query: str,
    splits: Sequence[TimeSplit],
    placeholders: Mapping[str, str],
    constants: Mapping[str, str] | None = None,
) -> DataFrame:
    """A user's own cohort or label query for every distinct set of dates.

    `placeholders` maps a `{name}` in the query to a split attribute, for example
    `{"as_of_date": "as_of"}`; `constants` replaces further names such as `prefix`.
    All sets of dates are served by one plan, in which the query is the inner side of
    a lateral join with the table of dates and reads its own tables once.  Where
    dates stand in places a column cannot, or Spark cannot take the query out of
    the join, the query runs once per set of dates.
    """
    runs: dict[tuple, list[int]] = {}
    for s in splits:
        runs.setdefault(tuple(getattr(s, a) for a in placeholders.values()), []).append(s.split_id)
    for name, value in (constants or {}).items():
        query = query.replace("{" + name + "}", str(value))
    frame = _lateral(spark, query, runs, list(placeholders))
    if frame is not None:
        return frame
    frames = []
    for days, ids in runs.items():
        text = query
        for name, value in zip(placeholders, days):
            text = text.replace("{" + name + "}", str(value))
        frame = spark.sql(text)
        frames.append(frame.select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("split_id"), "*"))
    return reduce(DataFrame.unionByName, frames)


def _lateral(spark: SparkSession, query: str, runs: Mapping[tuple, list[int]], names: Sequence[str]) -> DataFrame | None:
    """The query joined laterally to its dates, or nothing where that is not possible.

    A quoted date, with or without `date` before it, becomes a column of the table of dates.
    """
    for i, name in enumerate(names):
        query = re.sub(rf"(?i)(\bdate\s*)?'\{{{name}\}}'", f"_dates._d{i}", query)
    if not names or any("{" + name + "}" in query for name in names):
        return None
    rows = ", ".join("({}, {})".format(", ".join(f"date '{d}'" for d in days), f"array({', '.join(map(str, ids))})")
                     for days, ids in runs.items())
    columns = ", ".join(f"_d{i}" for i in range(len(names)))
    text = (f"select _dates._ids, _found.* from values {rows} as _dates({columns}, _ids), "
            f"lateral ({query.strip().rstrip(';')}) as _found")
    try:
        frame = spark.sql(text)
        frame._jdf.queryExecution().optimizedPlan()  # the query leaves the join here, or not at all
    except Exception as error:  # noqa: BLE001
        if not _is_refused(error):
            raise
        return None
    return frame.select(F.explode("_ids").alias("split_id"), *[f"`{c}`" for c in frame.columns if c != "_ids"])


def _is_refused(error: Exception) -> bool:
    """Whether Spark refused a lateral query, and not a query that would fail by itself as well."""
    return isinstance(error, (AnalysisException, ParseException)) or "correlated" in str(error).lower()
