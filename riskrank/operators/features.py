"""Point-in-time features: trailing windows, days since, latest and static records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.functions.dates import date_cell, next_day, parse_interval, shift
from riskrank.functions.expressions import ratio
from riskrank.operators.asof import first_per_group
from riskrank.operators.imputation import fill_columns, fill_statistics, parse_strategy
from riskrank.operators.splits import (
    Span, TimeSplit, distinct_spans, known_cuts, require_dates, span_cuts, spread_over_spans, to_split_rows,
    visible_rows,
)
from riskrank.operators.value_metrics import counted_features, is_counted, is_sketched, sketched_features
from riskrank.session import broadcast_if_small, cut_lineage, join_large

# spread metrics: combined from the counts, means and squared deviations of cells
_SPREAD = {"stddev": (F.sqrt, 1), "stddev_samp": (F.sqrt, 1), "variance": (lambda x: x, 1), "var_samp": (lambda x: x, 1),
           "stddev_pop": (F.sqrt, 0), "var_pop": (lambda x: x, 0)}
# metrics that combine from per-cell sums, counts and extremes
_COMBINED = ("sum", "count", "avg", "mean", "min", "max", "datediff", *_SPREAD)


@dataclass(frozen=True)
class Feature:
    """One output column: a metric of one column over one trailing window."""

    name: str
    column: str
    metric: str
    window: str = "all"
    fill: str | None = None


@dataclass
class Block:
    """Feature columns ready to join to a cohort, with the fill of each.

    The frame has one row per entity, or with `spans` one per (entity, `_span`):
    splits that share a feature window share its rows.
    """

    frame: DataFrame
    fills: dict[str, str | None]
    spans: list[Span] | None = None


def compile_features(config: Mapping) -> list[Feature]:
    """Feature list of one event-table config: `{prefix}_{metric}_{column}[_{window}]`."""
    prefix, fills = config["prefix"], config.get("imputation", {})
    features = []
    for item in config["aggregates"]:
        column = item["column_name"]
        for metric in item["metrics"]:
            fill = fills.get(metric)
            if metric == "datediff":
                features.append(Feature(f"{prefix}_days_since_{column}", column, metric, "all", fill))
                continue
            for window in item.get("time_windows", ["all"]):
                suffix = "" if window == "all" else "_" + window.replace(" ", "_")
                features.append(Feature(f"{prefix}_{metric}_{column}{suffix}", column, metric, window, fill))
    return features


def _of_span(days: Sequence[date]) -> Column:
    """The span's entry in a list of days, one per span."""
    return F.get(F.array(*[F.lit(x) for x in days]), F.col("_span"))


def window_features(
    events: DataFrame,
    splits: Sequence[TimeSplit],
    features: Sequence[Feature],
    *,
    entity: str = "entity_id",
    event_date: str = "event_date",
    knowledge_date: str = "knowledge_date",
) -> DataFrame:
    """(split_id, entity, features) for all splits in one pass over the events.

    A row counts for a split when its event date lies in the split's feature
    window and it was known by the window's end.  A trailing window keeps event
    dates strictly after (end - window).  `datediff` is the smallest number of days
    from the column to the window's end, and has no trailing windows.

    All date tests compare with a short list of days, so events are first summed
    per (entity, date cell, knowledge cell) with partial sums before the shuffle.
    That leaves a few rows per entity, whatever its size; only these are spread
    over the splits, inside one partition per entity.  `median`, `percentile_<0..100>`,
    `mode` (of several, the smallest) and `count_distinct` follow from counts of values
    per cell, `approx_count_distinct` from a sketch per cell.  Any other metric Spark
    knows is evaluated on the rows themselves.
    """
    spans = distinct_spans(splits, "feature")
    return to_split_rows(_window_rows(events, spans, features, entity, event_date, knowledge_date), spans)


def _window_rows(events, spans, features, entity, event_date, knowledge_date) -> DataFrame:
    """(entity, _span, features): as above, before spans are unfolded to splits."""
    require_dates(events, event_date, knowledge_date)
    combined = [f for f in features if f.metric in _COMBINED]
    counted = [f for f in features if is_counted(f.metric)]
    sketched = [f for f in features if is_sketched(f.metric)]
    direct = [f for f in features if f not in combined and f not in counted and f not in sketched]
    seen = visible_rows(events, spans, event_date, knowledge_date)

    parts = []
    if combined:
        parts.append(_combined_features(seen, spans, combined, entity, event_date, knowledge_date))
    if direct:
        parts.append(_direct_features(seen, spans, direct, entity, event_date, knowledge_date))
    for some, build in ((counted, counted_features), (sketched, sketched_features)):
        if some:
            days, known = span_cuts(spans, _openings(spans, some)), known_cuts(spans)
            cells = seen.withColumns({"_day": date_cell(F.col(event_date), days), "_known": date_cell(F.col(knowledge_date), known)})
            parts.append(build(cells, lambda df: spread_over_spans(df, spans, "_day", "_known"), some, entity,
                               lambda f, value: _inside(f, spans, "_day", value)))
    result = reduce(lambda a, b: join_large(a, b, [entity, "_span"], "inner"), parts)
    return result.select(entity, "_span", *[f.name for f in features])


def _inside(feature: Feature, spans: Sequence[Span], event: str, value: Column) -> Column:
    if feature.window == "all" or feature.metric == "datediff":
        return value
    opening = _of_span([shift(s.end, -parse_interval(feature.window)) for s in spans])
    return F.when(F.col(event) > opening, value)


def _openings(spans: Sequence[Span], features: Sequence[Feature]) -> list[date]:
    """The first days of all trailing windows."""
    return [next_day(shift(s.end, -parse_interval(f.window))) for s in spans for f in features if f.window != "all"]


def _combined_features(seen, spans, features, entity, event_date, knowledge_date):
    needs: dict[str, tuple[str, str]] = {}
    for f in features:
        for kind in {"avg": ("sum", "count"), "mean": ("sum", "count"), "datediff": ("max",),
                     **dict.fromkeys(_SPREAD, ("count", "avg", "var_pop"))}.get(f.metric, (f.metric,)):
            needs[f"_{kind}_{f.column}"] = (kind, f.column)
    partials = [getattr(F, kind)(F.col(column).cast("double") if kind in ("avg", "var_pop") else column).alias(name)
                for name, (kind, column) in needs.items()]
    cells = seen.groupBy(
        entity,
        date_cell(F.col(event_date), span_cuts(spans, _openings(spans, features))).alias("_day"),
        date_cell(F.col(knowledge_date), known_cuts(spans)).alias("_known"),
    ).agg(*partials)

    # the day after an opening starts a cell, so a cell lies wholly inside or outside a window
    def total(f: Feature, kind: str, how) -> Column:
        return how(_inside(f, spans, "_day", F.col(f"_{kind}_{f.column}")))

    def spread(f: Feature) -> Column:
        """Squared deviations inside the cells, and of the cells' means from the mean of all."""
        n, mean, inner = (_inside(f, spans, "_day", F.col(f"_{k}_{f.column}")) for k in ("count", "avg", "var_pop"))
        rows, centre = F.sum(n), F.sum(n * mean) / F.sum(n)
        outer = F.greatest(F.sum(n * mean * mean) - rows * centre * centre, F.lit(0.0))
        root, freedom = _SPREAD[f.metric]
        return F.when(rows > freedom, root((F.sum(n * inner) + outer) / (rows - freedom)))

    def final(f: Feature) -> Column:
        if f.metric in _SPREAD:
            return spread(f)
        if f.metric in ("avg", "mean"):
            return ratio(total(f, "sum", F.sum), total(f, "count", F.sum))
        if f.metric == "count":
            return F.coalesce(total(f, "count", F.sum), F.lit(0).cast("bigint"))
        if f.metric == "datediff":
            return F.datediff(_of_span([s.end for s in spans]), total(f, "max", F.max).cast("date"))
        return total(f, f.metric, {"sum": F.sum, "min": F.min, "max": F.max}[f.metric])

    return (spread_over_spans(cells.repartition(entity), spans, "_day", "_known")
            .groupBy(entity, "_span").agg(*[final(f).alias(f.name) for f in features]))


def _direct_features(seen, spans, features, entity, event_date, knowledge_date):
    finals = [F.call_function(f.metric, _inside(f, spans, event_date, F.col(f.column))).alias(f.name)
              for f in features]
    return spread_over_spans(seen, spans, event_date, knowledge_date).groupBy(entity, "_span").agg(*finals)


def days_since_features(
    events: DataFrame,
    splits: Sequence[TimeSplit],
    columns: Sequence[str],
    *,
    prefix: str,
    entity: str = "entity_id",
    event_date: str = "event_date",
    knowledge_date: str = "knowledge_date",
) -> DataFrame:
    """Days from the latest value of each date column to the end of the feature window."""
    features = [Feature(f"{prefix}_days_since_{c}", c, "datediff") for c in columns]
    return window_features(events, splits, features, entity=entity,
                           event_date=event_date, knowledge_date=knowledge_date)


def latest_record_asof(
    df: DataFrame,
    splits: Sequence[TimeSplit],
    *,
    date_col: str,
    entity: str = "entity_id",
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Per split and entity, the record at the latest date inside the feature window.

    Records are first reduced to the latest per (entity, date cell), in every map
    task, so an entity with a long history is never gathered whole.  Records tied
    at the latest date are decided by `tiebreak`, then by their remaining columns.
    """
    spans = distinct_spans(splits, "feature")
    return to_split_rows(_latest_rows(df, spans, date_col, entity, tiebreak), spans)


def _latest_rows(df, spans, date_col, entity, tiebreak=()) -> DataFrame:
    require_dates(df, date_col)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (entity, date_col)]
    order = [F.col(date_col).desc(), *tiebreak, *rest]
    cell = date_cell(F.col(date_col), span_cuts(spans))
    latest = first_per_group(visible_rows(df, spans, date_col, None).withColumn("_cell", cell),
                             [entity, "_cell"], order).drop("_cell")
    spread = spread_over_spans(latest.repartition(entity), spans, date_col, None)
    return first_per_group(spread, [entity, "_span"], order)


def static_features(
    df: DataFrame,
    *,
    entity: str = "entity_id",
    columns: Sequence[str] | None = None,
    keep_duplicates: bool = False,
) -> DataFrame:
    """The entity and its columns in table order, all or only the listed ones.

    One row per entity: the first by all columns.  `keep_duplicates=True` leaves
    repeated entities as they are, so they repeat cohort rows when joined.
    """
    names = [c for c in df.columns if c != entity and (columns is None or c in columns)]
    picked = df.select(entity, *names)
    if keep_duplicates:
        return picked
    return first_per_group(picked, [entity], [F.col(c).asc_nulls_last() for c in names])


def source_table(spark: SparkSession, tables: Mapping[str, DataFrame], name: str, prefix: str = "") -> DataFrame:
    """A configured table: a given frame by its bare name, else from the catalog."""
    bare = name.split(".")[-1].replace("{prefix}_", "")
    return tables[bare] if bare in tables else spark.table(name.replace("{prefix}", prefix))


def feature_block(
    spark: SparkSession, tables: Mapping[str, DataFrame], splits: Sequence[TimeSplit], config: Mapping,
    *, entity: str = "entity_id", prefix: str = "",
) -> Block:
    """Features of one table as its config entry asks for them."""
    df = source_table(spark, tables, config["from_table"], prefix)
    kind = config["table_type"]
    spans = distinct_spans(splits, "feature")
    if kind == "event":
        features = compile_features(config)
        frame = _window_rows(df, spans, features, entity, config["event_date_column_name"],
                             config["knowledge_date_column_name"])
        return Block(frame, {f.name: f.fill for f in features}, spans)
    if kind != "entity":
        raise ValueError(f"unknown table_type {kind!r}")
    dated = config.get("event_date_column_name")
    names = [c for c in df.columns if c not in (entity, dated)
             and ("columns" not in config or c in config["columns"])]
    fills = {c: config["imputation"] for c in names}
    if dated:
        return Block(_latest_rows(df.select(entity, dated, *names), spans, dated, entity).drop(dated), fills, spans)
    return Block(static_features(df, entity=entity, columns=names), fills)


def assemble_features(
    cohort: DataFrame,
    blocks: Sequence[Block],
    splits: Sequence[TimeSplit],
    *,
    entity: str = "entity_id",
) -> DataFrame:
    """Left join every block to the cohort and impute, one row per cohort row.

    Column statistics are taken per split over the cohort.  A block needs only
    itself for them, so the wide join is not evaluated twice; a computed block
    with such fills is written once and read by both.
    """
    spans = distinct_spans(splits, "feature")
    span_of = {i: n for n, s in enumerate(spans) for i in s.split_ids}
    span = F.get(F.array(*[F.lit(span_of.get(i)) for i in range(max(span_of) + 1)]), F.col("split_id"))
    placed = cohort.withColumn("_span", span)
    out, statistics, fills = placed, None, {}
    for block in blocks:
        frame, keys = block.frame, [entity, "_span"] if block.spans else [entity]
        fills.update(block.fills)
        measured = {c: f for c, f in block.fills.items() if f and parse_strategy(f).statistic}
        if measured:
            if block.spans:
                frame = cut_lineage(frame)
            own = join_large(placed, frame.select(*keys, *measured), keys)
            found = fill_statistics(own, measured, ["split_id"])
            statistics = found if statistics is None else statistics.join(found, "split_id")
        out = join_large(out, frame, keys)
    if statistics is not None:
        statistics = broadcast_if_small(statistics, len(splits), 16 * len(statistics.columns))
        out = out.join(statistics, "split_id", "left")
    return out.select(*cohort.columns, *fill_columns(fills))
