"""Metrics of the distribution of a column over trailing windows: median, percentiles, mode, distinct values.

Values are counted per (entity, date cell, knowledge cell) first, so a value that an entity has a million times is one
row.  Those counts are spread over the spans, added up by value and window, and placed in value order; a percentile is
then picked from running counts, so no entity's values have to fit one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.operators.ranking import running_sums
from riskrank.session import join_large

_PERCENTILE = re.compile(r"percentile_(\d{1,2}|100)")
_DISTINCT = ("count_distinct", "nunique")
#: Sketched metrics, by their state of a cell, the state of several, and the estimate: errors are those of the sketches.
_SKETCHED: dict[str, tuple[str, str, str]] = {
    "approx_count_distinct": ("hll_sketch_agg", "hll_union_agg", "hll_sketch_estimate"),
}


def share_of(metric: str) -> float | None:
    """The percentile a metric asks for, between 0 and 1."""
    if metric == "median":
        return 0.5
    found = _PERCENTILE.fullmatch(metric)
    return float(found[1]) / 100 if found else None


def is_counted(metric: str) -> bool:
    """Whether a metric follows from the counts of values."""
    return share_of(metric) is not None or metric == "mode" or metric in _DISTINCT


def is_sketched(metric: str) -> bool:
    return metric in _SKETCHED


def _percentile(value: Column, n: Column, upto: Column, total: Column, share: float) -> Column:
    """Between the two values next to the percentile's place, as far as it lies from the lower one."""
    place = (total - 1) * F.lit(share)
    low, high = F.floor(place), F.ceil(place)

    def at(rank: Column) -> Column:
        return F.max(F.when((upto - n <= rank) & (rank < upto), value.cast("double")))

    return at(low) + (at(high) - at(low)) * F.max(place - low)


def counted_features(
    cells: DataFrame, spread: Callable[[DataFrame], DataFrame], features: Sequence, entity: str,
    inside: Callable[[object, Column], Column],
) -> DataFrame:
    """(entity, _span, features) of the metrics that follow from counts of values.

    `cells` has (entity, _day, _known) and the columns; `spread` gives a copy per span, and `inside` keeps a value
    where the cell lies in a feature's window.
    """
    group, parts = [entity, "_span"], []
    for column in dict.fromkeys(f.column for f in features):
        mine = [f for f in features if f.column == column]
        windows = list(dict.fromkeys(f.window for f in mine))
        first = {w: next(f for f in mine if f.window == w) for w in windows}
        counts = cells.groupBy(entity, "_day", "_known", F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
        seen = F.col("_value").isNotNull()
        by_value = spread(counts).groupBy(*group, "_value").agg(
            *[F.coalesce(F.sum(F.when(seen, inside(first[w], F.col("_n")))), F.lit(0)).alias(f"_n{i}")
              for i, w in enumerate(windows)])
        numbers = [f"_n{i}" for i in range(len(windows))]
        if any(share_of(f.metric) is not None for f in mine):
            by_value = running_sums(by_value, group, ["_value"], numbers)
        finals = []
        for f in mine:
            n = F.col(f"_n{windows.index(f.window)}")
            if f.metric in _DISTINCT:
                final = F.count(F.when(n > 0, 1))
            elif f.metric == "mode":
                final = F.min(F.when(n > 0, F.struct(-n, F.col("_value").alias("value"))))["value"]
            else:
                name = f"_n{windows.index(f.window)}"
                final = _percentile(F.col("_value"), n, F.col(f"{name}_upto"), F.col(f"{name}_all"), share_of(f.metric))
            finals.append(final.alias(f.name))
        parts.append(by_value.groupBy(*group).agg(*finals))
    return reduce(lambda a, b: join_large(a, b, group, "inner"), parts)


def sketched_features(
    cells: DataFrame, spread: Callable[[DataFrame], DataFrame], features: Sequence, entity: str,
    inside: Callable[[object, Column], Column],
) -> DataFrame:
    """(entity, _span, features) of the metrics that are estimated from one sketch per cell."""
    needs = dict.fromkeys((f.metric, f.column) for f in features)
    names = {need: f"_sketch{i}" for i, need in enumerate(needs)}
    sketches = cells.groupBy(entity, "_day", "_known").agg(
        *[F.call_function(_SKETCHED[m][0], F.col(c)).alias(names[m, c]) for m, c in needs])
    finals = []
    for f in features:
        _, union, estimate = _SKETCHED[f.metric]
        merged = F.call_function(union, inside(f, F.col(names[f.metric, f.column])))
        finals.append(F.coalesce(F.call_function(estimate, merged), F.lit(0)).alias(f.name))
    return spread(sketches).groupBy(entity, "_span").agg(*finals)
