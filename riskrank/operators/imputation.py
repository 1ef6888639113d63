"""Filling missing features, with optional 0/1 flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import all_of
from riskrank.presets import INFINITY_FILL
from riskrank.session import broadcast_if_small

_CONSTANTS = {"zero": 0, "inf": INFINITY_FILL}
_STATISTICS = {"mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Strategy:
    """A constant, or a column statistic; `flag` adds `{column}_impute_flag`."""

    constant: int | None
    statistic: str | None
    flag: bool


def parse_strategy(text: str) -> Strategy:
    """Read a strategy name, by its beginning; the ending `_noflag` drops the flag."""
    flag = not text.endswith("_noflag")
    for name, value in _CONSTANTS.items():
        if text.startswith(name):
            return Strategy(value, None, flag)
    for name in _STATISTICS:
        if text.startswith(name):
            return Strategy(None, name, flag)
    raise ValueError(f"unknown imputation {text!r}")


def _statistic_name(column: str) -> str:
    return f"_stat_{column}"


def fill_statistics(df: DataFrame, fills: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """One row per group with the statistic each column is filled from."""
    return df.groupBy(*by).agg(*[
        _STATISTICS[parse_strategy(f).statistic](c).alias(_statistic_name(c)) for c, f in fills.items()])


def fill_columns(fills: Mapping[str, str | None]) -> list[Column]:
    """Filled columns, each followed by its flag when its strategy has one."""
    out: list[Column] = []
    for name, text in fills.items():
        if text is None:
            out.append(F.col(name))
            continue
        strategy = parse_strategy(text)
        value = (F.lit(strategy.constant) if strategy.statistic is None
                 else F.col(_statistic_name(name)))
        out.append(F.coalesce(F.col(name), value).alias(name))
        if strategy.flag:
            out.append(F.when(F.col(name).isNull(), 1).otherwise(0).alias(f"{name}_impute_flag"))
    return out


def impute(
    df: DataFrame,
    fills: Mapping[str, str],
    *,
    by: Sequence[str] = ("split_id",),
    groups: int | None = None,
) -> DataFrame:
    """Fill NULLs per column with a constant or with the column's statistic in its group.

    A column that is NULL throughout a group stays NULL there (and is flagged).
    `groups`, when known, bounds the statistics table and lets it be broadcast;
    without it Catalyst decides from the size it measures.
    """
    measured = {c: f for c, f in fills.items() if parse_strategy(f).statistic}
    out = df
    if measured:
        stats = fill_statistics(df, measured, by)
        stats = stats.select(*[F.col(b).alias(f"_by_{b}") for b in by],
                             *[_statistic_name(c) for c in measured])
        if groups is not None:
            stats = broadcast_if_small(stats, groups, 16 * len(stats.columns))
        out = df.join(stats, all_of([F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]), "left")
    kept = [c for c in df.columns if c not in fills]
    return out.select(*kept, *fill_columns(fills))
