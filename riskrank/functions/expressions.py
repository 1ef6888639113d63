"""Small reusable Column builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean across columns of one row, skipping NULLs; NULL when all are NULL."""
    present = [F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in columns]
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    return F.try_divide(sum(values[1:], values[0]), sum(present[1:], present[0]))


def any_flag(condition: Column) -> Column:
    """Aggregate: 1 when any row of the group meets the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of failing on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def short_class(column: Column) -> Column:
    """The part of a dotted class name after the last dot."""
    return F.substring_index(column, ".", -1)


def code_category(
    column: Column, exact: Mapping[str, str], prefixes: Mapping[str, str], default: str
) -> Column:
    """Exact code matches first, then matches on leading characters, else the default."""
    chain = None
    for code, category in exact.items():
        condition = column == code
        chain = F.when(condition, category) if chain is None else chain.when(condition, category)
    for prefix, category in prefixes.items():
        condition = column.startswith(prefix)
        chain = F.when(condition, category) if chain is None else chain.when(condition, category)
    return F.lit(default) if chain is None else chain.otherwise(default)
