"""Entity-by-year panels from coded reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.expressions import code_category
from riskrank.session import cut_lineage, join_large


def categorize_codes(
    df: DataFrame,
    column: str,
    *,
    exact: Mapping[str, str],
    prefixes: Mapping[str, str],
    default: str,
    output: str = "category",
) -> DataFrame:
    """Map codes to categories: exact code, then leading characters, then the default."""
    return df.withColumn(output, code_category(F.col(column), exact, prefixes, default))


def positive_or_zero(column: Column) -> Column:
    """Missing, zero and negative values become 0."""
    return F.when(column > 0, column).otherwise(F.lit(0.0))


#: Values of a dimension that are gathered and unfolded next to every base value.
BLOCK_VALUES = 10_000
#: Values a side of a tile, where a dimension has more than that.
TILE_VALUES = 1_000


def complete_grid(df: DataFrame, base: str, dims: Mapping[str, Sequence | None]) -> DataFrame:
    """Distinct values of `base` combined with every value of each dimension.

    `base` stays distributed.  A dimension's values (years, categories) are given by the
    caller or read from the data, and unfolded next to every base value, so nothing is
    cross joined.  More values than `BLOCK_VALUES` are not gathered but meet the grid in tiles.
    `df` is read several times, so it should be a written table.
    """
    grid = df.select(base).where(F.col(base).isNotNull()).distinct()
    for dim, values in dims.items():
        if values is not None:
            grid = grid.withColumn(dim, F.explode(F.array(*[F.lit(v) for v in values])))
            continue
        found = df.select(dim).where(F.col(dim).isNotNull()).distinct()
        number = found.count()
        if number <= BLOCK_VALUES:
            gathered = found.agg(F.sort_array(F.collect_list(dim)).alias("v")).scalar()
            grid = grid.withColumn(dim, F.explode(gathered))
        else:
            grid = _tiled(grid, found, grid.count(), number)
    return grid


def _tiled(left: DataFrame, right: DataFrame, left_rows: int, right_rows: int) -> DataFrame:
    """Every row of `left` next to every row of `right`.

    Both are cut by hash into parts of about `TILE_VALUES` rows; a row is copied once for
    every part of the other side, and a pair meets in the one tile of their two parts.
    Copies are thus a small share of the result, however large the sides are.
    """
    parts = {"_left": -(-left_rows // TILE_VALUES) or 1, "_right": -(-right_rows // TILE_VALUES) or 1}

    def copied(df: DataFrame, own: str, other: str) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(parts[own])))
        # counted on from the row's own part: a constant list of all parts would be kept in the plan
        every = F.sequence(F.col(own), F.col(own) + F.lit(parts[other] - 1))
        return df.withColumn(other, F.explode(every)).withColumn(other, F.pmod(other, F.lit(parts[other])))

    pairs = join_large(copied(left, "_left", "_right"), copied(right, "_right", "_left"), ["_left", "_right"], "inner")
    return pairs.select(*left.columns, *right.columns)


def densify(
    df: DataFrame, base: str, dims: Mapping[str, Sequence | None], value: str
) -> DataFrame:
    """All combinations of base and dimensions; absent or non-positive values become 0.

    `df` holds at most one row per combination; it is written once, since the grid
    and the values both come from it.
    """
    keys = [base, *dims]
    df = cut_lineage(df.select(*keys, value))
    grid = complete_grid(df, base, dims)
    filled = join_large(grid, df, keys)
    return filled.withColumn(value, positive_or_zero(F.col(value)))


def pivot_wide(
    df: DataFrame, keys: Sequence[str], column: str, value: str, values: Sequence[str]
) -> DataFrame:
    """Long to wide with declared output columns, matched by name; absent cells are NULL.

    One conditional sum per declared value: a single shuffle on the keys with
    partial sums before it, and no extra job to find the values.
    """
    cells = [F.sum(F.when(F.col(column) == v, F.col(value))).alias(v) for v in values]
    return df.groupBy(*keys).agg(*cells)


def reporting_panel(
    reports: DataFrame,
    entity_ids: DataFrame,
    *,
    key: str,
    cycle: str,
    code: str,
    tons: str,
    exact: Mapping[str, str],
    prefixes: Mapping[str, str],
    default: str,
    categories: Sequence[str],
) -> DataFrame:
    """Tons per category for every entity in every report year, dated 31 December.

    Summed straight into the wide form; only (entity, year) is then completed, so
    the long entity x year x category grid never exists.  The sums are written once:
    the entities, the years and the values are all read from them, not from the reports.
    """
    coded = categorize_codes(reports, code, exact=exact, prefixes=prefixes, default=default)
    coded = coded.withColumn(cycle, F.col(cycle).cast("int")).where(F.col(cycle).isNotNull())
    wide = cut_lineage(pivot_wide(coded, [key, cycle], "category", tons, categories))
    grid = complete_grid(wide, key, {cycle: None})
    ids = entity_ids.select(F.col("id_number").alias(key), F.col("id").alias("entity_id"))
    return join_large(grid, wide, [key, cycle]).join(ids, key).select(
        "entity_id",
        F.make_date(F.col(cycle), F.lit(12), F.lit(31)).alias("event_date"),
        *[positive_or_zero(F.col(c)).alias(c) for c in categories],
    )
