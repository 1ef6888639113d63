"""Exact distributed ranks: surrogate ids, rank scores and top-k flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrank.functions.expressions import all_of
from riskrank.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition id above, row position below


def place_rows(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Rows in global order, with `_row` (increasing) and `_part` (the range they fell in).

    Range partitioning spreads any group over as many ranges as it fills, ties
    included when `order` is total.  The placed rows are written once, because
    range bounds are sampled and every later step must see the same ones.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    return cut_lineage(placed).withColumn("_part", F.shiftright("_row", _ROW_BITS))


def rank_rows(
    df: DataFrame,
    order: Sequence[Column],
    *,
    group: Sequence[str] = (),
    rank: str = "rank",
    count: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Position (from 1) of every row inside its group, exact for any group size.

    Rows are placed in (group, order), so one large group spreads over many tasks.
    A row's rank is its position in its range plus the number of rows of its group
    in lower ranges; those counts form a table of about (ranges + groups) rows.
    `order` must be total, else ties break arbitrarily.
    """
    placed = place_rows(df, [F.col(g).asc() for g in group] + list(order), partitions)

    names = {g: f"_g{i}" for i, g in enumerate(group)}
    runs = placed.groupBy("_part", *[F.col(g).alias(n) for g, n in names.items()]).agg(
        F.count(F.lit(1)).alias("_run_rows"), F.min("_row").alias("_run_start"))
    whole = Window.partitionBy(*names.values()) if names else Window.partitionBy()
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"), *names.values(), "_run_start",
        F.coalesce(F.sum("_run_rows").over(before), F.lit(0)).alias("_run_before"),
        F.sum("_run_rows").over(whole).alias("_group_rows"),
    )
    same_run = all_of([F.col("_part") == F.col("_run_part"),
                       *[F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]])
    result = placed.join(runs, same_run).withColumn(
        rank, F.col("_run_before") + F.col("_row") - F.col("_run_start") + 1)
    if count:
        result = result.withColumn(count, F.col("_group_rows"))
    return result.select(*df.columns, rank, *([count] if count else []))


def running_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str], partitions: int | None = None,
) -> DataFrame:
    """Rows with `<value>_upto`, the sum over their group up to and with them, and `<value>_all`, that of the group.

    Exact for any group size, as `rank_rows`: a sum is that within the row's range plus those of lower ranges.
    `order` must be total within a group.
    """
    placed = place_rows(df, [F.col(c).asc() for c in (*group, *order)], partitions)
    names = {g: f"_g{i}" for i, g in enumerate(group)}
    parts = placed.groupBy(F.col("_part").alias("_run_part"), *[F.col(g).alias(n) for g, n in names.items()]).agg(
        *[F.sum(v).alias(f"_sum_{v}") for v in values])
    whole = Window.partitionBy(*names.values())
    before = whole.orderBy("_run_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_run_part", *names.values(),
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(whole).alias(f"{v}_all") for v in values])
    inside = Window.partitionBy("_part", *group).orderBy("_row")
    rows = placed.select("*", *[F.sum(v).over(inside).alias(f"_inside_{v}") for v in values])
    same = all_of([F.col("_part") == F.col("_run_part"),
                   *[F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]])
    return rows.join(parts, same).select(
        *df.columns, *[(F.col(f"_inside_{v}") + F.col(f"_before_{v}")).alias(f"{v}_upto") for v in values],
        *[f"{v}_all" for v in values])


def assign_surrogate_ids(
    df: DataFrame, key_cols: Sequence[str], id_col: str = "id", partitions: int | None = None
) -> DataFrame:
    """Distinct keys in order, numbered densely from 1."""
    keys = df.select(*key_cols).distinct()
    return rank_rows(keys, [F.col(c).asc_nulls_last() for c in key_cols],
                     rank=id_col, partitions=partitions)


def rank_baseline(
    df: DataFrame,
    column: str,
    *,
    sort: str = "desc",
    entity: str = "entity_id",
    group: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Score in [0, 1] evenly spaced over the order of one column.

    `desc`: the largest value scores 1; `asc`: the smallest does.  The smaller
    entity wins a tie.  A single row scores 0.  Class 1 when the score is above
    one half.  Adds `rank` (1 = highest score), `group_rows`, `probability` and
    `prediction`.
    """
    if sort not in ("asc", "desc"):
        raise ValueError(f"sort must be 'asc' or 'desc', not {sort!r}")
    by = F.col(column).desc_nulls_first() if sort == "desc" else F.col(column).asc_nulls_last()
    order = [by, *[F.col(c).asc() for c in (entity, *tiebreak)]]
    ranked = rank_rows(df, order, group=group, count="group_rows", partitions=partitions)
    rows = F.col("group_rows")
    score = F.when(rows == 1, F.lit(0.0)).otherwise(
        (rows - F.col("rank")).cast("double") / (rows - 1))
    return (ranked.withColumn("probability", score)
            .withColumn("prediction", F.col("probability") > 0.5))


def rank_scores(
    scores: DataFrame,
    *,
    entity: str = "entity_id",
    group: Sequence[str] = ("split_id", "model_id"),
    score: str = "probability",
    tiebreak: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add `rank` (1 = highest score, smaller entity wins ties) and `group_rows`.

    `tiebreak` names further columns where an entity occurs more than once in a group.
    """
    order = [F.col(score).desc(), *[F.col(c).asc() for c in (entity, *tiebreak)]]
    return rank_rows(scores, order, group=group, count="group_rows", partitions=partitions)


def cutoff(k: int | float, rows: Column) -> Column:
    """Rows to flag: an int is a count, a float is a proportion, truncated."""
    if isinstance(k, float):
        return F.floor(rows.cast("double") * F.lit(k))
    return F.lit(k)


def top_k_flags(ranked: DataFrame, ks: Sequence[int | float]) -> DataFrame:
    """Add `prediction_at_{k}` (0/1) for every k to rows that carry a rank.

    A proportion that truncates to 0 flags nothing; a k above the group size flags all.
    """
    flags = [(F.col("rank") <= cutoff(k, F.col("group_rows"))).cast("int").alias(f"prediction_at_{k}")
             for k in ks]
    return ranked.select("*", *flags)
