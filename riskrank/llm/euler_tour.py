"""Distributed list ranking: running sums along a linked list of any length that is spread over many tasks.

An element is named by two numbers, `a` and `b`, and names the next one by `na` and `nb` (null at the end).  Every round
tosses a coin per element, by a hash of its name, and splices out the elements with heads whose forerunner has tails:
about a quarter, no two of them neighbours.  The forerunner takes over their values, and a table notes how far behind it
each one lay.  When few elements are left one task walks them, and the rounds are undone in reverse.  A round is one
join on unique names, so no key is hot, and all rounds together move about four times the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.session import cut_lineage

#: The list that one task walks in the end has at most this many elements.
BASE = 1 << 15


def _coin(toss: int, a: Column, b: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(toss), a, b), F.lit(2)) == 1


def _splice(links: DataFrame, values: Sequence[str], toss: int) -> DataFrame:
    """One round: what is left, and in the rows that took over another element its name and the way to it."""
    heads, next_heads = _coin(toss, F.col("a"), F.col("b")), _coin(toss, F.col("na"), F.col("nb"))
    before = ~heads & F.col("na").isNotNull() & next_heads
    y = links.filter(before).select("a", "b", F.col("na").alias("xa"), F.col("nb").alias("xb"),
                                    *[F.col(v).alias(f"y_{v}") for v in values])
    x = links.filter(heads).select(F.col("a").alias("xa"), F.col("b").alias("xb"), "na", "nb", *values)
    met = y.join(x, ["xa", "xb"], "full_outer")
    taken = F.col("a").isNotNull()
    spliced = met.select(
        F.coalesce("a", "xa").alias("a"), F.coalesce("b", "xb").alias("b"), "na", "nb",
        *[(F.coalesce(f"y_{v}", F.lit(0)) + F.col(v)).alias(v) for v in values],
        F.when(taken, F.col("xa")).alias("xa"), F.when(taken, F.col("xb")).alias("xb"),
        *[F.when(taken, F.col(f"y_{v}")).alias(f"y_{v}") for v in values])
    return spliced.unionByName(links.filter(~heads & ~before), allowMissingColumns=True)


def _walk(values: Sequence[str]):
    """Sums before each element of a short list, by one task."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        after = {(a, b): (na, nb, v) for a, b, na, nb, *v in rows}
        starts = after.keys() - {(na, nb) for na, nb, _ in after.values()}
        out, sums = [], [0] * len(values)
        at = starts.pop() if starts else None
        while at in after:
            na, nb, v = after.pop(at)
            out.append((*at, *sums))
            sums, at = [s + x for s, x in zip(sums, v)], (na, nb)
        if starts or after:
            raise ValueError("the links are not one list")
        names = ["a", "b", *values]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names)

    return walk


def rank_list(links: DataFrame, values: Sequence[str], base: int = BASE) -> DataFrame:
    """(a, b, values): for each element of the list the sum of the values of all elements before it."""
    names = ["a", "b", "na", "nb", *values]
    current, rounds = cut_lineage(links.select(*names)), []
    while (left := current.count()) > base:
        step = cut_lineage(_splice(current, values, len(rounds)))
        rounds.append(step)
        current = step.select(*names)
        if len(rounds) > 60 + 4 * left.bit_length():
            raise ValueError("the links are not one list")
    schema = ", ".join(f"{c} long" for c in ["a", "b", *values])
    found = [cut_lineage(current.repartition(1).mapInArrow(_walk(values), schema))]
    for step in reversed(rounds):
        spliced = step.filter(F.col("xa").isNotNull()).select("a", "b", "xa", "xb", *[f"y_{v}" for v in values])
        before = reduce(DataFrame.unionByName, found)
        found.append(cut_lineage(spliced.join(before, ["a", "b"]).select(
            F.col("xa").alias("a"), F.col("xb").alias("b"), *[(F.col(v) + F.col(f"y_{v}")).alias(v) for v in values])))
    return reduce(DataFrame.unionByName, found)
