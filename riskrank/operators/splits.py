"""Rolling train/test time splits and the fan-out of dated rows over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.functions.dates import next_day, parse_date, parse_interval, shift

SPLIT_SCHEMA = ("split_id int, repeat int, role string, split int, feature_start date, "
                "feature_end date, label_start date, label_end date, as_of date")


@dataclass(frozen=True)
class TimeSplit:
    """One training as-of date or one test period of one repeat."""

    split_id: int
    repeat: int
    role: str
    split: int
    feature_start: date
    feature_end: date
    label_start: date
    label_end: date
    as_of: date


def temporal_splits(cfg: Mapping, cohort_as_of: str = "test_label_end") -> list[TimeSplit]:
    """Plan all splits from the temporal settings of an experiment.

    Repeat i trains on as-of dates stepping through its feature duration, always
    with features from the global start (expanding), and tests on one period that
    slides with i and starts one label duration later.  The label window starts on
    the day the feature window ends.  `cohort_as_of='test_label_end'` takes every
    cohort of a repeat as of the end of its test labels; `'feature_end'` takes it
    as of the split's own feature end, which uses no later knowledge.
    """
    if cohort_as_of not in ("test_label_end", "feature_end"):
        raise ValueError(f"unknown cohort_as_of {cohort_as_of!r}")
    start = parse_date(cfg["feature_start_time"])
    duration = parse_interval(cfg["feature_duration"])
    label = parse_interval(cfg["label_duration"])
    repeat_every = parse_interval(cfg["train_repeat_interval"])
    step = parse_interval(cfg["feature_aod_interval"])
    if shift(start, step) <= start:
        raise ValueError("feature_aod_interval must move forward")

    splits: list[TimeSplit] = []

    def add(repeat: int, role: str, ordinal: int, first: date, last: date, test_end: date) -> None:
        end = shift(last, label)
        as_of = test_end if cohort_as_of == "test_label_end" else last
        splits.append(TimeSplit(len(splits), repeat, role, ordinal, first, last, last, end, as_of))

    for i in range(cfg["num_train_repeat"]):
        train_start = shift(start, repeat_every * i)
        test_start = shift(train_start, label)
        test_end = shift(shift(test_start, duration), label)
        ordinal, as_of = 0, shift(train_start, step)
        while as_of <= shift(train_start, duration):
            add(i, "train", ordinal, start, as_of, test_end)
            ordinal, as_of = ordinal + 1, shift(as_of, step)
        add(i, "test", 0, test_start, shift(test_start, duration), test_end)
    return splits


def splits_frame(spark: SparkSession, splits: Sequence[TimeSplit]) -> DataFrame:
    rows = [tuple(s.__dict__.values()) for s in splits]
    return spark.createDataFrame(rows, SPLIT_SCHEMA)


@dataclass(frozen=True)
class Span:
    """A visibility window with the splits that share it."""

    start: date
    end: date
    split_ids: tuple[int, ...]


def distinct_spans(splits: Sequence[TimeSplit], window: str) -> list[Span]:
    """The distinct `feature` or `label` windows of the splits.

    Repeats overlap, so there are fewer windows than splits, and everything that
    depends on the window alone is computed once per window.
    """
    members: dict[tuple[date, date], list[int]] = {}
    for s in splits:
        members.setdefault((getattr(s, f"{window}_start"), getattr(s, f"{window}_end")), []).append(s.split_id)
    return [Span(a, b, tuple(ids)) for (a, b), ids in sorted(members.items())]


def to_split_rows(df: DataFrame, spans: Sequence[Span], span_col: str = "_span") -> DataFrame:
    """Replace a span index by one row per split that uses the span."""
    ids = F.array(*[F.array(*[F.lit(i) for i in s.split_ids]) for s in spans])
    others = [c for c in df.columns if c != span_col]
    return df.select(F.explode(F.get(ids, F.col(span_col))).alias("split_id"), *others)


def fan_out(
    df: DataFrame,
    splits: Sequence[TimeSplit],
    *,
    event_date: str = "event_date",
    knowledge_date: str | None = None,
    window: str = "feature",
) -> DataFrame:
    """One copy of a dated row for every split in whose window it is visible.

    Visible: the event date lies in the window, ends included, and the row was
    known by the window's end.  The splits are part of the expression, so there is
    no join; rows no split can see are filtered at the scan.
    """
    spans = distinct_spans(splits, window)
    seen = visible_rows(df, spans, event_date, knowledge_date)
    return to_split_rows(spread_over_spans(seen, spans, event_date, knowledge_date), spans)


def spread_over_spans(
    df: DataFrame, spans: Sequence[Span], event: str, known: str | None
) -> DataFrame:
    """One copy of a row per span that sees it, with the span's index as `_span`."""
    marks = []
    for i, s in enumerate(spans):
        inside = F.col(event).between(F.lit(s.start), F.lit(s.end))
        if known:
            inside &= F.col(known) <= F.lit(s.end)
        marks.append(F.when(inside, F.lit(i)))
    return df.withColumn("_span", F.explode(F.array(*marks))).where("_span is not null")


def visible_rows(
    df: DataFrame, spans: Sequence[Span], event_date: str, knowledge_date: str | None
) -> DataFrame:
    """Rows that at least one span might see; NULL dates are never visible."""
    first, last = min(s.start for s in spans), max(s.end for s in spans)
    seen = df.where(F.col(event_date).between(F.lit(first), F.lit(last)))
    if knowledge_date:
        seen = seen.where(F.col(knowledge_date) <= F.lit(last))
    return seen


def require_dates(df: DataFrame, *columns: str) -> None:
    """Date cells are whole days, so the columns they are made from must be dates."""
    for c in columns:
        kind = df.schema[c].dataType.simpleString()
        if kind != "date":
            raise TypeError(f"column {c!r} is a {kind}, expected a date: cast it first")


def span_cuts(spans: Sequence[Span], extra: Sequence[date] = ()) -> list[date]:
    """Days on which the answer to any span's event-date test can change."""
    return sorted({s.start for s in spans} | {next_day(s.end) for s in spans} | set(extra))


def known_cuts(spans: Sequence[Span]) -> list[date]:
    return sorted({next_day(s.end) for s in spans})


def union_splits(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames, tagging each with its position as `split`."""
    tagged = [f.select(F.lit(i).alias("split"), *f.columns) for i, f in enumerate(frames)]
    return reduce(DataFrame.unionByName, tagged)
