"""Aggregate expressions shared by the products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.functions.columns import as_col, first_existing, is_type

# Per-type counter name -> event type.
TYPE_COUNTERS = {
    "stars": "WatchEvent",
    "forks": "ForkEvent",
    "pushes": "PushEvent",
    "prs": "PullRequestEvent",
    "issues": "IssuesEvent",
}

# A percentile sketch keeps at most about this many samples per group, so its
# state is bounded whatever the group size; its rank error is rows / accuracy.
DEFAULT_ACCURACY = 10_000


def count_of(event_type: str) -> Column:
    return F.count_if(is_type(event_type))


def type_counts(names: Sequence[str] = tuple(TYPE_COUNTERS)) -> list[Column]:
    """One counter per activity type, all in the same pass."""
    return [count_of(TYPE_COUNTERS[n]).alias(n) for n in names]


def measured_sum(measurable: Column, condition: Column) -> Column:
    """Rows meeting ``condition`` among the measurable ones; NULL if none is measurable."""
    return F.sum(F.when(measurable, condition.cast("int")))


# Sketch size 2^14: a relative standard error below 0.01.
SKETCH_LOG2_SIZE = 14


def approx_distinct(c: Column | str) -> Column:
    """Distinct values from a mergeable sketch of fixed size; no shuffle of the values."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(as_col(c), SKETCH_LOG2_SIZE))


def percentile(c: Column | str, p: float, accuracy: int = DEFAULT_ACCURACY) -> Column:
    """Percentile from a mergeable sketch: partial per task, one small state per group."""
    return F.percentile_approx(as_col(c), p, accuracy)


def null_count(c: Column | str) -> Column:
    return F.count_if(as_col(c).isNull())


def null_counts(df: DataFrame, fields: dict[str, Sequence[str]]) -> DataFrame:
    """One row of NULL counts, all columns in one pass.

    ``fields`` maps an output name to candidate paths; a field without any
    existing path is NULL ("not measurable") rather than 0.
    """
    aggs = []
    for alias, candidates in fields.items():
        found = first_existing(df, candidates)
        aggs.append((null_count(found) if found else F.lit(None).cast("bigint")).alias(alias))
    return df.agg(*aggs)


def distinct_with_null(c: Column | str) -> Column:
    """Distinct values where NULL counts as one more value."""
    return F.count_distinct(as_col(c)) + F.max(as_col(c).isNull().cast("int"))


def rounded_avg(c: Column | str, digits: int) -> Column:
    return F.round(F.avg(as_col(c)), digits)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that is NULL, not an error, for a zero denominator."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def share_pct(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(F.lit(100.0) * as_col(numerator), denominator)


def value_counts(df: DataFrame, c: Column | str, name: str, count: str = "count") -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return (
        df.groupBy(as_col(c).alias(name))
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), F.asc_nulls_last(name))
    )


def metric_rows(row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame turned into (metric, value) rows, values as text."""
    texts = row.select(*[F.col(c).cast("string").alias(c) for c in row.columns])
    return texts.unpivot([], texts.columns, name, value)
