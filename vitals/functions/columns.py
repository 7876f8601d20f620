"""Projections and predicates over event and model columns.

Only built-in expressions, so everything stays in generated code and every
predicate that compares a stored column with a literal reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAIN_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- schema-adaptive selection ----------------------------------------------


def field_type(schema: T.StructType, dotted: str) -> T.DataType | None:
    """Type of a (possibly nested) field, or None when the path does not exist."""
    current: T.DataType = schema
    for part in dotted.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate path present in ``df``, for raw and flattened layouts."""
    return next((c for c in candidates if field_type(df.schema, c) is not None), None)


def pick(df: DataFrame, candidates: Sequence[str], alias: str) -> Column:
    """Column at the first existing candidate path; an error when there is none."""
    found = first_existing(df, candidates)
    if found is None:
        raise ValueError(f"none of the columns exist: {', '.join(candidates)}")
    return F.col(found).alias(alias)


def conform(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Select named columns; one that is missing becomes a typed NULL."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(name) if name in present else F.lit(None).cast(type_).alias(name)
            for name, type_ in columns
        ]
    )


# -- text, time, arrays -------------------------------------------------------


def parsed_timestamp(text: Column | str) -> Column:
    """ISO-8601 text to timestamp; malformed text is NULL instead of an error."""
    return F.try_to_timestamp(as_col(text))


def lower_or_unknown(c: Column | str) -> Column:
    return F.coalesce(F.lower(as_col(c)), F.lit("unknown"))


def shown_null(c: Column | str) -> Column:
    """NULL as ``(null)`` so a distribution shows it as a group."""
    return F.coalesce(as_col(c), F.lit("(null)"))


def path_part(c: Column | str, index: int) -> Column:
    """1-based part of an ``owner/name`` path; NULL when the path is too short."""
    return F.try_element_at(F.split(as_col(c), "/"), F.lit(index))


def array_length(c: Column | str) -> Column:
    """Length of an array, NULL for a NULL array in every ANSI mode."""
    return F.when(as_col(c).isNotNull(), F.size(as_col(c)))


def array_length_or_zero(c: Column | str) -> Column:
    return F.coalesce(array_length(c), F.lit(0))


def period(day: Column | str, grain: str) -> Column:
    """Calendar period label of a date; ``week`` is the Monday that starts it."""
    if grain == "week":
        return F.date_format(F.date_trunc("week", as_col(day)), "yyyy-MM-dd")
    return F.date_format(as_col(day), GRAIN_FORMATS[grain])


def quarter_era(day: Column | str) -> Column:
    """``YYYY-Qn`` label of a date."""
    return F.concat(F.year(as_col(day)).cast("string"), F.lit("-Q"), F.quarter(as_col(day)).cast("string"))


def is_weekend(day: Column | str) -> Column:
    """Saturday or Sunday (Spark's dayofweek is 1 on Sunday, 7 on Saturday)."""
    return F.dayofweek(as_col(day)).isin(1, 7)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))


def owner_of(repo: Column | str) -> Column:
    return path_part(repo, 1)


# -- predicates ---------------------------------------------------------------


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def is_opened_pr() -> Column:
    return is_type("PullRequestEvent") & (F.col("payload_action") == "opened")


def is_merged_pr() -> Column:
    """Merged pull request in both payload layouts.

    The older feed marks a merge as ``closed`` with ``merged = true``; the newer
    one drops that flag and sends the action ``merged``.
    """
    action = F.col("payload_action")
    older = (action == "closed") & F.col("pr_merged").eqNullSafe(F.lit(True))
    return is_type("PullRequestEvent") & (older | (action == "merged"))


def not_flagged(c: Column | str) -> Column:
    """True unless the flag is set; a NULL flag passes."""
    return ~F.coalesce(as_col(c), F.lit(False))


def not_on(dates: Iterable[date | str], day: str = "event_date") -> Column:
    """Not one of the given dates, as DATE literals so partitions are pruned."""
    days = [F.lit(str(d)).cast("date") for d in dates]
    return ~F.col(day).isin(days) if days else F.lit(True)


def in_range(lo: date | str, hi: date | str, day: str = "event_date") -> Column:
    """Inclusive date range, as DATE literals so partitions are pruned."""
    return F.col(day).between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date"))


# -- labels -------------------------------------------------------------------


def ranged_label(c: Column | str, bounds: Sequence[tuple[float, str]], top: str, missing: str) -> Column:
    """Label by ascending inclusive upper bounds, with an explicit arm for NULL."""
    value = as_col(c)
    label = F.when(value.isNull(), missing)
    for upper, name in bounds:
        label = label.when(value <= upper, name)
    return label.otherwise(top)


def below_label(c: Column | str, bounds: Sequence[tuple[float, str]], top: str, missing: str) -> Column:
    """Label by ascending exclusive upper bounds, with an explicit arm for NULL."""
    value = as_col(c)
    label = F.when(value.isNull(), missing)
    for upper, name in bounds:
        label = label.when(value < upper, name)
    return label.otherwise(top)


def gated_label(c: Column | str = "gated") -> Column:
    """NULL and the text ``False`` are open access; any other value is gated."""
    return F.when(F.coalesce(as_col(c), F.lit("False")) == "False", "non-gated").otherwise("gated")
