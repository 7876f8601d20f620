"""Data-quality checks on cleaned and raw events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.functions import columns as C
from vitals.functions.aggregates import count_of, null_count, ratio, value_counts
from vitals.session import require_utc

# Reported counter -> event type.
TYPE_COLUMNS = {
    "push_events": "PushEvent",
    "pr_events": "PullRequestEvent",
    "watch_events": "WatchEvent",
    "issue_events": "IssuesEvent",
    "fork_events": "ForkEvent",
}
# Columns whose NULLs are reported, with their types.
KEY_COLUMNS = {
    "event_type": "string",
    "event_date": "date",
    "actor_login": "string",
    "repo_name": "string",
    "pr_merged": "boolean",
    "pr_number": "bigint",
    "payload_action": "string",
    "push_distinct_size": "bigint",
}
# Columns flagged when mostly NULL.
FLAGGED = ("pr_merged", "push_distinct_size")


def era_quality(events: DataFrame, null_flag_pct: float = 50) -> DataFrame:
    """Rows, days, type and NULL counts per era, all in one pass.

    A column the data lacks has a NULL count and the flag ``MISSING``.
    """
    present = [c for c in KEY_COLUMNS if c in events.columns]
    table = events.groupBy("era").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("event_date").alias("distinct_days"),
        F.min("event_date").alias("date_start"),
        F.max("event_date").alias("date_end"),
        *[count_of(t).alias(name) for name, t in TYPE_COLUMNS.items()],
        *[null_count(c).alias(f"null_{c}") for c in present],
    )
    missing = [c for c in KEY_COLUMNS if c not in present]
    for c in missing:
        table = table.withColumn(f"null_{c}", F.lit(None).cast("bigint"))
    per_day = F.round(ratio("total_events", "distinct_days")).cast("bigint")

    def flag(c):
        if c in missing:
            return F.lit("MISSING").alias(f"flag_{c}")
        over = ratio(F.col(f"null_{c}") * F.lit(100.0), "total_events") > null_flag_pct
        return F.when(over, "ISSUE").otherwise("OK").alias(f"flag_{c}")

    return table.select(
        "era",
        "total_events",
        "distinct_days",
        per_day.alias("avg_events_per_day"),
        "date_start",
        "date_end",
        *TYPE_COLUMNS,
        *[f"null_{c}" for c in KEY_COLUMNS],
        *[flag(c) for c in FLAGGED],
    )


def daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(F.count("*").alias("events"))


def field_value_counts(events: DataFrame, column: str, day: date | str | None = None) -> DataFrame:
    """Values of one column, on one day's partition or everywhere."""
    if day is not None:
        events = events.filter(F.col("event_date") == F.lit(str(day)).cast("date"))
    return value_counts(events, column, column)


def compare_counts(new: DataFrame, old: DataFrame, key: str, pct: bool = False) -> DataFrame:
    """Rows per key in two versions of the data.

    Both sides are aggregated before they meet, so the outer join sees one row
    per key. A key that one version lacks has no count there and differs by all
    rows of the other.
    """
    counted = (
        new.groupBy(key)
        .agg(F.count("*").alias("new_count"))
        .join(old.groupBy(key).agg(F.count("*").alias("old_count")), key, "full_outer")
    )
    diff = F.coalesce("new_count", F.lit(0)) - F.coalesce("old_count", F.lit(0))
    table = counted.withColumn("diff", diff)
    if pct:
        change = F.round(ratio(diff * F.lit(100.0), "old_count"), 2)
        table = table.withColumn("diff_pct", change)
    return table


def compare_by_type(new: DataFrame, old: DataFrame) -> DataFrame:
    return compare_counts(new, old, "event_type")


def compare_by_day(new: DataFrame, old: DataFrame) -> DataFrame:
    return compare_counts(new, old, "event_date", pct=True)


def compare_totals_nulls(new: DataFrame, old: DataFrame) -> DataFrame:
    """Total rows and NULLs of the key columns in both versions, as metric rows."""

    def profile(df: DataFrame, name: str) -> DataFrame:
        shared = [c for c in KEY_COLUMNS if c in new.columns and c in old.columns]
        row = df.agg(
            F.count("*").alias("total_rows"), *[null_count(c).alias(f"null_{c}") for c in shared]
        )
        return row.unpivot([], row.columns, "metric", name)

    joined = profile(new, "new_value").join(profile(old, "old_value"), "metric")
    diff = F.col("new_value") - F.col("old_value")
    return joined.select(
        "metric",
        "new_value",
        "old_value",
        diff.alias("diff"),
        F.round(ratio(diff * F.lit(100.0), "old_value"), 2).alias("diff_pct"),
    )


def _hours(events: DataFrame, lo: date | str, hi: date | str) -> DataFrame:
    """Hours with an event within a range of days, in the cleaned or the raw layout.

    The range reaches the scan: as a partition filter where the day is stored, else on the time.
    A malformed raw time is no event of any hour.
    """
    require_utc(events.sparkSession)
    column = C.first_existing(events, ("event_ts", "created_at"))
    if column is None:
        raise ValueError("hour coverage needs a time column: event_ts or created_at")
    if "event_date" in events.columns:
        events = events.filter(C.in_range(lo, hi))
    at = C.parsed_timestamp(column) if dict(events.dtypes).get(column) == "string" else F.col(column)
    hours = events.select(F.date_trunc("hour", at).alias("hour"))
    return hours.filter(F.to_date("hour").between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date")))


def hour_coverage(events: DataFrame, lo: date | str, hi: date | str) -> DataFrame:
    """Hours with data on each day of a range; days without any appear with 0."""
    hours = (
        _hours(events, lo, hi)
        .groupBy(F.to_date("hour").alias("event_date"))
        .agg(F.count_distinct("hour").alias("n"))
    )
    first, last = (F.lit(str(d)).cast("date") for d in (lo, hi))
    days = events.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("event_date"))
    found = F.coalesce("n", F.lit(0))
    return days.join(hours, "event_date", "left").select(
        "event_date", found.alias("hours_present"), (found == 24).alias("complete")
    )


def missing_hours(events: DataFrame, lo: date | str, hi: date | str) -> DataFrame:
    """Expected hours of a date range that have no event."""
    start = F.lit(f"{lo} 00:00:00").cast("timestamp")
    end = F.lit(f"{hi} 23:00:00").cast("timestamp")
    expected = events.sparkSession.range(1).select(
        F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("hour")
    )
    return expected.join(_hours(events, lo, hi).distinct(), "hour", "left_anti")


def archive_coverage(archives: DataFrame, lo: date | str, hi: date | str) -> DataFrame:
    """Delivered hourly archives on each day of a range, from ``readers.archive_hours``: an archive
    without events counts, a missing one does not. Days without any appear with 0."""
    found = archives.groupBy("event_date").agg(F.count_distinct("hour").alias("n"), F.sum("length").alias("bytes"))
    first, last = (F.lit(str(d)).cast("date") for d in (lo, hi))
    days = archives.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("event_date"))
    present = F.coalesce("n", F.lit(0))
    return days.join(found, "event_date", "left").select(
        "event_date", present.alias("hours_present"), (present == 24).alias("complete"), F.coalesce("bytes", F.lit(0)).alias("bytes")
    )


DIGEST_BUCKETS = 64


def content_digests(events: DataFrame, key: str = "event_id", day: str = "event_date", buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Rows and an order-independent digest of their contents by day and bucket of the key.

    The digest is the sum of the rows' 64-bit hashes over all columns in order of name, so it does not depend
    on files, order or partitions, and counts repeated rows. One pass; only sums are shuffled.
    """
    row_hash = F.xxhash64(*sorted(events.columns)).cast("decimal(38,0)")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return events.groupBy(F.col(day).alias("day"), bucket.alias("bucket")).agg(
        F.count("*").alias("rows"), F.sum(row_hash).alias("digest")
    )


def changed_rows(new: DataFrame, old: DataFrame, key: str = "event_id", day: str = "event_date", buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Keys whose rows differ between two versions, with the ``change``: added, removed or changed.

    Counts by day or type cannot see changes that cancel; digests can. They locate days and buckets that
    differ, and only rows of these are joined. A key counts as changed if its multiset of rows does.
    """
    columns = sorted(set(new.columns) & set(old.columns))
    new, old = new.select(*columns), old.select(*columns)
    digests = [content_digests(df, key, day, buckets) for df in (new, old)]
    n, o = digests[0].alias("n"), digests[1].alias("o")
    same_place = F.col("n.day").eqNullSafe(F.col("o.day")) & (F.col("n.bucket") == F.col("o.bucket"))
    differs = ~(F.col("n.rows").eqNullSafe(F.col("o.rows")) & F.col("n.digest").eqNullSafe(F.col("o.digest")))
    places = (
        n.join(o, same_place, "full_outer").filter(differs)
        .select(F.coalesce("n.day", "o.day").alias("_day"), F.coalesce("n.bucket", "o.bucket").alias("_bucket"))
    )

    def suspects(df: DataFrame, name: str) -> DataFrame:
        placed = df.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        own = placed.join(places, F.col(day).eqNullSafe(F.col("_day")) & (F.col("_b") == F.col("_bucket")), "left_semi")
        digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        return own.groupBy(F.col(day).alias("day"), F.col(key).alias("key")).agg(F.struct(F.count("*"), digest).alias(name))

    a, b = suspects(new, "new").alias("a"), suspects(old, "old").alias("b")
    same_key = F.col("a.day").eqNullSafe(F.col("b.day")) & F.col("a.key").eqNullSafe(F.col("b.key"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("new") != F.col("old"), "changed")
    return (
        a.join(b, same_key, "full_outer").select(F.coalesce("a.day", "b.day").alias(day), F.coalesce("a.key", "b.key").alias(key), change.alias("change"))
        .filter("change IS NOT NULL")
    )
