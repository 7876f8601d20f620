"""Profiles of raw or cleaned events and models, and package downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.functions import columns as C
from vitals.functions.aggregates import (
    DEFAULT_ACCURACY,
    distinct_with_null,
    metric_rows,
    null_counts,
    percentile,
    ratio,
    value_counts,
)
from vitals.functions.ordering import top_k
from vitals.functions.percentiles import percentile_table
from vitals.schemas import CORE_EVENT_TYPES

# Logical field -> its path in the raw layout, then in the cleaned one. Fixed values.
EVENT_PATHS = {
    "id": ("id", "event_id"),
    "event_type": ("type", "event_type"),
    "created_at_or_event_ts": ("created_at", "event_ts"),
    "actor_login": ("actor.login", "actor_login"),
    "repo_name": ("repo.name", "repo_name"),
    "payload_action": ("payload.action", "payload_action"),
}
# Reported NULL metric -> logical field.
EVENT_NULLS = {
    "id_nulls": "id",
    "type_nulls": "event_type",
    "created_at_or_event_ts_nulls": "created_at_or_event_ts",
    "actor_login_nulls": "actor_login",
    "repo_name_nulls": "repo_name",
    "payload_action_nulls": "payload_action",
}
# Model columns profiled for NULLs when they exist.
MODEL_COLUMNS = (
    "modelId",
    "model_id",
    "author",
    "pipeline_tag",
    "library_name",
    "downloads",
    "likes",
    "lastModified",
    "last_modified_ts",
    "created_at",
    "created_ts",
)
MODEL_NESTED = {
    "license_nulls": ("card_data.license", "license"),
    "datasets_nulls": ("card_data.datasets", "training_datasets"),
}
_TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def _event_view(df: DataFrame) -> DataFrame:
    """The logical event fields of either layout."""
    return df.select(*[C.pick(df, paths, name) for name, paths in EVENT_PATHS.items()])


def _event_time(df: DataFrame):
    found = C.first_existing(df, ("event_ts", "created_at"))
    if found is None:
        raise ValueError("the events need created_at or event_ts")
    return C.parsed_timestamp(found) if found == "created_at" else F.col(found).cast("timestamp")


def events_summary(df: DataFrame) -> DataFrame:
    """Size, distinct repositories and actors, and the time range, as metric rows.

    The time column is counted as part of the layout, as raw data gains it.
    """
    width = len(df.columns) + (0 if "event_ts" in df.columns else 1)
    # The time is parsed before the rows are copied for the two distinct counts.
    view = df.select(
        C.pick(df, EVENT_PATHS["repo_name"], "repo_name"),
        C.pick(df, EVENT_PATHS["actor_login"], "actor_login"),
        _event_time(df).alias("at"),
    )
    row = view.agg(
        F.count("*").alias("total_rows"),
        F.lit(width).alias("total_columns"),
        distinct_with_null("repo_name").alias("distinct_repositories"),
        distinct_with_null("actor_login").alias("distinct_actors"),
        F.date_format(F.min("at"), _TEXT_TIME).alias("min_event_timestamp"),
        F.date_format(F.max("at"), _TEXT_TIME).alias("max_event_timestamp"),
    )
    return metric_rows(row)


def event_type_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, C.first_existing(df, EVENT_PATHS["event_type"]), "event_type")


def events_null_counts(df: DataFrame) -> DataFrame:
    """NULLs of the six logical fields; a field the layout lacks has a NULL count."""
    return metric_rows(null_counts(df, {m: EVENT_PATHS[f] for m, f in EVENT_NULLS.items()}))


def top_active_repos(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` repositories with most events."""
    name = C.pick(df, EVENT_PATHS["repo_name"], "repo_name")
    counted = df.select(name).filter(F.col("repo_name").isNotNull()).groupBy("repo_name").count()
    return top_k(counted, k, "count", "repo_name")


def events_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """Some rows of either layout with the same five columns."""
    return _event_view(df).drop("payload_action").limit(n)


def profile_events(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": events_summary(df),
        "event_type_distribution": event_type_distribution(df),
        "null_counts": events_null_counts(df),
        "top_repos": top_active_repos(df),
        "sample": events_sample(df),
    }


def models_summary(df: DataFrame, accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Size, distinct labels and download and like statistics, as metric rows.

    Distinct counts are an aggregate of their own: next to a sketch in one aggregate,
    every distinct value would carry a sketch through the shuffle.
    """
    author = C.first_existing(df, ("author", "owner"))
    two_digits = lambda c: F.format_string("%.2f", F.avg(c))
    distinct = df.agg(
        distinct_with_null(author).alias("distinct_authors"),
        F.count_distinct("pipeline_tag").alias("distinct_pipeline_tags"),
        F.count_distinct("library_name").alias("distinct_library_names"),
    )
    totals = [
        F.count("*").alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.min("downloads").alias("min_downloads"),
        F.max("downloads").alias("max_downloads"),
        two_digits("downloads").alias("avg_downloads"),
        F.min("likes").alias("min_likes"),
        F.max("likes").alias("max_likes"),
        two_digits("likes").alias("avg_likes"),
    ]
    if exact:
        row = percentile_table(df.select("downloads", "likes"), [], totals, {"median_downloads": ("downloads", 0.5)})
    else:
        row = df.agg(*totals, percentile("downloads", 0.5, accuracy).alias("median_downloads"))
    return metric_rows(row.withColumns({c: distinct.select(c).scalar() for c in distinct.columns}))


def pipeline_tag_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, C.shown_null("pipeline_tag"), "pipeline_tag")


def library_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, C.shown_null("library_name"), "library_name")


def models_null_counts(df: DataFrame) -> DataFrame:
    """NULLs of the model columns that exist, nested licence and datasets included."""
    fields = {f"{c}_nulls": (c,) for c in MODEL_COLUMNS if c in df.columns}
    fields |= {m: paths for m, paths in MODEL_NESTED.items() if C.first_existing(df, paths)}
    return metric_rows(null_counts(df, fields))


def top_authors(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` authors with most models."""
    author = C.pick(df, ("author", "owner"), "author")
    counted = df.select(author).filter(F.col("author").isNotNull()).groupBy("author").count()
    return top_k(counted, k, "count", "author")


def top_downloads(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most downloaded models, in the columns the layout has."""
    key = C.first_existing(df, ("modelId", "model_id"))
    wanted = (key, "author", "pipeline_tag", "library_name", "downloads", "likes")
    rows = df.filter(F.col("downloads").isNotNull()).select(*[c for c in wanted if c in df.columns])
    return top_k(rows, k, "downloads", key)


def models_sample(df: DataFrame, n: int = 10) -> DataFrame:
    key = C.first_existing(df, ("modelId", "model_id"))
    modified = C.first_existing(df, ("lastModified", "last_modified_ts"))
    wanted = (key, "author", "pipeline_tag", "library_name", "downloads", "likes", modified)
    return df.select(*[c for c in wanted if c in df.columns]).limit(n)


def profile_models(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": models_summary(df),
        "pipeline_tag_distribution": pipeline_tag_distribution(df),
        "library_distribution": library_distribution(df),
        "null_counts": models_null_counts(df),
        "top_authors": top_authors(df),
        "top_downloads": top_downloads(df),
        "sample": models_sample(df),
    }


# -- exploration of raw events and package downloads ---------------------------


def null_report(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, from one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], df.columns, "column", "null_count")
    pct = F.round(ratio(F.col("null_count") * F.lit(100.0), "_rows"), 1)
    return long.select("column", "null_count", pct.alias("null_pct"))


def core_event_share(df: DataFrame) -> DataFrame:
    """Rows of each event type, whether it is a core type, and the core share in percent."""
    name = C.pick(df, EVENT_PATHS["event_type"], "event_type")
    core = F.col("event_type").isin(*CORE_EVENT_TYPES)
    counted = df.select(name).groupBy("event_type").count()
    totals = counted.agg(
        F.sum("count").alias("all"), F.sum(F.when(core, F.col("count")).otherwise(0)).alias("core")
    )
    pct = F.round(ratio(F.lit(100.0) * F.col("core"), "all"), 1)
    share = totals.select(pct.alias("p")).scalar()
    return counted.select(
        "event_type", "count", F.coalesce(core, F.lit(False)).alias("is_core"), share.alias("core_pct")
    )


def events_per_hour(df: DataFrame) -> DataFrame:
    """Events per UTC hour of the day."""
    return df.groupBy(F.hour(_event_time(df)).alias("hour")).agg(F.count("*").alias("events"))


def distinct_repos_actors(df: DataFrame) -> DataFrame:
    """Distinct repositories and actors; NULL is not a value here."""
    return df.agg(
        F.count_distinct(C.first_existing(df, EVENT_PATHS["repo_name"])).alias("repos"),
        F.count_distinct(C.first_existing(df, EVENT_PATHS["actor_login"])).alias("actors"),
    )


def package_totals(downloads: DataFrame) -> DataFrame:
    return downloads.groupBy("project").agg(F.sum("downloads").alias("downloads"))


def package_monthly_pivot(downloads: DataFrame, projects: list[str]) -> DataFrame:
    """Months as rows, the given projects as columns; the list spares a pass to find it."""
    return (
        downloads.filter(F.col("project").isin(projects))
        .groupBy("month")
        .pivot("project", projects)
        .agg(F.sum("downloads"))
    )


def package_monthly_top(downloads: DataFrame, k: int = 8) -> DataFrame:
    """The same numbers for the ``k`` largest projects, one row per month and project."""
    leaders = top_k(package_totals(downloads), k, "downloads", "project").select("project")
    return (
        downloads.join(leaders, "project", "left_semi")
        .groupBy("month", "project")
        .agg(F.sum("downloads").alias("downloads"))
    )


def package_growth_pct(downloads: DataFrame) -> DataFrame:
    """Growth from a project's first to its last month, in percent, one digit."""
    monthly = downloads.groupBy("project", "month").agg(F.sum("downloads").alias("n"))
    ends = monthly.groupBy("project").agg(
        F.min_by("n", "month").alias("first"), F.max_by("n", "month").alias("last")
    )
    growth = ratio((F.col("last") - F.col("first")) * F.lit(100.0), "first")
    return ends.select("project", F.round(growth, 1).alias("growth_pct"))
