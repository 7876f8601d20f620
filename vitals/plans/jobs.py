"""Complete jobs: read, compute, store.

A result that later steps need is written once and read back; no job keeps a
large frame in executor memory or recomputes it for a second output.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitals.functions.ordering import top_k
from vitals.operators import activity, adoption, cleaning, deepdive, eras, models, profiling, quality, rhythm
from vitals.operators.joins import label_ai, schema_difference
from vitals.sources import readers, writers


def clean_events_job(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    fmt: str = "json",
    curated_csv: str | None = None,
    sample_path: str | None = None,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """Raw hourly files to cleaned events by day. Re-running it replaces its own days only."""
    raw = readers.read_events(spark, source, fmt, skip_corrupt_files=skip_corrupt_files)
    seed = readers.read_curated_repos(spark, curated_csv) if curated_csv else None
    writers.write_events(cleaning.clean_events(raw, seed), target)
    stored = spark.read.parquet(target)
    if sample_path:
        sample = writers.sample_rows(stored, stored.columns, 10, ["event_ts", "event_id"])
        writers.export_report(sample, sample_path)
    return stored


def add_events_job(
    spark: SparkSession, source: str | list[str], target: str, fmt: str = "json"
) -> DataFrame:
    """Add newly arrived raw files to cleaned events, also when they hold part of a day.

    The cleaned batch is stored first. Only the days it touches, which the calendar
    bounds, are read from the target, de-duplicated together with it and replaced, so a record
    delivered in two batches is kept once and a repeated run changes nothing.
    """
    cleaned = cleaning.clean_events(readers.read_events(spark, source, fmt))
    with writers.Scratch(spark) as scratch:
        batch = scratch.stored(cleaned, "batch", by="event_date")
        present = _present(spark, target)
        if present is None:
            writers.write_events(batch, target)
        else:
            days = [row.event_date for row in batch.select("event_date").distinct().collect()]
            touched = present.filter(F.col("event_date").isin(days))
            both = batch.unionByName(touched, allowMissingColumns=True)
            writers.write_events(cleaning.dedupe(both, "event_id", [F.col("event_ts")]), target)
    return spark.read.parquet(target)


def _present(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """What a path holds, or none where there is no such path yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def add_contributors_job(events: DataFrame, targets: DataFrame, path: str, grain: str = "month") -> DataFrame:
    """Contributor flow of all batches so far, reading only this batch's events.

    The state at ``path`` holds each actor's active periods by era. A batch, in any order and also one seen
    before, is merged into the eras it touches; other eras are neither read nor written.
    """
    spark = events.sparkSession
    with writers.Scratch(spark) as scratch:
        batch = scratch.stored(deepdive.contributor_periods(events, grain), "contributors")
        present = _present(spark, path, batch.schema)
        if present is not None:
            touched = [row.era for row in batch.select("era").distinct().collect()]
            same = F.col("era").isin([era for era in touched if era is not None])
            kept = present.filter(same | F.col("era").isNull() if None in touched else same)
            batch = deepdive.merged_periods(batch.unionByName(kept.select(batch.columns)))
        writers.write_events(batch, path, by="era")
    return deepdive.flow_of_periods(spark.read.schema(batch.schema).parquet(path), targets)


def clean_models_job(
    spark: SparkSession, source: str, target: str, fmt: str = "json", sample_path: str | None = None
) -> DataFrame:
    writers.write_table(cleaning.clean_models(readers.read_models(spark, source, fmt)), target)
    stored = spark.read.parquet(target)
    if sample_path:
        sample = writers.sample_rows(stored, stored.columns, 10, [F.desc("downloads"), "model_id"])
        writers.export_report(sample, sample_path)
    return stored


def ingest_hub_records_job(spark: SparkSession, source: str, models_path: str, results_path: str) -> None:
    """Hub API records to the raw model table and its evaluation-result child table."""
    lines = readers.read_hub_records(spark, source)
    writers.write_table(cleaning.normalize_model_record(lines), models_path)
    writers.write_table(cleaning.flatten_eval_results(lines), results_path)


def profile_job(df: DataFrame, folder: str, kind: str) -> None:
    """Profile reports of raw or cleaned data (kind: events or models).

    Raw archives are decoded once: the reports read a stored copy by column.
    """
    with writers.Scratch(df.sparkSession) as scratch:
        df = scratch.stored(df, "profiled")
        tables = {"events": profiling.profile_events, "models": profiling.profile_models}[kind](df)
        for name, table in tables.items():
            writers.export_report(table, f"{folder}/{name}")


def models_eda_job(df: DataFrame, folder: str, as_of: date | str) -> None:
    with writers.Scratch(df.sparkSession) as scratch:
        df = scratch.stored(df, "explored")
        for name, table in models.models_eda(df, as_of).items():
            writers.export_report(table, f"{folder}/{name}")


def scoring_job(
    events: DataFrame, models_: DataFrame, seed: DataFrame, packages: DataFrame, folder: str
) -> DataFrame:
    """Daily metrics, the three-way join and the health score, each stored."""
    daily = writers.stored(activity.repo_daily_metrics(events, seed), f"{folder}/repo_daily_metrics")
    joined = writers.stored(
        adoption.hub_repo_join(
            adoption.library_stats_for_join(models_), seed, activity.repo_yearly(daily)
        ),
        f"{folder}/hub_repo_join",
    )
    scored = writers.stored(
        adoption.health_score(joined, adoption.package_yearly(packages)), f"{folder}/health_score"
    )
    writers.export_csv(joined, f"{folder}/hub_repo_join_csv", [F.desc("hf_total_downloads"), "repo_name"])
    writers.export_csv(scored, f"{folder}/health_score_csv", [F.desc("health_score"), "repo_name"])
    return scored


def top_repo_job(
    spark: SparkSession,
    path: str,
    seed: DataFrame,
    folder: str,
    table: str | None = None,
    supplement: str | None = None,
    exclude: Iterable[date | str] = (),
    k: int = 1000,
) -> DataFrame:
    """Ranking of all repositories and the three reports that start from it."""
    events = readers.read_table_or_path(spark, table, path) if table else spark.read.parquet(path)
    events = readers.exclude_dates(events, exclude)
    if supplement:
        events = readers.union_optional(events, supplement)
    top = writers.stored(activity.top_repos(events, k), f"{folder}/top_repos")
    labelled = label_ai(top, seed)
    reports = {
        "ai_vs_general": (labelled, [F.desc("stars"), "repo_name"]),
        "group_summary": (activity.group_summary(labelled), ["is_ai"]),
        "star_growth_hype": (
            activity.star_growth_hype(events, top, seed),
            [F.desc("peak_ratio"), "repo_name"],
        ),
        "contributor_health": (
            activity.contributor_health(events, top, seed),
            [F.desc("total_contributors"), "repo_name"],
        ),
    }
    for name, (table_, order) in reports.items():
        writers.export_csv(writers.stored(table_, f"{folder}/{name}"), f"{folder}/{name}_csv", order)
    return top


def era_job(events: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Era comparison and rhythm tables, typed and partitioned by era.

    ``events`` carries an ``era`` column and may hold any subset of the eras;
    only those are replaced, and the stored tables always show all of them.
    """
    tables = {
        "summary_metrics": eras.era_summary(events),
        "push_size_distribution": eras.push_size_distribution(events),
        "pr_push_ratio": eras.pr_push_ratio(events),
        "active_repos_monthly": eras.active_repos_monthly(events),
        "weekday_weekend": rhythm.weekday_weekend(events),
        "weekday_weekend_by_type": rhythm.weekday_weekend(events, by_type=True),
        "push_per_actor": rhythm.push_per_actor(events),
        "data_quality": quality.era_quality(events),
    }
    merged = {}
    for name, table in tables.items():
        merged[name] = writers.write_era(table, f"{folder}/{name}")
        keys = [c for c in ("era", "month", "is_weekend", "event_type") if c in merged[name].columns]
        writers.export_csv(merged[name], f"{folder}/{name}_csv", keys)
    return merged


def deepdive_job(events: DataFrame, top: DataFrame, seed: DataFrame, folder: str, k: int = 200) -> None:
    """Target repositories in depth; the targets' events are stored once for all reports and then deleted."""
    targets = writers.stored(deepdive.target_repos(top, seed, k), f"{folder}/target_repos")
    columns = [
        "event_type", "event_ts", "event_date", "actor_login", "repo_name", "payload_action",
        "pr_number", "pr_merged", "push_distinct_size", "era",
    ]
    kept = events.select(*columns).join(targets.select("repo_name"), "repo_name", "left_semi")
    with writers.Scratch(events.sparkSession) as scratch:
        rows = scratch.stored(kept, "target_events", by="event_date")
        merge_time = writers.stored(deepdive.pr_merge_time(rows, targets), f"{folder}/pr_merge_time")
        prs = writers.stored(deepdive.daily_pr_timeseries(rows, targets), f"{folder}/daily_pr_timeseries")
        commits = writers.stored(
            deepdive.daily_commits_timeseries(rows, targets), f"{folder}/daily_commits_timeseries"
        )
        flow = writers.stored(deepdive.contributor_flow(rows, targets), f"{folder}/contributor_flow")
    pr_count = deepdive.daily_pr_count(prs)
    commit_count = deepdive.daily_commits(commits)
    # Tables with a row per repository and period grow with time and keep a file per task.
    growing: dict[str, tuple[DataFrame, Sequence[str]]] = {
        "daily_pr_timeseries": (prs, ["repo_name", "era", "event_date"]),
        "daily_commits_timeseries": (commits, ["repo_name", "era", "event_date"]),
        "contributor_flow": (flow, ["repo_name", "era", "month", "contributor_type"]),
    }
    reports: dict[str, tuple[DataFrame, Sequence[str]]] = {
        "pr_merge_time": (merge_time, ["repo_name", "era"]),
        "daily_pr_count": (pr_count, ["repo_name", "era"]),
        "daily_commits": (commit_count, ["repo_name", "era"]),
        "group_pr_merge_time": (deepdive.group_pr_merge_time(merge_time), ["era", "is_ai"]),
        "group_daily_prs": (deepdive.group_daily_prs(pr_count), ["era", "is_ai"]),
        "group_daily_commits": (deepdive.group_daily_commits(commit_count), ["era", "is_ai"]),
    }
    for name, (table, order) in {**growing, **reports}.items():
        writers.export_csv(table, f"{folder}/{name}_csv", order, one_file=name not in growing)


def compare_job(new: DataFrame, old: DataFrame, folder: str) -> None:
    """Reproducibility reports of a re-cleaned dataset against the stored one."""
    writers.export_csv(quality.compare_by_type(new, old), f"{folder}/by_type", ["event_type"])
    writers.export_csv(quality.compare_by_day(new, old), f"{folder}/by_day", ["event_date"])
    writers.export_csv(quality.compare_totals_nulls(new, old), f"{folder}/totals", ["metric"])
    writers.export_csv(schema_difference(new, old), f"{folder}/schema", ["column"])


def package_pivot(downloads: DataFrame, k: int = 8) -> DataFrame:
    """Month x project table of the ``k`` largest projects; ``k`` names reach the driver."""
    totals = top_k(profiling.package_totals(downloads), k, "downloads", "project")
    names = [row.project for row in totals.select("project").collect()]
    return profiling.package_monthly_pivot(downloads, names)
