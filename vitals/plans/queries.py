"""Every product as a query over the test tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import columns as C
from vitals.functions.aggregates import null_counts
from vitals.functions.percentiles import exact_percentiles
from vitals.operators import (
    activity,
    adoption,
    cleaning,
    deepdive,
    eras,
    joins,
    models,
    profiling,
    quality,
    rhythm,
    risk,
)
from vitals.plans import testdata as data
from vitals.plans.jobs import add_contributors_job, package_pivot
from vitals.schemas import CORE_EVENT_TYPES
from vitals.session import shared_path
from vitals.sources import readers, writers
from vitals.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-07-01"
TOP = 60
# Cohorts that have actors at the scale of the test tables.
COHORTS = (3, 5)
PER_DAY = 1
ERAS = [f"W{n}" for n in range(1, 6)]
# First quarters of several years, as (label, first day, last day).
FIRST_QUARTERS = [(f"{y}-Q1", f"{y}-01-01", f"{y}-03-31") for y in range(1995, 2002)]


class Inputs:
    """Input frames of one query, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def ev(self) -> DataFrame:
        return data.activity(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return data.raw_events(self.spark, self.sf_dir)

    @cached_property
    def parsed(self) -> DataFrame:
        return data.parsed_events(self.spark, self.sf_dir)

    @cached_property
    def raw_md(self) -> DataFrame:
        return data.raw_models(self.spark, self.sf_dir)

    @cached_property
    def md(self) -> DataFrame:
        return cleaning.clean_models(self.raw_md)

    @cached_property
    def hub(self) -> DataFrame:
        return data.hub_lines(self.spark, self.sf_dir)

    @cached_property
    def seed(self) -> DataFrame:
        return data.seed(self.spark, self.sf_dir)

    @cached_property
    def orders(self) -> DataFrame:
        """Orders as activity over several years: customers as repositories, priorities as actors."""
        return data.table(self.spark, self.sf_dir, "orders").selectExpr(
            "concat('c', o_custkey) AS repo_name",
            "o_orderpriority AS actor_login",
            "to_date(o_orderdate) AS event_date",
        )

    @cached_property
    def pkg(self) -> DataFrame:
        return data.package_downloads(self.spark, self.sf_dir)

    @cached_property
    def top(self) -> DataFrame:
        return activity.top_repos(self.ev, TOP)

    @cached_property
    def daily(self) -> DataFrame:
        return activity.repo_daily_metrics(self.ev, self.seed)

    @cached_property
    def joined(self) -> DataFrame:
        stats = adoption.library_stats_for_join(self.md)
        return adoption.hub_repo_join(stats, self.seed, activity.repo_yearly(self.daily))

    @cached_property
    def scored(self) -> DataFrame:
        return adoption.health_score(self.joined, adoption.package_yearly(self.pkg))

    @cached_property
    def hype(self) -> DataFrame:
        return activity.star_growth_hype(self.ev, self.top, self.seed)

    @cached_property
    def health(self) -> DataFrame:
        return activity.contributor_health(self.ev, self.top, self.seed)

    @cached_property
    def targets(self) -> DataFrame:
        return deepdive.target_repos(self.top, self.seed, k=20)

    @cached_property
    def new(self) -> DataFrame:
        """The newer of two versions of the data: its first day was lost."""
        return self.ev.filter(F.col("event_date") > F.lit("2024-01-01").cast("date"))

    @cached_property
    def old(self) -> DataFrame:
        """The older version: it had no forks."""
        return self.ev.filter(F.col("event_type") != "ForkEvent")


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and arrays as text, so two engines give equal values."""
    changed = {}
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.round(c, digits)
        elif isinstance(field.dataType, T.ArrayType):
            changed[field.name] = F.array_join(c, ",")
        elif isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(changed) if changed else df


def _flat_record(df: DataFrame) -> DataFrame:
    return df.select(
        "modelId", "author", "gated", "likes", "downloads", "downloads_all_time",
        F.col("card_data.license").alias("license"),
        F.col("card_data.base_model").alias("base_model"),
        F.col("safetensors.parameters.total").alias("total"),
        "created_at",
    )


# -- sources and sinks: written to the shared folder and read back --------------


def cleaned_from_files(i: Inputs) -> DataFrame:
    """Events delivered as gzip JSON-lines files, read and cleaned."""
    path = shared_path(i.spark, "feed")
    data.raw_event_lines(i.spark, i.sf_dir).write.option("compression", "gzip").text(path)
    return cleaning.clean_events(readers.read_events(i.spark, path, name_glob="*.gz"))


def stored_events(i: Inputs) -> DataFrame:
    """Events stored by day, one day re-written, a range copied and read without one day."""
    path = shared_path(i.spark, "events")
    writers.write_events(i.ev, path)
    writers.write_events(i.ev.filter(C.in_range("2024-01-12", "2024-01-12")), path)
    stored, copied = i.spark.read.parquet(path), f"{path}-copy"
    writers.copy_range(stored, copied, "2024-01-10", "2024-01-20")
    kept = readers.read_clean_events(i.spark, copied, hi="2024-01-19", exclude=["2024-01-15"], all_columns=True)
    return kept.groupBy("event_date", "event_type").agg(F.count("*").alias("events"))


def stored_eras(i: Inputs) -> DataFrame:
    """Per-era results stored in two runs; the second replaces the eras it holds."""
    path = shared_path(i.spark, "eras")
    writers.write_era(rhythm.weekday_weekend(i.old), path)
    return writers.write_era(rhythm.weekday_weekend(i.ev.filter(F.col("era") >= "W3")), path)


def exported_metrics(i: Inputs) -> DataFrame:
    """NULL counts exported as a metric,value CSV and read back with a schema."""
    path = shared_path(i.spark, "metrics")
    columns = ["pr_number", "pr_merged", "push_distinct_size", "payload_action"]
    writers.export_metrics(null_counts(i.ev, {c: [c] for c in columns}), path)
    return readers.read_csv(i.spark, path, "metric STRING, value BIGINT")


def exported_report(i: Inputs) -> DataFrame:
    """First events exported with readable timestamps and read back."""
    path = shared_path(i.spark, "report")
    columns = ["event_id", "event_type", "event_ts", "repo_name"]
    writers.export_report(writers.sample_rows(i.ev, columns, 10, ["event_ts", "event_id"]), path)
    return readers.read_csv(i.spark, path, "event_id STRING, event_type STRING, event_ts STRING, repo_name STRING")


def models_from_lines(i: Inputs) -> DataFrame:
    """Models delivered as JSON lines, read and cleaned."""
    path = shared_path(i.spark, "models")
    i.raw_md.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return cleaning.clean_models(readers.read_models(i.spark, path))


def models_from_parquet(i: Inputs) -> DataFrame:
    """The same models stored as Parquet in four files."""
    path = shared_path(i.spark, "models")
    writers.write_raw(i.raw_md, path, files=4)
    return cleaning.clean_models(readers.read_models(i.spark, path, fmt="parquet"))


def seed_from_array(i: Inputs) -> DataFrame:
    """The curated list delivered as one JSON array."""
    path = shared_path(i.spark, "seed")
    i.seed.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).write.text(path)
    return readers.read_seed(i.spark, path).select("repo", "category", "hf_library")


def packages_from_lines(i: Inputs) -> DataFrame:
    """Downloads delivered as JSON lines with quoted numbers."""
    path = shared_path(i.spark, "packages")
    quoted = F.struct("project", "month", F.col("downloads").cast("string").alias("downloads"))
    i.pkg.select(F.to_json(quoted).alias("value")).write.text(path)
    return profiling.package_totals(readers.read_package_downloads(i.spark, path))


def events_with_supplement(i: Inputs) -> DataFrame:
    """Events in two stored parts, the second optional, and a third that does not exist."""
    first, second = (shared_path(i.spark, name) for name in ("events", "supplement"))
    early = F.col("event_date") < F.lit("2024-01-16").cast("date")
    writers.write_events(i.ev.filter(early), first)
    writers.write_table(i.ev.filter(~early).drop("payload_action"), second)
    both = readers.union_optional(readers.read_table_or_path(i.spark, "no_such_table", first), second)
    return quality.daily_counts(readers.union_optional(both, f"{second}-missing"))


def summary_from_sketches(i: Inputs) -> DataFrame:
    """Era totals merged from sketches that were stored day by day in two batches; the second batch
    stores one day of the first again. Close means within three standard errors."""
    path = shared_path(i.spark, "sketches")
    early = F.col("event_date") < F.lit("2024-01-16").cast("date")
    writers.write_events(eras.daily_sketches(i.ev.filter(early)), path)
    writers.write_events(eras.daily_sketches(i.ev.filter(F.col("event_date") >= F.lit("2024-01-15").cast("date"))), path)
    names = ("distinct_repos", "distinct_actors")
    exact = i.ev.groupBy("era").agg(F.count_distinct("repo_name").alias(names[0]), F.count_distinct("actor_login").alias(names[1]))
    near = [(F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= 0.03 * F.col(f"e.{c}")).alias(f"{c}_close") for c in names]
    merged = eras.merged_sketches(i.spark.read.parquet(path))
    return merged.alias("a").join(exact.alias("e"), "era").select("era", "total_events", *near)


def contributor_flow_in_batches(i: Inputs) -> DataFrame:
    """Contributor flow from a maintained state: the later days first, then the earlier, with one day in both."""
    path = shared_path(i.spark, "contributors")
    later = i.ev.filter(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
    add_contributors_job(later, i.targets, path, grain="day")
    earlier = i.ev.filter(F.col("event_date") < F.lit("2024-01-16").cast("date"))
    return add_contributors_job(earlier, i.targets, path, grain="day")


def streamed_days(i: Inputs) -> DataFrame:
    """Daily activity of each repository from a stream over files; an event long after the others, delivered
    later, closes all their days. Distinct actors are approximate in a stream and left out."""
    feed, days, state = (shared_path(i.spark, name) for name in ("feed", "days", "stream"))
    data.raw_event_lines(i.spark, i.sf_dir).write.text(feed)
    later = """'{"id":"last","type":"WatchEvent","created_at":"2030-01-01T00:00:00Z","repo":{"name":"last/last"}}' AS value"""
    for lines in (None, i.spark.range(1).selectExpr(later)):
        if lines is not None:
            lines.write.mode("append").text(feed)
        events = daily.stream_clean_events(daily.stream_raw_events(i.spark, feed, 100_000))
        daily.write_stream(daily.stream_repo_days(events), days, state).awaitTermination()
    return i.spark.read.parquet(days).drop("distinct_actors")


def bucketed_stars(i: Inputs) -> DataFrame:
    """Stars and pushes of each repository from two bucketed tables, joined without a shuffle."""
    tables = []
    for kind, event_type in (("stars", "WatchEvent"), ("pushes", "PushEvent")):
        tables.append(f"vitals_{kind}_{uuid.uuid4().hex}")
        counted = i.ev.filter(C.is_type(event_type)).groupBy("repo_name").agg(F.count("*").alias(kind))
        writers.write_bucketed(counted, tables[-1], buckets=16)
    return joins.bucketed_join(i.spark, *tables)


def _cut_one(spark: SparkSession, path: str, name: str) -> None:
    """Replaces the archive in a folder by its first two thirds, as if its transfer had broken off."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(f"{path}/{name}")
    files = folder.getFileSystem(conf)
    for status in files.listStatus(folder):
        if status.getPath().getName().endswith(".gz"):
            source, target = files.open(status.getPath()), files.create(hadoop.fs.Path(folder, "cut.gz"))
            part = spark._jvm.org.apache.commons.io.input.BoundedInputStream(source, status.getLen() * 2 // 3)
            hadoop.io.IOUtils.copyBytes(part, target, 1 << 16, True)
            files.delete(status.getPath(), False)


def truncated_archives(i: Inputs) -> DataFrame:
    """Events in three gzip archives of which one was cut: what a tolerant read keeps of each."""
    path = shared_path(i.spark, "archives")
    lines = i.ev.select(F.to_json(F.struct("event_id", F.col("event_type").alias("type"), "repo_name", "actor_login")).alias("value"), F.expr("CAST(event_id AS BIGINT) % 3").alias("third"))
    lines.repartition("third").write.partitionBy("third").option("compression", "gzip").text(path)
    _cut_one(i.spark, path, "third=1")
    losses = readers.archive_losses(i.spark, path)
    third = F.regexp_extract("path", "third=([0-9])", 1).cast("bigint")
    sizes = i.ev.groupBy(F.expr("CAST(event_id AS BIGINT) % 3").alias("third")).agg(F.count("*").alias("n"))
    return losses.withColumn("third", third).join(sizes, "third").select(
        "third", "ended_early", F.when(~F.col("ended_early"), F.col("rows")).alias("whole_rows"), (F.col("rows") < F.col("n")).alias("lost_some"), (F.col("rows") > 0).alias("kept_some")
    )


def _hourly_archives(i: Inputs) -> str:
    """Parsed events as hourly gzip archives named as the feed names them; some hours were never delivered."""
    path = shared_path(i.spark, "hours")
    at = F.col("event_ts")
    hour = F.concat(F.date_format(at, "yyyy-MM-dd"), F.lit("-"), F.hour(at).cast("string"))
    delivered = ~((F.dayofmonth(at) % 5 == 0) & (F.hour(at) % 7 == 3))
    record = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.struct(F.col("repo_name").alias("name")).alias("repo"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at")))
    lines = i.ev.filter(delivered).select(record.alias("value"), hour.alias("hour"))
    lines.repartition("hour").write.partitionBy("hour").option("compression", "gzip").text(path)
    hadoop, conf = i.spark._jvm.org.apache.hadoop, i.spark._jsc.hadoopConfiguration()
    files = hadoop.fs.Path(path).getFileSystem(conf)
    for status in files.globStatus(hadoop.fs.Path(f"{path}/hour=*/*.gz")):
        name = status.getPath().getParent().getName().partition("=")[2]
        files.rename(status.getPath(), hadoop.fs.Path(f"{path}/{name}.json.gz"))
    return path


def archive_coverage(i: Inputs) -> DataFrame:
    """Delivered archives of a month by their names, beside the events read from them."""
    path = _hourly_archives(i)
    covered = quality.archive_coverage(readers.archive_hours(i.spark, path, "2024-01"), "2024-01-01", "2024-01-31")
    month = readers.read_event_month(i.spark, path, "2024-01")
    events = month.groupBy(F.to_date(C.parsed_timestamp("created_at")).alias("event_date")).agg(F.count("*").alias("events"))
    return covered.drop("bytes").join(events, "event_date", "left")


def swapped_rows(i: Inputs) -> DataFrame:
    """Two versions with equal counts by type and day: repositories of some events differ, one event was
    lost on each day and another one repeated."""
    number = F.col("event_id").cast("bigint")
    renamed = i.ev.withColumn("repo_name", F.when(number % 97 == 5, "elsewhere").otherwise(F.col("repo_name")))
    new = renamed.filter(number % 1000 != 7).unionByName(renamed.filter(number % 1000 == 8))
    return quality.changed_rows(new, i.ev)


def schema_changes(i: Inputs) -> DataFrame:
    """Columns lost, added or changed between two versions."""
    old = i.ev.select("event_id", "event_type", "pr_number")
    new = i.ev.select("event_type", F.col("pr_number").cast("string").alias("pr_number"), "era")
    return joins.schema_difference(new, old)


def approximate_summary(i: Inputs) -> DataFrame:
    """Whether the estimated distinct counts are within three standard errors of the exact ones."""
    exact = eras.era_summary(i.ev, exact=True).alias("e")
    names = ("distinct_repos", "distinct_actors")
    near = [
        (F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= 0.03 * F.col(f"e.{c}")).alias(f"{c}_close") for c in names
    ]
    return eras.era_summary(i.ev).alias("a").join(exact, "era").select("era", *near)


# Query name -> product over its inputs.
PRODUCTS: dict[str, Callable[[Inputs], DataFrame]] = {
    # cleaning
    "clean_events": lambda i: cleaning.clean_events(i.parsed),
    "clean_events_curated": lambda i: cleaning.clean_events(
        i.parsed, i.seed.select(F.col("repo").alias("repo_name"))
    ),
    "clean_models": lambda i: cleaning.clean_models(i.raw_md),
    "normalize_model_record": lambda i: _flat_record(cleaning.normalize_model_record(i.hub)),
    "flatten_eval_results": lambda i: cleaning.flatten_eval_results(i.hub),
    # activity
    "repo_daily_metrics": lambda i: i.daily,
    "repo_yearly": lambda i: activity.repo_yearly(i.daily),
    "top_repos": lambda i: i.top,
    "label_ai": lambda i: joins.label_ai(i.top, i.seed),
    "group_summary": lambda i: activity.group_summary(joins.label_ai(i.top, i.seed)),
    "group_summary_medians": lambda i: activity.group_summary(joins.label_ai(i.top, i.seed), medians=True),
    "star_growth_hype": lambda i: i.hype,
    "star_growth_hype_weekly": lambda i: activity.star_growth_hype(i.ev, i.top, i.seed, grain="week"),
    "contributor_health": lambda i: i.health,
    "top_pushers": lambda i: activity.top_pushers(i.ev),
    "bus_factor": lambda i: activity.bus_factor(i.ev),
    # adoption
    "library_stats_for_join": lambda i: adoption.library_stats_for_join(i.md),
    "hub_repo_join": lambda i: i.joined,
    "package_yearly": lambda i: adoption.package_yearly(i.pkg),
    "health_score": lambda i: i.scored,
    "health_score_minmax": lambda i: adoption.health_score(
        i.joined, adoption.package_yearly(i.pkg), norm="minmax"
    ),
    # eras
    "era_summary": lambda i: eras.era_summary(i.ev, exact=True),
    "era_summary_by_number": lambda i: eras.era_summary(i.ev, exact=True, scope="number"),
    "era_summary_approx": approximate_summary,
    "push_size_distribution": lambda i: eras.push_size_distribution(i.ev),
    "pr_push_ratio": lambda i: eras.pr_push_ratio(i.ev, exact=True),
    "pr_push_quartiles": lambda i: eras.pr_push_quartiles(i.ev),
    "active_repos_monthly": lambda i: eras.active_repos_monthly(i.ev),
    "active_in_first_quarters": lambda i: eras.active_repos_monthly(
        eras.with_era(i.orders, eras.era_of_ranges(FIRST_QUARTERS))
    ),
    "active_by_quarter": lambda i: eras.active_repos_monthly(
        eras.with_era(i.orders, C.quarter_era("event_date")), grain="year"
    ),
    "era_type_counts": lambda i: eras.era_type_counts(i.ev, CORE_EVENT_TYPES),
    "merge_eras": lambda i: eras.merge_eras(
        [eras.push_size_distribution(i.ev.filter(F.col("era") == era)) for era in ERAS]
    ),
    "one_commit_share": lambda i: eras.one_commit_share(eras.push_size_distribution(i.ev)),
    "pr_merge_rate": lambda i: eras.pr_merge_rate(eras.era_summary(i.ev)),
    "era_delta": lambda i: eras.era_delta(
        eras.era_summary(i.ev, exact=True), ["total_events", "distinct_actors", "merged_prs"]
    ),
    # deep dive
    "target_repos": lambda i: i.targets,
    "pr_merge_time": lambda i: deepdive.pr_merge_time(i.ev, i.targets, exact=True),
    "pr_merge_time_across_eras": lambda i: deepdive.pr_merge_time(
        i.ev, i.targets, within_era=False, exact=True
    ),
    "daily_pr_timeseries": lambda i: deepdive.daily_pr_timeseries(i.ev, i.targets),
    "daily_pr_count": lambda i: deepdive.daily_pr_count(deepdive.daily_pr_timeseries(i.ev, i.targets)),
    "daily_commits_timeseries": lambda i: deepdive.daily_commits_timeseries(i.ev, i.targets),
    "daily_commits": lambda i: deepdive.daily_commits(deepdive.daily_commits_timeseries(i.ev, i.targets)),
    "contributor_flow": lambda i: deepdive.contributor_flow(i.ev, i.targets, grain="day"),
    "contributor_flow_in_batches": contributor_flow_in_batches,
    "contributor_flow_monthly": lambda i: deepdive.contributor_flow(i.ev, i.targets),
    "group_pr_merge_time": lambda i: deepdive.group_pr_merge_time(
        deepdive.pr_merge_time(i.ev, i.targets, exact=True)
    ),
    "group_daily_commits": lambda i: deepdive.group_daily_commits(
        deepdive.daily_commits(deepdive.daily_commits_timeseries(i.ev, i.targets))
    ),
    "group_daily_prs": lambda i: deepdive.group_daily_prs(
        deepdive.daily_pr_count(deepdive.daily_pr_timeseries(i.ev, i.targets))
    ),
    # rhythm
    "weekday_weekend": lambda i: rhythm.weekday_weekend(i.ev),
    "weekday_weekend_by_type": lambda i: rhythm.weekday_weekend(i.ev, by_type=True),
    "push_per_actor": lambda i: rhythm.push_per_actor(i.ev, cohorts=COHORTS, per_day=PER_DAY, exact=True),
    "weekend_share": lambda i: rhythm.weekend_share_with_baseline(i.ev),
    "weekend_share_by_type": lambda i: rhythm.weekend_share(
        rhythm.weekday_weekend(i.ev, by_type=True), ["era", "event_type"]
    ),
    # event profiles, in the raw or the cleaned layout
    "events_summary": lambda i: profiling.events_summary(i.raw),
    "event_type_distribution": lambda i: profiling.event_type_distribution(i.raw),
    "events_null_counts": lambda i: profiling.events_null_counts(i.raw),
    "top_active_repos": lambda i: profiling.top_active_repos(i.raw),
    "events_sample": lambda i: profiling.events_sample(
        i.ev.orderBy("event_ts", F.col("event_id").cast("bigint"))
    ),
    "null_report": lambda i: profiling.null_report(i.ev),
    "core_event_share": lambda i: profiling.core_event_share(i.raw),
    "events_per_hour": lambda i: profiling.events_per_hour(i.raw),
    "distinct_repos_actors": lambda i: profiling.distinct_repos_actors(i.raw),
    # model profiles and exploration
    "models_summary": lambda i: profiling.models_summary(i.raw_md, exact=True),
    "pipeline_tag_distribution": lambda i: profiling.pipeline_tag_distribution(i.raw_md),
    "library_distribution": lambda i: profiling.library_distribution(i.raw_md),
    "models_null_counts": lambda i: profiling.models_null_counts(i.raw_md),
    "top_authors": lambda i: profiling.top_authors(i.raw_md),
    "top_downloads": lambda i: profiling.top_downloads(i.md),
    "models_sample": lambda i: profiling.models_sample(i.md.orderBy(F.desc("downloads"), "model_id")),
    "downloads_distribution": lambda i: models.downloads_distribution(i.md),
    "downloads_percentiles": lambda i: models.downloads_percentiles(i.md, exact=True),
    "downloads_likes_correlation": lambda i: models.downloads_likes_correlation(i.md),
    "pipeline_tag_stats": lambda i: models.pipeline_tag_stats(i.md),
    "library_stats": lambda i: models.library_stats(i.md),
    "monthly_creation_trend": lambda i: models.monthly_creation_trend(i.md),
    "license_stats": lambda i: models.license_stats(i.md),
    "parameter_distribution": lambda i: models.parameter_distribution(i.md),
    "owner_concentration": lambda i: models.owner_concentration(i.md, 10),
    "owner_model_count_distribution": lambda i: models.owner_model_count_distribution(i.md),
    "staleness_distribution": lambda i: models.staleness_distribution(i.md, AS_OF),
    "gated_stats": lambda i: models.gated_stats(i.md),
    # package downloads
    "package_totals": lambda i: profiling.package_totals(i.pkg),
    "package_monthly_pivot": lambda i: package_pivot(i.pkg),
    "package_monthly_top": lambda i: profiling.package_monthly_top(i.pkg, 3),
    "package_growth_pct": lambda i: profiling.package_growth_pct(i.pkg),
    # quality
    "era_quality": lambda i: quality.era_quality(i.ev),
    "daily_counts": lambda i: quality.daily_counts(i.ev),
    "field_value_counts": lambda i: quality.field_value_counts(i.ev, "payload_action"),
    "field_value_counts_day": lambda i: quality.field_value_counts(i.ev, "pr_merged", "2024-01-15"),
    "compare_by_type": lambda i: quality.compare_by_type(i.new, i.old),
    "compare_by_day": lambda i: quality.compare_by_day(i.new, i.old),
    "compare_totals_nulls": lambda i: quality.compare_totals_nulls(i.new, i.old),
    "hour_coverage": lambda i: quality.hour_coverage(i.ev, "2023-12-31", "2024-02-01"),
    "hour_coverage_raw": lambda i: quality.hour_coverage(i.parsed, "2024-01-03", "2024-01-20"),
    "missing_hours_raw": lambda i: quality.missing_hours(i.parsed, "2024-01-03", "2024-01-20"),
    "missing_hours": lambda i: quality.missing_hours(i.ev, "2023-12-31", "2024-02-01"),
    # derived reports
    "risk_band": lambda i: risk.risk_band(i.health),
    "contributor_risk_pattern": lambda i: risk.contributor_risk_pattern(
        i.health, concentrated=0.08, few_prs=17, few_pushers=12
    ),
    "builder_share": lambda i: risk.builder_share(i.health),
    "hype_rate": lambda i: risk.hype_rate(
        activity.star_growth_hype(i.ev, i.top, i.seed, grain="day"), burst=2, extreme=2.5
    ),
    "peak_month_share": lambda i: risk.peak_month_share(
        activity.star_growth_hype(i.ev, i.top, i.seed, grain="week")
    ),
    "owner_hype": lambda i: risk.owner_hype(i.hype),
    "rank_correlation": lambda i: adoption.rank_correlation(i.scored, "gh_stars_2025", "health_score"),
    "topk_overlap": lambda i: adoption.topk_overlap(i.scored, "gh_stars_2025", "health_score"),
    # Ratios of billions: a double has no six digits after the point there.
    "adoption_per_star": lambda i: comparable(adoption.adoption_per_star(i.scored), 3),
    "adoption_archetype": lambda i: adoption.adoption_archetype(i.scored, 20, 10_000_000),
    "bubble_frame": lambda i: adoption.bubble_frame(i.scored, per_point=1, smallest=290, largest=310),
    "star_rank_of_healthiest": lambda i: adoption.star_rank_of_healthiest(i.top, i.scored),
    # sources and sinks
    "cleaned_from_files": cleaned_from_files,
    "stored_events": stored_events,
    "stored_eras": stored_eras,
    "models_from_lines": models_from_lines,
    "models_from_parquet": models_from_parquet,
    "seed_from_array": seed_from_array,
    "packages_from_lines": packages_from_lines,
    "events_with_supplement": events_with_supplement,
    "schema_difference": schema_changes,
    "summary_from_sketches": summary_from_sketches,
    "streamed_days": streamed_days,
    "bucketed_stars": bucketed_stars,
    "truncated_archives": truncated_archives,
    "archive_coverage": archive_coverage,
    "swapped_rows": swapped_rows,
    "exported_metrics": exported_metrics,
    "exported_report": exported_report,
    # building blocks
    "exclude_dates": lambda i: quality.daily_counts(
        readers.exclude_dates(i.ev, ["2024-01-06", "2024-01-13"])
    ),
    "date_range": lambda i: quality.daily_counts(i.ev.filter(C.in_range("2024-01-10", "2024-01-20"))),
    "exclude_repos": lambda i: profiling.top_active_repos(
        joins.exclude_repos(i.ev, i.seed.select(F.col("repo").alias("repo_name")))
    ),
    "event_value_percentiles": lambda i: exact_percentiles(
        data.table(i.spark, i.sf_dir, "events").select("event_type", "value"),
        "value",
        {"p50": 0.5, "p90": 0.9, "p99": 0.99},
        ["event_type"],
        few=True,
    ),
    "ordered_sample": lambda i: writers.sample_rows(
        i.ev, ["event_id", "event_type", "repo_name"], 10, ["event_ts", "event_id"]
    ),
}


def prepared(spark: SparkSession) -> SparkSession:
    """What the library asks of a session, supplied for a session that only runs these queries:
    UTC, and a shared folder where everything runs in one process."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    if not context.getCheckpointDir() and re.fullmatch(r"local(\[[^]]*\])?", context.master):
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="vitals-"))
    return spark


def queries() -> dict[str, Query]:
    def query(product: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: comparable(product(Inputs(prepared(spark), sf_dir)))

    return {name: query(product) for name, product in PRODUCTS.items()}
