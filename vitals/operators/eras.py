"""Comparison of periods. The era is a column: one plan serves all eras.

Nothing loops over eras on the driver and nothing is cached, so an era that
holds most of the rows only means more tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitals.functions import columns as C
from vitals.functions.aggregates import (
    DEFAULT_ACCURACY,
    SKETCH_LOG2_SIZE,
    approx_distinct,
    count_of,
    measured_sum,
    percentile,
    share_pct,
)
from vitals.functions.percentiles import exact_percentiles, percentile_table
from vitals.operators.joins import union_all


# Reported quartiles.
RATIO_QUARTILES = {"p25_pr_push_ratio": 0.25, "median_pr_push_ratio": 0.5, "p75_pr_push_ratio": 0.75}


def with_era(events: DataFrame, era: Column) -> DataFrame:
    """Adds the era of each row; rows outside every era are dropped."""
    return events.withColumn("era", era).filter(F.col("era").isNotNull())


def era_of_ranges(ranges: Sequence[tuple[str, str, str]], day: str = "event_date") -> Column:
    """Era label from (label, first day, last day) ranges, NULL outside them."""
    label = F.lit(None).cast("string")
    for name, lo, hi in reversed(ranges):
        label = F.when(C.in_range(lo, hi, day), name).otherwise(label)
    return label


def pull_requests(events: DataFrame, scope: str = "repo") -> DataFrame:
    """One row per pull request and era with a merged flag.

    ``scope="repo"`` identifies a request by repository and number;
    ``"number"`` by the bare number, which merges requests of different
    repositories (the published totals were computed that way).
    """
    identity = {"repo": ["repo_name", "pr_number"], "number": ["pr_number"]}[scope]
    return (
        events.filter(C.is_type("PullRequestEvent") & F.col("pr_number").isNotNull())
        .groupBy("era", *identity)
        .agg(F.max(C.is_merged_pr()).alias("merged"))
    )


def era_summary(
    events: DataFrame, exact: bool = False, scope: str = "repo", accuracy: int = DEFAULT_ACCURACY
) -> DataFrame:
    """Totals per era.

    Sketches and counters share one pass. Pull requests, and exact distinct
    counts when asked for, are aggregates of their own: next to a percentile in
    one aggregate, a distinct count would carry a percentile buffer with every
    distinct value through the shuffle. Both read few columns, pull requests
    also few rows. ``exact`` also makes the median exact at any size, by selection.
    """
    size = F.when(C.is_type("PushEvent"), F.col("push_distinct_size"))
    names = {"distinct_repos": "repo_name", "distinct_actors": "actor_login"}
    counts = [
        F.count("*").alias("total_events"),
        count_of("PushEvent").alias("total_pushes"),
        count_of("PullRequestEvent").alias("total_pr_events"),
        count_of("WatchEvent").alias("total_stars"),
    ]
    if exact:
        sized = events.select("era", "event_type", size.alias("size"))
        counts += [F.avg("size").alias("avg_commit_size")]
        totals = percentile_table(sized, ["era"], counts, {"median_commit_size": ("size", 0.5)}, few=True)
        counted = [F.count_distinct(c).alias(name) for name, c in names.items()]
        totals = totals.join(events.groupBy("era").agg(*counted), "era")
    else:
        totals = events.groupBy("era").agg(
            *counts,
            F.avg(size).alias("avg_commit_size"),
            percentile(size, 0.5, accuracy).alias("median_commit_size"),
            *[approx_distinct(c).alias(name) for name, c in names.items()],
        )
    requests = (
        pull_requests(events, scope)
        .groupBy("era")
        .agg(F.count("*").alias("distinct_prs"), F.count_if("merged").alias("merged_prs"))
    )
    return totals.join(requests, "era", "left").select(
        "era",
        "total_events",
        "distinct_repos",
        "distinct_actors",
        "total_pushes",
        F.coalesce("distinct_prs", F.lit(0)).alias("distinct_prs"),
        "total_pr_events",
        "total_stars",
        F.coalesce("merged_prs", F.lit(0)).alias("merged_prs"),
        "avg_commit_size",
        "median_commit_size",
    )


def daily_sketches(events: DataFrame) -> DataFrame:
    """Events and mergeable sketches of repositories and actors per era and day, to be stored by day.

    A new day is one more row: totals of any longer period come from ``merged_sketches`` without
    reading events again. Re-running a day replaces its rows (``writers.write_events``).
    """
    sketch = lambda c: F.hll_sketch_agg(c, SKETCH_LOG2_SIZE)
    return events.groupBy("era", "event_date").agg(
        F.count("*").alias("total_events"), sketch("repo_name").alias("repos"), sketch("actor_login").alias("actors")
    )


def merged_sketches(days: DataFrame) -> DataFrame:
    """Totals and approximate distinct counts per era from stored ``daily_sketches``."""
    merged = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    return days.groupBy("era").agg(
        F.sum("total_events").alias("total_events"),
        merged("repos").alias("distinct_repos"),
        merged("actors").alias("distinct_actors"),
    )


def push_size_distribution(events: DataFrame) -> DataFrame:
    """Pushes per commit-count bucket and era.

    An era whose feed lacks the size has NULL buckets and a total of 0: not
    measurable, which is different from no pushes. ``commits_eq_0`` makes the
    buckets add up to the total.
    """
    size = F.col("push_distinct_size")
    measurable = C.is_type("PushEvent") & size.isNotNull()
    buckets = {
        "commits_eq_0": size == 0,
        "commits_eq_1": size == 1,
        "commits_2_5": size.between(2, 5),
        "commits_6_20": size.between(6, 20),
        "commits_gt_20": size > 20,
    }
    return events.groupBy("era").agg(
        *[measured_sum(measurable, condition).alias(name) for name, condition in buckets.items()],
        F.count_if(measurable).alias("total_push_events"),
    )


def repo_pr_push(events: DataFrame, min_pushes: int = 10) -> DataFrame:
    """Pushes, pull requests, contributors and their ratio per era and repository.

    Pushes and contributors come from a (era, repository, actor) aggregate,
    pull requests from their own filtered one. Both sides end partitioned by
    (era, repository), so the join adds no shuffle.
    """
    keys = ["era", "repo_name"]
    pushed = (
        events.groupBy(*keys, "actor_login")
        .agg(count_of("PushEvent").alias("n"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("pushes"), F.count("actor_login").alias("contributors"))
        .filter(F.col("pushes") >= min_pushes)
    )
    requests = pull_requests(events, "repo").groupBy(*keys).agg(F.count("*").alias("n_prs"))
    joined = pushed.join(requests, keys, "left").withColumn("prs", F.coalesce("n_prs", F.lit(0)))
    return joined.select(
        *keys, "pushes", "prs", "contributors", (F.col("prs") / F.col("pushes")).alias("pr_push_ratio")
    )


def pr_push_ratio(
    events: DataFrame, min_pushes: int = 10, accuracy: int = DEFAULT_ACCURACY, exact: bool = False
) -> DataFrame:
    """Distribution over repositories of pull requests per push, by era."""
    value = "pr_push_ratio"
    repos = repo_pr_push(events, min_pushes)
    means = [
        F.count("repo_name").alias("repo_count"),
        F.avg(value).alias("avg_pr_push_ratio"),
        F.avg("contributors").alias("avg_contributors_per_repo"),
    ]
    if exact:
        repos = repos.select("era", "repo_name", "contributors", value)
        return percentile_table(repos, ["era"], means, {n: (value, p) for n, p in RATIO_QUARTILES.items()}, few=True)
    return repos.groupBy("era").agg(*means, *[percentile(value, p, accuracy).alias(n) for n, p in RATIO_QUARTILES.items()])


def pr_push_quartiles(events: DataFrame, min_pushes: int = 10) -> DataFrame:
    """Exact quartiles of the same ratio, still without a group in one task."""
    ratios = repo_pr_push(events, min_pushes).select("era", "pr_push_ratio")
    return exact_percentiles(ratios, "pr_push_ratio", RATIO_QUARTILES, ["era"], few=True)


def active_repos_monthly(events: DataFrame, grain: str = "month") -> DataFrame:
    """Distinct repositories and actors per period and era."""
    return events.groupBy(C.period("event_date", grain).alias("month"), "era").agg(
        F.count_distinct("repo_name").alias("active_repos"),
        F.count_distinct("actor_login").alias("active_actors"),
        F.count("*").alias("total_events"),
    )


def era_type_counts(events: DataFrame, types: Sequence[str]) -> DataFrame:
    """One column per event type; the given list spares Spark a pass to find it."""
    return events.groupBy("era").pivot("event_type", list(types)).count()


def merge_eras(parts: Sequence[DataFrame], order: Sequence[str] = ("era",)) -> DataFrame:
    """Typed per-era results in one ordered table."""
    return union_all(parts).orderBy(*order)


def one_commit_share(sizes: DataFrame) -> DataFrame:
    """Share of one-commit pushes, from ``push_size_distribution``."""
    return sizes.select("era", share_pct("commits_eq_1", "total_push_events").alias("pct"))


def pr_merge_rate(summary: DataFrame) -> DataFrame:
    """Share of pull requests that were merged, from ``era_summary``."""
    return summary.select("era", share_pct("merged_prs", "distinct_prs").alias("pct"))


def era_delta(wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Change of each metric against the previous and the first era, in percent.

    One row per era and metric goes through the windows, however many events
    are behind it.
    """
    numbers = wide.select("era", *[F.col(m).cast("double").alias(m) for m in metrics])
    long = numbers.unpivot(["era"], list(metrics), "metric", "value")
    by_era = W.partitionBy("metric").orderBy("era")
    value = F.col("value")
    previous = F.lag("value").over(by_era)
    first = F.first("value").over(by_era)
    return long.select(
        "metric",
        "era",
        share_pct(value - previous, previous).alias("pct_prev"),
        share_pct(value - first, first).alias("pct_first"),
    )
