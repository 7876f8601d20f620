"""Repository activity: daily metrics, rankings, bursts and contributors."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitals.functions import columns as C
from vitals.functions.aggregates import rounded_avg, type_counts
from vitals.functions.ordering import top_k
from vitals.functions.percentiles import percentile_table
from vitals.operators.joins import keep_repos, label_ai
from vitals.sources.dimensions import seed_repos
from vitals.sources.readers import exclude_dates

ACTIVITY = ("stars", "forks", "pushes", "prs", "issues")


def repo_daily_metrics(events: DataFrame, seed: DataFrame) -> DataFrame:
    """Activity of the curated repositories per day.

    One distinct aggregate, so Spark counts it in two shuffles keyed by
    (repository, day, actor) and (repository, day): a hot repository is spread
    over its actors before its totals meet.
    """
    return (
        keep_repos(events, seed_repos(seed))
        .groupBy("repo_name", "event_date")
        .agg(
            *type_counts(),
            F.count_distinct("actor_login").alias("distinct_actors"),
            F.count("event_id").alias("total_events"),
        )
    )


def repo_yearly(daily: DataFrame, suffix: str = "2025") -> DataFrame:
    """Daily metrics rolled up per repository.

    ``gh_actors_<suffix>`` adds up *daily* distinct actors (actor-days); an actor
    active on three days counts three times.
    """
    sums = [F.sum(name).alias(f"gh_{name}_{suffix}") for name in ACTIVITY]
    return daily.groupBy("repo_name").agg(
        *sums,
        F.sum("distinct_actors").alias(f"gh_actors_{suffix}"),
        F.count_distinct("event_date").alias("gh_active_days"),
    )


def repo_totals(events: DataFrame) -> DataFrame:
    """Activity of every repository over the whole input.

    The two distinct counts share one aggregate. Its row copies collapse inside
    each task, where a file holds few days, before anything is shuffled; a
    separate pre-aggregate by actor and day gave no clear gain when measured.
    """
    return events.groupBy("repo_name").agg(
        *type_counts(),
        F.count_distinct("actor_login").alias("distinct_actors"),
        F.count_distinct("event_date").alias("active_days"),
        F.count("event_id").alias("total_events"),
    )


def top_repos(
    events: DataFrame, k: int = 1000, by: str = "stars", exclude: Iterable[date | str] = ()
) -> DataFrame:
    """The ``k`` repositories with most ``by``, ties by name."""
    return top_k(repo_totals(exclude_dates(events, exclude)), k, by, "repo_name")


def group_summary(top: DataFrame, medians: bool = False) -> DataFrame:
    """Curated repositories against the others: mean, and exact median, activity per repository."""
    measures = {
        "stars": "stars",
        "forks": "forks",
        "pushes": "pushes",
        "prs": "prs",
        "contributors": "distinct_actors",
        "active_days": "active_days",
    }
    aggs = [rounded_avg(c, 1).alias(f"avg_{name}") for name, c in measures.items()]
    aggs = [F.count("*").alias("repo_count"), *aggs]
    if medians:
        wanted = {f"median_{name}": (c, 0.5) for name, c in measures.items()}
        return percentile_table(top.select("is_ai", *measures.values()), ["is_ai"], aggs, wanted, few=True)
    return top.groupBy("is_ai").agg(*aggs)


def star_growth_hype(
    events: DataFrame, top: DataFrame, seed: DataFrame, grain: str = "month"
) -> DataFrame:
    """Star bursts: the best period of a repository against its mean active period.

    Counts per (repository, period) collapse before anything else moves; the
    per-repository step then sees one row per period, so no window is needed.
    """
    per_period = (
        keep_repos(events.filter(C.is_type("WatchEvent")), top.select("repo_name"))
        .groupBy("repo_name", C.period("event_date", grain).alias("period"))
        .agg(F.count("*").alias("n"))
    )
    hype = per_period.groupBy("repo_name").agg(
        F.sum("n").alias("total_stars"),
        rounded_avg("n", 1).alias("avg_monthly_stars"),
        F.max("n").alias("peak_stars"),
        (F.max("n") / (F.avg("n") + 1)).alias("peak_ratio"),
        F.count("period").alias("months_active"),
        F.min_by("period", F.struct(-F.col("n"), F.col("period"))).alias("peak_month"),
    )
    return label_ai(hype, seed)


def actor_activity(events: DataFrame, opened_only: bool = False) -> DataFrame:
    """Pushes and pull requests per repository and actor, in one pass."""
    pr = C.is_opened_pr() if opened_only else C.is_type("PullRequestEvent")
    return events.groupBy("repo_name", "actor_login").agg(
        F.count_if(C.is_type("PushEvent")).alias("pushes"), F.count_if(pr).alias("prs")
    )


def contributor_health(
    events: DataFrame, top: DataFrame, seed: DataFrame, opened_only: bool = False
) -> DataFrame:
    """Contributors of the top repositories and the weight of the strongest pusher.

    Everything derives from one (repository, actor) aggregate: distinct counts
    become plain counts, the strongest pusher a maximum. A repository without
    pushes (or pull requests) has NULL there, "not measurable".
    """
    per_actor = actor_activity(keep_repos(events, top.select("repo_name")), opened_only)
    pushed, requested = F.col("pushes") > 0, F.col("prs") > 0
    health = per_actor.groupBy("repo_name").agg(
        F.count("actor_login").alias("total_contributors"),
        F.sum(F.when(pushed, F.col("pushes"))).alias("total_pushes"),
        F.sum(F.when(pushed, F.col("actor_login").isNotNull().cast("int"))).alias("push_contributors"),
        F.max(F.when(pushed, F.col("pushes"))).alias("top1_pushes"),
        F.sum(F.when(requested, F.col("actor_login").isNotNull().cast("int"))).alias("pr_contributors"),
    )
    health = health.withColumn(
        "top1_push_ratio", F.round(F.col("top1_pushes") / (F.col("total_pushes") + 1), 3)
    )
    return label_ai(health, seed).select(
        "repo_name",
        "total_contributors",
        "total_pushes",
        "push_contributors",
        "top1_pushes",
        "top1_push_ratio",
        "pr_contributors",
        "is_ai",
    )


def top_pushers(events: DataFrame) -> DataFrame:
    """Strongest pusher of each repository, all of them when several tie.

    A rank window would put all actors of one repository into one task. Joining
    the per-actor counts to the repository's maximum on (repository, count)
    gives the same rows and spreads a hot repository over its counts.
    """
    per_actor = (
        events.filter(C.is_type("PushEvent"))
        .groupBy("repo_name", "actor_login")
        .agg(F.count("*").alias("push_count"))
    )
    best = per_actor.groupBy("repo_name").agg(F.max("push_count").alias("push_count"))
    return per_actor.join(best, ["repo_name", "push_count"], "left_semi").select(
        "repo_name", "actor_login", "push_count"
    )


def bus_factor(events: DataFrame, share: float = 0.8) -> DataFrame:
    """Fewest actors who together made at least ``share`` of a repository's pushes.

    Actors with equally many pushes are interchangeable, so the running sum goes
    over *distinct push counts*. Distinct counts c1 > c2 > ... add up to at most
    the repository's pushes N, so there are fewer than sqrt(2 N) of them: 45,000
    rows for a repository with a billion pushes, however many actors it has.
    """
    per_actor = (
        events.filter(C.is_type("PushEvent"))
        .groupBy("repo_name", "actor_login")
        .agg(F.count("*").alias("n"))
    )
    levels = per_actor.groupBy("repo_name", "n").agg(F.count("*").alias("actors"))
    whole = W.partitionBy("repo_name")
    above = whole.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)
    made = F.col("n") * F.col("actors")
    summed = (
        levels.withColumn("before", F.coalesce(F.sum(made).over(above), F.lit(0)))
        .withColumn("actors_before", F.coalesce(F.sum("actors").over(above), F.lit(0)))
        .withColumn("total", F.sum(made).over(whole))
        # Exact decimal arithmetic: 0.8 * total must not be off by a rounding error.
        .withColumn("needed", F.ceil(F.lit(Decimal(str(share))) * F.col("total")).cast("bigint"))
    )
    crossing = (F.col("before") < F.col("needed")) & (F.col("before") + made >= F.col("needed"))
    return summed.filter(crossing).select(
        "repo_name",
        F.expr("actors_before + (needed - before + n - 1) div n").alias("bus_factor"),
    )
