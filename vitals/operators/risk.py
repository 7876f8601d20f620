"""Risk labels and summaries on top of contributor and burst tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.functions import columns as C
from vitals.functions.aggregates import ratio


def risk_band(health: DataFrame, low: float = 0.3, high: float = 0.7) -> DataFrame:
    """Colour of the strongest pusher's share; gray when it is not measurable."""
    band = C.below_label("top1_push_ratio", [(low, "green"), (high, "orange")], "red", "gray")
    return health.select("repo_name", band.alias("band"))


def contributor_risk_pattern(
    health: DataFrame, concentrated: float = 0.7, few_prs: int = 50, few_pushers: int = 5
) -> DataFrame:
    """Push concentration read together with the number of pull-request authors.

    Merges count as pushes of whoever merged, so a high share alone may only
    mean that one person merges what many wrote.
    """
    pushers = F.coalesce("push_contributors", F.lit(0))
    authors = F.coalesce("pr_contributors", F.lit(0))
    one_pusher = F.coalesce(F.col("top1_push_ratio") >= concentrated, F.lit(False))
    pattern = (
        F.when((pushers <= few_pushers) & (authors <= few_prs), "audience only")
        .when(one_pusher & (authors <= few_prs), "single point")
        .when(one_pusher, "concentrated merge")
        .otherwise("healthy")
    )
    return health.select("repo_name", pattern.alias("pattern"))


def builder_share(health: DataFrame) -> DataFrame:
    """Actors who push, as a share of all actors."""
    return health.select(
        "repo_name",
        ratio(F.coalesce("push_contributors", F.lit(0)), "total_contributors").alias("share"),
    )


def hype_rate(hype: DataFrame, burst: float = 3, extreme: float = 10) -> DataFrame:
    """Share of repositories with a burst and with an extreme one, curated or not."""
    return hype.groupBy("is_ai").agg(
        (F.avg((F.col("peak_ratio") > burst).cast("int")) * 100).alias("pct_burst"),
        (F.avg((F.col("peak_ratio") > extreme).cast("int")) * 100).alias("pct_extreme"),
        F.avg("peak_ratio").alias("avg_peak_ratio"),
    )


def peak_month_share(hype: DataFrame) -> DataFrame:
    """Share of all stars that came in the best period."""
    return hype.select("repo_name", ratio("peak_stars", "total_stars").alias("share"))


def owner_hype(hype: DataFrame) -> DataFrame:
    """Repositories and mean burst per owner."""
    return hype.groupBy(C.owner_of("repo_name").alias("owner")).agg(
        F.count("*").alias("repos"), F.avg("peak_ratio").alias("avg_peak_ratio")
    )
