"""Exploration of cleaned model-hub records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.functions import columns as C
from vitals.functions.aggregates import DEFAULT_ACCURACY, rounded_avg, value_counts
from vitals.functions.ordering import top_k
from vitals.functions.percentiles import exact_percentiles

# Inclusive upper bounds and labels of the buckets.
DOWNLOAD_BUCKETS = [(0, "0"), (100, "1-100"), (10_000, "101-10K"), (1_000_000, "10K-1M")]
OWNER_BUCKETS = [(1, "1"), (5, "2-5"), (20, "6-20"), (100, "21-100")]
STALENESS_BUCKETS = [(30, "<30 days"), (90, "30-90 days"), (365, "90-365 days")]
# Exclusive upper bounds and labels of the buckets.
PARAMETER_BUCKETS = [
    (1_000_000_000, "<1B"),
    (7_000_000_000, "1-7B"),
    (13_000_000_000, "7-13B"),
    (70_000_000_000, "13-70B"),
]
# Reported download percentiles.
DOWNLOAD_PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def _bucket_counts(df: DataFrame, label: Column, name: str) -> DataFrame:
    return df.groupBy(label.alias(name)).agg(F.count("*").alias("count"))


def downloads_distribution(models: DataFrame) -> DataFrame:
    """Models per download bucket; missing downloads have their own bucket."""
    label = C.ranged_label("downloads", DOWNLOAD_BUCKETS, "1M+", "unknown")
    return _bucket_counts(models, label, "bucket")


def downloads_percentiles(
    models: DataFrame, accuracy: int = DEFAULT_ACCURACY, exact: bool = False
) -> DataFrame:
    """Download percentiles as metric rows; one sketch, or one exact pass, serves all of them."""
    if exact:
        wanted = {f"downloads_{name}": p for name, p in DOWNLOAD_PERCENTILES.items()}
        row = exact_percentiles(models.select("downloads"), "downloads", wanted)
        return row.unpivot([], row.columns, "metric", "value")
    ps = list(DOWNLOAD_PERCENTILES.values())
    row = models.agg(F.percentile_approx("downloads", ps, accuracy).alias("v")).select(
        *[F.col("v")[i].alias(f"downloads_{name}") for i, name in enumerate(DOWNLOAD_PERCENTILES)]
    )
    return row.unpivot([], row.columns, "metric", "value")


def downloads_likes_correlation(models: DataFrame) -> DataFrame:
    """Pearson correlation of downloads and likes, four digits."""
    row = models.agg(F.round(F.corr("downloads", "likes"), 4).alias("downloads_likes_correlation"))
    return row.unpivot([], row.columns, "metric", "value")


def _group_stats(models: DataFrame, key: str, likes: bool = True) -> DataFrame:
    aggs = [
        F.count("*").alias("model_count"),
        F.sum("downloads").alias("total_downloads"),
        rounded_avg("downloads", 2).alias("avg_downloads"),
    ]
    if likes:
        aggs.append(rounded_avg("likes", 2).alias("avg_likes"))
    return models.groupBy(key).agg(*aggs)


def pipeline_tag_stats(models: DataFrame) -> DataFrame:
    return _group_stats(models, "pipeline_tag")


def library_stats(models: DataFrame) -> DataFrame:
    return _group_stats(models, "library_name")


def license_stats(models: DataFrame) -> DataFrame:
    return _group_stats(models, "license", likes=False)


def monthly_creation_trend(models: DataFrame) -> DataFrame:
    """New models per month, the month as its first day."""
    month = F.trunc("created_ts", "month")
    return (
        models.filter(F.col("created_ts").isNotNull())
        .groupBy(month.alias("month"))
        .agg(F.count("*").alias("new_models"), F.sum("downloads").alias("total_downloads"))
    )


def parameter_distribution(models: DataFrame) -> DataFrame:
    label = C.below_label("parameter_count", PARAMETER_BUCKETS, "70B+", "unknown")
    return _bucket_counts(models, label, "param_bucket")


def owner_concentration(models: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` owners with most downloads."""
    per_owner = models.groupBy("owner").agg(
        F.count("*").alias("model_count"),
        F.sum("downloads").alias("total_downloads"),
        F.sum("likes").alias("total_likes"),
    )
    return top_k(per_owner, k, "total_downloads", "owner")


def owner_model_count_distribution(models: DataFrame) -> DataFrame:
    """Owners by how many models they have."""
    per_owner = models.groupBy("owner").agg(F.count("*").alias("n"))
    label = C.ranged_label("n", OWNER_BUCKETS, "100+", "unknown")
    return _bucket_counts(per_owner, label, "models_per_owner")


def staleness_distribution(models: DataFrame, as_of: date | str) -> DataFrame:
    """Models by age of the last change on a given day; no clock, so repeatable."""
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date("last_modified_ts"))
    label = C.ranged_label(age, STALENESS_BUCKETS, ">1 year", "unknown")
    return _bucket_counts(models, label, "staleness")


def gated_stats(models: DataFrame) -> DataFrame:
    """Gated models against open ones."""
    return models.groupBy(C.gated_label("gated").alias("is_gated")).agg(
        F.count("*").alias("model_count"),
        rounded_avg("downloads", 2).alias("avg_downloads"),
        rounded_avg("likes", 2).alias("avg_likes"),
    )


def models_eda(models: DataFrame, as_of: date | str) -> dict[str, DataFrame]:
    """All exploration tables by report name."""
    return {
        "downloads_distribution": downloads_distribution(models),
        "downloads_percentiles": downloads_percentiles(models),
        "downloads_likes_correlation": downloads_likes_correlation(models),
        "pipeline_tag_stats": pipeline_tag_stats(models),
        "library_stats": library_stats(models),
        "monthly_creation_trend": monthly_creation_trend(models),
        "license_stats": license_stats(models),
        "parameter_distribution": parameter_distribution(models),
        "owner_concentration": owner_concentration(models),
        "owner_model_count_distribution": owner_model_count_distribution(models),
        "staleness_distribution": staleness_distribution(models, as_of),
        "gated_stats": gated_stats(models),
        "core_task_counts": value_counts(
            models.filter(F.col("pipeline_tag").isNotNull()), "pipeline_tag", "pipeline_tag"
        ),
    }
