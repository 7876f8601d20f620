"""Ranks and top-k that stay distributed.

A window without PARTITION BY sends every row to one task. The functions here
first collapse rows to their distinct values, cut these into buckets of similar
size at bounds taken from the values themselves, and add two prefix sums: one over
the (few) buckets and one inside each bucket. No task ever holds the whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BUCKETS = 256


def top_k(df: DataFrame, k: int, by: str, key: str | Sequence[str]) -> DataFrame:
    """Largest ``k`` rows by ``by``, ties broken by key; plans as TakeOrderedAndProject."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(F.desc(by), *[F.asc(c) for c in keys]).limit(k)


def _bounds(hist: DataFrame, value: str) -> DataFrame:
    """Bucket bounds as one array: every fourth value of a sample in order.

    The sample are the values of least hash, so it depends on the data only and is the same
    wherever the plan computes it. Copies of a value are one, so no value weighs more than
    another, and neither outliers nor infinities widen a bucket.
    """
    sample = hist.orderBy(F.xxhash64(value), F.col(value)).limit(4 * BUCKETS)
    every = F.filter(F.sort_array(F.collect_list(value)), lambda _, i: i % 4 == 3)
    return sample.agg(every.alias("_bounds"))


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct non-NULL value: ``rows`` with it, ``before`` rows below it, ``total``.

    From this follow, exactly: rank = before + 1, average rank =
    before + (rows + 1) / 2. Copies of one value collapse map-side, so a hot value costs nothing.
    """
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias("rows"))
        # Always true, but keeps the counts in every branch below, so that all of
        # them reuse one shuffle of the input.
        .filter("rows > 0")
    )
    # Bounds and total are one row each: scalar subqueries, not joins.
    bounded = hist.withColumn("_bounds", _bounds(hist, value).scalar())
    bounded = bounded.withColumn("total", hist.agg(F.sum("rows")).scalar())
    bucket = F.size(F.filter("_bounds", lambda b: b < F.col(value)))
    bucketed = bounded.withColumn("_bucket", bucket).drop("_bounds")

    ahead = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.sum("rows").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        .drop("_n")
    )
    inside = W.partitionBy("_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        bucketed.join(offsets, "_bucket")
        .withColumn("before", F.col("_offset") + F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .select(value, "rows", "before", "total")
    )


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Rank of each distinct value, ties sharing their mean rank."""
    mean = F.col("before") + (F.col("rows") + 1) / F.lit(2.0)
    return value_ranks(df, value).select(value, mean.alias(name))


def descending_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the competition rank, 1 for the largest value, ties sharing the best rank."""
    ranks = value_ranks(df, value).select(
        F.col(value).alias("_v"), (F.col("total") - F.col("before") - F.col("rows") + 1).alias(name)
    )
    return df.join(ranks, df[value] == F.col("_v"), "left").drop("_v")
