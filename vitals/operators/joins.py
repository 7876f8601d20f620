"""Equi-joins and set operations shared by the products."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.sources.dimensions import seed_repos


def keep_repos(events: DataFrame, repos: DataFrame, key: str = "repo_name") -> DataFrame:
    """Rows whose repository is in ``repos``, compared in lower case.

    A semi join never multiplies rows, whatever duplicates the list has.
    """
    if key not in repos.columns:
        raise ValueError(f"the repository list needs a {key} column")
    names = repos.select(F.lower(key).alias(key))
    return events.join(names, key, "left_semi")


def exclude_repos(events: DataFrame, repos: DataFrame, key: str = "repo_name") -> DataFrame:
    """Rows whose repository is not in ``repos``."""
    return events.join(repos.select(F.lower(key).alias(key)), key, "left_anti")


def label_ai(df: DataFrame, seed: DataFrame) -> DataFrame:
    """Adds ``is_ai``: whether the repository is on the curated list."""
    flagged = seed_repos(seed).withColumn("_member", F.lit(True))
    return (
        df.join(flagged, "repo_name", "left")
        .withColumn("is_ai", F.coalesce("_member", F.lit(False)))
        .drop("_member")
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def schema_difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """Columns that exist, or have their type, in only one of two frames."""
    mine, theirs = dict(new.dtypes), dict(old.dtypes)
    rows = [
        (name, mine.get(name), theirs.get(name))
        for name in dict.fromkeys([*mine, *theirs])
        if mine.get(name) != theirs.get(name)
    ]
    return new.sparkSession.createDataFrame(rows, "column STRING, new_type STRING, old_type STRING")


def bucketed_join(spark: SparkSession, left: str, right: str, key: str = "repo_name", how: str = "inner") -> DataFrame:
    """Two tables bucketed alike by ``key``, joined bucket by bucket: neither side is shuffled or
    broadcast, however large. Tables of different bucket counts raise."""
    specs = []
    for table in (left, right):
        rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name IN ('Num Buckets', 'Bucket Columns')").collect()
        specs.append({r.col_name: r.data_type for r in rows})
    if specs[0] != specs[1] or specs[0].get("Bucket Columns") != f"[`{key}`]":
        raise ValueError(f"not bucketed alike by {key}: {specs}")
    return spark.table(left).hint("merge").join(spark.table(right), key, how)
