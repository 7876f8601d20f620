"""Small lookup tables.

None of them carries a broadcast hint. Spark broadcasts a join side whose own
size estimate (file bytes, limit rows) is below
``spark.sql.autoBroadcastJoinThreshold``, shuffles it otherwise, and lets AQE
switch at run time. A curated list that grows past the bound therefore still
works, only by a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals import schemas


def license_map(spark: SparkSession) -> DataFrame:
    """Licence spelling to normalized identifier."""
    return spark.createDataFrame(list(schemas.LICENSE_SYNONYMS.items()), schemas.LICENSE_MAP)


def license_lookup() -> Column:
    """The same mapping as one constant map expression, so no join is planned."""
    pairs = [F.lit(x) for pair in schemas.LICENSE_SYNONYMS.items() for x in pair]
    return F.create_map(*pairs)


def seed_repos(seed: DataFrame) -> DataFrame:
    """Distinct lower-case names of the curated repositories."""
    return seed.select(F.lower("repo").alias("repo_name")).filter("repo_name IS NOT NULL").distinct()


def seed_libraries(seed: DataFrame) -> DataFrame:
    """Library of each curated repository that has one."""
    return seed.filter("hf_library IS NOT NULL").select(
        F.col("hf_library").alias("library_name"), F.lower("repo").alias("repo_name"), "category"
    )
