from bisect import bisect_left
import random

from pyspark.sql import functions as F
from brute import average_ranks

from vitals.functions import ordering
from vitals.functions.ordering import average_rank, descending_rank, top_k, value_ranks


def sample(seed, n=400):
    r = random.Random(seed)
    pick = [lambda: r.expovariate(0.001), lambda: 7.0, lambda: -r.random(), lambda: float(r.randint(0, 5))]
    return [(r.choice("ab"), r.choice(pick)()) for _ in range(n)]


def test_value_ranks_against_brute_force(spark):
    data = sample(1)
    df = spark.createDataFrame(data + [("a", None)], "k string, v double")
    values = [v for _, v in data]
    for row in value_ranks(df, "v").collect():
        assert row.rows == values.count(row.v)
        assert row.before == sum(x < row.v for x in values)
        assert row.total == len(values)


def test_ranks_with_ties(spark):
    values = [3, 1, 3, 2, 3, 1]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    means = average_ranks(values)
    assert {r.v: r.r for r in average_rank(df, "v", "r").collect()} == dict(zip(values, means))
    got = {r.v: r.r for r in descending_rank(df, "v", "r").collect()}
    assert got == {3: 1, 2: 4, 1: 5}


def test_no_task_holds_the_whole_column(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 1.0)
    plan = value_ranks(df, "v")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # The window over rows is partitioned by bucket; the other runs over bucket totals.
    assert sum("[_bucket" in w.split("],")[-2] for w in windows) >= 1
    assert len(windows) == 2


def test_outliers_and_infinities_do_not_fill_one_bucket(spark):
    rows_in = spark.range(20_000).select(
        F.when(F.col("id") == 0, 0.0)
        .when(F.col("id") == 1, float("inf"))
        .when(F.col("id") == 2, float("-inf"))
        .otherwise(1.7e9 + F.col("id"))
        .alias("v")
    )
    hist = rows_in.groupBy("v").agg(F.count("*").alias("rows"))
    bounds = ordering._bounds(hist, "v").first()._bounds
    assert len(bounds) == ordering.BUCKETS
    values = sorted(r.v for r in rows_in.collect())
    sizes = [0] * (len(bounds) + 1)
    for v in values:
        sizes[bisect_left(bounds, v)] += 1
    assert max(sizes) < 6 * len(values) / len(bounds)


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v int")
    assert [r.k for r in top_k(df, 2, "v", "k").collect()] == ["c", "a"]
    plan = top_k(df, 2, "v", "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
