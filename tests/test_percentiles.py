import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitals.functions.percentiles import exact_percentiles, percentile_table
from vitals.operators import deepdive, eras, rhythm
from vitals.plans import testdata as data

WANTED = {"p0": ("v", 0.0), "p25": ("v", 0.25), "w50": ("w", 0.5), "v95": ("v", 0.95), "w99": ("w", 0.99), "p100": ("v", 1.0)}


def brute(values, p):
    own = sorted(v for v in values if v is not None)
    return own[max(math.ceil(Decimal(str(p)) * len(own)), 1) - 1] if own else None


def draw(rng):
    return rng.choice([
        lambda: rng.expovariate(0.001), lambda: 7.0, lambda: -rng.random(), lambda: float(rng.randint(0, 5)),
        lambda: float("inf"), lambda: None, lambda: -0.5,
    ])()


@pytest.mark.parametrize("few", [True, False])
def test_groups_below_and_above_the_sketch_limit(spark, few):
    """With an accuracy of 100 a sketch of 50 values is no longer complete."""
    rng = random.Random(few)
    rows = []
    for key, n in [("a", 1), ("b", 48), ("c", 49), ("d", 50), ("e", 51), ("f", 400), (None, 700), ("g", 3000)]:
        rows += [(key, draw(rng), rng.choice([rng.randint(-(2**62), 2**62), 3, None])) for _ in range(n)]
    rows += [("null", None, 5)] * 60
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, w long").repartition(7)
    table = percentile_table(df, ["k"], [F.count("*").alias("n"), F.max("w").alias("most")], WANTED, few, accuracy=100)
    assert table.columns == ["k", "n", "most", *WANTED]
    got = {r.k: r for r in table.collect()}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        assert (got[key].n, got[key].most) == (len(own), max((r[2] for r in own if r[2] is not None), default=None))
        for name, (c, p) in WANTED.items():
            assert got[key][name] == brute([r[1 if c == "v" else 2] for r in own], p), (key, name)
    whole = percentile_table(df, [], [F.count("*").alias("n")], WANTED, accuracy=100).first()
    for name, (c, p) in WANTED.items():
        assert whole[name] == brute([r[1 if c == "v" else 2] for r in rows], p)


def test_a_group_of_many_distinct_values(spark):
    """Equal to the engine's own exact percentile for 250,007 values in each group."""
    ps = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    df = spark.range(800_000).select(F.when(F.col("id") % 4 > 0, "hot").otherwise("cold").alias("k"), (F.pmod(F.col("id") * 7919, F.lit(250_007)) * 3).alias("v"))
    exact = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias(n) for n, p in ps.items()]
    assert sorted(exact_percentiles(df, "v", ps, ["k"], few=True).collect()) == sorted(df.groupBy("k").agg(*exact).collect())
    assert exact_percentiles(df, "v", ps).first() == df.agg(*exact).first()


def test_no_rows_and_single_values(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert exact_percentiles(df, "v", {"p": 0.5}).first().p == 5.0
    assert exact_percentiles(df.limit(0), "v", {"p": 0.5}).first().p is None
    assert exact_percentiles(df.limit(0).withColumn("k", F.lit(1)), "v", {"p": 0.5}, ["k"]).collect() == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_no_window_spans_a_group(spark):
    ev = data.activity(spark, "/root/testdata/sf0.001")
    top = ev.select("repo_name").distinct().withColumn("is_ai", F.lit(True))
    tables = {
        "ratio": eras.pr_push_ratio(ev, exact=True),
        "pushes": rhythm.push_per_actor(ev, exact=True),
        "summary": eras.era_summary(ev, exact=True),
        "merges": deepdive.pr_merge_time(ev, top, exact=True),
    }
    for name, table in tables.items():
        windows = [line for line in plan_of(table) if "Window [" in line and "_upto" in line]
        assert len(windows) == 1, name
        assert "_k#" in windows[0].split("windowspecdefinition(")[1].split("ASC")[0], name
