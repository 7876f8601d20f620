"""One repository, one actor and one group of copies each hold a third of the rows."""

import math
from collections import Counter

import pytest
from frames import rows
from pyspark.sql import functions as F

from vitals.operators import activity, cleaning, eras, rhythm

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(N).select(
        i.cast("string").alias("event_id"),
        F.when(i % 5 == 1, "WatchEvent").when(i % 5 == 2, "PullRequestEvent").otherwise("PushEvent").alias("event_type"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("r"), (i % 997).cast("string"))).alias("repo_name"),
        F.when(i % 7 < 3, "bot").otherwise(F.concat(F.lit("u"), (i % 4999).cast("string"))).alias("actor_login"),
        F.date_add(F.lit("2025-01-01").cast("date"), (i % 90).cast("int")).alias("event_date"),
        F.when(i % 4 == 0, "opened").when(i % 4 == 1, "merged").otherwise("closed").alias("payload_action"),
        (i % 50).alias("pr_number"),
        F.lit(None).cast("boolean").alias("pr_merged"),
        (i % 30).alias("push_distinct_size"),
        F.lit("2025-Q1").alias("era"),
    )


@pytest.fixture(scope="module")
def local(skewed):
    return skewed.toPandas()


def test_totals(skewed, local):
    got = {r["repo_name"]: r for r in rows(activity.repo_totals(skewed))}
    mine = local[local.repo_name == "hot"]
    assert got["hot"]["total_events"] == len(mine) == N // 3
    assert got["hot"]["distinct_actors"] == mine.actor_login.nunique()
    assert got["hot"]["active_days"] == mine.event_date.nunique()
    assert sum(r["total_events"] for r in got.values()) == N


def test_bus_factor_and_its_bounded_window(skewed, local):
    pushes = local[local.event_type == "PushEvent"]
    per_actor = pushes[pushes.repo_name == "hot"].actor_login.value_counts().tolist()
    total, running, k = sum(per_actor), 0, 0
    while running * 10 < total * 8:
        running, k = running + per_actor[k], k + 1
    got = {r["repo_name"]: r["bus_factor"] for r in rows(activity.bus_factor(skewed))}
    assert got["hot"] == k
    assert len(set(per_actor)) < math.sqrt(2 * total)


def test_eras_and_rhythm(skewed, local):
    summary = rows(eras.era_summary(skewed, exact=True))[0]
    prs = local[local.event_type == "PullRequestEvent"]
    assert summary["distinct_prs"] == len(set(zip(prs.repo_name, prs.pr_number)))
    merged = prs[prs.payload_action == "merged"]
    assert summary["merged_prs"] == len(set(zip(merged.repo_name, merged.pr_number)))
    pushes = local[local.event_type == "PushEvent"]
    counts = Counter(pushes.actor_login)
    got = rows(rhythm.push_per_actor(skewed))[0]
    assert got["total_push_actors"] == len(counts)
    assert got["actors_gt_1000_pushes"] == sum(n > 1000 for n in counts.values())


def test_exact_quartiles(skewed, local):
    ratios = []
    for _, g in local.groupby("repo_name"):
        pushes = (g.event_type == "PushEvent").sum()
        if pushes >= 10:
            ratios.append(g[g.event_type == "PullRequestEvent"].pr_number.nunique() / pushes)
    ratios.sort()
    got = rows(eras.pr_push_quartiles(skewed))[0]
    for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        assert got[f"{name}_pr_push_ratio"] == ratios[math.ceil(p * len(ratios)) - 1]


def test_copies_of_one_event_do_not_reach_one_task(spark, skewed):
    copies = skewed.withColumn("event_id", F.when(F.col("repo_name") == "hot", "same").otherwise(F.col("event_id")))
    single = cleaning.dedupe(copies.repartition(8), "event_id", [F.col("event_date")])
    assert single.count() == N - N // 3 + 1
    single.collect()
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning(event_id")[1]
