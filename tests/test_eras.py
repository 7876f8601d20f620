import math

from frames import pr, push, rows, star

from vitals.functions import columns as C
from vitals.operators import eras, rhythm

# Published totals: era -> (merged, distinct pull requests, merge rate in percent). Fixed values.
PUBLISHED_MERGES = {"2022-Q1": (135134, 141919, 95.22), "2025-Q1": (236555, 366134, 64.61)}
# Published totals: era -> (one-commit pushes, pushes, share in percent). Fixed values.
PUBLISHED_PUSHES = {"2022-Q1": (127275548, 146374582, 86.95), "2025-Q1": (293779042, 313568297, 93.69)}
# Published totals: era -> (weekday events, weekend events, weekend percent). Fixed values.
PUBLISHED_WEEKENDS = {"2022-Q1": (153486438, 53276974, 25.77), "2023-Q1": (188619748, 58760292, 23.75)}


def test_era_summary_with_both_layouts_and_scopes(spark, events_of):
    ev = events_of(
        [
            pr("a", 1, "opened"), pr("a", 1, "closed", True), pr("b", 1, "closed", None), pr("b", 2, "merged"),
            pr("b", 2, "closed", True), pr("b", None, "opened"), push("a", "x", 1), push("a", "y", 3),
            push("a", "y", None), star("c"), star("c", era="2026-Q1"),
        ]
    )
    got = {r["era"]: r for r in rows(eras.era_summary(ev, exact=True))}
    one = got["2025-Q1"]
    assert (one["total_events"], one["distinct_repos"], one["distinct_actors"]) == (10, 3, 3)
    assert (one["total_pushes"], one["total_pr_events"], one["total_stars"]) == (3, 6, 1)
    assert (one["distinct_prs"], one["merged_prs"]) == (3, 2)
    assert (one["avg_commit_size"], one["median_commit_size"]) == (2.0, 1)
    assert (got["2026-Q1"]["distinct_prs"], got["2026-Q1"]["merged_prs"]) == (0, 0)
    assert got["2026-Q1"]["avg_commit_size"] is None
    bare = {r["era"]: r for r in rows(eras.era_summary(ev, exact=True, scope="number"))}["2025-Q1"]
    assert (bare["distinct_prs"], bare["merged_prs"]) == (2, 2)
    approx = {r["era"]: r for r in rows(eras.era_summary(ev))}["2025-Q1"]
    assert (approx["distinct_repos"], approx["distinct_actors"]) == (3, 3)


def test_buckets_add_up_and_unmeasured_eras_stay_null(spark, events_of):
    sizes = [0, 1, 1, 2, 5, 6, 20, 21, None]
    ev = events_of([push("a", "x", s) for s in sizes] + [push("a", "x", None, era="2026-Q1")])
    got = {r["era"]: r for r in rows(eras.push_size_distribution(ev))}
    buckets = ["commits_eq_0", "commits_eq_1", "commits_2_5", "commits_6_20", "commits_gt_20"]
    assert [got["2025-Q1"][b] for b in buckets] == [1, 2, 2, 2, 1]
    assert got["2025-Q1"]["total_push_events"] == 8
    assert [got["2026-Q1"][b] for b in buckets] == [None] * 5
    assert got["2026-Q1"]["total_push_events"] == 0
    share = {r["era"]: r["pct"] for r in rows(eras.one_commit_share(eras.push_size_distribution(ev)))}
    assert share == {"2025-Q1": 25.0, "2026-Q1": None}


def test_pr_push_ratio_only_for_busy_repos(spark, events_of):
    ev = events_of(
        [push("a", f"u{i}") for i in range(10)]
        + [pr("a", n, "opened", actor="v") for n in (1, 2, 2)]
        + [push("b", "x") for _ in range(20)]
        + [push("c", "x") for _ in range(9)]
    )
    got = rows(eras.pr_push_ratio(ev))[0]
    assert got["repo_count"] == 2
    assert (got["p25_pr_push_ratio"], got["p75_pr_push_ratio"]) == (0.0, 0.2)
    assert math.isclose(got["avg_pr_push_ratio"], 0.1)
    assert got["avg_contributors_per_repo"] == 6.0
    exact = rows(eras.pr_push_quartiles(ev))[0]
    assert all(exact[k] == got[k] for k in exact)
    assert rows(eras.pr_push_ratio(ev, min_pushes=9))[0]["repo_count"] == 3


def test_active_repos(spark, events_of):
    ev = events_of([star("a", "x"), star("a", "y"), star("b", "x"), star("a", "x", ts="2025-02-01 00:00:00")])
    got = {r["month"]: r for r in rows(eras.active_repos_monthly(ev))}
    assert (got["2025-01"]["active_repos"], got["2025-01"]["active_actors"], got["2025-01"]["total_events"]) == (2, 2, 3)
    assert got["2025-02"]["active_repos"] == 1


def test_published_rates(spark):
    summary = spark.createDataFrame(
        [(e, m, n) for e, (m, n, _) in PUBLISHED_MERGES.items()], "era string, merged_prs long, distinct_prs long"
    )
    for r in rows(eras.pr_merge_rate(summary)):
        assert round(r["pct"], 2) == PUBLISHED_MERGES[r["era"]][2]
    sizes = spark.createDataFrame(
        [(e, m, n) for e, (m, n, _) in PUBLISHED_PUSHES.items()],
        "era string, commits_eq_1 long, total_push_events long",
    )
    for r in rows(eras.one_commit_share(sizes)):
        assert round(r["pct"], 2) == PUBLISHED_PUSHES[r["era"]][2]
    weekends = spark.createDataFrame(
        [(e, w, n) for e, (a, b, _) in PUBLISHED_WEEKENDS.items() for w, n in ((False, a), (True, b))],
        "era string, is_weekend boolean, events long",
    )
    for r in rows(rhythm.weekend_share(weekends)):
        assert round(r["weekend_pct"], 2) == PUBLISHED_WEEKENDS[r["era"]][2]


def test_era_delta(spark):
    wide = spark.createDataFrame([("a", 100, 5), ("b", 150, 0), ("c", 75, 10)], "era string, x long, y long")
    got = {(r["metric"], r["era"]): (r["pct_prev"], r["pct_first"]) for r in rows(eras.era_delta(wide, ["x", "y"]))}
    assert got[("x", "a")] == (None, 0.0)
    assert got[("x", "b")] == (50.0, 50.0)
    assert got[("x", "c")] == (-50.0, -25.0)
    assert got[("y", "c")] == (None, 100.0)  # no change in percent from zero


def test_era_labels(spark, events_of):
    ev = events_of([star("a"), star("a", ts="2025-05-01 00:00:00")]).drop("era")
    ranges = [("2025-Q1", "2025-01-01", "2025-03-31"), ("2026-Q1", "2026-01-01", "2026-03-31")]
    assert [r["era"] for r in rows(eras.with_era(ev, eras.era_of_ranges(ranges)))] == ["2025-Q1"]
    got = sorted(r["era"] for r in rows(eras.with_era(ev, C.quarter_era("event_date"))))
    assert got == ["2025-Q1", "2025-Q2"]


def test_merge_eras_keeps_types_and_fills_gaps(spark):
    a = spark.createDataFrame([("2026", 1)], "era string, x long")
    b = spark.createDataFrame([("2025", 0.5)], "era string, y double")
    merged = eras.merge_eras([a, b])
    assert merged.dtypes == [("era", "string"), ("x", "bigint"), ("y", "double")]
    assert [r.era for r in merged.collect()] == ["2025", "2026"]


def test_type_counts_per_era(spark, events_of):
    got = rows(eras.era_type_counts(events_of([star("a"), push("a", "x")]), ["WatchEvent", "PushEvent", "ForkEvent"]))[0]
    assert (got["WatchEvent"], got["PushEvent"], got["ForkEvent"]) == (1, 1, None)


def test_rhythm(spark, events_of):
    ev = events_of(
        [push("a", "x", ts="2025-01-04 01:00:00"), push("b", "x", ts="2025-01-06 01:00:00"), star("a", ts="2025-01-06 02:00:00")]
    )
    got = {r["is_weekend"]: r for r in rows(rhythm.weekday_weekend(ev))}
    assert (got[True]["events"], got[False]["events"], got[False]["actors"], got[False]["repos"]) == (1, 2, 2, 2)
    assert len(rows(rhythm.weekday_weekend(ev, by_type=True))) == 3
    both = rows(rhythm.weekend_share_with_baseline(ev))[0]
    assert math.isclose(both["weekend_pct"], 100 / 3) and both["baseline_pct"] == 50.0


def test_push_cohorts(spark, events_of):
    ev = events_of(
        [push("a", "bot") for _ in range(101)]
        + [push("a", "dev", ts=f"2025-01-0{d} 00:00:00") for d in (6, 7)]
        + [push("b", "dev", ts="2025-01-07 00:00:00")]
    )
    got = rows(rhythm.push_per_actor(ev))[0]
    assert (got["total_push_actors"], got["avg_pushes"], got["median_pushes"], got["p99_pushes"]) == (2, 52.0, 3, 101)
    assert (got["actors_gt_100_pushes"], got["actors_gt_1000_pushes"], got["actors_gt_50_per_day"]) == (1, 0, 1)
    assert (got["median_pushes_per_day"], got["avg_active_days"], got["avg_repos_per_actor"]) == (1.5, 1.5, 1.5)
