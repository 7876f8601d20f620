import random

from frames import pr, push, rows, star

from vitals.operators import activity, joins, risk
from vitals.operators.activity import bus_factor


def seed_of(spark, *names):
    return spark.createDataFrame(
        [(n, "c", None) for n in names], "repo string, category string, hf_library string"
    )


def test_daily_metrics_only_for_curated_repos(spark, events_of):
    ev = events_of([star("a/b"), star("a/b", "z"), push("a/b", "z"), push("c/d", "z"), push(None, "z")])
    got = rows(activity.repo_daily_metrics(ev, seed_of(spark, "A/B", "a/b")))
    assert len(got) == 1
    assert (got[0]["stars"], got[0]["pushes"], got[0]["distinct_actors"], got[0]["total_events"]) == (2, 1, 2, 3)


def test_yearly_adds_daily_actors(spark, events_of):
    ev = events_of([push("a/b", "z"), push("a/b", "z", ts="2025-01-07 01:00:00")])
    got = rows(activity.repo_yearly(activity.repo_daily_metrics(ev, seed_of(spark, "a/b"))))[0]
    assert (got["gh_actors_2025"], got["gh_active_days"], got["gh_pushes_2025"]) == (2, 2, 2)


def test_top_repos_ties_and_excluded_days(spark, events_of):
    ev = events_of([star("b"), star("a"), star("c"), star("c"), star("d", ts="2025-01-09 00:00:00")])
    got = [r.repo_name for r in activity.top_repos(ev, 2, exclude=["2025-01-09"]).collect()]
    assert got == ["c", "a"]


def test_label_and_summary(spark, events_of):
    top = activity.top_repos(events_of([star("a"), star("b"), star("b")]))
    labelled = joins.label_ai(top, seed_of(spark, "B", "B"))
    assert {r["repo_name"]: r["is_ai"] for r in rows(labelled)} == {"a": False, "b": True}
    got = {r["is_ai"]: r for r in rows(activity.group_summary(labelled, medians=True))}
    assert got[True]["avg_stars"] == 2.0 and got[True]["median_stars"] == 2


def test_burst_uses_active_months_only(spark, events_of):
    data = [star("a", ts="2025-01-03 00:00:00")] * 6 + [star("a", ts="2025-03-03 00:00:00")] * 2
    data += [push("a", "z", ts="2025-02-01 00:00:00"), star("b", ts="2025-05-01 00:00:00")]
    ev = events_of(data)
    got = {r["repo_name"]: r for r in rows(activity.star_growth_hype(ev, activity.top_repos(ev), seed_of(spark, "a")))}
    a = got["a"]
    assert (a["total_stars"], a["avg_monthly_stars"], a["peak_stars"], a["months_active"]) == (8, 4.0, 6, 2)
    assert a["peak_ratio"] == 6 / 5 and a["peak_month"] == "2025-01" and a["is_ai"]
    assert not got["b"]["is_ai"]


def test_contributor_health(spark, events_of):
    ev = events_of(
        [push("a", "x")] * 3
        + [push("a", "y"), push("a", None), star("a", "w"), star("b", "w")]
        + [pr("a", 1, "opened", actor="x"), pr("a", 1, "closed", actor="v")]
    )
    top = activity.top_repos(ev)
    got = {r["repo_name"]: r for r in rows(activity.contributor_health(ev, top, seed_of(spark, "a")))}
    a, b = got["a"], got["b"]
    assert (a["total_contributors"], a["total_pushes"], a["push_contributors"]) == (4, 5, 2)
    assert (a["top1_pushes"], a["top1_push_ratio"], a["pr_contributors"]) == (3, 0.5, 2)
    assert (b["total_pushes"], b["push_contributors"], b["pr_contributors"]) == (None, None, None)
    opened = activity.contributor_health(ev, top, seed_of(spark, "a"), opened_only=True)
    assert {r["repo_name"]: r["pr_contributors"] for r in rows(opened)}["a"] == 1
    bands = {r["repo_name"]: r["band"] for r in rows(risk.risk_band(activity.contributor_health(ev, top, seed_of(spark, "a"))))}
    assert bands == {"a": "orange", "b": "gray"}


def test_top_pushers_keeps_ties(spark, events_of):
    ev = events_of([push("a", "x"), push("a", "y"), push("b", "x"), push("b", "x"), push("b", "y")])
    got = {(r["repo_name"], r["actor_login"]) for r in rows(activity.top_pushers(ev))}
    assert got == {("a", "x"), ("a", "y"), ("b", "x")}


def test_bus_factor_against_brute_force(spark, events_of):
    r = random.Random(3)
    counts = {(f"r{i}", f"a{j}"): r.choice([1, 1, 2, 5, 30]) for i in range(6) for j in range(r.randint(1, 12))}
    ev = events_of([push(repo, actor) for (repo, actor), n in counts.items() for _ in range(n)])
    for share in (0.5, 0.8, 1.0):
        expected = {}
        for repo in {k[0] for k in counts}:
            mine = sorted((n for (x, _), n in counts.items() if x == repo), reverse=True)
            total, running, k = sum(mine), 0, 0
            while running * 1000 < round(share * 1000) * total:
                running, k = running + mine[k], k + 1
            expected[repo] = k
        assert {x["repo_name"]: x["bus_factor"] for x in rows(bus_factor(ev, share))} == expected


def test_derived_risk_tables(spark):
    health = spark.createDataFrame(
        [("team", 100, 40, 0.1, 300), ("merger", 100, 40, 0.9, 300), ("solo", 50, 9, 0.9, 3), ("crowd", 999, 2, 0.9, 1),
         ("none", 5, None, None, None)],
        "repo_name string, total_contributors long, push_contributors long, top1_push_ratio double, pr_contributors long",
    )
    got = {r["repo_name"]: r["pattern"] for r in rows(risk.contributor_risk_pattern(health))}
    assert got == {
        "team": "healthy", "merger": "concentrated merge", "solo": "single point",
        "crowd": "audience only", "none": "audience only",
    }
    shares = {r["repo_name"]: r["share"] for r in rows(risk.builder_share(health))}
    assert shares["team"] == 0.4 and shares["none"] == 0.0
    hype = spark.createDataFrame(
        [("o/a", True, 12.0, 5, 10), ("o/b", True, 4.0, 1, 10), ("p/c", False, 1.0, 1, 1)],
        "repo_name string, is_ai boolean, peak_ratio double, peak_stars long, total_stars long",
    )
    rate = {r["is_ai"]: r for r in rows(risk.hype_rate(hype))}
    assert (rate[True]["pct_burst"], rate[True]["pct_extreme"], rate[True]["avg_peak_ratio"]) == (100.0, 50.0, 8.0)
    assert {r["owner"]: r["repos"] for r in rows(risk.owner_hype(hype))} == {"o": 2, "p": 1}
    assert {r["repo_name"]: r["share"] for r in rows(risk.peak_month_share(hype))}["o/a"] == 0.5
