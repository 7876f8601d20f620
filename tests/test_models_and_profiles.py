from brute import pearson
from frames import push, rows, star

from vitals.operators import joins, models, profiling, quality

MODEL = (
    "model_id string, owner string, author string, pipeline_tag string, library_name string, license string, "
    "downloads long, likes long, parameter_count long, gated string, created_ts string, last_modified_ts string"
)


def models_of(spark, *data):
    names = [p.split()[0] for p in MODEL.split(", ")]
    df = spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], MODEL)
    return df.withColumns(
        {c: df[c].cast("timestamp") for c in ("created_ts", "last_modified_ts")}
    )


def counts(df, key):
    return {r[key]: r["count"] for r in rows(df)}


def test_buckets(spark):
    sizes = [None, 0, 1, 100, 101, 10_000, 10_001, 1_000_000, 1_000_001]
    df = models_of(spark, *[dict(downloads=d) for d in sizes])
    assert counts(models.downloads_distribution(df), "bucket") == {
        "unknown": 1, "0": 1, "1-100": 2, "101-10K": 2, "10K-1M": 2, "1M+": 1,
    }
    b = 1_000_000_000
    df = models_of(spark, *[dict(parameter_count=p) for p in (None, b - 1, b, 7 * b, 13 * b, 70 * b)])
    assert counts(models.parameter_distribution(df), "param_bucket") == {
        "unknown": 1, "<1B": 1, "1-7B": 1, "7-13B": 1, "13-70B": 1, "70B+": 1,
    }
    owners = [dict(owner=f"o{i}") for i in range(3)] + [dict(owner="big")] * 5 + [dict(owner="huge")] * 101
    assert counts(models.owner_model_count_distribution(models_of(spark, *owners)), "models_per_owner") == {
        "1": 3, "2-5": 1, "100+": 1,
    }


def test_staleness_on_a_given_day(spark):
    days = ["2025-01-31 10:00:00", "2025-01-01 00:00:00", "2024-11-02 00:00:00", "2024-02-01 00:00:00", "2020-01-01 00:00:00", None]
    df = models_of(spark, *[dict(last_modified_ts=d) for d in days])
    assert counts(models.staleness_distribution(df, "2025-01-31"), "staleness") == {
        "<30 days": 2, "30-90 days": 1, "90-365 days": 1, ">1 year": 1, "unknown": 1,
    }


def test_group_tables(spark):
    df = models_of(
        spark,
        dict(owner="a", pipeline_tag="t", library_name="l", license="mit", downloads=10, likes=1, gated=None, created_ts="2025-01-03 00:00:00"),
        dict(owner="a", pipeline_tag="t", library_name="m", license="mit", downloads=5, likes=2, gated="False", created_ts="2025-01-09 00:00:00"),
        dict(owner="b", pipeline_tag="u", library_name="l", license="x", downloads=99, likes=4, gated="auto"),
    )
    tags = {r["pipeline_tag"]: r for r in rows(models.pipeline_tag_stats(df))}
    assert (tags["t"]["model_count"], tags["t"]["total_downloads"], tags["t"]["avg_downloads"], tags["t"]["avg_likes"]) == (2, 15, 7.5, 1.5)
    assert {r["library_name"]: r["model_count"] for r in rows(models.library_stats(df))} == {"l": 2, "m": 1}
    assert {r["license"]: r["total_downloads"] for r in rows(models.license_stats(df))} == {"mit": 15, "x": 99}
    assert [(str(r["month"]), r["new_models"]) for r in rows(models.monthly_creation_trend(df))] == [("2025-01-01", 2)]
    assert [r["owner"] for r in rows(models.owner_concentration(df, 1))] == ["b"]
    gated = {r["is_gated"]: r["model_count"] for r in rows(models.gated_stats(df))}
    assert gated == {"non-gated": 2, "gated": 1}
    p = {r["metric"]: r["value"] for r in rows(models.downloads_percentiles(df))}
    assert (p["downloads_p25"], p["downloads_p50"], p["downloads_p99"]) == (5, 10, 99)
    assert rows(models.downloads_likes_correlation(df))[0]["value"] == round(pearson([10, 5, 99], [1, 2, 4]), 4)
    assert len(models.models_eda(df, "2025-01-31")) == 13


def test_event_profile_of_both_layouts(spark, events_of):
    flat = events_of([push("a", "x"), star("a", "y"), star(None, None)])
    raw = spark.sql(
        "SELECT '1' id, 'PushEvent' type, '2025-01-06T10:00:00Z' created_at, named_struct('login','X') actor, "
        "named_struct('name','A') repo, named_struct('action', CAST(NULL AS STRING)) payload"
    )
    metrics = {r["metric"]: r["value"] for r in rows(profiling.events_summary(flat))}
    assert (metrics["total_rows"], metrics["distinct_repositories"], metrics["distinct_actors"]) == ("3", "2", "3")
    assert metrics["min_event_timestamp"] == "2025-01-06 10:00:00"
    metrics = {r["metric"]: r["value"] for r in rows(profiling.events_summary(raw))}
    assert (metrics["total_columns"], metrics["distinct_actors"], metrics["max_event_timestamp"]) == ("7", "1", "2025-01-06 10:00:00")
    nulls = {r["metric"]: r["value"] for r in rows(profiling.events_null_counts(raw))}
    assert (nulls["payload_action_nulls"], nulls["repo_name_nulls"]) == ("1", "0")
    for df in (flat, raw):
        tables = profiling.profile_events(df)
        assert tables["sample"].columns == ["id", "event_type", "created_at_or_event_ts", "actor_login", "repo_name"]
        assert all(t.count() for t in tables.values())
    assert rows(profiling.top_active_repos(flat)) == [{"repo_name": "a", "count": 2}]
    assert [r["hour"] for r in rows(profiling.events_per_hour(raw))] == [10]
    assert rows(profiling.distinct_repos_actors(flat)) == [{"repos": 1, "actors": 2}]


def test_exploration_of_raw_events(spark):
    raw = spark.createDataFrame([("PushEvent",), ("PushEvent",), ("CreateEvent",), (None,)], "type string")
    got = {r["event_type"]: r for r in rows(profiling.core_event_share(raw))}
    assert (got["PushEvent"]["count"], got["PushEvent"]["is_core"], got["PushEvent"]["core_pct"]) == (2, True, 50.0)
    assert got["CreateEvent"]["is_core"] is False and got[None]["is_core"] is False
    report = rows(profiling.null_report(raw))
    assert report == [{"column": "type", "null_count": 1, "null_pct": 25.0}]


def test_model_profile_of_both_layouts(spark):
    raw = spark.sql(
        "SELECT 'a/b' modelId, 'A' author, CAST(NULL AS STRING) pipeline_tag, 'l' library_name, 5L downloads, 2L likes, "
        "'2025' lastModified, named_struct('license', CAST(NULL AS STRING), 'datasets', array('d')) card_data"
    )
    nulls = {r["metric"]: r["value"] for r in rows(profiling.models_null_counts(raw))}
    assert (nulls["license_nulls"], nulls["datasets_nulls"], nulls["pipeline_tag_nulls"]) == ("1", "0", "1")
    assert "created_ts_nulls" not in nulls
    assert rows(profiling.pipeline_tag_distribution(raw)) == [{"pipeline_tag": "(null)", "count": 1}]
    clean = models_of(spark, dict(model_id="a/b", owner="a", author=None, downloads=1, likes=1), dict(model_id="a/c", owner="a", author="z", downloads=None))
    metrics = {r["metric"]: r["value"] for r in rows(profiling.models_summary(clean))}
    assert (metrics["distinct_authors"], metrics["avg_downloads"], metrics["median_downloads"]) == ("2", "1.00", "1")
    assert [r["model_id"] for r in rows(profiling.top_downloads(clean))] == ["a/b"]
    assert rows(profiling.top_authors(clean)) == [{"author": "z", "count": 1}]
    assert rows(profiling.top_authors(clean.drop("author"))) == [{"author": "a", "count": 2}]
    for df in (raw, clean):
        assert all(t.count() for t in profiling.profile_models(df).values())


def test_packages(spark):
    df = spark.createDataFrame(
        [("p", "2025-01-01", 10), ("p", "2025-12-01", 15), ("q", "2025-01-01", 4), ("q", "2025-02-01", 1), ("z", "2025-01-01", 0)],
        "project string, month string, downloads long",
    )
    assert {r["project"]: r["downloads"] for r in rows(profiling.package_totals(df))} == {"p": 25, "q": 5, "z": 0}
    growth = {r["project"]: r["growth_pct"] for r in rows(profiling.package_growth_pct(df))}
    assert growth == {"p": 50.0, "q": -75.0, "z": None}
    pivot = {r["month"]: r for r in rows(profiling.package_monthly_pivot(df, ["p", "q"]))}
    assert (pivot["2025-01-01"]["p"], pivot["2025-01-01"]["q"], pivot["2025-12-01"]["q"]) == (10, 4, None)
    assert {r["project"] for r in rows(profiling.package_monthly_top(df, 2))} == {"p", "q"}


def test_era_quality(spark, events_of):
    ev = events_of([push("a", "x"), push("a", "x", None), star(None, "y", ts="2025-01-07 00:00:00")])
    got = rows(quality.era_quality(ev))[0]
    assert (got["total_events"], got["distinct_days"], got["avg_events_per_day"]) == (3, 2, 2)
    assert (got["push_events"], got["watch_events"], got["null_repo_name"], got["null_push_distinct_size"]) == (2, 1, 1, 2)
    assert (got["flag_pr_merged"], got["flag_push_distinct_size"]) == ("ISSUE", "ISSUE")
    missing = rows(quality.era_quality(ev.drop("pr_merged")))[0]
    assert (missing["null_pr_merged"], missing["flag_pr_merged"]) == (None, "MISSING")
    calm = rows(quality.era_quality(ev, null_flag_pct=90))[0]
    assert calm["flag_push_distinct_size"] == "OK"


def test_comparison_of_two_versions(spark, events_of):
    new = events_of([push("a", "x"), push("a", "x"), star("a")])
    old = events_of([push("a", "x"), push("a", "x", ts="2025-01-07 00:00:00")])
    by_type = {r["event_type"]: r for r in rows(quality.compare_by_type(new, old))}
    assert (by_type["PushEvent"]["diff"], by_type["WatchEvent"]["old_count"], by_type["WatchEvent"]["diff"]) == (0, None, 1)
    by_day = {str(r["event_date"]): r for r in rows(quality.compare_by_day(new, old))}
    assert (by_day["2025-01-06"]["diff_pct"], by_day["2025-01-07"]["diff"]) == (200.0, -1)
    totals = {r["metric"]: r for r in rows(quality.compare_totals_nulls(new, old))}
    assert (totals["total_rows"]["diff"], totals["total_rows"]["diff_pct"]) == (1, 50.0)
    assert totals["null_push_distinct_size"]["diff"] == 1
    diff = rows(joins.schema_difference(new.withColumn("extra", new.era), old.drop("pr_number")), "column")
    assert [(r["column"], r["new_type"], r["old_type"]) for r in diff] == [
        ("extra", "string", None),
        ("pr_number", "bigint", None),
    ]


def test_coverage(spark, events_of):
    ev = events_of([star("a", ts=f"2025-01-06 {h:02}:10:00") for h in range(24)] + [star("a", ts="2025-01-07 05:00:00")])
    got = {str(r["event_date"]): (r["hours_present"], r["complete"]) for r in rows(quality.hour_coverage(ev, "2025-01-05", "2025-01-07"))}
    assert got == {"2025-01-05": (0, False), "2025-01-06": (24, True), "2025-01-07": (1, False)}
    assert quality.missing_hours(ev, "2025-01-05", "2025-01-07").count() == 24 + 23
    assert [r["events"] for r in rows(quality.daily_counts(ev), "event_date")] == [24, 1]
    assert rows(quality.field_value_counts(ev, "event_type", "2025-01-07")) == [{"event_type": "WatchEvent", "count": 1}]
