import json
import os

import pytest
from frames import rows, star
from pyspark.sql import functions as F

from vitals.operators import deepdive
from vitals.operators.cleaning import clean_events
from vitals.plans import jobs
from vitals.plans import testdata as data
from vitals.session import shared_folder
from vitals.sources import readers, writers
from vitals.streaming import daily

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed") / "raw")
    lines = data.raw_event_lines(spark, SF)
    lines.repartition(4).write.option("compression", "gzip").text(folder)
    return folder


@pytest.fixture(scope="module")
def cleaned(spark, raw_folder, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    jobs.clean_events_job(spark, raw_folder, f"{folder}/events", sample_path=f"{folder}/sample")
    sample = spark.read.option("header", True).csv(f"{folder}/sample")
    assert sample.count() == 10 and sample.columns[0] == "event_id"
    events = spark.read.parquet(f"{folder}/events")
    return events.withColumn("era", data.week_era(F.col("event_date")))


def test_cleaning_job_matches_the_tables(spark, cleaned):
    expected = data.activity(spark, SF).withColumn("event_ts", F.date_trunc("second", "event_ts"))
    assert rows(cleaned.select(*expected.columns), "event_id") == rows(expected, "event_id")


def test_rerun_of_the_cleaning_job_changes_nothing(spark, raw_folder, tmp_path):
    first = jobs.clean_events_job(spark, raw_folder, str(tmp_path / "e")).count()
    assert jobs.clean_events_job(spark, raw_folder, str(tmp_path / "e")).count() == first


def test_scoring_chain(spark, cleaned, tmp_path):
    models = jobs.clean_models_job(spark, _stored_models(spark, tmp_path), str(tmp_path / "models"), "parquet", str(tmp_path / "ms"))
    seed, packages = data.seed(spark, SF), data.package_downloads(spark, SF)
    scored = jobs.scoring_job(cleaned, models, seed, packages, str(tmp_path / "out"))
    from vitals.plans.queries import queries

    direct = queries()["health_score"](spark, SF)
    assert scored.count() == direct.count()
    a = [round(r["health_score"], 6) for r in rows(scored, "repo_name")]
    assert a == [r["health_score"] for r in rows(direct, "repo_name")]
    csv = spark.read.option("header", True).csv(str(tmp_path / "out/health_score_csv"))
    values = [float(r.health_score) for r in csv.collect()]
    assert values == sorted(values, reverse=True)


def test_batches_of_one_day_add_up(spark, tmp_path):
    def event(i, hour):
        return json.dumps({"id": str(i), "type": "PushEvent", "created_at": f"2025-01-01T{hour:02}:00:00Z",
                           "repo": {"name": "a/b"}, "actor": {"login": "x"}})

    for name, lines in {"b0": [event(1, 0), event(2, 0)], "b1": [event(2, 0), event(3, 1)]}.items():
        (tmp_path / name).write_text("\n".join(lines))
    target = str(tmp_path / "events")
    assert jobs.add_events_job(spark, str(tmp_path / "b0"), target).count() == 2
    for _ in range(2):
        ids = [r.event_id for r in jobs.add_events_job(spark, str(tmp_path / "b1"), target).collect()]
        assert sorted(ids) == ["1", "2", "3"]


def _stored_models(spark, tmp_path):
    path = str(tmp_path / "raw_models")
    data.raw_models(spark, SF).write.parquet(path)
    return path


def test_top_repo_job(spark, cleaned, tmp_path):
    path = str(tmp_path / "events")
    cleaned.drop("era").write.partitionBy("event_date").parquet(path)
    top = jobs.top_repo_job(
        spark, path, data.seed(spark, SF), str(tmp_path / "top"), table="no_such_table",
        supplement=str(tmp_path / "none"), exclude=["2024-01-06"], k=20,
    )
    assert top.count() == 20
    for name in ("ai_vs_general", "star_growth_hype", "contributor_health"):
        assert spark.read.parquet(str(tmp_path / "top" / name)).count() == 20
        assert os.path.isdir(tmp_path / "top" / f"{name}_csv")


def test_era_job_is_incremental(spark, cleaned, tmp_path):
    folder = str(tmp_path / "eras")
    jobs.era_job(cleaned.filter("era < 'W3'"), folder)
    merged = jobs.era_job(cleaned.filter("era >= 'W3'"), folder)
    whole = jobs.era_job(cleaned, str(tmp_path / "whole"))
    for name, table in merged.items():
        order = [c for c in ("era", "month", "is_weekend", "event_type") if c in table.columns]
        assert rows(table, *order) == rows(whole[name], *order), name


def test_deepdive_job(spark, cleaned, tmp_path):
    from vitals.operators import activity

    jobs.deepdive_job(cleaned, activity.top_repos(cleaned), data.seed(spark, SF), str(tmp_path / "d"), k=5)
    flow = spark.read.option("header", True).csv(str(tmp_path / "d/contributor_flow_csv"))
    assert flow.count() > 0
    assert len([d for d in os.listdir(tmp_path / "d") if d.endswith("_csv")]) == 9
    assert flow.count() == spark.read.parquet(str(tmp_path / "d/contributor_flow")).count()
    assert shared_files(spark, "target_events") == []


def shared_files(spark, name):
    return [f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith(f"{name}-")]


def test_scratch_is_deleted_also_after_an_error(spark):
    with writers.Scratch(spark) as scratch:
        assert scratch.stored(spark.range(5), "scratch").count() == 5
        assert len(shared_files(spark, "scratch")) == 1
    assert shared_files(spark, "scratch") == []
    with pytest.raises(ZeroDivisionError), writers.Scratch(spark) as scratch:
        scratch.stored(spark.range(5), "scratch")
        1 / 0
    assert shared_files(spark, "scratch") == []


def test_contributors_of_batches_equal_one_run(spark, events_of, tmp_path):
    targets = spark.createDataFrame([("a", True), ("b", False)], "repo_name string, is_ai boolean")
    days = ["2025-01-06", "2025-01-20", "2025-02-03", "2025-02-20", "2025-04-01"]
    made = [
        star(repo, actor, f"{day} 10:00:00", era)
        for k, day in enumerate(days)
        for repo in "abc"
        for j, actor in enumerate(["x", "y", "z", None])
        if (k + j) % 3 or actor is None
        for era in [None if repo == "b" and k == 4 else "2025-Q1" if k < 4 else "2025-Q2"]
    ]
    whole, path = events_of(made), str(tmp_path / "state")
    order = ["era", "repo_name", "month", "contributor_type"]
    expected = rows(deepdive.contributor_flow(whole, targets), *order)
    batches = [whole.filter(F.col("event_date") == day) for day in ("2030-01-01", days[2], days[0], days[3], days[4], days[1], days[4])]
    for batch in batches:
        flow = jobs.add_contributors_job(batch, targets, path)
    assert rows(flow, *order) == expected
    assert {"new", "returning"} <= {r["contributor_type"] for r in expected}
    # The label is not part of the state, and a repository may become a target later.
    others = spark.createDataFrame([("a", False), ("c", True)], "repo_name string, is_ai boolean")
    flow = jobs.add_contributors_job(batches[0], others, path)
    assert rows(flow, *order) == rows(deepdive.contributor_flow(whole, others), *order)
    assert shared_files(spark, "contributors") == []


def test_a_batch_reads_only_the_eras_it_touches(spark, events_of, tmp_path):
    path = str(tmp_path / "state")
    targets = spark.createDataFrame([("a", True)], "repo_name string, is_ai boolean")
    for era, day in (("2025-Q1", "2025-01-06"), ("2025-Q2", "2025-04-06")):
        jobs.add_contributors_job(events_of([star("a", "x", f"{day} 10:00:00", era)]), targets, path)
    first = sorted(os.listdir(tmp_path / "state/era=2025-Q1"))
    jobs.add_contributors_job(events_of([star("a", "y", "2025-04-07 10:00:00", "2025-Q2")]), targets, path)
    assert sorted(os.listdir(tmp_path / "state/era=2025-Q1")) == first


def test_profile_compare_and_pivot_jobs(spark, cleaned, raw_folder, tmp_path):
    jobs.profile_job(readers.read_events(spark, raw_folder), str(tmp_path / "raw"), "events")
    jobs.profile_job(cleaned, str(tmp_path / "clean"), "events")
    jobs.profile_job(data.raw_models(spark, SF), str(tmp_path / "models"), "models")
    assert len(os.listdir(tmp_path / "models")) == 7
    jobs.compare_job(cleaned, cleaned.filter("event_type <> 'ForkEvent'"), str(tmp_path / "cmp"))
    assert sorted(os.listdir(tmp_path / "cmp")) == ["by_day", "by_type", "schema", "totals"]
    pivot = jobs.package_pivot(data.package_downloads(spark, SF), 3)
    assert len(pivot.columns) == 4


def test_hub_ingest_and_model_eda_jobs(spark, tmp_path):
    data.hub_lines(spark, SF).write.text(str(tmp_path / "lines"))
    jobs.ingest_hub_records_job(spark, str(tmp_path / "lines"), str(tmp_path / "m"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == spark.read.parquet(f"{SF}/part.parquet").count()
    assert "metric_value" in spark.read.parquet(str(tmp_path / "r")).columns
    models = jobs.clean_models_job(spark, _stored_models(spark, tmp_path), str(tmp_path / "c"), "parquet")
    jobs.models_eda_job(models, str(tmp_path / "eda"), "2024-07-01")
    assert len(os.listdir(tmp_path / "eda")) == 13


def test_stream_equals_batch_on_closed_days(spark, raw_folder, tmp_path):
    from vitals.functions.aggregates import type_counts

    # A last event far past the watermark closes every day of the data.
    flush = {"id": "flush", "type": "WatchEvent", "created_at": "2024-06-01T00:00:00Z",
             "actor": {"login": "z"}, "repo": {"name": "z/z"}}
    feed, late = tmp_path / "feed", tmp_path / "late"
    data.raw_event_lines(spark, SF).write.text(str(feed))
    daily.write_stream(
        daily.stream_clean_events(daily.stream_raw_events(spark, str(feed))), str(tmp_path / "clean"), str(tmp_path / "c1")
    ).awaitTermination(120)
    batch = clean_events(readers.read_events(spark, str(feed)))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == batch.count()

    late.mkdir()
    (feed / "zz-flush.txt").write_text(json.dumps(flush) + "\n")
    days = daily.stream_repo_days(daily.stream_clean_events(daily.stream_raw_events(spark, str(feed), 1)))
    daily.write_stream(days, str(tmp_path / "days"), str(tmp_path / "c2")).awaitTermination(120)
    expected = batch.groupBy("repo_name", "event_date").agg(
        *type_counts(), F.approx_count_distinct("actor_login", 0.01).alias("distinct_actors"),
        F.count("event_id").alias("total_events"),
    )
    got = spark.read.parquet(str(tmp_path / "days")).filter("repo_name <> 'z/z'")
    assert rows(got.select(*expected.columns), "repo_name", "event_date") == rows(expected, "repo_name", "event_date")
