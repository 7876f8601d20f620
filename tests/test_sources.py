import gzip
import json
import os

import pytest
from frames import push, rows, star
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vitals import schemas
from vitals.sources import dimensions, readers, writers


def gz(path, *records):
    with gzip.open(path, "wt") as f:
        f.write("".join(json.dumps(r) + "\n" for r in records))


def test_events_by_file_directory_month_and_glob(spark, tmp_path):
    for name in ("2025-01-01-0", "2025-01-31-23", "2025-02-01-0"):
        gz(tmp_path / f"{name}.json.gz", {"id": name, "type": "PushEvent"})
    assert readers.read_events(spark, str(tmp_path)).count() == 3
    assert readers.read_events(spark, f"{tmp_path}/2025-02-01-0.json.gz").count() == 1
    assert readers.read_events(spark, f"{tmp_path}/2025-01-*.json.gz").count() == 2
    assert readers.read_event_month(spark, str(tmp_path), "2025-01").count() == 2


def test_truncated_archive_is_tolerated_only_on_request(spark, tmp_path):
    gz(tmp_path / "good.json.gz", {"id": "1"})
    gz(tmp_path / "bad.json.gz", *[{"id": str(i), "type": os.urandom(40).hex()} for i in range(20000)])
    whole = (tmp_path / "bad.json.gz").read_bytes()
    (tmp_path / "bad.json.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        readers.read_events(spark, str(tmp_path)).count()
    kept = readers.read_events(spark, str(tmp_path), skip_corrupt_files=True)
    assert kept.count() >= 1
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"


def test_json_and_parquet_inputs_agree(spark, tmp_path):
    gz(tmp_path / "m.json.gz", {"modelId": "a/b", "likes": 1, "card_data": {"license": "mit"}})
    raw = readers.read_models(spark, str(tmp_path / "m.json.gz"))
    writers.write_raw(raw, str(tmp_path / "parquet"), 2)
    again = readers.read_models(spark, str(tmp_path / "parquet"), "parquet")
    assert again.dtypes == raw.dtypes and rows(again) == rows(raw)
    with pytest.raises(ValueError):
        readers.read_input(spark, str(tmp_path), "orc", schemas.RAW_MODEL)


def test_seed_is_one_json_array(spark, tmp_path):
    path = tmp_path / "seed.json"
    path.write_text('[\n {"repo": "A/B", "category": "x", "hf_library": "lib"},\n {"repo": "a/b", "category": "x", "hf_library": null}\n]\n')
    seed = readers.read_seed(spark, str(path))
    assert seed.count() == 2
    assert rows(dimensions.seed_repos(seed)) == [{"repo_name": "a/b"}]
    assert rows(dimensions.seed_libraries(seed)) == [{"library_name": "lib", "repo_name": "a/b", "category": "x"}]


def test_package_downloads_are_quoted_numbers(spark, tmp_path):
    gz(tmp_path / "p.json.gz", {"project": "p", "month": "2025-01-01", "downloads": "12"}, {"project": "p", "downloads": "x"})
    got = rows(readers.read_package_downloads(spark, str(tmp_path / "p.json.gz")))
    assert [r["downloads"] for r in got] == [12, None]


def test_csv_with_schema_and_curated_list(spark, tmp_path):
    (tmp_path / "a.csv").write_text("era,n\n2025-Q1,5\n")
    assert readers.read_csv(spark, str(tmp_path / "a.csv"), "era STRING, n BIGINT").dtypes[1] == ("n", "bigint")
    (tmp_path / "repos.csv").write_text("stars,repo_name\n1,Org/Repo\n")
    assert rows(readers.read_curated_repos(spark, str(tmp_path / "repos.csv"))) == [{"repo_name": "Org/Repo"}]
    with pytest.raises(ValueError):
        readers.read_curated_repos(spark, str(tmp_path / "a.csv"))


def test_events_partitioned_by_day_and_pruned(spark, events_of, tmp_path):
    path = str(tmp_path / "ev")
    days = [push("a", "x", ts=f"2025-01-0{d} 00:00:00") for d in (1, 2, 3)]
    writers.write_events(events_of(days), path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"event_date=2025-01-0{d}" for d in (1, 2, 3)]
    df = readers.read_clean_events(spark, path, lo="2025-01-02", exclude=["2025-01-03"]).filter("event_type = 'PushEvent'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: [")[1]
    assert "event_date" in filters.split("PushedFilters")[0]
    assert "EqualTo(event_type,PushEvent)" in filters
    assert df.count() == 1


def test_rewriting_days_replaces_only_them(spark, events_of, tmp_path):
    path = str(tmp_path / "ev")
    writers.write_events(events_of([push("a", "x", ts="2025-01-01 00:00:00"), push("a", "x", ts="2025-01-02 00:00:00")]), path)
    for _ in range(2):
        writers.write_events(events_of([push("b", "x", ts="2025-01-02 00:00:00")]), path)
    got = rows(spark.read.parquet(path), "event_date")
    assert [r["repo_name"] for r in got] == ["a", "b"]


def test_days_are_not_split_into_one_file_per_task(spark, events_of, tmp_path):
    many = events_of([push("a", f"u{i}", ts=f"2025-01-0{1 + i % 3} 00:00:00") for i in range(300)]).repartition(20)
    path = str(tmp_path / "ev")
    writers.write_events(many, path)
    files = [f for d in os.listdir(path) if "=" in d for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    assert len(files) == 3


def test_copy_range(spark, events_of, tmp_path):
    src = events_of([push("a", "x", ts=f"2025-01-0{d} 00:00:00") for d in (1, 2, 3)])
    writers.copy_range(src, str(tmp_path / "q"), "2025-01-02", "2025-01-03")
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_bucketed_table_needs_no_shuffle(spark, events_of):
    ev = events_of([push("a", "x"), push("b", "x"), star("a")])
    assert writers.write_bucketed(ev, "bucketed_events", 4) == 3
    table = readers.read_table_or_path(spark, "bucketed_events", "/nowhere")
    plan = table.groupBy("repo_name").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert table.count() == 3
    spark.sql("DROP TABLE bucketed_events")


def test_path_when_there_is_no_table(spark, events_of, tmp_path):
    writers.write_table(events_of([star("a")]), str(tmp_path / "t"))
    assert readers.read_table_or_path(spark, "absent_table", str(tmp_path / "t")).count() == 1


def test_optional_source(spark, events_of, tmp_path):
    ev = events_of([star("a")])
    assert readers.union_optional(ev, str(tmp_path / "absent")).count() == 1
    writers.write_events(events_of([star("b")]).drop("pr_merged"), str(tmp_path / "more"))
    both = readers.union_optional(ev, str(tmp_path / "more"))
    assert both.count() == 2 and both.columns == ev.columns
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        readers.union_optional(ev, str(tmp_path / "empty"))


def test_reports(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP '2025-01-01 02:03:04' t, TIMESTAMP_NTZ '2025-01-01 02:03:04' n, 'a,\"b' s, array(1, 2) l")
    writers.export_report(df, str(tmp_path / "r"))
    files = [f for f in os.listdir(tmp_path / "r") if f.endswith(".csv")]
    assert len(files) == 1
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "r")).first()
    assert (back.t, back.n, back.s, back.l) == ("2025-01-01 02:03:04", "2025-01-01 02:03:04", 'a,"b', "[1,2]")
    writers.export_metrics(spark.sql("SELECT 1 AS a, 'x' AS b"), str(tmp_path / "m"))
    got = rows(readers.read_csv(spark, str(tmp_path / "m"), "metric STRING, value STRING"), "metric")
    assert got == [{"metric": "a", "value": "1"}, {"metric": "b", "value": "x"}]


def test_csv_order(spark, tmp_path):
    df = spark.range(50).repartition(7)
    writers.export_csv(df, str(tmp_path / "o"), [F.desc("id")])
    (name,) = [f for f in os.listdir(tmp_path / "o") if f.endswith(".csv")]
    lines = (tmp_path / "o" / name).read_text().split()
    assert lines == ["id"] + [str(i) for i in range(49, -1, -1)]


def test_samples(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    assert [r.id for r in writers.sample_rows(df, ["id"], 2, ["v"]).collect()] == [99, 98]
    assert writers.sample_rows(df, ["v"], 3).count() == 3


def test_one_era_is_replaced(spark, tmp_path):
    path = str(tmp_path / "eras")
    schema = "era string, n long"
    writers.write_era(spark.createDataFrame([("2025-Q1", 1), ("2026-Q1", 2)], schema), path)
    writers.write_era(spark.createDataFrame([("2026-Q1", 3)], schema), path)
    got = rows(spark.read.parquet(path), "era")
    assert [(r["era"], r["n"]) for r in got] == [("2025-Q1", 1), ("2026-Q1", 3)]


def test_a_shrinking_second_run_leaves_nothing_of_the_first(spark, events_of, tmp_path):
    ev = events_of([star("a", ts=f"2025-01-0{d} 10:00:00") for d in range(1, 8)])
    few = ev.filter("event_date <= DATE '2025-01-02'")
    for by in (None, "event_date"):
        path = str(tmp_path / f"stored-{by}")
        assert writers.stored(ev, path, by=by).count() == 7
        assert writers.stored(few, path, by=by).count() == 2
    path = str(tmp_path / "copy")
    writers.copy_range(ev, path, "2025-01-01", "2025-01-07")
    writers.copy_range(ev, path, "2025-01-03", "2025-01-04")
    assert spark.read.parquet(path).count() == 2
    # An extended dataset keeps its other days.
    writers.write_events(ev, path)
    writers.write_events(few, path)
    assert spark.read.parquet(path).count() == 7


def test_parquet_months_and_options(spark, events_of, tmp_path):
    ev = events_of([star("a")])
    for name in ("2025-01-03-10", "2025-02-01-00"):
        ev.coalesce(1).write.parquet(str(tmp_path / "out" / name))
        (part,) = (tmp_path / "out" / name).glob("part-*.parquet")
        (tmp_path / "months").mkdir(exist_ok=True)
        (tmp_path / "months" / f"{name}.parquet").write_bytes(part.read_bytes())
    folder = str(tmp_path / "months")
    assert readers.read_events(spark, folder, "parquet").count() == 2
    assert readers.read_event_month(spark, folder, "2025-01", fmt="parquet").count() == 1


def test_the_shared_folder_must_be_named(spark):
    from vitals.session import require_utc, shared_folder

    class Bare:
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
