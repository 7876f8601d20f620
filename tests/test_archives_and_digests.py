import gzip

import pytest
from frames import rows
from pyspark.sql import functions as F

from vitals.operators import joins, quality
from vitals.sources import readers, writers


def archive(path, n, members=1):
    lines = [f'{{"id":"{i}","type":"PushEvent","created_at":"2024-01-05T07:00:00Z"}}\n' for i in range(n)]
    size = -(-n // members) or 1
    data = b"".join(gzip.compress("".join(lines[k : k + size]).encode()) for k in range(0, max(n, 1), size))
    path.write_bytes(data)
    return data


def test_losses_of_cut_damaged_and_whole_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "PIECE", 100)
    archive(tmp_path / "whole.gz", 5000)
    archive(tmp_path / "members.gz", 5000, members=7)
    archive(tmp_path / "none.gz", 0)
    data = archive(tmp_path / "cut.gz", 50_000)
    (tmp_path / "cut.gz").write_bytes(data[: len(data) // 2])
    damaged = bytearray(archive(tmp_path / "damaged.gz", 50_000))
    damaged[-6] ^= 1  # the checksum
    (tmp_path / "damaged.gz").write_bytes(bytes(damaged))
    got = {r["path"].rpartition("/")[2]: r for r in rows(readers.archive_losses(spark, str(tmp_path)))}
    assert {name: r["ended_early"] for name, r in got.items()} == {
        "whole.gz": False, "members.gz": False, "none.gz": False, "cut.gz": True, "damaged.gz": True,
    }
    assert (got["whole.gz"]["rows"], got["members.gz"]["rows"], got["none.gz"]["rows"]) == (5000, 5000, 0)
    assert 0 < got["cut.gz"]["rows"] < 50_000 and got["cut.gz"]["length"] == len(data) // 2
    read = readers.read_events(spark, str(tmp_path), name_glob="*.gz", skip_corrupt_files=True)
    assert read.count() == sum(r["rows"] for r in got.values())


def test_archive_coverage_counts_archives_not_events(spark, tmp_path):
    for hour in range(24):
        archive(tmp_path / f"2024-01-02-{hour}.json.gz", 0 if hour == 3 else 2)
    archive(tmp_path / "2024-01-03-7.json.gz", 1)
    archive(tmp_path / "2024-02-01-0.json.gz", 1)
    (tmp_path / "2024-01-04-x.txt").write_text("no archive")
    hours = readers.archive_hours(spark, str(tmp_path), "2024-01")
    got = rows(quality.archive_coverage(hours, "2024-01-01", "2024-01-04"), "event_date")
    assert [(r["hours_present"], r["complete"]) for r in got] == [(0, False), (24, True), (1, False), (0, False)]
    assert readers.read_event_month(spark, str(tmp_path), "2024-01").count() == 23 * 2 + 1


def test_bucketed_tables_join_without_an_exchange(spark):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    assert writers.write_bucketed(left, "t_left", 8, "k") == 1000
    assert writers.write_bucketed(right, "t_right", 8, "k") == 40
    writers.write_bucketed(right, "t_other", 4, "k")
    joined = joins.bucketed_join(spark, "t_left", "t_right", "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 800
    with pytest.raises(ValueError):
        joins.bucketed_join(spark, "t_left", "t_other", "k")


SCHEMA = "event_id string, event_date string, v int"


def test_changes_that_cancel_in_counts_are_located(spark):
    old = [(str(i), f"2024-01-0{i % 3 + 1}", i) for i in range(60)] + [(None, None, 1), ("d", "2024-01-01", 1), ("d", "2024-01-01", 1)]
    new = [r for r in old if r[0] != "9"]
    new = [("x", r[1], r[2]) if r[0] == "12" else (r[0], r[1], -r[2]) if r[0] == "20" else r for r in new]
    new.remove(("d", "2024-01-01", 1))
    frames = [spark.createDataFrame(x, SCHEMA).withColumn("event_date", F.to_date("event_date")) for x in (new, old)]
    got = {(r["event_id"], r["change"]) for r in rows(quality.changed_rows(*frames, buckets=4))}
    assert got == {("9", "removed"), ("12", "removed"), ("x", "added"), ("20", "changed"), ("d", "changed")}
    assert rows(quality.changed_rows(frames[0], frames[0].repartition(5))) == []


def test_digests_do_not_depend_on_the_order(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("event_id"), F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("event_date"))
    a, b = (rows(quality.content_digests(x), "day", "bucket") for x in (df, df.orderBy(F.desc("event_id")).repartition(7)))
    assert a == b and sum(r["rows"] for r in a) == 500
