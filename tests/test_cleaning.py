import gzip
import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from vitals import schemas
from vitals.operators import cleaning
from vitals.sources import readers
from vitals.sources.dimensions import license_map


def event(id_, type_="PushEvent", created_at="2025-01-16T01:02:03Z", repo="Org/Repo", **payload):
    return {
        "id": id_, "type": type_, "public": True, "created_at": created_at,
        "actor": {"id": 7, "login": "Ada", "display_login": "ada"},
        "repo": None if repo is None else {"id": 9, "name": repo},
        "payload": payload,
    }


FIXTURE = [
    event("1", size=3, distinct_size=2, push_id=5, commits=[{"sha": "a"}, {"sha": "b"}, {"sha": "c"}]),
    event("1", size=3, distinct_size=2, push_id=5, commits=[{"sha": "a"}, {"sha": "b"}, {"sha": "c"}]),
    event("2", commits=[]),
    event("3", "PullRequestEvent", action="closed", number=4,
          pull_request={"number": 4, "state": "closed", "merged": True}),
    event("4", "PullRequestEvent", action="closed", pull_request={"number": 5, "state": "closed"}),
    event("5", "PullRequestEvent", action="merged", pull_request={"number": 6}),
    event("6", "IssuesEvent", action="opened", issue={"number": 8, "state": "open"}),
    event("7", "CreateEvent", ref="main"),
    event("8", created_at=None),
    event("9", created_at="not a time"),
    event("10", repo=None),
    {**event("11"), "repo": {"id": 1}},
    {**event("12", "WatchEvent", action="started"), "org": {"id": 3, "login": "ORG"}},
]


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    lines = "\n".join(json.dumps(e) for e in FIXTURE) + "\n{broken\n"
    with gzip.open(folder / "2025-01-16-0.json.gz", "wt") as f:
        f.write(lines)
    return str(folder)


def test_clean_events(spark, raw_path):
    cleaned = cleaning.clean_events(readers.read_events(spark, raw_path))
    expected = [tuple(part.split()) for part in schemas.CLEAN_EVENT.split(",")]
    assert cleaned.dtypes == [(name, type_.lower()) for name, type_ in expected]
    got = {r["event_id"]: r for r in rows(cleaned)}
    assert sorted(got) == ["1", "12", "2", "3", "4", "5", "6"]
    assert cleaned.count() == 7
    first = got["1"]
    assert (first["actor_login"], first["repo_name"]) == ("ada", "org/repo")
    assert (str(first["event_ts"]), str(first["event_date"])) == ("2025-01-16 01:02:03", "2025-01-16")
    assert (first["push_size"], first["push_distinct_size"], first["commit_count"]) == (3, 2, 3)
    assert got["2"]["commit_count"] == 0
    assert got["3"]["commit_count"] is None
    assert (got["3"]["pr_number"], got["3"]["pr_merged"], got["3"]["payload_number"]) == (4, True, 4)
    assert got["4"]["pr_merged"] is None
    assert got["5"]["payload_action"] == "merged"
    assert (got["6"]["issue_number"], got["6"]["issue_state"]) == (8, "open")
    assert got["12"]["org_login"] == "org"


def test_full_and_narrow_schema_clean_alike(spark, raw_path):
    full = cleaning.clean_events(readers.read_events(spark, raw_path, full=True))
    narrow = cleaning.clean_events(readers.read_events(spark, raw_path))
    assert rows(full, "event_id") == rows(narrow, "event_id")


def test_clean_events_for_curated_repos(spark, raw_path):
    raw = readers.read_events(spark, raw_path)
    seed = spark.createDataFrame([("ORG/REPO",), ("org/repo",)], "repo_name string")
    assert cleaning.clean_events(raw, seed).count() == 7
    other = spark.createDataFrame([("x/y",)], "repo_name string")
    assert cleaning.clean_events(raw, other).count() == 0
    with pytest.raises(ValueError):
        cleaning.clean_events(raw, seed.withColumnRenamed("repo_name", "name"))


def test_survivor_depends_on_data_only(spark):
    data = [("k", 2, "late"), ("k", 1, "b"), ("k", 1, "a"), ("j", 5, "x")]
    schema = "id string, t int, v string"
    first = cleaning.dedupe(spark.createDataFrame(data, schema).repartition(4), "id", [F.col("t")])
    second = cleaning.dedupe(spark.createDataFrame(data[::-1], schema).coalesce(1), "id", [F.col("t")])
    assert rows(first, "id") == rows(second, "id")
    assert {r["id"]: r["t"] for r in rows(first)} == {"k": 1, "j": 5}


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", 1)], "id string, t int")
    plan = cleaning.dedupe(df, "id", [F.col("t")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_rows_of_one_task_are_spread_before_they_are_sorted(spark):
    """One task holds all rows, a third of them of one key; each split is sorted on its own."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 3000 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i / 4).cast("int")))
    df = spark.range(0, 60_000, 1, 1).select(key.alias("key"), (i % 1000).alias("t"), F.sha2(i.cast("string"), 512).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        single = cleaning.dedupe(df, "key", [F.desc("t")])
        got = {r["key"]: r["t"] for r in single.collect()}
        plan = single._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert single.columns == df.columns
    expected = {}
    for r in df.collect():
        expected[r["key"]] = max(r["t"], expected.get(r["key"], -1))
    assert got == expected and None in got
    spread = plan.split("== Initial Plan ==")[0].split("Partial", 1)[1]
    assert spread.index("Sort [") < spread.index("AQEShuffleRead") < spread.index("REBALANCE_PARTITIONS_BY_COL")


def model(id_="Org/Name", **over):
    base = {
        "modelId": id_, "author": "Org", "lastModified": "2025-03-06T13:37:44+00:00", "private": None,
        "disabled": None, "gated": None, "pipeline_tag": "Text-Generation", "tags": ["a", "b"],
        "library_name": None, "likes": 1, "downloads": 2, "card_data": {"license": "Apache 2.0"},
        "safetensors": {"parameters": {"total": 9}}, "config": {"model_type": "BERT", "architectures": ["X"]},
        "created_at": "2022-03-02T23:29:04+00:00",
    }
    return json.dumps({**base, **over})


@pytest.fixture(scope="module")
def raw_models(spark):
    lines = [
        model(),
        model(lastModified="2024-01-01T00:00:00+00:00", likes=0),
        model("a/private", private=True),
        model("a/disabled", disabled=True),
        model("a/open", private=False, disabled=False),
        model("noslash"),
        model("a/badtime", lastModified="x"),
        model("a/notime", lastModified=None),
        model("a/notags", tags=None, card_data=None),
        model("a/odd", card_data={"license": "Own-1"}, gated="auto"),
        model(None),
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return readers.parse_lines(df, schemas.RAW_MODEL)


def test_clean_models(spark, raw_models):
    cleaned = cleaning.clean_models(raw_models)
    expected = [part.strip().split(" ") for part in schemas.CLEAN_MODEL.split(",")]
    assert cleaned.columns == [name for name, _ in expected]
    got = {r["model_id"]: r for r in rows(cleaned)}
    assert sorted(got) == ["Org/Name", "a/notags", "a/odd", "a/open"]
    one = got["Org/Name"]
    assert (one["owner"], one["model_name"], one["author"], one["likes"]) == ("Org", "Name", "org", 1)
    assert (one["pipeline_tag"], one["library_name"]) == ("text-generation", "unknown")
    assert (one["license"], one["parameter_count"], one["model_type"]) == ("apache-2.0", 9, "bert")
    assert str(one["last_modified_date"]) == "2025-03-06"
    assert (got["a/notags"]["tag_count"], got["a/notags"]["license"]) == (0, "unknown")
    assert got["a/odd"]["license"] == "own-1"


def test_license_table_and_constant_map_agree(spark, raw_models):
    a = cleaning.clean_models(raw_models)
    b = cleaning.clean_models(raw_models, license_map(spark))
    assert rows(a, "model_id") == rows(b, "model_id")


def test_normalize_hub_records(spark):
    records = [
        {"id": "a/1", "gated": False, "cardData": {"license": "mit", "base_model": "b/2"},
         "safetensors": {"total": 5}, "createdAt": "2022-03-02T23:29:04+00:00"},
        {"id": "a/2", "gated": True, "cardData": {"base_model": ["b/2", "b/3"]}, "safetensors": {}},
        {"id": "a/3", "gated": "manual", "cardData": None, "config": {"model_type": "t5"}},
        {"id": "a/4"},
    ]
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    got = {r["modelId"]: r for r in rows(cleaning.normalize_model_record(lines))}
    assert [got[f"a/{i}"]["gated"] for i in (1, 2, 3, 4)] == [None, "True", "manual", None]
    assert got["a/1"]["card_data"]["base_model"] == "b/2"
    assert got["a/2"]["card_data"]["base_model"] is None
    assert got["a/3"]["card_data"] is None
    assert got["a/1"]["safetensors"] == {"parameters": {"total": 5}}
    assert got["a/2"]["safetensors"] is None
    assert got["a/3"]["config"]["model_type"] == "t5"
    normalized = cleaning.normalize_model_record(lines)
    parsed = readers.parse_lines(lines, schemas.RAW_MODEL)
    assert normalized.dtypes == parsed.dtypes


def test_flatten_eval_results(spark):
    record = {"id": "a/1", "cardData": {"eval_results": [
        {"task_type": "t", "metric_type": "acc", "metric_value": 0.5, "verified": True},
        {"task_type": "t", "metric_type": "f1", "metric_value": "x"}]}}
    lines = [json.dumps(record), json.dumps({"id": "a/2", "cardData": {"eval_results": []}}), '{"id":"a/3"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = rows(cleaning.flatten_eval_results(df), "metric_type")
    assert [(r["model_id"], r["metric_type"], r["metric_value"], r["verified"]) for r in got] == [
        ("a/1", "acc", "0.5", True),
        ("a/1", "f1", "x", None),
    ]


def test_core_task_models(spark):
    df = spark.createDataFrame([("translation",), ("other",), (None,)], "pipeline_tag string")
    assert cleaning.core_task_models(df).count() == 1


def test_parsing_happens_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    df = readers.parse_lines(lines, schemas.CLEANING_EVENT).filter("type = 'x' AND created_at IS NOT NULL")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_type_filter_reaches_the_json_scan(spark, raw_path):
    cleaned = cleaning.clean_events(readers.read_events(spark, raw_path))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan json" in line)
    assert "In(type, [" in scan and "url" not in scan.split("ReadSchema")[1]
