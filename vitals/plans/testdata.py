"""The test tables seen as events, models, curated repositories and downloads.

Every frame is a projection of whole tables; nothing is filtered or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals import schemas
from vitals.session import require_utc
from vitals.sources.readers import parse_lines

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return require_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def week_era(day: Column) -> Column:
    """Era of the one-month event table: W1 to W5 by day of month."""
    return F.concat(F.lit("W"), (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("string"))


# The property text holds one number; a pattern reads it faster than a JSON parser.
_KEY = """nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '')"""
_SIZE = "CASE WHEN event_type = 'purchase' THEN CAST(floor(value / 10) AS BIGINT) END"
_NUMBER = "CASE WHEN event_type = 'click' THEN user_id % 10 END"

# Cleaned column -> expression over the event table.
EVENT_SQL = {
    "event_id": "CAST(event_id AS STRING)",
    "event_type": """CASE event_type WHEN 'purchase' THEN 'PushEvent' WHEN 'click' THEN 'PullRequestEvent'
                     WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
                     WHEN 'error' THEN 'IssuesEvent' END""",
    "event_ts": "CAST(ts AS TIMESTAMP)",
    "event_date": "to_date(ts)",
    "is_public": "true",
    "actor_id": "user_id",
    "actor_login": "concat('u', user_id)",
    "repo_id": f"CAST({_KEY} AS BIGINT)",
    "repo_name": f"concat('r', {_KEY})",
    "org_id": "CAST(NULL AS BIGINT)",
    "org_login": "CAST(NULL AS STRING)",
    "payload_action": """CASE event_type
                         WHEN 'click' THEN CASE event_id % 4 WHEN 0 THEN 'opened' WHEN 3 THEN 'merged'
                                           ELSE 'closed' END
                         WHEN 'error' THEN if(event_id % 2 = 0, 'opened', 'closed')
                         WHEN 'view' THEN 'started' END""",
    "payload_number": _NUMBER,
    "issue_number": "CASE WHEN event_type = 'error' THEN user_id END",
    "issue_state": "CASE WHEN event_type = 'error' THEN if(event_id % 2 = 0, 'open', 'closed') END",
    "pr_number": _NUMBER,
    "pr_state": "CASE WHEN event_type = 'click' THEN if(event_id % 4 = 0, 'open', 'closed') END",
    "pr_merged": "CASE WHEN event_type = 'click' AND event_id % 4 = 1 THEN true END",
    "push_id": "CASE WHEN event_type = 'purchase' THEN event_id END",
    "push_size": _SIZE,
    "push_distinct_size": _SIZE,
    "commit_count": f"CASE WHEN event_type = 'purchase' THEN CAST({_SIZE} AS INT) END",
}


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events with their era."""
    columns = [f"{sql} AS {name}" for name, sql in EVENT_SQL.items()]
    era = "concat('W', CAST(floor((day(ts) - 1) / 7) + 1 AS STRING)) AS era"
    return table(spark, sf_dir, "events").selectExpr(*columns, era)


# One event as the feed delivers it, by variant of the delivery.
_RECORD = """
    CASE variant WHEN 'bad_time' THEN concat('t', event_id) WHEN 'no_repo' THEN concat('n', event_id)
                 ELSE event_id END AS id,
    if(variant = 'other_type', 'CreateEvent', event_type) AS type,
    struct(actor_id AS id, upper(actor_login) AS login) AS actor,
    CASE WHEN variant <> 'no_repo' THEN struct(repo_id AS id, upper(repo_name) AS name) END AS repo,
    struct(payload_action AS action, payload_number AS number, push_size AS size,
           push_distinct_size AS distinct_size, push_id,
           CASE WHEN commit_count IS NOT NULL THEN array_repeat(struct('0' AS sha), commit_count) END
               AS commits,
           CASE WHEN issue_number IS NOT NULL THEN struct(issue_number AS number, issue_state AS state) END
               AS issue,
           CASE WHEN pr_number IS NOT NULL
                THEN struct(pr_number AS number, pr_state AS state, pr_merged AS merged) END
               AS pull_request) AS payload,
    is_public AS public,
    CAST(NULL AS STRUCT<id: BIGINT, login: STRING>) AS org,
    if(variant = 'bad_time', 'yesterday', date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")) AS created_at
"""


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = "explode(array('ok', 'copy', 'other_type', 'bad_time', 'no_repo')) AS variant"
    return activity(spark, sf_dir).selectExpr("*", variants)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the raw layout, the way a feed delivers them.

    Each event comes with a repeated delivery, a record of a type that is not
    analysed, one with a malformed time and one without a repository; names are
    in upper case.
    """
    return _delivered(spark, sf_dir).selectExpr(f"struct({_RECORD}) AS r").select("r.*")


def raw_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON lines."""
    return _delivered(spark, sf_dir).selectExpr(f"to_json(struct({_RECORD})) AS value")


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines parsed with the schema cleaning reads."""
    return parse_lines(raw_event_lines(spark, sf_dir), schemas.CLEANING_EVENT)


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One curated repository per part size; its library is the latest part's type."""
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_size")
        .agg(F.min("p_brand").alias("category"), F.lower(F.max_by("p_type", "p_partkey")).alias("library"))
        .selectExpr("concat('R', p_size) AS repo", "category", "nullif(library, 'standard') AS hf_library")
    )


# Raw model fields over the part table; ``age`` is the age of the record's version in days.
_DOWNLOADS = """CASE p_size % 6 WHEN 0 THEN 0L WHEN 1 THEN CAST(p_size AS BIGINT) WHEN 2 THEN p_partkey + 101
                WHEN 3 THEN p_partkey * 1000 WHEN 4 THEN p_partkey * 1000000 END"""
_ISO = "concat(date_format({}, 'yyyy-MM-dd'), 'T00:00:00+00:00')"
_MODIFIED = _ISO.format("date_sub(date_add(DATE '2023-01-01', CAST(p_partkey % 730 AS INT)), age)")
_CREATED = _ISO.format("date_add(DATE '2022-03-02', CAST(p_partkey * 7 % 400 AS INT))")
_LICENSE = """CASE split(p_name, ' ')[0] WHEN 'red' THEN 'Apache 2.0' WHEN 'large' THEN 'MIT License'
              WHEN 'blue' THEN 'GPL3' WHEN 'new' THEN 'apache-2.0' WHEN 'cold' THEN 'Custom'
              WHEN 'hot' THEN 'bsd-3' WHEN 'old' THEN 'cc-by-4' END"""
MODEL_SQL = {
    "modelId": "concat(p_brand, if(p_size = 48, '-', '/'), replace(p_name, ' ', '-'), '-', p_partkey)",
    "author": "CASE WHEN p_size <> 47 THEN p_brand END",
    "sha": "CAST(NULL AS STRING)",
    "lastModified": f"if(p_size = 46, 'yesterday', {_MODIFIED})",
    "private": "CASE WHEN p_size = 50 THEN true WHEN p_size >= 10 THEN false END",
    "disabled": "CASE WHEN p_size = 49 THEN true END",
    "gated": "CASE WHEN p_size <= 4 THEN 'auto' WHEN p_size <= 8 THEN 'False' END",
    "pipeline_tag": "CASE WHEN p_size % 5 <> 0 THEN upper(split(p_name, ' ')[1]) END",
    "tags": "CASE WHEN p_size <> 44 THEN split(p_name, ' ') END",
    "library_name": "CASE WHEN p_type <> 'STANDARD' THEN p_type END",
    "likes": "CAST(p_size - age AS BIGINT)",
    "downloads": _DOWNLOADS,
    "downloads_all_time": f"2 * {_DOWNLOADS}",
    "trending_score": "CAST(p_size % 7 AS BIGINT)",
    "card_data": f"""struct({_LICENSE} AS license, array(split(p_name, ' ')[1]) AS datasets,
                     array('en') AS language, CASE WHEN p_size % 3 = 0 THEN p_brand END AS base_model)""",
    "safetensors": """CASE WHEN p_size % 4 <> 0
                      THEN struct(struct(p_partkey % 97 * 1000000000 AS total) AS parameters) END""",
    "config": "struct(upper(split(p_name, ' ')[0]) AS model_type, array(p_type) AS architectures)",
    "created_at": f"CASE WHEN p_size <> 45 THEN {_CREATED} END",
}


def raw_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a raw model record, plus an older version of each record."""
    versions = table(spark, sf_dir, "part").selectExpr("*", "explode(array(0, 1)) AS age")
    return versions.selectExpr(*[f"{sql} AS {name}" for name, sql in MODEL_SQL.items()])


# One hub API record as JSON text: flags, lists and names mixed as in the feed.
_EVAL_RESULTS = """concat(
    '[{"task_type":"t","dataset_name":"', p_type, '","metric_type":"acc","metric_value":"',
    CAST(p_retailprice AS INT), '","verified":true},',
    '{"task_type":"t","dataset_name":"all","metric_type":"f1","metric_value":"', p_size, '"}]')"""
_CARD = f"""concat(
    '{{"license":"mit","base_model":',
    CASE p_size % 3 WHEN 0 THEN concat('"', p_brand, '"') WHEN 1 THEN concat('["', p_brand, '"]')
                    ELSE 'null' END,
    ',"eval_results":', if(p_size % 2 = 0, {_EVAL_RESULTS}, 'null'), '}}')"""
_HUB_LINE = f"""concat(
    '{{"id":"', p_brand, '/', p_partkey, '","author":"', p_brand, '","gated":',
    CASE WHEN p_size <= 4 THEN '"auto"' WHEN p_size <= 8 THEN 'false' WHEN p_size <= 12 THEN 'true'
         ELSE 'null' END,
    ',"downloads":', p_partkey, ',"downloadsAllTime":', p_partkey * 2, ',"likes":', p_size,
    ',"cardData":', if(p_size % 7 = 0, 'null', {_CARD}),
    ',"safetensors":', if(p_size % 4 = 0, 'null', concat('{{"total":', p_partkey * 1000, '}}')),
    ',"createdAt":"2022-03-02T00:00:00+00:00"}}')"""


def hub_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a hub API record, one JSON object per line."""
    return table(spark, sf_dir, "part").selectExpr(f"{_HUB_LINE} AS value")


def package_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity per part type and month, as package downloads."""
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.lower("p_type").alias("project"),
            F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("month"),
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("downloads"))
    )
