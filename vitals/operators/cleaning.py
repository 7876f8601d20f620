"""Raw records to typed, de-duplicated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitals import schemas
from vitals.functions import columns as C
from vitals.operators.joins import keep_repos
from vitals.session import require_utc
from vitals.sources import dimensions
from vitals.sources.readers import parse_lines

# Cleaned column -> path in the raw event, for plain copies.
_EVENT_PATHS = {
    "event_id": "id",
    "event_type": "type",
    "is_public": "public",
    "actor_id": "actor.id",
    "repo_id": "repo.id",
    "org_id": "org.id",
    "payload_action": "payload.action",
    "payload_number": "payload.number",
    "issue_number": "payload.issue.number",
    "issue_state": "payload.issue.state",
    "pr_number": "payload.pull_request.number",
    "pr_state": "payload.pull_request.state",
    "pr_merged": "payload.pull_request.merged",
    "push_id": "payload.push_id",
    "push_size": "payload.size",
    "push_distinct_size": "payload.distinct_size",
}
# Names compared without regard to case.
_EVENT_NAMES = {"actor_login": "actor.login", "repo_name": "repo.name", "org_login": "org.login"}


def dedupe(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``, further ties by a hash of the whole row.

    The survivor depends on the data alone, so a recomputed task picks the same
    one. Rows are first spread by a hash of the key, where Spark splits what is larger
    than its advisory size, so no task sorts more than that however many rows its
    share of the input unfolds into. The rank-one filter then lets Spark cut each
    task's rows to one per key before the shuffle by key: a key holding a third of
    all copies reaches that key's task once per split, not once per copy.
    """
    ties = F.xxhash64(*[F.col(c) for c in df.columns])
    newest = W.partitionBy(key).orderBy(*order, ties)
    spread = df.withColumn("_spread", F.xxhash64(key)).hint("rebalance", "_spread").drop("_spread")
    return spread.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def flatten_events(raw: DataFrame) -> DataFrame:
    """Nested raw events to the 22 flat columns; names lower-cased, timestamps parsed."""
    require_utc(raw.sparkSession)
    at = C.parsed_timestamp("created_at")
    made = {name: F.col(path) for name, path in _EVENT_PATHS.items()}
    made |= {name: F.lower(F.col(path)) for name, path in _EVENT_NAMES.items()}
    made["event_ts"] = at
    made["event_date"] = F.to_date(at)
    made["commit_count"] = C.array_length("payload.commits")
    names = [part.split()[0] for part in schemas.CLEAN_EVENT.split(",")]
    return raw.select(*[made[name].alias(name) for name in names])


def clean_events(
    raw: DataFrame, seed: DataFrame | None = None, types: Sequence[str] = schemas.CORE_EVENT_TYPES
) -> DataFrame:
    """Core events with a valid time and repository, one row per event id.

    The type filter and the optional repository filter run before the
    de-duplicating shuffle, so dropped rows are never moved.
    """
    flat = (
        flatten_events(raw.filter(F.col("type").isin(*types)))
        .filter(F.col("event_ts").isNotNull())
        .filter(F.col("repo_name").isNotNull())
    )
    if seed is not None:
        flat = keep_repos(flat, seed)
    return dedupe(flat, "event_id", [F.col("event_ts")])


def clean_models(raw: DataFrame, license_map: DataFrame | None = None) -> DataFrame:
    """Public, well-formed model records with normalized labels, one row per model id.

    ``license_map`` (raw_license, normalized_license) replaces the built-in
    synonyms; without it the lookup is a constant map and plans no join.
    """
    modified = C.parsed_timestamp("lastModified")
    flat = raw.filter(C.not_flagged("private") & C.not_flagged("disabled")).select(
        F.col("modelId").alias("model_id"),
        C.path_part("modelId", 1).alias("owner"),
        C.path_part("modelId", 2).alias("model_name"),
        F.lower("author").alias("author"),
        modified.alias("last_modified_ts"),
        F.to_date(modified).alias("last_modified_date"),
        C.parsed_timestamp("created_at").alias("created_ts"),
        C.lower_or_unknown("pipeline_tag").alias("pipeline_tag"),
        C.lower_or_unknown("library_name").alias("library_name"),
        "downloads",
        "likes",
        "downloads_all_time",
        "trending_score",
        "tags",
        C.array_length_or_zero("tags").alias("tag_count"),
        F.col("card_data.datasets").alias("training_datasets"),
        F.col("card_data.language").alias("languages"),
        F.col("card_data.base_model").alias("base_model"),
        F.col("safetensors.parameters.total").alias("parameter_count"),
        F.lower("config.model_type").alias("model_type"),
        F.col("config.architectures").alias("architectures"),
        "gated",
        F.lower("card_data.license").alias("raw_license"),
    )
    valid = flat.filter(
        F.col("model_id").isNotNull()
        & F.col("model_id").contains("/")
        & F.col("last_modified_ts").isNotNull()
    )
    single = dedupe(valid, "model_id", [F.desc("last_modified_ts")])
    return normalize_license(single, license_map)


def normalize_license(df: DataFrame, license_map: DataFrame | None = None) -> DataFrame:
    """``raw_license`` to ``license``: mapped, else as written, else ``unknown``."""
    if license_map is None:
        mapped = F.try_element_at(dimensions.license_lookup(), F.col("raw_license"))
        joined = df.withColumn("_mapped", mapped)
    else:
        lookup = license_map.select(
            F.col("raw_license").alias("_raw"), F.col("normalized_license").alias("_mapped")
        )
        joined = df.join(lookup, F.col("raw_license") == F.col("_raw"), "left").drop("_raw")
    label = F.coalesce("_mapped", "raw_license", F.lit("unknown"))
    return joined.withColumn("license", label).drop("raw_license", "_mapped")


def parse_hub_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Hub API records, one JSON object per line, as typed columns."""
    return parse_lines(lines, schemas.HUB_RECORD, column)


def _variant_kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def normalize_model_record(lines: DataFrame, column: str = "value") -> DataFrame:
    """Hub API records to the raw model layout.

    ``gated`` is kept as text or becomes ``True`` for a set flag and NULL for an
    unset one; ``base_model`` is kept only when it is a single name; the
    parameter total moves under ``parameters``.
    """
    r = parse_hub_records(lines, column)
    gated = F.col("gated")
    gated_text = F.try_variant_get(gated, "$", "string")
    base = F.col("cardData.base_model")
    total = F.col("safetensors.total")
    return r.select(
        F.col("id").alias("modelId"),
        "author",
        "sha",
        "lastModified",
        "private",
        "disabled",
        F.when(_variant_kind(gated) == "STRING", F.when(gated_text != "", gated_text))
        .when(gated_text == "true", "True")
        .alias("gated"),
        "pipeline_tag",
        "tags",
        "library_name",
        "likes",
        "downloads",
        F.col("downloadsAllTime").alias("downloads_all_time"),
        F.col("trendingScore").alias("trending_score"),
        F.when(
            F.col("cardData").isNotNull(),
            F.struct(
                F.col("cardData.license").alias("license"),
                F.col("cardData.datasets").alias("datasets"),
                F.col("cardData.language").alias("language"),
                F.when(_variant_kind(base) == "STRING", F.try_variant_get(base, "$", "string")).alias(
                    "base_model"
                ),
            ),
        ).alias("card_data"),
        F.when(
            total.isNotNull(), F.struct(F.struct(total.alias("total")).alias("parameters"))
        ).alias("safetensors"),
        "config",
        F.col("createdAt").alias("created_at"),
    )


def flatten_eval_results(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per model and evaluation result of its card."""
    results = parse_hub_records(lines, column).select(
        F.col("id").alias("model_id"), F.explode("cardData.eval_results").alias("e")
    )
    return results.select(
        "model_id", *[F.col(f"e.{name}").alias(name) for name, _ in schemas.EVAL_RESULT_FIELDS]
    )


def core_task_models(models: DataFrame) -> DataFrame:
    """Models whose task is one of the core pipeline tags."""
    return models.filter(F.col("pipeline_tag").isin(*schemas.CORE_PIPELINE_TAGS))
