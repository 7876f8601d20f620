"""Explicit input schemas and the fixed values the results depend on."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Raw code-hosting events (JSON lines). Field names of the feed.
# ---------------------------------------------------------------------------
_PERSON = "STRUCT<login STRING, id BIGINT>"

RAW_EVENT = f"""
    id STRING,
    type STRING,
    actor STRUCT<id BIGINT, login STRING, display_login STRING,
                 gravatar_id STRING, url STRING, avatar_url STRING>,
    repo STRUCT<id BIGINT, name STRING, url STRING>,
    payload STRUCT<
        action STRING, ref STRING, ref_type STRING, master_branch STRING,
        description STRING, number BIGINT, size BIGINT, distinct_size BIGINT,
        push_id BIGINT,
        commits ARRAY<STRUCT<sha STRING, author STRUCT<email STRING, name STRING>,
                             message STRING, distinct BOOLEAN, url STRING>>,
        issue STRUCT<id BIGINT, number BIGINT, title STRING, state STRING, user {_PERSON}>,
        pull_request STRUCT<id BIGINT, number BIGINT, state STRING, merged BOOLEAN,
                            title STRING, user {_PERSON}>,
        forkee STRUCT<id BIGINT, full_name STRING, owner {_PERSON}>>,
    public BOOLEAN,
    created_at STRING,
    org STRUCT<id BIGINT, login STRING, gravatar_id STRING, url STRING, avatar_url STRING>
"""

# The part of RAW_EVENT that cleaning reads. The JSON reader skips every field
# outside its schema, so commit messages, titles and URLs are never decoded.
CLEANING_EVENT = """
    id STRING,
    type STRING,
    actor STRUCT<id BIGINT, login STRING>,
    repo STRUCT<id BIGINT, name STRING>,
    payload STRUCT<
        action STRING, number BIGINT, size BIGINT, distinct_size BIGINT, push_id BIGINT,
        commits ARRAY<STRUCT<sha STRING>>,
        issue STRUCT<number BIGINT, state STRING>,
        pull_request STRUCT<number BIGINT, state STRING, merged BOOLEAN>>,
    public BOOLEAN,
    created_at STRING,
    org STRUCT<id BIGINT, login STRING>
"""

# The event types that carry the analysed activity.
CORE_EVENT_TYPES = ("WatchEvent", "ForkEvent", "PushEvent", "PullRequestEvent", "IssuesEvent")

# Cleaned events: output column -> type, in output order. Fixed values.
CLEAN_EVENT = """
    event_id STRING, event_type STRING, event_ts TIMESTAMP, event_date DATE,
    is_public BOOLEAN, actor_id BIGINT, actor_login STRING, repo_id BIGINT,
    repo_name STRING, org_id BIGINT, org_login STRING, payload_action STRING,
    payload_number BIGINT, issue_number BIGINT, issue_state STRING, pr_number BIGINT,
    pr_state STRING, pr_merged BOOLEAN, push_id BIGINT, push_size BIGINT,
    push_distinct_size BIGINT, commit_count INT
"""

# ---------------------------------------------------------------------------
# Raw model-hub records. Field names of the snapshot.
# ---------------------------------------------------------------------------
RAW_MODEL = """
    modelId STRING, author STRING, sha STRING, lastModified STRING,
    private BOOLEAN, disabled BOOLEAN, gated STRING, pipeline_tag STRING,
    tags ARRAY<STRING>, library_name STRING, likes BIGINT, downloads BIGINT,
    downloads_all_time BIGINT, trending_score BIGINT,
    card_data STRUCT<license STRING, datasets ARRAY<STRING>, language ARRAY<STRING>,
                     base_model STRING>,
    safetensors STRUCT<parameters STRUCT<total BIGINT>>,
    config STRUCT<model_type STRING, architectures ARRAY<STRING>>,
    created_at STRING
"""

# Cleaned models: output column -> type, in output order. Fixed values.
CLEAN_MODEL = """
    model_id STRING, owner STRING, model_name STRING, author STRING,
    last_modified_ts TIMESTAMP, last_modified_date DATE, created_ts TIMESTAMP,
    pipeline_tag STRING, library_name STRING, downloads BIGINT, likes BIGINT,
    downloads_all_time BIGINT, trending_score BIGINT, tags ARRAY<STRING>, tag_count INT,
    training_datasets ARRAY<STRING>, languages ARRAY<STRING>, base_model STRING,
    parameter_count BIGINT, model_type STRING, architectures ARRAY<STRING>,
    gated STRING, license STRING
"""

# One evaluation result of a model card. Fixed values.
EVAL_RESULT_FIELDS = (
    ("task_type", "STRING"),
    ("dataset_type", "STRING"),
    ("dataset_name", "STRING"),
    ("dataset_config", "STRING"),
    ("dataset_split", "STRING"),
    ("metric_type", "STRING"),
    ("metric_value", "STRING"),
    ("verified", "BOOLEAN"),
)

# Hub API record before normalization; fields whose JSON type varies are read as
# VARIANT so a string can be told from a flag, a number or a list.
HUB_RECORD = f"""
    id STRING, author STRING, sha STRING, lastModified STRING, private BOOLEAN,
    disabled BOOLEAN, gated VARIANT, pipeline_tag STRING, tags ARRAY<STRING>,
    library_name STRING, likes BIGINT, downloads BIGINT, downloadsAllTime BIGINT,
    trendingScore BIGINT,
    cardData STRUCT<license STRING, datasets ARRAY<STRING>, language ARRAY<STRING>,
                    base_model VARIANT,
                    eval_results ARRAY<STRUCT<{", ".join(f"{n} {t}" for n, t in EVAL_RESULT_FIELDS)}>>>,
    safetensors STRUCT<total BIGINT>,
    config STRUCT<model_type STRING, architectures ARRAY<STRING>>,
    createdAt STRING
"""

# The task tags counted as core.
CORE_PIPELINE_TAGS = (
    "text-generation",
    "text-classification",
    "token-classification",
    "question-answering",
    "fill-mask",
    "summarization",
    "translation",
    "text2text-generation",
    "image-classification",
    "object-detection",
    "image-segmentation",
    "text-to-image",
    "image-to-text",
    "automatic-speech-recognition",
    "text-to-speech",
    "feature-extraction",
    "sentence-similarity",
    "zero-shot-classification",
    "reinforcement-learning",
    "depth-estimation",
)

# Licence spelling -> normalized identifier.
LICENSE_SYNONYMS = {
    "apache 2.0": "apache-2.0",
    "apache2": "apache-2.0",
    "apache-2": "apache-2.0",
    "mit license": "mit",
    "gpl-3": "gpl-3.0",
    "gpl3": "gpl-3.0",
    "gplv3": "gpl-3.0",
    "bsd-3": "bsd-3-clause",
    "bsd-2": "bsd-2-clause",
    "cc-by-4": "cc-by-4.0",
    "cc-by-sa-4": "cc-by-sa-4.0",
    "cc-by-nc-4": "cc-by-nc-4.0",
    "cc-by-nc-sa-4": "cc-by-nc-sa-4.0",
}

# ---------------------------------------------------------------------------
# Small inputs
# ---------------------------------------------------------------------------
SEED = "repo STRING, category STRING, hf_library STRING"
PACKAGE_DOWNLOADS = "project STRING, month STRING, downloads STRING"
CURATED_REPOS = "repo_name STRING"
LICENSE_MAP = "raw_license STRING, normalized_license STRING"
