"""Fixed schemas of the layers and control tables."""

from __future__ import annotations

from pyspark.sql import types as T

REPO = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
])

ACTOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.StringType()),
])

# Bronze: raw event plus lineage.  ``payload`` keeps the type-dependent JSON
# object as a Variant.  ``_absent_keys`` lists which of the keys in
# TRACKED_KEYS were absent from the raw JSON object (absent differs from an
# explicit null for validation, see operators.validate).  ``_raw`` is the event
# as it came: its JSON text, or the text that could not be parsed.
BRONZE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("repo", REPO),
    T.StructField("actor", ACTOR),
    T.StructField("payload", T.VariantType()),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_source", T.StringType()),
    T.StructField("source_repo", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_arrival_seq", T.LongType()),
    T.StructField("_file", T.StringType()),
    T.StructField("_pos", T.ArrayType(T.LongType())),
    T.StructField("_absent_keys", T.ArrayType(T.StringType())),
    T.StructField("_raw", T.StringType()),
])

# Arrival order of Bronze rows, unique per row: arrival (a file's modification
# time), file path, position in the file.
ORDER = ("_arrival_seq", "_file", "_pos")

# Keys whose absence is recorded in Bronze ``_absent_keys``.
TRACKED_KEYS = ("id", "type", "created_at", "repo", "repo.id", "repo.name")

# Checkpoint / control table: one row per (pipeline, source, commit).
CONTROL = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("source_repo", T.StringType()),
    T.StructField("last_processed_timestamp", T.TimestampType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("execution_timestamp", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# Retention table: a row when a version is retired from a layer, and one when
# its files are removed.
RETENTION = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_run_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType()),
])

# Run history: one row per run (JSON Lines on disk).
RUN = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("source_repo", T.StringType()),
])

# Columns of the flat Silver base projection, in output order.
SILVER_BASE = (
    "event_id", "event_type", "created_at", "repo_id", "repo_name", "repo_url",
    "actor_id", "actor_login", "payload", "_ingestion_timestamp",
    "_transformation_timestamp", "_source", "event_date", "event_hour",
    "_content_hash", "_ts_fallback", "source_repo", "_batch_id", "_arrival_seq", "_file", "_pos",
)

SILVER_FEATURES = (
    "push_size", "push_ref", "push_commits_count",
    "pr_action", "pr_state", "pr_merged", "pr_additions", "pr_deletions",
    "issue_action", "issue_state", "issue_labels", "watch_action",
    "activity_category", "is_active_contribution", "time_of_day",
)
