"""Bronze -> Silver: validate, dedup, flatten, type, hash, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.features import (
    activity_category, is_active_contribution, payload_features, time_of_day,
)
from tidemark.functions.hashing import content_hash
from tidemark.functions.timefns import day_name, parse_event_time, ts_literal
from tidemark.operators import dedup, validate
from tidemark.schemas import ORDER
from tidemark.sources.testdata import DEFAULT_RUN_TS

EMPTY_OBJECT = "{}"


def clean(rows: DataFrame, run_ts: str = DEFAULT_RUN_TS, include_id_in_hash: bool = True) -> DataFrame:
    """Flatten validated Bronze rows into the Silver base schema.

    ``created_at`` becomes an instant; unparseable or null text falls back to
    the run timestamp and is flagged by ``_ts_fallback``.
    """
    parsed = parse_event_time("created_at")
    payload = F.col("payload")
    out = rows.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.coalesce(parsed, ts_literal(run_ts)).alias("created_at"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.coalesce(F.col("repo.url"), F.lit("")).alias("repo_url"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.when(payload.isNull() | F.is_variant_null(payload), F.parse_json(F.lit(EMPTY_OBJECT)))
        .otherwise(payload).alias("payload"),
        F.col("_ingestion_timestamp"),
        ts_literal(run_ts).alias("_transformation_timestamp"),
        F.coalesce(F.col("_source"), F.lit("unknown")).alias("_source"),
        parsed.isNull().alias("_ts_fallback"),
        F.col("source_repo"), F.col("_batch_id"), *ORDER,
    )
    out = (out.withColumn("event_date", F.to_date("created_at"))
              .withColumn("event_hour", F.hour("created_at")))
    return out.withColumn("_content_hash", content_hash(include_id_in_hash))


def enrich(silver: DataFrame) -> DataFrame:
    """Payload features, activity category, active flag, time of day."""
    feats = payload_features("event_type", "payload")
    cols = [c.alias(name) for name, c in feats.items()]
    return silver.select(
        "*", *cols,
        activity_category("event_type").alias("activity_category"),
        is_active_contribution("event_type").alias("is_active_contribution"),
        time_of_day("event_hour").alias("time_of_day"),
    )


def to_silver(bronze: DataFrame, run_ts: str = DEFAULT_RUN_TS,
              event_types: Sequence[str] | None = None,
              not_after: str | None = None, dedup_strategy: str = "id") -> DataFrame:
    """The Silver chain: required checks -> first-wins dedup -> type filter
    -> clean -> enrich.  Dedup precedes the type filter, so a disallowed
    first copy suppresses a later allowed one.

    ``dedup_strategy``: ``id`` keeps the first row of each event id;
    ``content_hash`` the first of each content including the id, and
    ``content_hash_no_id`` the first of each content under whatever id."""
    ok = validate.required_ok(bronze, not_after)
    allowed = validate.type_allowed
    if dedup_strategy == "id":
        return enrich(clean(dedup.first_wins(ok).filter(allowed(event_types)), run_ts))
    if dedup_strategy not in ("content_hash", "content_hash_no_id"):
        raise ValueError(f"unknown dedup strategy: {dedup_strategy}")
    rows = content_dedup(clean(ok, run_ts, dedup_strategy == "content_hash"))
    return enrich(rows.filter(allowed(event_types, "event_type")))


def label(bronze: DataFrame, event_types: Sequence[str] | None = None,
          not_after: str | None = None) -> DataFrame:
    """Every Bronze row with its ``_reject_reason`` (NULL = goes to Silver).
    A boolean column ``_late``, if there is one, marks rows that are too late."""
    req = validate.with_required_reason(bronze, not_after)
    if "_late" in bronze.columns:
        req = req.withColumn(validate.REASON, F.when(
            F.col(validate.REASON).isNull() & F.col("_late"), F.lit(validate.LATE)).otherwise(F.col(validate.REASON)))
    ok = req.filter(F.col(validate.REASON).isNull())
    joined = req.join(dedup.first_keys(ok).withColumn("_is_first", F.lit(True)), ["id", *ORDER], "left")
    reason = (F.when(F.col(validate.REASON).isNotNull(), F.col(validate.REASON))
              .when(F.col("_is_first").isNull(), F.lit(validate.DUPLICATE))
              .when(~validate.type_allowed(event_types), F.lit(validate.TYPE_FILTERED)))
    return joined.withColumn(validate.REASON, reason).drop("_is_first")


def quarantine(bronze: DataFrame, event_types: Sequence[str] | None = None,
               not_after: str | None = None) -> DataFrame:
    return label(bronze, event_types, not_after).filter(F.col(validate.REASON).isNotNull())


def batch_quality(bronze: DataFrame, event_types: Sequence[str] | None = None,
                  not_after: str | None = None, by: str = "_batch_id") -> DataFrame:
    """Per batch: total, valid, filtered, and one count per reason."""
    r = F.col(validate.REASON)
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(r.isNull()).alias("valid"),
            F.count_if(r.isNotNull()).alias("filtered"),
            F.count_if(r.isin(*validate.REQUIRED_REASONS)).alias("invalid"),
            F.count_if(r == validate.DUPLICATE).alias("duplicates"),
            F.count_if(r == validate.TYPE_FILTERED).alias("type_filtered")]
    return label(bronze, event_types, not_after).groupBy(by).agg(*aggs)


def reason_counts(bronze: DataFrame, event_types: Sequence[str] | None = None,
                  not_after: str | None = None) -> DataFrame:
    return (quarantine(bronze, event_types, not_after)
            .groupBy(validate.REASON).agg(F.count(F.lit(1)).alias("n_rows")))


def content_dedup(silver_like: DataFrame) -> DataFrame:
    """First-wins by ``_content_hash`` (documented content strategy)."""
    return dedup.first_wins(silver_like, "_content_hash")


def with_day_name(silver: DataFrame) -> DataFrame:
    return silver.withColumn("day_name", day_name("created_at"))
