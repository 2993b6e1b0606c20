"""Validation: required fields, repo sanity, timestamp check, type allow-list.

Rows are never dropped silently and a bad row never aborts a batch: every
rejected row carries a ``_reject_reason``, and an incremental run writes it to
the quarantine layer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.timefns import parse_event_time, ts_literal

REASON = "_reject_reason"
# Reasons in the order they are tested; the first that applies is reported.
REQUIRED_REASONS = (
    "corrupt_record", "missing_id", "null_id", "missing_type", "null_type", "missing_created_at",
    "missing_repo", "repo_not_object", "missing_repo_id", "missing_repo_name",
    "null_repo_name", "future_timestamp",
)
# Reasons of an incremental run: at or before the watermark; in Silver already.
LATE = "late"
SEEN = "already_in_silver"
DUPLICATE = "duplicate"
TYPE_FILTERED = "type_filtered"
ALL_REASONS = REQUIRED_REASONS + (LATE, DUPLICATE, TYPE_FILTERED, SEEN)


def _absent(key: str) -> Column:
    return F.coalesce(F.array_contains(F.col("_absent_keys"), F.lit(key)), F.lit(False))


def required_reason(not_after: str | None = None) -> Column:
    """Reason a Bronze row fails the per-row checks, NULL when it passes.

    Presence of id / type / created_at / repo (absent differs from null: a
    null created_at is kept and later replaced by the run timestamp), a usable
    repo object, and optionally no event time after ``not_after``.
    """
    expr = (
        F.when(_absent("_corrupt_record"), "corrupt_record")
        .when(_absent("id"), "missing_id")
        .when(F.col("id").isNull(), "null_id")
        .when(_absent("type"), "missing_type")
        .when(F.col("type").isNull(), "null_type")
        .when(_absent("created_at"), "missing_created_at")
        .when(_absent("repo"), "missing_repo")
        .when(F.col("repo").isNull(), "repo_not_object")
        .when(_absent("repo.id"), "missing_repo_id")
        .when(_absent("repo.name"), "missing_repo_name")
        .when(F.col("repo.name").isNull(), "null_repo_name")
    )
    if not_after is not None:
        expr = expr.when(parse_event_time("created_at") > ts_literal(not_after), "future_timestamp")
    return expr


def type_allowed(event_types: Sequence[str] | None, col: str = "type") -> Column:
    """Allow-list predicate; ``None`` or an empty list keeps every type."""
    if not event_types:
        return F.lit(True)
    return F.coalesce(F.col(col).isin(*event_types), F.lit(False))


def with_required_reason(bronze: DataFrame, not_after: str | None = None) -> DataFrame:
    return bronze.withColumn(REASON, required_reason(not_after))


def required_ok(bronze: DataFrame, not_after: str | None = None) -> DataFrame:
    """Bronze rows that pass the per-row checks."""
    return bronze.filter(required_reason(not_after).isNull())
