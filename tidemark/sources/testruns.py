"""A run log for the health operators, derived from labelled Bronze rows.

The driver has no run log, so the queries by source use this deterministic
one; the log that ``plans.incremental_run`` writes is read by its own queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import validate


def derived_run_log(labeled: DataFrame) -> DataFrame:
    """A deterministic run log derived from labeled Bronze rows: one run per
    (source_repo, _batch_id).  It starts the day after the batch, plus one
    minute per raw row, lasts 1 s + 0.25 s per raw row, and fails when any
    row failed the per-row checks."""
    r = F.col(validate.REASON)
    agg = labeled.groupBy("source_repo", "_batch_id").agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(r.isNull()).alias("records_processed"),
        F.count_if(r.isin(*validate.REQUIRED_REASONS)).alias("rejected"))
    start_us = (F.unix_micros(F.to_timestamp(F.date_add(F.to_date("_batch_id"), 1)))
                + F.col("raw_rows") * F.lit(60_000_000))
    duration = F.round(F.lit(1.0) + F.col("raw_rows") * F.lit(0.25), 3)
    failed = F.col("rejected") > 0
    return agg.select(
        F.concat_ws("@", "source_repo", "_batch_id").alias("run_id"),
        "source_repo", "_batch_id",
        F.timestamp_micros(start_us).alias("start_time"),
        F.timestamp_micros(start_us + (duration * 1_000_000).cast("long")).alias("end_time"),
        duration.alias("duration_seconds"),
        F.col("records_processed"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("rejected "), F.col("rejected").cast("string"),
                                F.lit(" rows"))).alias("error"),
    )
