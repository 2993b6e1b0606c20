"""Control table (checkpoints) and run history, as append-only tables.

A checkpoint is a row appended to the control table AFTER the batch's data
is written; readers trust only batches that have a successful control row
(see operators.incremental.committed).  Nothing is updated in place, so a
crash between the data write and the control append leaves the batch
uncommitted and the next run simply redoes it: it writes a version of its own,
and readers take the version that was committed last.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.sinks import read_or_empty
from tidemark.schemas import CONTROL, RETENTION, RUN

RETIRED = "retired"


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Control rows; a table that is not there yet means bootstrap (no rows)."""
    return read_or_empty(spark, path, CONTROL)


def succeeded(control: DataFrame, pipeline: str) -> DataFrame:
    return control.filter((F.col("pipeline") == pipeline) & (F.col("status") == "success"))


def committed_versions(control: DataFrame, pipeline: str) -> DataFrame:
    """The run whose version of a batch counts, the one committed last, and when
    the batch was committed first: batches stay in that order when one is run again."""
    at = F.col("execution_timestamp")
    last = F.max(F.struct(at.alias("at"), "run_id"))
    return (succeeded(control, pipeline).groupBy("_batch_id").agg(last.alias("_l"), F.min(at).alias("first_at"))
            .select("_batch_id", F.col("_l.run_id").alias("_run_id"), F.col("_l.at").alias("committed_at"), "first_at"))


def watermark_rows(control: DataFrame, pipeline: str, versions: DataFrame) -> DataFrame:
    """(_batch_id, source_repo, watermark) that the given versions committed."""
    ok = succeeded(control, pipeline).where(F.col("source_repo").isNotNull())
    return ok.withColumnRenamed("run_id", "_run_id").join(
        versions.select("_batch_id", "_run_id"), ["_batch_id", "_run_id"], "left_semi").select(
            "_batch_id", "source_repo", F.col("last_processed_timestamp").alias("watermark"))


def last_watermarks(control: DataFrame, pipeline: str) -> DataFrame:
    """(source_repo, watermark) of the committed versions; no row = bootstrap."""
    return watermark_rows(control, pipeline, committed_versions(control, pipeline)).groupBy("source_repo").agg(
        F.max("watermark").alias("watermark"))


def global_watermark(control: DataFrame, pipeline: str) -> DataFrame:
    return last_watermarks(control, pipeline).agg(F.max("watermark").alias("watermark"))


def success_rows(spark: SparkSession, pipeline: str, run_id: str, batch_id: str, watermarks: DataFrame,
                 execution_ts: dt.datetime, metadata: dict | None = None) -> DataFrame:
    """The success rows of a batch: one for the batch (no source), and one per
    source in ``watermarks`` (watermark + records processed)."""
    meta = F.create_map(*[x for k, v in (metadata or {}).items() for x in (F.lit(k), F.lit(str(v)))]) \
        if metadata else F.lit(None).cast("map<string,string>")
    batch = spark.createDataFrame([(None, None, int((metadata or {}).get("records", 0)))],
                                  "source_repo string, watermark timestamp, records_processed long")
    return batch.unionByName(watermarks.select("source_repo", "watermark", "records_processed")).select(
        F.lit(pipeline).alias("pipeline"), "source_repo",
        F.col("watermark").alias("last_processed_timestamp"),
        F.col("records_processed").cast("long").alias("records_processed"),
        F.lit(execution_ts).cast("timestamp").alias("execution_timestamp"),
        F.lit("success").alias("status"), F.lit(run_id).alias("run_id"),
        F.lit(batch_id).alias("_batch_id"), F.lit(None).cast("string").alias("error_message"),
        meta.alias("metadata"))


def read_retention(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RETENTION)


def retired(retention: DataFrame, pipeline: str, layer: str) -> DataFrame:
    """(_batch_id, _run_id) of the versions that a layer's readers see no more."""
    return retention.where((F.col("pipeline") == pipeline) & (F.col("layer") == layer)
                           & (F.col("status") == RETIRED)).select("_batch_id", "_run_id")


def commit(rows: DataFrame, path: str) -> None:
    """Append the success rows of a batch, or of several at once: one row a
    source and batch in one small file, so all of it becomes visible or nothing."""
    rows.coalesce(1).write.mode("append").parquet(path)


def mark_failed(spark: SparkSession, path: str, pipeline: str, run_id: str, batch_id: str,
                error: str, execution_ts: dt.datetime) -> None:
    """Append a failure row; it carries no watermark, so nothing advances."""
    row = [(pipeline, None, None, 0, execution_ts, "failed", run_id, batch_id, error, None)]
    spark.createDataFrame(row, CONTROL).write.mode("append").parquet(path)


def stats(control: DataFrame, pipeline: str) -> DataFrame:
    """Latest control state: last status, last success, records, watermark;
    ``never_run`` when there is no row."""
    c = control.filter(F.col("pipeline") == pipeline)
    last = F.max_by(F.struct("status", "error_message", "run_id"), "execution_timestamp")
    ok = F.col("status") == "success"
    return c.agg(
        F.count(F.lit(1)).alias("control_rows"),
        last.alias("_last"),
        F.max(F.when(ok, F.col("execution_timestamp"))).alias("last_success"),
        F.max(F.when(ok, F.col("last_processed_timestamp"))).alias("last_processed"),
    ).select(
        F.when(F.col("control_rows") == 0, F.lit("never_run")).otherwise(F.col("_last.status"))
        .alias("status"),
        F.col("_last.error_message").alias("last_error"), F.col("_last.run_id").alias("last_run_id"),
        "last_success", "last_processed", "control_rows")


class RunTracker:
    """Run history rows (JSON Lines), one per run, appended at the end."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def start(self, now: dt.datetime) -> str:
        self.run_id, self.start_time = str(uuid.uuid4()), now
        return self.run_id

    def end(self, now: dt.datetime, records: int, status: str, error: str | None,
            source_repo: str | None = None) -> None:
        dur = (now - self.start_time).total_seconds()
        row = [(self.run_id, self.start_time, now, dur, records, status, error, source_repo)]
        self.spark.createDataFrame(row, RUN).write.mode("append").json(self.path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUN, "json")
