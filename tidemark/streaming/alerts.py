"""Error alarms on a stream of run records.

Runs come as a file stream; failures are counted per window of end time with a
watermark, so that the state holds the windows of the last ``delay`` only.  Each
micro-batch writes the windows that it changed, so an alarm is out as soon as the
threshold is passed.  A run record that is later than ``delay`` behind the latest
end time doesn't count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import as_wall_clock
from tidemark.operators.health import ALERT_THRESHOLD, ALERT_WINDOW
from tidemark.plans.sinks import read_or_empty
from tidemark.session import configure, work_dir
from tidemark.streaming.events import EPOCH, run_available_now

_WINDOW = T.StructType([T.StructField(c, T.TimestampType()) for c in ("start", "end")])
UPDATES = T.StructType([T.StructField("w", _WINDOW), T.StructField("n_failed", T.LongType()),
                        T.StructField("n_runs", T.LongType()), T.StructField(EPOCH, T.LongType())])


def count_failures(runs: DataFrame, out: str, checkpoint: str, window: str = ALERT_WINDOW,
                   delay: str = "15 minutes") -> dict | None:
    """Run a stream of run records to the end of what there is; writes the windows
    that each micro-batch changed."""
    counts = runs.withWatermark("end_time", delay).groupBy(F.window("end_time", window).alias("w")).agg(
        F.count_if(F.col("status") == "failed").alias("n_failed"), F.count(F.lit(1)).alias("n_runs"))
    return run_available_now(counts, out, checkpoint, "update")


def alerts(spark: SparkSession, out: str, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """Windows with more than ``threshold`` failures, by their last update."""
    last = read_or_empty(spark, out, UPDATES).groupBy("w").agg(
        F.max_by(F.struct("n_failed", "n_runs"), EPOCH).alias("c"))
    return last.where(F.col("c.n_failed") > threshold).select(
        as_wall_clock("w.start").alias("window_start"), as_wall_clock("w.end").alias("window_end"),
        "c.n_failed", "c.n_runs")


def over_runs(runs: DataFrame, bounds: tuple[str, ...]) -> DataFrame:
    """A run log, sent in files between the given end times, one micro-batch each."""
    spark = configure(runs.sparkSession)
    root = work_dir(spark, "alerts", uuid.uuid4().hex)
    runs = runs.select("run_id", "end_time", "status")
    part = sum((F.col("end_time") >= F.to_timestamp(F.lit(b))).cast("int") for b in bounds)
    for k in range(len(bounds) + 1):
        runs.where(part == k).coalesce(1).write.mode("append").json(f"{root}/runs")
    stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).json(f"{root}/runs")
    count_failures(stream, f"{root}/windows", f"{root}/checkpoint")
    return alerts(spark, f"{root}/windows")
