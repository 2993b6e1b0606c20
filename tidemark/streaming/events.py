"""Streaming Bronze -> deduplicated events -> windowed counts.

Sources are file streams (new landing files become micro-batches).  Sinks go
through ``foreachBatch`` and write each epoch to its own partition with
overwrite, so a retried epoch replaces its own output: exactly-once on top of
the checkpointed source offsets.  Queries run with ``availableNow``: everything
present is processed in bounded micro-batches, then the query stops, which is
how a scheduled incremental job runs a stream.

Dedup is exact however late a copy or an event comes: the first copy of an id
in arrival order survives in its micro-batch, and ids of earlier epochs are
anti-joined.  The table of ids takes the place of stream state, so there is no
watermark that could drop rows; an event older than the times seen before it
(less a delay) is kept and recorded as late.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import parse_event_time, ts_literal
from tidemark.operators import dedup, validate
from tidemark.plans.sinks import read_or_empty
from tidemark.session import configure, work_dir
from tidemark.sources.testdata import DEFAULT_RUN_TS, dirty_bronze, spread_events

EPOCH = "_epoch"
EVENTS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("repo_name", T.StringType()), T.StructField("_batch_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()), T.StructField("_ts_fallback", T.BooleanType()),
    T.StructField("late", T.BooleanType()), T.StructField(EPOCH, T.LongType())])
#: The slice of event time that windows are made of: every window here starts
#: and ends on its bounds.
PANE = "15 minutes"
#: Sketches have 2^12 registers: a standard error of about 1.6 %.
SKETCH_BITS, SKETCH_ERROR = 12, 0.016
PANES = T.StructType([
    T.StructField("pane", T.TimestampType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_count", T.LongType()), T.StructField("high", T.TimestampType()),
    T.StructField(EPOCH, T.LongType())])


def with_event_time(bronze: DataFrame, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    """Valid Bronze rows with ``event_time`` (fallback: the run timestamp)."""
    parsed = parse_event_time("created_at")
    return (validate.required_ok(bronze)
            .withColumn("event_time", F.coalesce(parsed, ts_literal(run_ts)))
            .withColumn("_ts_fallback", parsed.isNull()))


def pane_counts(events: DataFrame) -> DataFrame:
    """Counts per pane (PANE of event time) and event type, and the latest parsed
    time: what tumbling and sliding windows are summed up from."""
    return events.groupBy(F.window("event_time", PANE).getField("start").alias("pane"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max(F.when(~F.col("_ts_fallback"), F.col("event_time"))).alias("high"))


def _minutes(interval: str) -> float:
    number, unit = interval.split()
    return float(number) * {"second": 1 / 60, "minute": 1, "hour": 60, "day": 1440, "week": 10080}[unit.rstrip("s")]


def windowed_counts(panes: DataFrame, duration: str, slide: str | None = None,
                    by: tuple[str, ...] = ()) -> DataFrame:
    """Event counts per tumbling (or sliding) window, and ``by``, from panes of
    all epochs: each event was counted in one of them, so counts add up.  Windows
    have to start and end on the bounds of panes; for others see ``stateful``."""
    for length in (duration, slide or duration):
        if _minutes(length) % _minutes(PANE):
            raise ValueError(f"{length} is no multiple of {PANE}")
    w = F.window("pane", duration, slide) if slide else F.window("pane", duration)
    return (panes.groupBy(w.alias("w"), *by)
            .agg(F.sum("event_count").alias("event_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    "event_count"))


def run_available_now(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> dict | None:
    """Run a streaming DataFrame to completion over the available input,
    writing every epoch to ``out/_epoch=<id>`` (idempotent on retry).  Returns the
    progress of the last micro-batch."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{EPOCH}={epoch_id}")

    return each_batch(df, write, checkpoint, mode)


def each_batch(df: DataFrame, write, checkpoint: str, mode: str = "append") -> dict | None:
    q = (df.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q.lastProgress


def dedup_to_table(bronze_stream: DataFrame, root: str, run_ts: str = DEFAULT_RUN_TS,
                   delay: str = "1 hour") -> None:
    """Run a Bronze stream into ``root``: ``events`` (each id once), ``panes``
    (the counts that an epoch adds), ``pairs`` (the dates and repositories that
    it saw, once each) and ``sketches`` (a sketch of them a date)."""
    spark = bronze_stream.sparkSession

    def each(batch: DataFrame, epoch: int) -> None:
        before = F.col(EPOCH) < epoch
        known = read_or_empty(spark, f"{root}/events", EVENTS).where(before).select("id")
        high = read_or_empty(spark, f"{root}/panes", PANES).where(before).agg(F.max("high")).scalar()
        firsts = dedup.first_wins(with_event_time(batch, run_ts)).join(known, "id", "left_anti")
        late = ~F.col("_ts_fallback") & (F.col("event_time") < high - F.expr(f"INTERVAL {delay}"))
        rows = firsts.select("id", F.col("type").alias("event_type"), F.col("repo.name").alias("repo_name"),
                             "_batch_id", "event_time", "_ts_fallback",
                             F.coalesce(late, F.lit(False)).alias("late"))
        rows.write.mode("overwrite").parquet(f"{root}/events/{EPOCH}={epoch}")
        done = read_or_empty(spark, f"{root}/events/{EPOCH}={epoch}", T.StructType(EVENTS.fields[:-1]))
        pane_counts(done).write.mode("overwrite").parquet(f"{root}/panes/{EPOCH}={epoch}")
        done.select(F.to_date("event_time").alias("event_date"), "repo_name").distinct() \
            .write.mode("overwrite").parquet(f"{root}/pairs/{EPOCH}={epoch}")
        done.groupBy(F.to_date("event_time").alias("event_date")).agg(
            F.hll_sketch_agg("repo_name", SKETCH_BITS).alias("repos")) \
            .write.mode("overwrite").parquet(f"{root}/sketches/{EPOCH}={epoch}")

    each_batch(bronze_stream, each, f"{root}/checkpoint")


def daily_distinct(pairs: DataFrame) -> DataFrame:
    """Exact distinct repositories per day from the pairs of all epochs."""
    return pairs.groupBy("event_date").agg(F.count_distinct("repo_name").alias("active_repos_count"))


def daily_distinct_sketch(sketches: DataFrame) -> DataFrame:
    """Approximate distinct repositories per day, from a sketch a day and epoch:
    SKETCH_BITS bound a sketch's size, however many repositories there are."""
    return sketches.groupBy("event_date").agg(
        F.hll_sketch_estimate(F.hll_union_agg("repos")).alias("active_repos_estimate"))


# -- the driver's events as a stream of several files, out of time order ------

# Fixed rule (shared with the SQL oracle): the file in which an event arrives.
FEED_FILES = 5
FALLBACK_MODS = (101, 149, 151)
RESENT_MOD = 20


def feed_file() -> F.Column:
    fallback = F.lit(False)
    for m in FALLBACK_MODS:
        fallback = fallback | (F.pmod("event_id", F.lit(m)) == 0)
    return F.when(fallback, F.lit(0)).otherwise(F.pmod(F.dayofmonth("ts") * 3, F.lit(FEED_FILES)))


def feed(spark: SparkSession, sf_dir: str, path: str, take_in: Callable[[DataFrame], None]) -> None:
    """``events`` as FEED_FILES appends, days out of order and rows without a
    usable time first, and one more append that sends some of them again.

    ``take_in`` gets the stream after each append: an append is one micro-batch,
    in however many files it was written, so epochs grow with it and not in number."""
    events = spread_events(spark, sf_dir)
    appends = [feed_file() == k for k in range(FEED_FILES)] + [F.pmod("event_id", F.lit(RESENT_MOD)) == 0]
    for which in appends:
        events.where(which).write.mode("append").parquet(path)
        take_in(spark.readStream.schema(events.schema).parquet(path))


_RUNS: dict[tuple, str] = {}


def stream_run(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> str:
    """The folder of one streaming run over the feed (once a session and input)."""
    key = (spark.sparkContext.applicationId, sf_dir, run_ts)
    if key not in _RUNS:
        root = work_dir(configure(spark), "streams", uuid.uuid4().hex)
        feed(spark, sf_dir, f"{root}/feed", lambda stream: dedup_to_table(dirty_bronze(stream, run_ts), root, run_ts))
        _RUNS[key] = root
    return _RUNS[key]


def stream_events(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    return read_or_empty(spark, f"{stream_run(spark, sf_dir, run_ts)}/events", EVENTS)


def stream_windows(spark: SparkSession, sf_dir: str, duration: str, slide: str | None = None,
                   by: tuple[str, ...] = (), run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    panes = read_or_empty(spark, f"{stream_run(spark, sf_dir, run_ts)}/panes", PANES)
    return windowed_counts(panes, duration, slide, by).withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def stream_daily_distinct(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    return daily_distinct(spark.read.parquet(f"{stream_run(spark, sf_dir, run_ts)}/pairs"))


def stream_daily_sketches(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    """Exact and estimated distinct repositories a day, and whether the estimate
    is within four standard errors (at least one)."""
    root = stream_run(spark, sf_dir, run_ts)
    n = F.col("active_repos_count")
    bound = F.greatest(F.lit(1.0), 4 * SKETCH_ERROR * n)
    return daily_distinct(spark.read.parquet(f"{root}/pairs")).join(
        daily_distinct_sketch(spark.read.parquet(f"{root}/sketches")), "event_date").select(
        "event_date", "active_repos_count", (F.abs(F.col("active_repos_estimate") - n) <= bound).alias("within_bound"))


def stream_to_layers(spark: SparkSession, bronze_stream: DataFrame, root: str, run_ts: str,
                     checkpoint: str, pipeline: str = "events", lateness_seconds: int = 0,
                     event_types=None, before_commit=None) -> None:
    """Streaming ingest into Bronze / Silver / Gold with exactly-once batches.

    Each micro-batch is handed to the incremental batch run under the batch id
    ``e<epoch>``: labels, first-wins Silver (a batch window is allowed inside
    foreachBatch), anti-join against committed ids, Gold, and the control-row
    commit.  A retried epoch runs the same batch id again, which replaces its
    version of the batch, so output is exactly-once.  ``before_commit`` is
    called when an epoch has written its layers and nothing is visible yet.
    """
    from tidemark.plans.incremental_run import run_batch

    def each(batch: DataFrame, epoch_id: int) -> None:
        stats = run_batch(spark, batch, root, f"e{epoch_id:010d}", run_ts, pipeline,
                          event_types, lateness_seconds, before_commit=before_commit)
        if stats["status"] != "success":
            raise RuntimeError(f"epoch {epoch_id} failed: {stats['error']}")

    each_batch(bronze_stream, each, checkpoint)
