"""Streams with bounded state: dedup and windows in Spark's state store.

Each epoch of the feed is split by the time that the epochs before it had
reached, less a delay.  Events on time go through two streams with a watermark:
``dropDuplicatesWithinWatermark`` on the id, whose state holds the ids of the last
delay only, and a windowed aggregation in update mode.  Late events, and those
without a usable time, can't be told apart from copies by such a state: they are
few, and are looked up in the id index instead (``operators.incremental``), which
is scanned beside their ids and never shuffled.  So nothing is dropped, and what
an epoch costs does not grow with the history.

The streams run over each epoch's files as one micro-batch, so that their
watermark is where the epochs before it ended and no event on time is behind it.
A retried epoch writes the same rows under other file names; the state drops them.

A copy that comes under another time than its original, on time and later than
the delay, is not known any more: ids are expected to keep their time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import dedup, incremental
from tidemark.plans.sinks import read_or_empty
from tidemark.session import configure, discard, materialize, work_dir
from tidemark.sources.testdata import DEFAULT_RUN_TS, dirty_bronze
from tidemark.streaming.events import EPOCH, run_available_now, with_event_time, feed, each_batch

ROWS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("_batch_id", T.StringType()), T.StructField("event_time", T.TimestampType())])
IDS = T.StructType([T.StructField("event_id", T.StringType()), T.StructField(EPOCH, T.LongType()),
                    T.StructField("_bucket", T.IntegerType())])
HIGH = T.StructType([T.StructField("high", T.TimestampType()), T.StructField(EPOCH, T.LongType())])


def _without_known(spark: SparkSession, rows: DataFrame, indexes: list[DataFrame], scratch: str) -> DataFrame:
    """``rows`` (stored) whose id no index holds."""
    asked = materialize(rows.select(F.col("id").alias("event_id"), incremental.id_bucket("id").alias("_bucket"))
                        .distinct(), f"{scratch}-asked")
    found = incremental.known_ids(indexes[0], asked)
    for index in indexes[1:]:
        found = found.unionByName(incremental.known_ids(index, asked))
    known = materialize(found.distinct(), f"{scratch}-known")
    return rows.join(known.withColumnRenamed("event_id", "id"), "id", "left_anti")


class StatefulFeed:
    """One feed under ``root``: ``firsts`` (each id on time once), ``late`` (the
    others, once) and ``windows`` (counts as they were updated)."""

    def __init__(self, spark: SparkSession, root: str, delay: str, duration: str, slide: str | None = None,
                 by: tuple[str, ...] = ()):
        self.spark, self.root, self.delay, self.by = spark, root, delay, by
        self.window = (duration, slide) if slide else (duration,)
        #: Progress of the dedup stream's last micro-batch of each epoch.
        self.progress: list[dict] = []

    def run(self, bronze_stream: DataFrame, run_ts: str = DEFAULT_RUN_TS) -> None:
        """Take in everything that ``bronze_stream`` has."""
        each_batch(bronze_stream, lambda batch, epoch: self._epoch(with_event_time(batch, run_ts), epoch),
                   f"{self.root}/checkpoint")

    def _index(self, lane: str, last: int) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/ids-{lane}", IDS).where(F.col(EPOCH) <= last).drop(EPOCH)

    def _add_ids(self, rows: DataFrame, lane: str, epoch: int) -> None:
        ids = rows.select(F.col("id").alias("event_id"), incremental.id_bucket("id").alias("_bucket"))
        ids.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{self.root}/ids-{lane}/{EPOCH}={epoch}")

    def _epoch(self, batch: DataFrame, epoch: int) -> None:
        spark, root, scratch = self.spark, self.root, f"{self.root}/scratch-{epoch}"
        highs = read_or_empty(spark, f"{root}/high", HIGH).where(F.col(EPOCH) < epoch)
        high = highs.agg(F.max("high").alias("high")).first()["high"]  # a row an epoch
        behind = F.col("event_time") < F.lit(high).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")
        firsts = dedup.first_wins(batch).select(
            "id", F.col("type").alias("event_type"), "_batch_id", "event_time",
            (F.col("_ts_fallback") | F.coalesce(behind, F.lit(False))).alias("late"))
        firsts = materialize(firsts, f"{scratch}/firsts")
        on_time = _without_known(spark, firsts.where("not late").drop("late"), [self._index("late", epoch - 1)], f"{scratch}/on")
        on_time = materialize(on_time, f"{scratch}/on-time")
        self._add_ids(on_time, "on-time", epoch)
        late = _without_known(spark, firsts.where("late").drop("late"),
                              [self._index("on-time", epoch), self._index("late", epoch - 1)], f"{scratch}/late")
        late = materialize(late, f"{scratch}/late-rows")
        self._add_ids(late, "late", epoch)
        late.write.mode("overwrite").parquet(f"{root}/late/{EPOCH}={epoch}")
        on_time.agg(F.max("event_time").alias("high")).write.mode("overwrite").parquet(f"{root}/high/{EPOCH}={epoch}")
        on_time.write.mode("overwrite").parquet(f"{root}/on-time/{EPOCH}={epoch}")
        self._advance()
        discard(spark, scratch)

    def _advance(self) -> None:
        """Let the two streams take in what has come."""
        spark, root = self.spark, self.root
        rows = spark.readStream.schema(ROWS).parquet(f"{root}/on-time/*").withWatermark("event_time", self.delay)
        self.progress.append(run_available_now(rows.dropDuplicatesWithinWatermark(["id"]), f"{root}/firsts",
                                               f"{root}/checkpoint-dedup"))
        firsts = spark.readStream.schema(ROWS).parquet(f"{root}/firsts/*").withWatermark("event_time", self.delay)
        counts = firsts.groupBy(F.window("event_time", *self.window).alias("w"), *self.by).agg(
            F.count(F.lit(1)).alias("event_count"))
        run_available_now(counts, f"{root}/windows", f"{root}/checkpoint-windows", "update")

    def events(self) -> DataFrame:
        """Each event once, late ones included."""
        parts = [read_or_empty(self.spark, f"{self.root}/{x}/*", ROWS) for x in ("firsts", "late")]
        return parts[0].unionByName(parts[1])

    def counts(self) -> DataFrame:
        """Event counts by window: the last update of each, and the late events."""
        spark = self.spark
        window = T.StructType([T.StructField(c, T.TimestampType()) for c in ("start", "end")])
        keys = [T.StructField("w", window), *[ROWS[c] for c in self.by]]
        updates = read_or_empty(spark, f"{self.root}/windows", T.StructType(
            [*keys, T.StructField("event_count", T.LongType()), T.StructField(EPOCH, T.LongType())]))
        names = ["w", *self.by]
        last = updates.groupBy(*names).agg(F.max_by("event_count", EPOCH).alias("event_count"))
        late = read_or_empty(spark, f"{self.root}/late/*", ROWS).groupBy(
            F.window("event_time", *self.window).alias("w"), *self.by).agg(F.count(F.lit(1)).alias("event_count"))
        late = late.withColumn("w", F.col("w").cast(window))
        return last.unionByName(late).groupBy(*names).agg(F.sum("event_count").alias("event_count")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *self.by, "event_count")


def over_events(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS, delay: str = "1 hour",
                duration: str = "25 minutes", slide: str = "10 minutes") -> StatefulFeed:
    """The driver's events, sent as several files out of time order and some of
    them again, through a stateful feed."""
    root = work_dir(configure(spark), "stateful", uuid.uuid4().hex)
    stateful = StatefulFeed(spark, root, delay, duration, slide, ("event_type",))
    feed(spark, sf_dir, f"{root}/feed", lambda stream: stateful.run(dirty_bronze(stream, run_ts), run_ts))
    return stateful
