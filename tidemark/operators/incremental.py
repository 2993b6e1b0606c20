"""Incremental operators: watermarks, the strict after-watermark predicate,
anti-join against already-processed events, committed-batch restriction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.timefns import parse_event_time

#: Folders of the id index.  Ids are dealt to them by hash.
ID_BUCKETS = 64
#: Ids of a batch that are broadcast (some 15 MB); more are joined by shuffle.
BROADCAST_IDS = 250_000


def watermarks(silver: DataFrame, by: str = "source_repo") -> DataFrame:
    """Per-source watermark: latest event time over surviving rows.  Rows
    whose time fell back to the run timestamp never advance it."""
    real = ~F.col("_ts_fallback")
    return silver.groupBy(by).agg(
        F.max(F.when(real, F.col("created_at"))).alias("watermark"),
        F.count(F.lit(1)).alias("records_processed"))


def advance(previous: DataFrame, new: DataFrame, by: str = "source_repo") -> DataFrame:
    """Watermarks never regress: greatest(previous, new) per source."""
    p = previous.select(by, F.col("watermark").alias("_prev"))
    n = new.select(by, F.col("watermark").alias("_new"))
    return (p.join(n, by, "full")
            .select(by, F.greatest("_prev", "_new").alias("watermark")))


def mark_late(bronze: DataFrame, wm: DataFrame, by: str = "source_repo", flag: str = "_late") -> DataFrame:
    """Bronze rows with a flag: at or before their source's watermark.  Sources
    without a watermark (bootstrap) and rows whose time does not parse are not
    late; the latter are caught by the anti-join against Silver.  The watermark
    table has a row a source; how to join it is left to AQE."""
    side = wm.select(by, F.col("watermark").alias("_wm"))
    late = parse_event_time("created_at") <= F.col("_wm")
    return bronze.join(side, by, "left").withColumn(flag, F.coalesce(late, F.lit(False))).drop("_wm")


def after_watermark(bronze: DataFrame, wm: DataFrame, by: str = "source_repo") -> DataFrame:
    """Bronze rows strictly after their source's watermark (see ``mark_late``)."""
    return mark_late(bronze, wm, by).filter(~F.col("_late")).drop("_late")


def unseen(new_silver: DataFrame, processed: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop events already in Silver: a left anti-join on ``key``.  Both sides
    are hash-partitioned on the key; AQE splits skewed partitions."""
    return new_silver.join(processed.select(key), key, "left_anti")


def id_bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS)).cast("int")


def known_ids(index: DataFrame, ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """The ids of a batch that an id index holds.

    ``index(event_id, _bucket)`` is the history, stored in folders by bucket;
    ``ids(event_id, _bucket)`` are the batch's distinct ids, stored.  Folders
    without an id of the batch are not read.  The ids of a batch with ``most`` at
    most are broadcast, and the history is only scanned beside them.  Those of a
    larger batch never pass the driver: both sides are shuffled once, by id.
    """
    count = {r["_bucket"]: r["count"] for r in ids.groupBy("_bucket").count().collect()}  # a row a folder
    if not count:
        return ids.select("event_id").limit(0)
    side = ids.select("event_id")
    side = F.broadcast(side) if sum(count.values()) <= most else side.hint("shuffle_merge")
    mine = index.where(F.col("_bucket").isin(sorted(count)))
    return mine.join(side, "event_id", "left_semi").select("event_id")


def committed(rows: DataFrame, control: DataFrame, keys=("source_repo", "_batch_id")) -> DataFrame:
    """Rows of committed batches only: left-semi join with successful control rows."""
    ok = control.filter(F.col("status") == "success").select(*keys).distinct()
    return rows.join(ok, list(keys), "left_semi")
