"""Retention as a committed delete.

A run decides from the committed batches and their quality counts what becomes
of each batch in a layer, without reading the layer:

1. versions to be archived are copied to the layer's archive (a run that is
   repeated replaces its own copies);
2. one append to the retention table retires the versions: from now on readers
   of the layer don't see them, and readers of the archive see the copies;
3. the retired versions' folders are deleted, and marked as removed.

A run that stops before 2 has changed nothing that is visible, one that stops
after it is finished by the next run: what is retired and not yet removed is
deleted then.  Ids, quality counts and Gold states are kept, so events of a
retired batch that come again are still known.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import health
from tidemark.plans import incremental_run, sinks, state
from tidemark.session import discard

#: Layers under retention, and the rows of a batch in each by the quality table.
LAYERS = {"bronze": "total", "silver": "valid"}
RETIRED, REMOVED = state.RETIRED, "removed"


def archive_of(layer: str) -> str:
    return f"archive/{layer}"


def _planned(spark: SparkSession, root: str, pipeline: str, as_of: str, layers: Sequence[str]) -> DataFrame:
    """(layer, _batch_id, action) of the committed batches.  A batch's date is its
    name, or the day on which it was committed first."""
    batches = incremental_run.committed_batches(spark, root, pipeline).select("_batch_id", "first_at")
    counts = incremental_run.read_quality(spark, root, pipeline).join(batches, "_batch_id").select(
        "_batch_id", F.coalesce(F.try_to_date("_batch_id", "yyyy-MM-dd"), F.to_date("first_at")).alias("batch_date"),
        *[F.col(LAYERS[x]).alias(f"{x}_rows") for x in layers])
    return health.retention_of_batches(counts, layers, as_of).select("layer", "_batch_id", "action")


def run_retention(spark: SparkSession, root: str, as_of: str, pipeline: str = "events",
                  layers: Sequence[str] = tuple(LAYERS), clock=incremental_run._now,
                  before_delete: Callable[[], None] | None = None) -> None:
    """Apply the retention rules as of a time.  ``before_delete`` is called when
    versions are retired and their folders are still there."""
    p = incremental_run.paths(root)
    done = state.read_retention(spark, p["retention"]).where(
        (F.col("pipeline") == pipeline) & (F.col("status") == RETIRED)).select("layer", "_batch_id", "_run_id")
    runs = state.read_control(spark, p["control"]).where(
        (F.col("pipeline") == pipeline) & F.col("source_repo").isNull()).select("_batch_id", F.col("run_id").alias("_run_id"))
    committed = incremental_run.committed_batches(spark, root, pipeline).select("_batch_id", "_run_id")
    plan = _planned(spark, root, pipeline, as_of, layers).where("action <> 'keep'")

    # Of a batch that goes, every version goes, those that were never committed too.
    going = plan.join(runs.distinct(), "_batch_id").select("layer", "_batch_id", "_run_id", "action")
    archived = plan.where("action = 'expire'").select(
        F.concat(F.lit(archive_of("")), "layer").alias("layer"), "_batch_id").join(runs.distinct(), "_batch_id").withColumn(
            "action", F.lit("expire"))
    new = going.unionByName(archived).join(done, ["layer", "_batch_id", "_run_id"], "left_anti")
    new = new.withColumns({"pipeline": F.lit(pipeline), "at": F.lit(clock()).cast("timestamp"), "status": F.lit(RETIRED)})
    # A few rows a batch; kept, as what they say changes with what follows.
    new = spark.createDataFrame(new.select(*state.RETENTION.names).collect(), state.RETENTION)

    for layer in layers:
        schema = incremental_run.BRONZE if layer == "bronze" else incremental_run.silver_schema(spark)
        copied = new.where((F.col("layer") == layer) & (F.col("action") == "archive")).join(
            committed, ["_batch_id", "_run_id"], "left_semi")
        fields = [f for f in schema.fields if f.name not in sinks.VERSION]
        whole = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in sinks.VERSION]])
        rows = sinks.read_or_empty(spark, p[layer], whole).join(copied.select(*sinks.VERSION), list(sinks.VERSION), "left_semi")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*sinks.VERSION).parquet(
            f"{root}/{archive_of(layer)}")
    new.coalesce(1).write.mode("append").parquet(p["retention"])
    if before_delete:
        before_delete()
    _remove(spark, root, pipeline, clock)


def _remove(spark: SparkSession, root: str, pipeline: str, clock) -> None:
    """Delete the folders of versions that are retired and not removed yet."""
    p = incremental_run.paths(root)
    table = state.read_retention(spark, p["retention"]).where(F.col("pipeline") == pipeline)
    key = ["layer", "_batch_id", "_run_id"]
    left = table.where(F.col("status") == RETIRED).join(
        table.where(F.col("status") == REMOVED).select(*key), key, "left_anti").collect()
    for row in left:
        discard(spark, sinks.version_path(f"{root}/{row.layer}", row._batch_id, row._run_id))
    at = clock()
    rows = [tuple({**r.asDict(), "status": REMOVED, "at": at}[c] for c in state.RETENTION.names) for r in left]
    spark.createDataFrame(rows, state.RETENTION).coalesce(1).write.mode("append").parquet(p["retention"])


def read_archive(spark: SparkSession, root: str, layer: str, pipeline: str = "events") -> DataFrame:
    """Rows of the layer's retired batches that are kept in the archive."""
    schema = incremental_run.BRONZE if layer == "bronze" else incremental_run.silver_schema(spark)
    table = state.read_retention(spark, incremental_run.paths(root)["retention"])
    moved = table.where((F.col("pipeline") == pipeline) & (F.col("layer") == layer) & (F.col("action") == "archive")
                        & (F.col("status") == RETIRED)).withColumns({"committed_at": F.col("at"), "first_at": F.col("at")})
    return sinks.read_layer(spark, f"{root}/{archive_of(layer)}", schema, moved,
                            without=state.retired(table, pipeline, archive_of(layer)))
