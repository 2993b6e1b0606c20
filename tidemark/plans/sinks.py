"""Layer sinks and readers.

Every layer is a folder of versions, ``_batch_id=<batch>/_run_id=<run>``.  A
run writes its own version and nothing else; the commit row in the control
table makes it visible, and a batch that is run again replaces the earlier
version by committing a later one, also when the new one is empty.  Readers
see committed versions only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

VERSION = ("_batch_id", "_run_id")


def version_path(path: str, batch_id: str, run_id: str) -> str:
    return f"{path}/_batch_id={batch_id}/_run_id={run_id}"


def write_version(df: DataFrame, path: str, batch_id: str, run_id: str, by: tuple[str, ...] = ()) -> None:
    """One batch version of a layer, in folders ``by`` some columns if asked.
    Otherwise an empty one has a file with the schema.  A retried write replaces
    its own files."""
    df.drop(*VERSION).write.mode("overwrite").partitionBy(*by).parquet(version_path(path, batch_id, run_id))


def read_version(spark: SparkSession, path: str, schema: T.StructType, batch_id: str, run_id: str) -> DataFrame:
    """The version that a run wrote, before it is committed."""
    fields = T.StructType([f for f in schema.fields if f.name not in VERSION])
    return spark.read.schema(fields).parquet(version_path(path, batch_id, run_id)).withColumn(
        "_batch_id", F.lit(batch_id))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table, or no rows where nothing has been written yet.  Any other
    fault, such as a permission or a network error, is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str) -> None:
    """Flat tables only (no arrays/maps/variants)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType, committed: DataFrame,
               scope: str = "all", as_of_batch: str | None = None, without: DataFrame | None = None) -> DataFrame:
    """Read the committed versions of a layer, but those ``without``.

    ``committed`` (``state.committed_versions``) has ``_batch_id``, ``_run_id``,
    ``committed_at`` and ``first_at``.  ``scope='latest'`` reads the batch committed
    last, ``'all'`` every batch; ``as_of_batch`` the batches up to that one, in
    the order in which they were committed first.
    """
    if scope not in ("all", "latest"):
        raise ValueError(f"invalid scope: {scope}")
    if as_of_batch is not None:
        at = committed.where(F.col("_batch_id") == as_of_batch).agg(F.max("first_at")).scalar()
        committed = committed.where(F.col("first_at") <= at)
    if scope == "latest":
        committed = committed.where(F.col("_batch_id") == committed.agg(
            F.max_by("_batch_id", F.struct("committed_at", "_batch_id"))).scalar())
    if without is not None:
        committed = committed.join(without, list(VERSION), "left_anti")
    fields = [f for f in schema.fields if f.name not in VERSION]
    whole = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in VERSION]])
    return read_or_empty(spark, path, whole).join(
        committed.select(*VERSION), list(VERSION), "left_semi").drop("_run_id")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate per-source Bronze frames (UNION ALL by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
