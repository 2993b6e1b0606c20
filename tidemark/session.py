"""Session helpers: the engine's required settings and a shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in the package assumes.  They are runtime SQL confs, so
# they can be applied to a session someone else built (the driver, a notebook).
RUNTIME_CONF = {
    # Timestamps are parsed to instants and reported on the UTC wall clock.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed ones,
    # switch to broadcast joins when a side turns out small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An object with a key twice is valid JSON: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Partition values such as _batch_id='2024-01-05' stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Re-running a batch replaces only that batch's partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to ``spark``."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks (no UI, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The shared folder is read from the session.  Only a local-mode session
    without one gets a private folder (as in tests); a cluster session without
    the setting is an error, since executors cannot share a machine-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        # spark.checkpoint.dir is a core setting (read-only at runtime); the
        # context's checkpoint folder is the runtime equivalent.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = spark.sparkContext.getCheckpointDir()
    path = "/".join([base.rstrip("/"), *parts]) if parts else base
    return path


def materialize(df, path: str | None = None):
    """Cut lineage: write ``df`` once as Parquet to the shared checkpoint folder
    and return a DataFrame that reads it back.  Used where several scalars or
    tables are derived from the same expensive intermediate, so the
    intermediate is computed once and each consumer reads only its columns."""
    path = path or work_dir(df.sparkSession, "materialized", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a work folder that nothing will read any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
