"""One batch run of the medallion layers: Bronze -> Silver -> Gold.

Silver is written once (partitioned by ``_batch_id``, dynamic overwrite, so
a re-run replaces only its own batches) and every Gold table is computed
from the written Silver, not from a re-derivation of it: the expensive
dedup shuffle happens once per run and lineage is cut at the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import gold, silver
from tidemark.schemas import SILVER_BASE, SILVER_FEATURES
from tidemark.session import materialize
from tidemark.sources.testdata import DEFAULT_RUN_TS


#: Gold tables written at a time.
WRITERS = 4


def write_silver(bronze: DataFrame, path: str, run_ts: str = DEFAULT_RUN_TS,
                 event_types: Sequence[str] | None = None) -> None:
    s = silver.to_silver(bronze, run_ts, event_types).select(*SILVER_BASE, *SILVER_FEATURES)
    (s.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch_id").parquet(path))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bundle(silver_rows: DataFrame, calculations: Sequence[str], run_ts: str, top_n: int, cuboid_path: str,
                 write: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame]) -> list[str]:
    """Compute each selected Gold table once and write it.

    Counts by type, date, hour and so on come from one small cuboid; tables by
    repository and contributor scan the written Silver for their own columns;
    rankings read the written metrics."""
    cube = materialize(gold.small_cuboid(silver_rows), cuboid_path)
    tables = gold.base_tables(silver_rows, cube, calculations, run_ts)
    write_all(tables, write)
    ranked = gold.rankings({n: read(n) for n in tables if n in gold.RANKED}, top_n)
    write_all(ranked, write)
    return [*tables, *ranked]


def write_all(tables: dict[str, DataFrame], write: Callable[[DataFrame, str], None]) -> None:
    """Independent tables are written side by side: most are small, and one
    after the other they would leave the executors waiting for each other's end."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(write, df, name) for name, df in tables.items()]:
            done.result()


def run_layers(spark: SparkSession, bronze: DataFrame, root: str, run_ts: str = DEFAULT_RUN_TS,
               event_types: Sequence[str] | None = None,
               calculations: Sequence[str] = gold.CALCULATIONS, top_n: int = 10) -> dict[str, DataFrame]:
    """Write Silver, then compute and write every selected Gold table."""
    write_silver(bronze, f"{root}/silver", run_ts, event_types)
    s = read_silver(spark, f"{root}/silver")
    names = write_bundle(s, calculations, run_ts, top_n, f"{root}/cuboid",
                         lambda df, name: df.write.mode("overwrite").parquet(f"{root}/gold/{name}"),
                         lambda name: spark.read.parquet(f"{root}/gold/{name}"))
    return {name: spark.read.parquet(f"{root}/gold/{name}") for name in names}
