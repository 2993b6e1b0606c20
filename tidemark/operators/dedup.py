"""Deduplication: first-wins by arrival order, by content, and order-free."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.schemas import ORDER


def first_wins(df: DataFrame, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """Keep the row that is first in ``order`` per ``key``.

    ``row_number() = 1`` lets Catalyst plan a partial WindowGroupLimit before
    the shuffle, so every map task forwards at most one row per key: a hot
    key with millions of copies costs one row per task, not one giant group.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_keys(df: DataFrame, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """(key, order) of each key's first row.  A plain min-aggregate with a
    map-side partial step, so hot keys are combined before the shuffle."""
    return df.groupBy(key).agg(F.min(F.struct(*order)).alias("_o")).select(key, "_o.*")


def later_copies(df: DataFrame, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """Rows that lose to an earlier row with the same key.

    Anti-join on (key, order): a hot key spreads over many tasks because its
    rows differ in ``order``.
    """
    return df.join(first_keys(df, key, order), [key, *order], "left_anti")


def drop_identical(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Order-free dedup; only for rows that are identical on ``subset`` (the
    survivor is unspecified otherwise)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def duplicate_count(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows, key groups (all NULL keys form one group) and duplicate rows."""
    k = F.col(key)
    groups = F.count_distinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), groups.cast("long").alias("n_keys"))
            .withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys")))
