"""Top-N rankings, top-k per group, latest row per key.

Ties are broken deterministically: count descending, then key ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.timefns import as_wall_clock


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Global top-N.  ``orderBy().limit()`` plans TakeOrderedAndProject: each
    task keeps its own N best rows, so only N rows per task reach the final
    merge.  The rank is numbered over those N rows only."""
    best = df.orderBy(*order).limit(n)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_k_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group.  Catalyst plans a partial WindowGroupLimit before
    the shuffle for ``row_number() <= k``; callers feed pre-aggregated counts."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_repos(repo_metrics: DataFrame, n: int = 10) -> DataFrame:
    return top_n(repo_metrics, [F.desc("total_events"), F.asc("repo_name")], n)


def top_contributors(contributor_metrics: DataFrame, n: int = 10) -> DataFrame:
    return top_n(contributor_metrics, [F.desc("total_contributions"), F.asc("actor_login")], n)


def latest_per_key(silver: DataFrame, key: str = "repo_name") -> DataFrame:
    """Latest event per key (latest created_at, then largest event_id).

    A max over a struct: decomposable, so hot keys are combined map-side.
    """
    best = F.max(F.struct("created_at", "event_id", "event_type"))
    return (silver.groupBy(key).agg(best.alias("_b"))
            .select(key, F.col("_b.event_id").alias("event_id"),
                    F.col("_b.event_type").alias("event_type"),
                    as_wall_clock(F.col("_b.created_at")).alias("created_at")))
