"""Gold metrics over Silver (group-by counts, distincts, series, rankings).

All outputs are flat tables; nested documents are produced only at export
(tidemark.plans.export).  Every aggregate here is decomposable or a distinct
count, so Spark plans a map-side partial aggregate before each shuffle: a hot
repo or contributor is combined per task before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.timefns import as_wall_clock, hour_key, ts_literal
from tidemark.operators.ranking import top_k_per_group
from tidemark.sources.testdata import DEFAULT_RUN_TS

# Names of the gold tables, selectable in metrics_bundle (A18).
CALCULATIONS = ("event_types", "repos", "contributors", "time_series", "activity")


# Small cuboid: Silver rolled up once to these cells.  Its size follows hours and
# types, not rows: every table by type, date, hour or activity is a roll-up of
# it.  Tables by repository or contributor would not shrink, so they read Silver.
CUBE_DIMS = ("event_type", "event_date", "hour_key", "activity_category", "time_of_day",
             "is_active_contribution", "pr_action", "pr_merged")


def _cells(silver: DataFrame, dims: tuple[str, ...], *sums: Column) -> DataFrame:
    return silver.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), *sums, F.min("created_at").alias("first_at"),
                                     F.max("created_at").alias("last_at"))


def small_cuboid(silver: DataFrame) -> DataFrame:
    """Pre-aggregate Silver to CUBE_DIMS cells (count, commits, first, last)."""
    return _cells(silver.withColumn("hour_key", hour_key("created_at")), CUBE_DIMS, F.sum(
        F.when(F.col("event_type") == "PushEvent", F.coalesce(F.col("push_commits_count"), F.lit(0)))).cast("long").alias("commits"))


def _cube(df: DataFrame) -> bool:
    return "n" in df.columns and "first_at" in df.columns


def _cnt(df: DataFrame) -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("long") if _cube(df) else F.count(F.lit(1))


def _cnt_if(df: DataFrame, cond: Column) -> Column:
    if _cube(df):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return F.count_if(cond)


def _tmin(df: DataFrame) -> Column:
    return F.min("first_at" if _cube(df) else "created_at")


def _tmax(df: DataFrame) -> Column:
    return F.max("last_at" if _cube(df) else "created_at")


def _hour(df: DataFrame) -> Column:
    return F.col("hour_key") if _cube(df) else hour_key("created_at")


def _commits(df: DataFrame) -> Column:
    if _cube(df):
        return F.coalesce(F.sum("commits"), F.lit(0)).cast("long")
    return F.sum(F.coalesce(F.col("push_commits_count"), F.lit(0))).cast("long")


def _n(df: DataFrame) -> Column:
    return _cnt(df).alias("event_count")


def login() -> Column:
    """Actor login with empty text read as missing."""
    return F.nullif(F.col("actor_login"), F.lit(""))


def event_type_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type").agg(_n(silver))


def repo_metrics(silver: DataFrame) -> DataFrame:
    total, active = _cnt(silver), _cnt_if(silver, F.col("is_active_contribution"))
    return (silver.groupBy("repo_name").agg(
        total.alias("total_events"),
        F.count_distinct(login()).alias("unique_contributors"),
        active.alias("active_contributions"),
        as_wall_clock(_tmin(silver)).alias("first_event"),
        as_wall_clock(_tmax(silver)).alias("last_event"))
        .withColumn("engagement_rate",
                    F.round(100.0 * F.col("active_contributions") / F.col("total_events"), 1)))


def _type_counts(silver: DataFrame, key: str | Column, key_name: str) -> DataFrame:
    return silver.groupBy(F.col(key).alias(key_name) if isinstance(key, str) else key.alias(key_name),
                          "event_type").agg(_n(silver))


def repo_top_types(silver: DataFrame, k: int = 5) -> DataFrame:
    counts = _type_counts(silver, "repo_name", "repo_name")
    return top_k_per_group(counts, "repo_name", [F.desc("event_count"), F.asc("event_type")], k)


def contributors(silver: DataFrame) -> DataFrame:
    """Silver rows with a usable actor login."""
    return silver.filter(login().isNotNull())


def contributor_metrics(silver: DataFrame) -> DataFrame:
    return contributors(silver).groupBy("actor_login").agg(
        _cnt(silver).alias("total_contributions"),
        F.count_distinct("repo_name").alias("repos_count"),
        as_wall_clock(_tmax(silver)).alias("last_activity"))


def contributor_repos(silver: DataFrame) -> DataFrame:
    """(contributor, repo) pairs as rows: never one unbounded list per key."""
    return contributors(silver).select("actor_login", "repo_name").distinct()


def contributor_top_types(silver: DataFrame, k: int = 3) -> DataFrame:
    counts = _type_counts(contributors(silver), "actor_login", "actor_login")
    return top_k_per_group(counts, "actor_login", [F.desc("event_count"), F.asc("event_type")], k)


def daily_series(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date").agg(
        _n(silver), F.count_distinct("repo_name").alias("active_repos_count"))


def daily_top_types(silver: DataFrame, k: int = 3) -> DataFrame:
    counts = _type_counts(silver, "event_date", "event_date")
    return top_k_per_group(counts, "event_date", [F.desc("event_count"), F.asc("event_type")], k)


def hourly_series(silver: DataFrame) -> DataFrame:
    return silver.groupBy(_hour(silver).alias("hour_key")).agg(_n(silver))


def hourly_types(silver: DataFrame) -> DataFrame:
    return silver.groupBy(_hour(silver).alias("hour_key"), "event_type").agg(_n(silver))


def activity_totals(silver: DataFrame) -> DataFrame:
    return silver.agg(_cnt(silver).alias("total_events"),
                      _cnt_if(silver, F.col("is_active_contribution")).alias("active_contributions"))


def activity_by_category(silver: DataFrame) -> DataFrame:
    return silver.groupBy("activity_category").agg(_n(silver))


def activity_by_time_of_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy("time_of_day").agg(_n(silver))


def push_metrics(silver: DataFrame) -> DataFrame:
    """One row, or no row when the batch has no pushes."""
    is_push = F.col("event_type") == "PushEvent"
    return (silver.filter(is_push)
            .agg(_cnt(silver).alias("total_pushes"), _commits(silver).alias("total_commits"))
            .filter(F.col("total_pushes") > 0)
            .withColumn("avg_commits_per_push",
                        F.round(F.col("total_commits") / F.col("total_pushes"), 6)))


def pr_metrics(silver: DataFrame) -> DataFrame:
    is_pr = F.col("event_type") == "PullRequestEvent"
    return (silver.filter(is_pr)
            .agg(_cnt(silver).alias("total_prs"),
                 _cnt_if(silver, F.coalesce(F.col("pr_merged"), F.lit(False))).alias("merged_prs"))
            .filter(F.col("total_prs") > 0))


def pr_actions(silver: DataFrame) -> DataFrame:
    """PR count by action; a NULL action is a group of its own."""
    return silver.filter(F.col("event_type") == "PullRequestEvent").groupBy("pr_action").agg(_n(silver))


def activity_single_pass(silver: DataFrame) -> DataFrame:
    """A11 + A14 + A15 as ONE global aggregate (one scan, conditional sums)."""
    is_push = F.col("event_type") == "PushEvent"
    is_pr = F.col("event_type") == "PullRequestEvent"
    commits = (F.sum("commits") if _cube(silver) else
               F.sum(F.when(is_push, F.coalesce(F.col("push_commits_count"), F.lit(0)))))
    return silver.agg(
        _cnt(silver).alias("total_events"),
        _cnt_if(silver, F.col("is_active_contribution")).alias("active_contributions"),
        _cnt_if(silver, is_push).alias("total_pushes"),
        commits.cast("long").alias("total_commits"),
        _cnt_if(silver, is_pr).alias("total_prs"),
        _cnt_if(silver, is_pr & F.coalesce(F.col("pr_merged"), F.lit(False))).alias("merged_prs"))


def summary(silver: DataFrame, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    return silver.agg(_cnt(silver).alias("total_events")).withColumn(
        "calculation_timestamp", as_wall_clock(ts_literal(run_ts)))


def type_by_date(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type", "event_date").agg(_n(silver))


# Tables of each calculation group: from the small cuboid, and from Silver.
FROM_CUBE = {
    "event_types": {"event_type_counts": event_type_counts, "type_by_date": type_by_date},
    "repos": {},
    "contributors": {},
    "time_series": {"daily_top_types": daily_top_types, "hourly_series": hourly_series,
                    "hourly_types": hourly_types},
    "activity": {"activity_totals": activity_totals, "activity_category": activity_by_category,
                 "time_of_day": activity_by_time_of_day, "push_metrics": push_metrics,
                 "pr_metrics": pr_metrics, "pr_actions": pr_actions},
}
FROM_SILVER = {
    "event_types": {},
    "repos": {"repo_metrics": repo_metrics, "repo_top_types": repo_top_types},
    "contributors": {"contributor_metrics": contributor_metrics, "contributor_repos": contributor_repos,
                     "contributor_top_types": contributor_top_types},
    "time_series": {"daily_series": daily_series},
    "activity": {},
}
# The tables that rankings are made of.
RANKED = ("repo_metrics", "contributor_metrics")


def base_tables(silver: DataFrame, cube: DataFrame, calculations=CALCULATIONS,
                run_ts: str = DEFAULT_RUN_TS, days: DataFrame | None = None) -> dict[str, DataFrame]:
    """The selected gold tables but the rankings.  ``cube`` is the small cuboid,
    or Silver itself; ``days`` has the days' repositories where ``silver`` has not."""
    out: dict[str, DataFrame] = {"summary": summary(cube, run_ts)}
    for name in calculations:
        out |= {table: fn(cube) for table, fn in FROM_CUBE[name].items()}
        out |= {table: fn(days if days is not None and fn is daily_series else silver)
                for table, fn in FROM_SILVER[name].items()}
    return out


# Partial aggregates of a batch, beside its small cuboid.  Cells add up over
# batches, and as they keep both sides of every distinct count, merging them
# gives the exact all-time tables.
CUBOID = "cells"
STATE_DIMS = {
    "contributions": ("repo_name", "actor_login", "event_type", "is_active_contribution"),
    "active_repos": ("event_date", "repo_name"),
}


def state_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The partial aggregates of a batch that grow with repositories and
    contributors, not with events."""
    return {name: _cells(silver, dims) for name, dims in STATE_DIMS.items()}


def merged_tables(states: dict[str, DataFrame], calculations=CALCULATIONS, run_ts: str = DEFAULT_RUN_TS,
                  top_n: int = 10) -> dict[str, DataFrame]:
    """All Gold tables from the partial aggregates of any number of batches, as
    plans; Silver is not read."""
    tables = base_tables(states["contributions"], states[CUBOID], calculations, run_ts, states["active_repos"])
    return tables | rankings(tables, top_n)


def rankings(tables: dict[str, DataFrame], top_n: int = 10) -> dict[str, DataFrame]:
    from tidemark.operators import ranking

    out = {}
    if "repo_metrics" in tables:
        out["top_repos"] = ranking.top_repos(tables["repo_metrics"], top_n)
    if "contributor_metrics" in tables:
        out["top_contributors"] = ranking.top_contributors(tables["contributor_metrics"], top_n)
    return out


def metrics_bundle(silver: DataFrame, calculations=CALCULATIONS, run_ts: str = DEFAULT_RUN_TS,
                   top_n: int = 10) -> dict[str, DataFrame]:
    """All gold tables, restricted to the selected calculation groups, as plans
    over Silver.  ``plans.medallion.write_bundle`` writes them with less work."""
    tables = base_tables(silver, silver, calculations, run_ts)
    return tables | rankings(tables, top_n)
