"""Metrics document as JSON Lines, the shape consumers read.

Every key of every gold table is one line, ``{"section", "key", "value"}``, built
with ``to_json`` where the row is and written in parallel.  A consumer that
wants one nested document folds the sections it needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Section, gold table, key column or columns, value columns.  Where several
# columns make the key, the value has them too.
SECTIONS = (
    ("summary", "summary", None, ("total_events", "calculation_timestamp")),
    ("event_types", "event_type_counts", "event_type", ("event_count",)),
    ("repos", "repo_metrics", "repo_name",
     ("total_events", "unique_contributors", "active_contributions", "first_event", "last_event")),
    ("contributors", "contributor_metrics", "actor_login",
     ("total_contributions", "repos_count", "last_activity")),
    ("daily", "daily_series", "event_date", ("event_count", "active_repos_count")),
    ("top_repos", "top_repos", "rank", ("repo_name", "total_events")),
    ("top_contributors", "top_contributors", "rank", ("actor_login", "total_contributions")),
    ("event_types_daily", "type_by_date", ("event_type", "event_date"), ("event_type", "event_date", "event_count")),
    ("repo_types", "repo_top_types", ("repo_name", "rank"), ("repo_name", "rank", "event_type", "event_count")),
    ("contributor_repos", "contributor_repos", ("actor_login", "repo_name"), ("actor_login", "repo_name")),
    ("contributor_types", "contributor_top_types", ("actor_login", "rank"),
     ("actor_login", "rank", "event_type", "event_count")),
    ("daily_types", "daily_top_types", ("event_date", "rank"), ("event_date", "rank", "event_type", "event_count")),
    ("hourly", "hourly_series", "hour_key", ("event_count",)),
    ("hourly_types", "hourly_types", ("hour_key", "event_type"), ("hour_key", "event_type", "event_count")),
    ("activity", "activity_totals", None, ("total_events", "active_contributions")),
    ("activity_categories", "activity_category", "activity_category", ("event_count",)),
    ("time_of_day", "time_of_day", "time_of_day", ("event_count",)),
    ("pushes", "push_metrics", None, ("total_pushes", "total_commits", "avg_commits_per_push")),
    ("pull_requests", "pr_metrics", None, ("total_prs", "merged_prs")),
    ("pr_actions", "pr_actions", "pr_action", ("event_count",)),
)


def document_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """(section, key, value) rows of the tables given; ``value`` is JSON text."""
    parts = []
    for section, table, key, values in SECTIONS:
        if table not in tables:
            continue
        df = tables[table]
        kinds = dict(df.dtypes)
        at = F.concat_ws("|", *key) if isinstance(key, tuple) else F.col(key).cast("string") if key else F.lit("all")
        cols = [(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if kinds[c].startswith("timestamp") else F.col(c)).alias(c)
                for c in values]
        parts.append(df.select(F.lit(section).alias("section"),
                               at.alias("key"),
                               F.to_json(F.struct(*cols)).alias("value")))
    return reduce(DataFrame.unionByName, parts)


def write_document(tables: dict[str, DataFrame], path: str) -> None:
    """One JSON line a key, written by as many tasks as there are."""
    document_lines(tables).write.mode("overwrite").json(path)
