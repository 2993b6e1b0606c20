"""Ad-hoc consumer queries: filters, distributions, KPIs, insights.

These re-express the notebook/loader computations as Spark plans.  Global
scalars (minimum, maximum, totals) are scalar subqueries, never cross joins
and never driver-side loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.timefns import as_wall_clock, day_name, ts_literal, weekday_rank
from tidemark.operators import gold
from tidemark.session import materialize

HIST_BINS = 20


def filter_events(df: DataFrame, event_types: Sequence[str] | None = None,
                  repos: Sequence[str] | None = None, start_date: str | None = None,
                  end_date: str | None = None) -> DataFrame:
    """Types AND repos AND date range, both ends inclusive; an empty list
    means no filter; a bare end date means midnight at its start."""
    out = df
    if event_types:
        out = out.filter(F.col("event_type").isin(*event_types))
    if repos:
        out = out.filter(F.col("repo_name").isin(*repos))
    if start_date:
        out = out.filter(F.col("created_at") >= ts_literal(start_date))
    if end_date:
        out = out.filter(F.col("created_at") <= ts_literal(end_date))
    return out


def repo_stats(silver: DataFrame) -> DataFrame:
    """Per repo: events, distinct actors (an empty login counts), first, last."""
    return silver.groupBy("repo_name").agg(
        F.count("event_id").alias("event_count"),
        F.count_distinct("actor_login").alias("actor_nunique"),
        as_wall_clock(F.min("created_at")).alias("first_event"),
        as_wall_clock(F.max("created_at")).alias("last_event"))


def contributor_stats(silver: DataFrame) -> DataFrame:
    """Per login (NULL dropped, empty kept): events, distinct repos, modal type
    (smallest type on a tie)."""
    return silver.filter(F.col("actor_login").isNotNull()).groupBy("actor_login").agg(
        F.count("event_id").alias("event_count"),
        F.count_distinct("repo_name").alias("repo_nunique"),
        F.mode("event_type", deterministic=True).alias("modal_event_type"))


def hourly_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_hour").agg(F.count(F.lit(1)).alias("event_count"))


def daily_trends(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.to_date("created_at").alias("event_date")).agg(
        F.count("event_id").alias("event_count"),
        F.count_distinct("repo_name").alias("repo_nunique"),
        F.count_distinct("actor_login").alias("actor_nunique"))


def hour_floor_series(silver: DataFrame) -> DataFrame:
    return silver.groupBy(as_wall_clock(F.date_trunc("HOUR", "created_at")).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("event_count"))


def weekday_hour_heatmap(silver: DataFrame) -> DataFrame:
    """Weekday x hour counts, all 24 hour columns, zero filled, Monday = 1."""
    hours = list(range(24))
    piv = (silver.groupBy(day_name("created_at").alias("day_name"),
                          weekday_rank("created_at").alias("day_rank"))
           .pivot("event_hour", hours).agg(F.count(F.lit(1))).na.fill(0))
    return piv.select("day_name", "day_rank",
                      *[F.col(str(h)).cast("long").alias(f"h{h:02d}") for h in hours])


def type_share(silver: DataFrame) -> DataFrame:
    """Share of each type.  The total is a window over the aggregated counts
    (one row per type), so Silver is aggregated once."""
    counts = gold.event_type_counts(silver)
    total = F.sum("event_count").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.round(100.0 * F.col("event_count") / total, 4))


def contribution_histogram(silver: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Contributors per bin of their contribution count: ``bins`` equal bins
    over [min, max], the max folded into the last bin, one bin if min = max."""
    per = materialize(gold.contributor_metrics(silver).select(F.col("total_contributions").alias("x")))
    ends = per.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    per = per.withColumn("_e", ends)
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / F.lit(bins)
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - lo) * F.lit(bins) / (hi - lo)) + 1, F.lit(bins))).cast("int")
    return (per.groupBy(b.alias("bin"), "_e").agg(F.count(F.lit(1)).alias("contributors"))
            .withColumn("bin_lower", F.round(lo + (F.col("bin") - 1) * width, 6))
            .withColumn("bin_upper", F.round(lo + F.col("bin") * width, 6)).drop("_e"))


def kpis(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("repo_name").alias("repos"),
        F.count_distinct(gold.login()).alias("contributors"),
        F.count_distinct("event_type").alias("event_types"))


def filtered_summary(silver: DataFrame, event_types: Sequence[str], repos: Sequence[str]) -> DataFrame:
    """Dashboard filter (types AND repos), count per type plus the filtered
    totals (events, distinct repos, distinct logins with '' counted)."""
    f = silver.filter(F.col("event_type").isin(*event_types) & F.col("repo_name").isin(*repos))
    # one pass: per-type rows and the grand total (ROLLUP); the total is then
    # spread over the per-type rows by a window over the few result rows
    r = f.rollup("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("repo_name").alias("repos"),
        F.count_distinct("actor_login").alias("contributors"), F.grouping_id().alias("_g"))
    everything = Window.partitionBy()

    def total(c: str) -> Column:
        return F.max(F.when(F.col("_g") == 1, F.col(c))).over(everything)

    return (r.select("event_type", "event_count", total("event_count").alias("total_events"),
                     total("repos").alias("repos"), total("contributors").alias("contributors"), "_g")
            .filter(F.col("_g") == 0).drop("_g"))


def distinct_values(silver: DataFrame, col: str) -> DataFrame:
    return silver.select(col).distinct()


def date_spine(silver: DataFrame) -> DataFrame:
    """Every calendar date from the first to the last event date."""
    rng = silver.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return rng.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("event_date"))


def peak_hour(silver: DataFrame) -> DataFrame:
    """Most frequent hour and time of day (smallest value on a tie)."""
    return silver.agg(F.mode("event_hour", deterministic=True).alias("peak_hour"),
                      F.mode("time_of_day", deterministic=True).alias("peak_time_of_day"))


def key_insights(silver: DataFrame) -> DataFrame:
    """One row: volume, top type and share, top repo, top contributor.

    For a run, ``insights_from`` reads the written gold tables.  Here the few
    columns they need are written once, so Silver is derived once."""
    narrow = materialize(silver.select("event_type", "repo_name", "actor_login", "created_at",
                                       "is_active_contribution"))
    return insights_from(gold.event_type_counts(narrow), gold.repo_metrics(narrow),
                         gold.contributor_metrics(narrow))


def insights_from(types: DataFrame, repos: DataFrame, contrib: DataFrame) -> DataFrame:
    """Key insights from the event-type, repo and contributor gold tables: one
    aggregate of each.  The first row of a ranking is a minimum of a struct."""
    def first(count: str, name: str, *more: str) -> Column:
        best = F.min(F.struct((-F.col(count)).alias("_c"), F.col(name).alias("name"), *more))
        return F.struct((-best["_c"]).alias("count"), best["name"].alias("name"),
                        *[best[m].alias(m) for m in more])

    def one(df: DataFrame, **cols: Column) -> Column:
        return df.agg(F.struct(*[c.alias(k) for k, c in cols.items()])).scalar()

    rows = F.count(F.lit(1))
    got = types.sparkSession.range(1).select(
        one(types, total=F.sum("event_count"), top=first("event_count", "event_type")).alias("t"),
        one(repos, n=rows, top=first("total_events", "repo_name", "unique_contributors")).alias("r"),
        one(contrib, n=rows, top=first("total_contributions", "actor_login", "repos_count")).alias("c"))
    return got.select(
        F.col("t.total").alias("total_events"), F.col("r.n").alias("n_repos"),
        F.col("c.n").alias("n_contributors"), F.col("t.top.name").alias("top_event_type"),
        F.col("t.top.count").alias("top_event_type_count"),
        F.round(100.0 * F.col("t.top.count") / F.col("t.total"), 1).alias("top_event_type_pct"),
        F.col("r.top.name").alias("top_repo"), F.col("r.top.count").alias("top_repo_events"),
        F.col("r.top.unique_contributors").alias("top_repo_contributors"),
        F.col("c.top.name").alias("top_contributor"),
        F.col("c.top.count").alias("top_contributor_contributions"),
        F.col("c.top.repos_count").alias("top_contributor_repos"))


def batch_date_range(silver: DataFrame, by: str = "_batch_id") -> DataFrame:
    return silver.groupBy(by).agg(as_wall_clock(F.min("created_at")).alias("min_created_at"),
                                  as_wall_clock(F.max("created_at")).alias("max_created_at"))
