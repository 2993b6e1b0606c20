"""Gold metrics on the reference's enriched-event fixture."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adhoc, gold, ranking

ROWS = [
    ("1", "PushEvent", "apache/spark", "user1", "2024-01-15T10:00:00Z", 10, True, "code_change", "morning"),
    ("2", "PullRequestEvent", "apache/spark", "user2", "2024-01-15T11:00:00Z", 11, True, "code_review", "morning"),
    ("3", "PushEvent", "delta-io/delta", "user1", "2024-01-15T14:00:00Z", 14, True, "code_change", "afternoon"),
]


@pytest.fixture()
def enriched(spark):
    df = spark.createDataFrame(ROWS, "event_id string, event_type string, repo_name string, actor_login string, "
                                     "created_at string, event_hour int, is_active_contribution boolean, "
                                     "activity_category string, time_of_day string")
    return (df.withColumn("created_at", F.to_timestamp("created_at"))
            .withColumn("event_date", F.to_date("created_at"))
            .withColumn("push_commits_count", F.when(F.col("event_type") == "PushEvent", F.lit(3)))
            .withColumn("pr_merged", F.when(F.col("event_type") == "PullRequestEvent", F.lit(True)))
            .withColumn("pr_action", F.when(F.col("event_type") == "PullRequestEvent", F.lit("opened"))))


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_event_type_counts(enriched):
    assert as_dict(gold.event_type_counts(enriched), "event_type", "event_count") == {
        "PushEvent": 2, "PullRequestEvent": 1}


def test_repo_metrics(enriched):
    m = {r["repo_name"]: r for r in gold.repo_metrics(enriched).collect()}
    assert m["apache/spark"]["total_events"] == 2 and m["apache/spark"]["unique_contributors"] == 2
    assert m["delta-io/delta"]["total_events"] == 1
    assert m["apache/spark"]["first_event"] == datetime(2024, 1, 15, 10)
    assert m["apache/spark"]["engagement_rate"] == 100.0


def test_daily_series(enriched):
    d = gold.daily_series(enriched).collect()
    assert len(d) == 1 and str(d[0]["event_date"]) == "2024-01-15" and d[0]["event_count"] == 3


def test_hourly_series(enriched):
    hs = gold.hourly_series(enriched)
    assert sorted(as_dict(hs, "hour_key", "event_count")) == ["2024-01-15T10", "2024-01-15T11", "2024-01-15T14"]


def test_activity(enriched):
    p = gold.push_metrics(enriched).collect()[0]
    assert (p["total_pushes"], p["total_commits"], p["avg_commits_per_push"]) == (2, 6, 3.0)
    pr = gold.pr_metrics(enriched).collect()[0]
    assert (pr["total_prs"], pr["merged_prs"]) == (1, 1)
    one = gold.activity_single_pass(enriched).collect()[0]
    assert one["total_pushes"] == 2 and one["total_commits"] == 6 and one["merged_prs"] == 1


def test_no_push_gives_no_push_row(enriched):
    assert gold.push_metrics(enriched.filter("event_type <> 'PushEvent'")).count() == 0


def test_rankings_and_ties(enriched):
    top = ranking.top_repos(gold.repo_metrics(enriched), 10).orderBy("rank").collect()
    assert [r["repo_name"] for r in top] == ["apache/spark", "delta-io/delta"]
    tc = ranking.top_contributors(gold.contributor_metrics(enriched), 1).collect()
    assert tc[0]["actor_login"] == "user1"
    tie = ranking.top_k_per_group(gold.type_by_date(enriched), "event_date",
                                  [F.desc("event_count"), F.asc("event_type")], 1).collect()
    assert tie[0]["event_type"] == "PushEvent"


def test_empty_input_gives_empty_tables(enriched):
    empty = enriched.limit(0)
    bundle = gold.metrics_bundle(empty)
    assert bundle["summary"].collect()[0]["total_events"] == 0
    for name in ("event_type_counts", "repo_metrics", "contributor_metrics", "push_metrics", "top_repos"):
        assert bundle[name].count() == 0


def test_key_insights_and_histogram(enriched):
    k = adhoc.key_insights(enriched).collect()[0]
    assert k["top_event_type"] == "PushEvent" and k["top_repo"] == "apache/spark"
    assert k["top_contributor"] == "user1" and k["top_event_type_pct"] == 66.7
    h = adhoc.contribution_histogram(enriched).orderBy("bin").collect()
    assert [(r["bin"], r["contributors"]) for r in h] == [(1, 1), (20, 1)]


def test_filter_inclusive(enriched):
    f = adhoc.filter_events(enriched, ["PushEvent"], None, "2024-01-15T10:00:00Z", "2024-01-15T14:00:00Z")
    assert f.count() == 2
    assert adhoc.filter_events(enriched, [], [], None, "2024-01-15").count() == 0


def test_written_bundle_equals_direct(spark, tmp_dir):
    from tidemark.plans import catalog, medallion
    s = catalog.silver_all(spark, "/root/testdata/sf0.001")
    direct = gold.metrics_bundle(s)
    written = medallion.run_layers(spark, catalog.bronze(spark, "/root/testdata/sf0.001"), tmp_dir)
    assert set(direct) == set(written)
    for name in direct:
        a, b = direct[name], written[name].select(*direct[name].columns)
        assert a.count() == b.count(), name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert spark.read.parquet(f"{tmp_dir}/cuboid").count() <= s.count()


def test_cuboid_tables_of_empty_input(enriched):
    e = enriched.withColumn("push_commits_count", F.lit(None).cast("int")).limit(0)
    bundle = gold.base_tables(e, gold.small_cuboid(e))
    assert bundle["activity_totals"].collect()[0]["total_events"] == 0
    assert bundle["push_metrics"].count() == 0


def test_states_of_batches_merge_to_the_whole(spark):
    from tidemark.operators import silver
    from tidemark.session import materialize
    from tidemark.sources.testdata import bronze_from_dir

    rows = materialize(silver.to_silver(bronze_from_dir(spark, "/root/testdata/sf0.001"), event_types=None))
    batches = [rows.where(F.pmod("_arrival_seq", F.lit(3)) == k) for k in range(3)]
    states = {gold.CUBOID: [gold.small_cuboid(b) for b in batches]}
    states |= {name: [gold.state_tables(b)[name] for b in batches] for name in gold.STATE_DIMS}
    merged = gold.merged_tables({name: a.unionByName(b).unionByName(c) for name, (a, b, c) in states.items()})
    whole = gold.metrics_bundle(rows)
    assert merged.keys() == whole.keys()
    for name in ("repo_metrics", "contributor_repos", "contributor_top_types", "daily_series", "pr_actions"):
        got, want = merged[name], whole[name]
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert gold.merged_tables({n: s[0].where("false") for n, s in states.items()})["repo_metrics"].count() == 0
