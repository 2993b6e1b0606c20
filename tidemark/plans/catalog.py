"""The query catalog: every operator as a (spark, sf_dir) -> DataFrame query
over the driver's tables.  Outputs are flat (scalar columns only); times are
reported as UTC wall-clock TIMESTAMP_NTZ.  Each query has an equivalent SQL
text in ``tidemark.plans.oracle`` with the same column names."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.features import DEFAULT_TYPE_FILTER, time_of_day_rank
from tidemark.functions.timefns import as_wall_clock
from tidemark.operators import adhoc, dedup, gold, health, incremental, profile, ranking, silver, validate
from tidemark.plans import export, incremental_run, retention, sinks, state
from tidemark.session import configure, work_dir
from tidemark.sources import testdata
from tidemark.sources.landing import CORRUPT, bronze_from_raw, read_landing, source_counts
from tidemark.sources.testdata import DEFAULT_RUN_TS, bronze_from_dir
from tidemark.sources.testruns import derived_run_log
from tidemark.streaming import alerts, events as streaming
from tidemark.streaming import stateful

# Fixed parameters of the catalog queries (mirrored in the oracle SQL).
RUN_TS = DEFAULT_RUN_TS
RUN1_LAST_BATCH = "2024-01-15"
FILTER_TYPES = ("PushEvent", "PullRequestEvent")
FILTER_REPOS = tuple(f"org3/repo{k}" for k in range(3, 100, 10))
FILTER_START, FILTER_END = "2024-01-05", "2024-01-20"
SUMMARY_TYPES = ("PushEvent", "IssuesEvent", "WatchEvent")
FRESHNESS_AS_OF = "2024-02-01T12:00:00Z"
RETENTION_AS_OF = "2024-04-15T00:00:00Z"
TOP_N = 10
# All-time Gold tables with a query each: after three runs, and after re-runs.
ALLTIME = ("repo_metrics", "contributor_metrics", "repo_top_types", "daily_series", "hourly_types", "push_metrics",
           "top_contributors")
ALLTIME_RERUN = ("repo_metrics", "daily_series")

Query = Callable[[SparkSession, str], DataFrame]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_dir(configure(spark), sf_dir, RUN_TS)


def silver_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with every event type kept (the input of the gold queries)."""
    return silver.to_silver(bronze(spark, sf_dir), RUN_TS, None)


def _flat_silver(s: DataFrame) -> DataFrame:
    return s.select("event_id", "event_type", as_wall_clock("created_at").alias("created_at"),
                    "repo_id", "repo_name", "repo_url", "actor_id", "actor_login", "event_date",
                    "event_hour", "_ts_fallback", "source_repo", "_batch_id", "_arrival_seq")


# -- Bronze ------------------------------------------------------------------

def q_bronze_rows(spark, d):
    b = bronze(spark, d)
    return b.select("id", "type", "created_at", F.col("repo.id").alias("repo_id"),
                    F.col("repo.name").alias("repo_name"), F.col("repo.url").alias("repo_url"),
                    F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
                    F.to_json("payload").alias("payload_json"), "source_repo", "_batch_id",
                    "_arrival_seq", F.array_join("_absent_keys", ",").alias("absent_keys"), "_source",
                    as_wall_clock("_ingestion_timestamp").alias("ingestion_timestamp"), "_file")


def q_bronze_source_counts(spark, d):
    return bronze(spark, d).groupBy("source_repo").agg(
        F.count(F.lit(1)).alias("raw_events"), F.count_distinct("id").alias("distinct_ids"),
        F.count_distinct("_batch_id").alias("batches"))


# -- Silver ------------------------------------------------------------------

def q_silver_clean(spark, d):
    return _flat_silver(silver_all(spark, d))


def q_silver_type_filtered(spark, d):
    s = silver.to_silver(bronze(spark, d), RUN_TS, DEFAULT_TYPE_FILTER)
    return s.select("event_id", "event_type", "_arrival_seq")


def q_silver_quarantine(spark, d):
    q = silver.quarantine(bronze(spark, d), DEFAULT_TYPE_FILTER)
    return q.select(F.col("id").alias("event_id"), "type", "_batch_id", "_arrival_seq",
                    F.col(validate.REASON).alias("reject_reason"))


def q_batch_quality_stats(spark, d):
    return silver.batch_quality(bronze(spark, d), DEFAULT_TYPE_FILTER)


def q_reject_reasons(spark, d):
    return silver.reason_counts(bronze(spark, d), DEFAULT_TYPE_FILTER).withColumnRenamed(
        validate.REASON, "reject_reason")


def q_dedup_first_wins(spark, d):
    ok = validate.required_ok(bronze(spark, d))
    return dedup.first_wins(ok).select(F.col("id").alias("event_id"), F.col("type").alias("event_type"),
                                       "_arrival_seq")


def q_duplicate_rows(spark, d):
    ok = validate.required_ok(bronze(spark, d))
    return dedup.later_copies(ok).select(F.col("id").alias("event_id"),
                                         F.col("type").alias("event_type"), "_arrival_seq")


def q_content_hash(spark, d):
    return silver_all(spark, d).select("event_id", "_content_hash")


def q_dedup_content_hash(spark, d):
    cleaned = silver.clean(validate.required_ok(bronze(spark, d)), RUN_TS)
    return silver.content_dedup(cleaned).select("event_id", "event_type", "_arrival_seq",
                                                "_content_hash")


def q_duplicate_count(spark, d):
    return dedup.duplicate_count(bronze(spark, d), "id")


def q_silver_push_features(spark, d):
    s = silver_all(spark, d).filter(F.col("event_type") == "PushEvent")
    return s.select("event_id", "push_size", "push_ref", "push_commits_count")


def q_silver_pr_features(spark, d):
    s = silver_all(spark, d).filter(F.col("event_type") == "PullRequestEvent")
    return s.select("event_id", "pr_action", "pr_state", "pr_merged", "pr_additions", "pr_deletions")


def q_silver_issue_features(spark, d):
    s = silver_all(spark, d).filter(F.col("event_type") == "IssuesEvent")
    return s.select("event_id", "issue_action", "issue_state",
                    F.array_join("issue_labels", ",").alias("issue_labels"),
                    F.size("issue_labels").alias("n_labels"))


def q_silver_enriched(spark, d):
    s = silver.with_day_name(silver_all(spark, d))
    return s.select("event_id", "event_type", "activity_category", "is_active_contribution",
                    "time_of_day", "day_name", "watch_action")


# -- Gold --------------------------------------------------------------------

def _gold(fn):
    return lambda spark, d: fn(silver_all(spark, d))


def q_top_repos(spark, d):
    return ranking.top_repos(gold.repo_metrics(silver_all(spark, d)), TOP_N)


def q_top_contributors(spark, d):
    return ranking.top_contributors(gold.contributor_metrics(silver_all(spark, d)), TOP_N)


def q_filtered_events(spark, d):
    f = adhoc.filter_events(silver_all(spark, d), FILTER_TYPES, FILTER_REPOS, FILTER_START, FILTER_END)
    return f.select("event_id", "event_type", "repo_name", as_wall_clock("created_at").alias("created_at"))


def q_filtered_summary(spark, d):
    return adhoc.filtered_summary(silver_all(spark, d), SUMMARY_TYPES, FILTER_REPOS)


def q_distinct_repos(spark, d):
    return adhoc.distinct_values(silver_all(spark, d), "repo_name")


def q_sample_rows(spark, d):
    return _flat_silver(profile.sample_rows(silver_all(spark, d), 5))


# -- Incremental ---------------------------------------------------------------

def _run1_silver(spark, d):
    b = bronze(spark, d).filter(F.col("_batch_id") <= RUN1_LAST_BATCH)
    return silver.to_silver(b, RUN_TS, None)


def _run2_silver(spark, d):
    wm = incremental.watermarks(_run1_silver(spark, d))
    return silver.to_silver(incremental.after_watermark(bronze(spark, d), wm), RUN_TS, None)


def q_watermark_by_source(spark, d):
    wm = incremental.watermarks(_run1_silver(spark, d))
    return wm.select("source_repo", as_wall_clock("watermark").alias("watermark"), "records_processed")


def q_incremental_new_rows(spark, d):
    return _run2_silver(spark, d).select("event_id", "source_repo", "_batch_id",
                                         as_wall_clock("created_at").alias("created_at"))


def q_anti_join_new_events(spark, d):
    new = incremental.unseen(_run2_silver(spark, d), _run1_silver(spark, d))
    return new.select("event_id", "event_type", "_batch_id")


def _runs(spark, d):
    return derived_run_log(silver.label(bronze(spark, d), None))


def q_committed_events(spark, d):
    return incremental.committed(silver_all(spark, d), _runs(spark, d)).select("event_id", "_batch_id")


# -- Health --------------------------------------------------------------------

def q_run_log(spark, d):
    return health.run_log_report(_runs(spark, d))


def q_run_health(spark, d):
    return health.run_health(_runs(spark, d))


def q_freshness(spark, d):
    return health.freshness(_runs(spark, d), FRESHNESS_AS_OF)


def q_run_trend(spark, d):
    return health.run_trend(_runs(spark, d))


def q_error_alerts(spark, d):
    return health.error_alerts(_runs(spark, d))


ALERT_FILES = ("2024-01-08", "2024-01-15", "2024-01-15 00:12:00", "2024-01-24")


def q_stream_error_alerts(spark, d):
    return alerts.over_runs(_runs(spark, d), ALERT_FILES)


def q_retention_plan(spark, d):
    b = bronze(spark, d)
    return health.retention_plan({"bronze": b, "silver": silver.to_silver(b, RUN_TS, None)},
                                 RETENTION_AS_OF)


# -- Streaming -----------------------------------------------------------------

def q_stream_dedup(spark, d):
    return streaming.stream_events(spark, d, RUN_TS).select(F.col("id").alias("event_id"), "_batch_id")


def q_stream_late_rows(spark, d):
    return streaming.stream_events(spark, d, RUN_TS).where("late").select(
        F.col("id").alias("event_id"), as_wall_clock("event_time").alias("event_time"))


def q_stream_hourly_counts(spark, d):
    return streaming.stream_windows(spark, d, "1 hour", None, (), RUN_TS)


def q_stream_hourly_type_counts(spark, d):
    return streaming.stream_windows(spark, d, "1 hour", None, ("event_type",), RUN_TS)


def q_stream_sliding_counts(spark, d):
    return streaming.stream_windows(spark, d, "1 hour", "15 minutes", (), RUN_TS)


_FEEDS: dict[tuple, stateful.StatefulFeed] = {}


def stateful_feed(spark, d):
    """The feed that two queries read, run once a session and input."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FEEDS:
        _FEEDS[key] = stateful.over_events(spark, d, RUN_TS)
    return _FEEDS[key]


def q_stream_dedup_state(spark, d):
    return stateful_feed(spark, d).events().select(F.col("id").alias("event_id"), "_batch_id")


def q_stream_state_windows(spark, d):
    return stateful_feed(spark, d).counts().withColumns({
        c: as_wall_clock(c) for c in ("window_start", "window_end")})


def q_stream_daily_sketches(spark, d):
    return streaming.stream_daily_sketches(spark, d, RUN_TS)


def q_stream_daily_distinct(spark, d):
    return streaming.stream_daily_distinct(spark, d, RUN_TS)


# -- Landing files ---------------------------------------------------------------

_ROOTS: dict[tuple, str] = {}


def _once(spark, d, what: str, make) -> str:
    """A folder that several queries read, made once a session and input."""
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _ROOTS:
        root = work_dir(configure(spark), what, uuid.uuid4().hex)
        make(root)
        _ROOTS[key] = root
    return _ROOTS[key]


def landing(spark, d):
    """Bronze of the events as landing files: indented arrays and JSON Lines."""
    root = _once(spark, d, "landing", lambda r: testdata.write_landing(spark, d, r, RUN_TS))
    return read_landing(spark, f"{root}/arrays", "landing", RUN_TS, pattern="*/*/*.txt").unionByName(
        read_landing(spark, f"{root}/lines", "landing", RUN_TS, pattern="*/*/*.txt", lines=True))


def q_landing_bronze(spark, d):
    return landing(spark, d).select(
        "id", "type", "created_at", F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.col("repo.url").alias("repo_url"), F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"), F.to_json("payload").alias("payload_json"), "source_repo",
        F.array_join("_absent_keys", ",").alias("absent_keys"),
        F.coalesce(F.get_json_object("_raw", "$.public"), F.col("_raw")).alias("unknown_field_or_raw"))


def q_landing_odd_files(spark, d):
    """Each event in a file of its own with something wrong around it: every
    text is an event or a rejected row that keeps it whole."""
    text = F.concat(F.lit('{"id": "'), F.col("event_id"), F.lit('"}'))
    kind = F.pmod("event_id", F.lit(7))
    files = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.array(
        text, F.concat(F.lit("["), text, F.lit("] trailing")), F.concat(text, text), F.concat(F.lit("["), text),
        F.concat(F.lit("# comment\n"), text), F.concat(F.lit("["), text, F.lit("]\n["), text, F.lit("]")),
        F.concat(F.lit("[\n  "), F.regexp_replace(text, "}", ', "id": "x"}'), F.lit("\n]")))[kind].alias("value"))
    raw = files.select("value", F.concat(F.lit("mem://org/repo/"), F.col("event_id"), F.lit(".json")).alias("_file"),
                       F.timestamp_millis(F.lit(0)).alias("_mtime"), F.array(F.lit(0).cast("long")).alias("_at"))
    out = bronze_from_raw(raw, "odd", RUN_TS)
    corrupt = F.array_contains("_absent_keys", CORRUPT)
    return out.select(F.regexp_extract("_file", r"(\d+)\.json", 1).cast("long").alias("event_id"), "id",
                      F.when(corrupt, F.col("_raw")).alias("rejected"))


def q_landing_source_counts(spark, d):
    return source_counts(landing(spark, d))


def q_landing_silver(spark, d):
    return silver.to_silver(landing(spark, d), RUN_TS).select(
        "event_id", "event_type", as_wall_clock("created_at").alias("created_at"), "source_repo")


def q_landing_quarantine(spark, d):
    return silver.quarantine(landing(spark, d), DEFAULT_TYPE_FILTER).select(
        F.col("id").alias("event_id"), "type", "source_repo", F.col(validate.REASON).alias("reject_reason"))


# -- Incremental runs over the layers ----------------------------------------------

FIRST_RUN = dt.datetime(2024, 2, 1)


def clock_of(run: int):
    """The fixed clock of a run: a day later than the one before it, and a
    minute from call to call (start, commit, end)."""
    calls = iter(range(1_000))
    return lambda: FIRST_RUN + dt.timedelta(days=run, minutes=next(calls))


def _three_runs(spark, d, root: str) -> None:
    batches = testdata.incremental_batches(testdata.spread_bronze(spark, d, RUN_TS))
    for k, (batch_id, rows) in enumerate(zip(testdata.BATCHES, batches)):
        stats = incremental_run.run_batch(spark, rows, root, batch_id, RUN_TS, event_types=DEFAULT_TYPE_FILTER,
                                          clock=clock_of(k))
        if stats["status"] != "success":
            raise RuntimeError(stats["error"])
    broken = batches[0].withColumn("id", F.raise_error(F.lit("boom")).cast("string"))
    incremental_run.run_batch(spark, broken, root, "2024-01-31", RUN_TS, clock=clock_of(3))


def runs_root(spark, d):
    """The layers after three runs, and a fourth that failed."""
    return _once(spark, d, "layers", lambda root: _three_runs(spark, d, root))


STOPPED_EPOCH = 1


def stream_layers_root(spark, d):
    """The layers after a scheduled stream over three appends.  Its second run
    stops when the layers are written and no control row is; the next run starts
    from the checkpoint."""
    def stop() -> None:
        raise RuntimeError("stopped")

    def make(root: str) -> None:
        feed = f"{root}/feed"
        for epoch, rows in enumerate(testdata.incremental_batches(testdata.spread_bronze(spark, d, RUN_TS))):
            rows.write.mode("append").parquet(feed)

            def run(before_commit=None):
                stream = spark.readStream.schema(rows.schema).parquet(feed)
                streaming.stream_to_layers(spark, stream, f"{root}/layers", RUN_TS, f"{root}/checkpoint",
                                           event_types=DEFAULT_TYPE_FILTER, before_commit=before_commit)
            if epoch == STOPPED_EPOCH:
                try:
                    run(stop)
                except StreamingQueryException:
                    pass
            run()

    return _once(spark, d, "stream-layers", make) + "/layers"


def q_stream_layers_silver(spark, d):
    return incremental_run.read_silver(spark, stream_layers_root(spark, d)).select(
        "event_id", "event_type", "_batch_id", as_wall_clock("created_at").alias("created_at"))


def q_stream_layers_gold(spark, d):
    return incremental_run.read_gold(spark, stream_layers_root(spark, d), "repo_metrics")


def q_stream_layers_control(spark, d):
    control = state.read_control(spark, incremental_run.paths(stream_layers_root(spark, d))["control"])
    return control.where(F.col("source_repo").isNull()).select("_batch_id", "status", "records_processed")


def rerun_root(spark, d):
    """The layers after three runs, then the first again as it was, and the
    second with other events."""
    def make(root: str) -> None:
        b = testdata.spread_bronze(spark, d, RUN_TS)
        batches = testdata.incremental_batches(b)
        again = [(testdata.BATCHES[0], batches[0]), (testdata.BATCHES[1], testdata.changed_batch(b))]
        for k, (batch_id, rows) in enumerate([*zip(testdata.BATCHES, batches), *again]):
            stats = incremental_run.run_batch(spark, rows, root, batch_id, RUN_TS, event_types=DEFAULT_TYPE_FILTER,
                                              clock=clock_of(k))
            if stats["status"] != "success":
                raise RuntimeError(stats["error"])

    return _once(spark, d, "reruns", make)


def q_incremental_rerun_silver(spark, d):
    return incremental_run.read_silver(spark, rerun_root(spark, d)).select(
        "event_id", "event_type", "_batch_id", as_wall_clock("created_at").alias("created_at"))


def q_incremental_rerun_quarantine(spark, d):
    return incremental_run.read_quarantine(spark, rerun_root(spark, d)).select(
        F.col("id").alias("event_id"), "type", "_batch_id", "_arrival_seq",
        F.col(validate.REASON).alias("reject_reason"))


def q_incremental_run_silver(spark, d):
    return incremental_run.read_silver(spark, runs_root(spark, d)).select(
        "event_id", "event_type", "_batch_id", as_wall_clock("created_at").alias("created_at"))


def q_incremental_run_quarantine(spark, d):
    return incremental_run.read_quarantine(spark, runs_root(spark, d)).select(
        F.col("id").alias("event_id"), "type", "_batch_id", "_arrival_seq",
        F.col(validate.REASON).alias("reject_reason"))


def q_incremental_run_bronze(spark, d):
    return incremental_run.read_bronze(spark, runs_root(spark, d)).select("id", "_batch_id", "_arrival_seq")


def q_incremental_run_quality(spark, d):
    return incremental_run.read_quality(spark, runs_root(spark, d))


def q_incremental_run_watermarks(spark, d):
    control = state.read_control(spark, incremental_run.paths(runs_root(spark, d))["control"])
    return state.last_watermarks(control, "events").select("source_repo", as_wall_clock("watermark").alias("watermark"))


def q_global_watermark(spark, d):
    control = state.read_control(spark, incremental_run.paths(runs_root(spark, d))["control"])
    return state.global_watermark(control, "events").select(as_wall_clock("watermark").alias("watermark"))


def q_layer_latest(spark, d):
    return incremental_run.read_silver(spark, runs_root(spark, d), scope="latest").select("event_id", "_batch_id")


def q_layer_as_of(spark, d):
    return incremental_run.read_silver(spark, runs_root(spark, d), as_of_batch=testdata.BATCHES[1]).select(
        "event_id", "_batch_id")


def q_gold_read_latest(spark, d):
    return incremental_run.read_gold(spark, runs_root(spark, d), "top_repos").drop("_batch_id")


def q_gold_latest_repo_metrics(spark, d):
    return incremental_run.read_gold(spark, runs_root(spark, d), "repo_metrics")


def q_gold_history_daily(spark, d):
    return incremental_run.read_gold(spark, runs_root(spark, d), "daily_series", scope="all")


def q_metrics_document_lines(spark, d):
    root = runs_root(spark, d)
    return export.document_lines({t: incremental_run.read_gold(spark, root, t) for _, t, _, _ in export.SECTIONS})


def _alltime(root_of, table: str) -> Query:
    """An all-time Gold table, merged from the batches' partial aggregates."""
    return lambda spark, d: incremental_run.read_gold_alltime(spark, root_of(spark, d))[table]


def q_gold_csv_repo_metrics(spark, d):
    """A Gold table after its way through CSV files."""
    table = incremental_run.read_gold(spark, runs_root(spark, d), "repo_metrics")
    root = _once(spark, d, "csv", lambda r: sinks.write_csv(table, r))
    return sinks.read_csv(spark, root, table.schema)


def q_layers_bundle(spark, d):
    """Every table that a consumer gets in one bundle, with its rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in incremental_run.load_layers(spark, runs_root(spark, d)).items()]
    return reduce(DataFrame.unionByName, parts)


def q_pipeline_stats(spark, d):
    s = state.stats(state.read_control(spark, incremental_run.paths(runs_root(spark, d))["control"]), "events")
    return s.select("status", F.contains("last_error", F.lit("boom")).alias("error_kept"),
                    as_wall_clock("last_success").alias("last_success"),
                    as_wall_clock("last_processed").alias("last_processed"), "control_rows")


def q_status_summary(spark, d):
    return incremental_run.status_summary(spark, runs_root(spark, d))


def _run_history(spark, d):
    return state.read_runs(spark, incremental_run.paths(runs_root(spark, d))["runs"])


def q_run_history(spark, d):
    return _run_history(spark, d).select(
        as_wall_clock("start_time").alias("start_time"), as_wall_clock("end_time").alias("end_time"),
        "duration_seconds", "records_processed", "status", F.col("error").isNotNull().alias("has_error"))


def q_pipeline_health(spark, d):
    control = state.read_control(spark, incremental_run.paths(runs_root(spark, d))["control"])
    return health.pipeline_health(_run_history(spark, d), control, "events")


def q_run_metrics_daily(spark, d):
    return health.daily_run_metrics(_run_history(spark, d))


def _retention(spark, d):
    quality = incremental_run.read_quality(spark, runs_root(spark, d)).select(
        "_batch_id", F.to_date("_batch_id").alias("batch_date"), F.col("total").alias("bronze_rows"),
        F.col("valid").alias("silver_rows"))
    return health.retention_of_batches(quality, ("bronze", "silver"), RETENTION_AS_OF)


def q_retention_of_batches(spark, d):
    return _retention(spark, d)


def q_retention_applied(spark, d):
    """Bronze after the retention run: rows kept and archived, from what it wrote."""
    root = _once(spark, d, "retained", lambda r: [
        df.write.parquet(f"{r}/{action}") for action, df in health.apply_retention(
            incremental_run.read_bronze(spark, runs_root(spark, d)), _retention(spark, d), "bronze").items()])
    parts = [spark.read.parquet(f"{root}/{a}").groupBy("_batch_id").agg(F.count(F.lit(1)).alias("row_count"))
             .withColumn("place", F.lit(a)) for a in ("keep", "archive")]
    return parts[0].unionByName(parts[1])


LATER_AS_OF = "2025-01-12T00:00:00Z"


def q_retention_run(spark, d):
    """Rows that readers see and rows in the layer's files, after a retention run
    that stopped before it deleted, one that finished it, and one a year later."""
    def stop() -> None:
        raise RuntimeError("stopped")

    def seen(root: str, stage: str) -> None:
        layers = f"{root}/layers"
        frames = {"bronze": incremental_run.read_bronze(spark, layers), "silver": incremental_run.read_silver(spark, layers),
                  "bronze_files": sinks.read_or_empty(spark, f"{layers}/bronze", incremental_run.BRONZE),
                  **{f"{x}_archive": retention.read_archive(spark, layers, x) for x in retention.LAYERS}}
        parts = [df.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("row_count")).withColumn("place", F.lit(place))
                 for place, df in frames.items()]
        reduce(DataFrame.unionByName, parts).withColumn("stage", F.lit(stage)).write.mode("append").parquet(f"{root}/seen")

    def make(root: str) -> None:
        _three_runs(spark, d, f"{root}/layers")  # layers of its own, as it deletes from them
        try:
            retention.run_retention(spark, f"{root}/layers", RETENTION_AS_OF, before_delete=stop)
        except RuntimeError:
            seen(root, "stopped")
        retention.run_retention(spark, f"{root}/layers", RETENTION_AS_OF)
        seen(root, "finished")
        retention.run_retention(spark, f"{root}/layers", LATER_AS_OF)
        seen(root, "later")

    return spark.read.parquet(f"{_once(spark, d, 'retention', make)}/seen")


# -- Ordered outputs, heads, types, plausibility -------------------------------------

def _ordered(df, *order):
    """A small table with its place in the output order."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def q_daily_series_ordered(spark, d):
    return _ordered(gold.daily_series(silver_all(spark, d)), "event_date")


def q_hourly_series_ordered(spark, d):
    return _ordered(gold.hourly_series(silver_all(spark, d)), "hour_key")


def q_event_type_distribution(spark, d):
    return _ordered(gold.event_type_counts(silver_all(spark, d)), F.desc("event_count"), "event_type")


def q_time_of_day_ordered(spark, d):
    return _ordered(gold.activity_by_time_of_day(silver_all(spark, d)), time_of_day_rank("time_of_day"))


def q_repo_head_15(spark, d):
    return ranking.top_n(adhoc.repo_stats(silver_all(spark, d)), [F.desc("event_count"), F.asc("repo_name")], 15)


def q_contributor_head_10(spark, d):
    return ranking.top_n(adhoc.contributor_stats(silver_all(spark, d)),
                         [F.desc("event_count"), F.asc("actor_login")], 10)


def q_shape_types(spark, d):
    return profile.column_types(_flat_silver(silver_all(spark, d)))


KIND_COLUMNS = ("id", "type", "created_at", "repo_id", "repo_name", "repo_url", "actor_id", "actor_login")


def q_bronze_value_kinds(spark, d):
    return profile.value_kinds(bronze(spark, d).select(
        "id", "type", "created_at", F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.col("repo.url").alias("repo_url"), F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login")), KIND_COLUMNS)


def q_silver_lineage(spark, d):
    return silver_all(spark, d).select("event_id", "_source", "_file", *[
        as_wall_clock(c).alias(c.strip("_")) for c in ("_ingestion_timestamp", "_transformation_timestamp")])


def q_dedup_identical(spark, d):
    """Rows that differ in nothing but their arrival, once."""
    return dedup.drop_identical(q_bronze_rows(spark, d).drop("_arrival_seq"))


def q_silver_not_in_future(spark, d):
    s = silver.to_silver(bronze(spark, d), RUN_TS, None, not_after=RUN_TS)
    return s.select("event_id", "event_type", "_arrival_seq")


def q_dedup_content_no_id(spark, d):
    s = silver.to_silver(bronze(spark, d), RUN_TS, None, dedup_strategy="content_hash_no_id")
    return s.select("event_id", "event_type", "_arrival_seq", "_content_hash")


QUERIES: dict[str, Query] = {
    # bronze / sources
    "bronze_rows": q_bronze_rows,
    "bronze_source_counts": q_bronze_source_counts,
    # validation, dedup, silver
    "silver_clean": q_silver_clean,
    "silver_type_filtered": q_silver_type_filtered,
    "silver_quarantine": q_silver_quarantine,
    "batch_quality_stats": q_batch_quality_stats,
    "reject_reasons": q_reject_reasons,
    "dedup_first_wins": q_dedup_first_wins,
    "duplicate_rows": q_duplicate_rows,
    "content_hash": q_content_hash,
    "dedup_content_hash": q_dedup_content_hash,
    "duplicate_count": q_duplicate_count,
    "silver_push_features": q_silver_push_features,
    "silver_pr_features": q_silver_pr_features,
    "silver_issue_features": q_silver_issue_features,
    "silver_enriched": q_silver_enriched,
    # gold
    "event_type_counts": _gold(gold.event_type_counts),
    "repo_metrics": _gold(gold.repo_metrics),
    "repo_top_types": _gold(gold.repo_top_types),
    "contributor_metrics": _gold(gold.contributor_metrics),
    "contributor_repos": _gold(gold.contributor_repos),
    "contributor_top_types": _gold(gold.contributor_top_types),
    "daily_series": _gold(gold.daily_series),
    "daily_top_types": _gold(gold.daily_top_types),
    "hourly_series": _gold(gold.hourly_series),
    "hourly_types": _gold(gold.hourly_types),
    "activity_totals": _gold(gold.activity_totals),
    "activity_category": _gold(gold.activity_by_category),
    "time_of_day": _gold(gold.activity_by_time_of_day),
    "push_metrics": _gold(gold.push_metrics),
    "pr_metrics": _gold(gold.pr_metrics),
    "pr_actions": _gold(gold.pr_actions),
    "activity_single_pass": _gold(gold.activity_single_pass),
    "metrics_summary": _gold(gold.summary),
    "type_by_date": _gold(gold.type_by_date),
    # rankings
    "top_repos": q_top_repos,
    "top_contributors": q_top_contributors,
    "latest_event_per_repo": _gold(ranking.latest_per_key),
    # profiling and ad-hoc
    "null_profile": _gold(profile.null_profile),
    "numeric_profile": _gold(profile.describe),
    "shape_profile": _gold(profile.shape),
    "date_span": _gold(profile.date_span),
    "sample_rows": q_sample_rows,
    "filtered_events": q_filtered_events,
    "adhoc_repo_stats": _gold(adhoc.repo_stats),
    "adhoc_contributor_stats": _gold(adhoc.contributor_stats),
    "hour_distribution": _gold(adhoc.hourly_distribution),
    "daily_trends": _gold(adhoc.daily_trends),
    "hour_floor_series": _gold(adhoc.hour_floor_series),
    "weekday_hour_heatmap": _gold(adhoc.weekday_hour_heatmap),
    "type_share": _gold(adhoc.type_share),
    "contribution_histogram": _gold(adhoc.contribution_histogram),
    "kpis": _gold(adhoc.kpis),
    "filtered_summary": q_filtered_summary,
    "distinct_repos": q_distinct_repos,
    "date_spine": _gold(adhoc.date_spine),
    "peak_hour": _gold(adhoc.peak_hour),
    "key_insights": _gold(adhoc.key_insights),
    "batch_date_range": _gold(adhoc.batch_date_range),
    # incremental
    "watermark_by_source": q_watermark_by_source,
    "incremental_new_rows": q_incremental_new_rows,
    "anti_join_new_events": q_anti_join_new_events,
    "committed_events": q_committed_events,
    # run log and health
    "run_log": q_run_log,
    "run_health": q_run_health,
    "freshness": q_freshness,
    "run_trend": q_run_trend,
    "error_alerts": q_error_alerts,
    "stream_error_alerts": q_stream_error_alerts,
    "retention_plan": q_retention_plan,
    # streaming
    "stream_dedup": q_stream_dedup,
    "stream_late_rows": q_stream_late_rows,
    "stream_dedup_state": q_stream_dedup_state,
    "stream_state_windows": q_stream_state_windows,
    "stream_hourly_type_counts": q_stream_hourly_type_counts,
    "stream_hourly_counts": q_stream_hourly_counts,
    "stream_sliding_counts": q_stream_sliding_counts,
    "stream_daily_distinct_repos": q_stream_daily_distinct,
    "stream_daily_sketches": q_stream_daily_sketches,
    "stream_layers_silver": q_stream_layers_silver,
    "stream_layers_gold": q_stream_layers_gold,
    "stream_layers_control": q_stream_layers_control,
    # landing files
    "landing_bronze": q_landing_bronze,
    "landing_source_counts": q_landing_source_counts,
    "landing_odd_files": q_landing_odd_files,
    "landing_silver": q_landing_silver,
    "landing_quarantine": q_landing_quarantine,
    # layers and state after a sequence of runs
    "incremental_run_bronze": q_incremental_run_bronze,
    "incremental_run_silver": q_incremental_run_silver,
    "incremental_rerun_silver": q_incremental_rerun_silver,
    "incremental_rerun_quarantine": q_incremental_rerun_quarantine,
    "incremental_run_quarantine": q_incremental_run_quarantine,
    "incremental_run_quality": q_incremental_run_quality,
    "incremental_run_watermarks": q_incremental_run_watermarks,
    "global_watermark": q_global_watermark,
    "layer_latest": q_layer_latest,
    "layer_as_of": q_layer_as_of,
    "gold_read_latest": q_gold_read_latest,
    "gold_latest_repo_metrics": q_gold_latest_repo_metrics,
    "gold_history_daily": q_gold_history_daily,
    **{f"gold_alltime_{t}": _alltime(runs_root, t) for t in ALLTIME},
    **{f"gold_alltime_rerun_{t}": _alltime(rerun_root, t) for t in ALLTIME_RERUN},
    "gold_csv_repo_metrics": q_gold_csv_repo_metrics,
    "layers_bundle": q_layers_bundle,
    "metrics_document_lines": q_metrics_document_lines,
    "pipeline_stats": q_pipeline_stats,
    "status_summary": q_status_summary,
    "run_history": q_run_history,
    "pipeline_health": q_pipeline_health,
    "run_metrics_daily": q_run_metrics_daily,
    "retention_of_batches": q_retention_of_batches,
    "retention_applied": q_retention_applied,
    "retention_run": q_retention_run,
    # ordered outputs, heads, types, plausibility, content dedup
    "daily_series_ordered": q_daily_series_ordered,
    "hourly_series_ordered": q_hourly_series_ordered,
    "event_type_distribution": q_event_type_distribution,
    "time_of_day_ordered": q_time_of_day_ordered,
    "repo_head_15": q_repo_head_15,
    "contributor_head_10": q_contributor_head_10,
    "shape_types": q_shape_types,
    "bronze_value_kinds": q_bronze_value_kinds,
    "silver_lineage": q_silver_lineage,
    "dedup_identical": q_dedup_identical,
    "silver_not_in_future": q_silver_not_in_future,
    "dedup_content_no_id": q_dedup_content_no_id,
}
