"""Run log, health, freshness, trend, error alerts, retention planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.timefns import as_wall_clock, ts_literal

# ---------------------------------------------------------------------------
# Fixed values (retention and alarm rules of the reference deployment).
RETENTION_RULES = {
    # layer: ((min_age_days, action), ...) checked from the oldest rule down
    "bronze": ((365, "expire"), (90, "archive")),
    "silver": ((180, "archive"),),
}
ALERT_WINDOW = "5 minutes"
ALERT_THRESHOLD = 5          # more than 5 failures per window
STALE_MINUTES = 60           # metrics older than an hour
NO_RUN_HOURS = 24            # no run in a day
# ---------------------------------------------------------------------------


def run_log_report(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "source_repo", "_batch_id",
                       as_wall_clock("start_time").alias("start_time"),
                       as_wall_clock("end_time").alias("end_time"),
                       "duration_seconds", "records_processed", "status", "error")


def run_health(runs: DataFrame, by: str = "source_repo") -> DataFrame:
    """Runs, last status and duration (by end time), success rate in %."""
    last = F.max_by(F.struct("status", "duration_seconds"), "end_time")
    return (runs.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_runs"),
        last.alias("_last"),
        F.count_if(F.col("status") == "success").alias("n_success"))
        .select(by, "n_runs", F.col("_last.status").alias("last_status"),
                F.col("_last.duration_seconds").alias("last_duration_seconds"),
                F.round(100.0 * F.col("n_success") / F.col("n_runs"), 1).alias("success_rate_pct")))


def freshness(runs: DataFrame, as_of: str, by: str = "source_repo",
              stale_minutes: int = STALE_MINUTES, no_run_hours: int = NO_RUN_HOURS) -> DataFrame:
    """Age of the last successful run and of the last run, with alert flags."""
    now_us = F.unix_micros(ts_literal(as_of))
    ok_end = F.max(F.when(F.col("status") == "success", F.col("end_time")))
    out = runs.groupBy(by).agg(ok_end.alias("last_success_end"), F.max("end_time").alias("last_end"))
    age_min = F.floor((now_us - F.unix_micros("last_success_end")) / F.lit(60_000_000)).cast("long")
    idle_h = (now_us - F.unix_micros("last_end")) / F.lit(3_600_000_000)
    return out.select(
        by, as_wall_clock("last_success_end").alias("last_success_end"),
        age_min.alias("minutes_since_success"),
        F.coalesce(age_min > stale_minutes, F.lit(True)).alias("is_stale"),
        (idle_h > no_run_hours).alias("no_run_in_window"))


def pipeline_health(runs: DataFrame, control: DataFrame, pipeline: str) -> DataFrame:
    """One row: the run log beside the checkpoint.  Runs, success rate, last
    status and duration, checkpoint status, records and watermark."""
    last = F.max_by(F.struct("status", "duration_seconds"), "end_time")
    r = runs.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "success").alias("ok"),
        last.alias("last"), F.sum("records_processed").alias("records"))).scalar()
    mine = control.where(F.col("pipeline") == pipeline)
    good = F.col("status") == "success"
    c = mine.agg(F.struct(
        F.max_by("status", "execution_timestamp").alias("status"),
        F.sum(F.when(good & F.col("source_repo").isNull(), F.col("records_processed"))).alias("records"),
        F.max(F.when(good, F.col("last_processed_timestamp"))).alias("watermark"))).scalar()
    one = runs.sparkSession.range(1).select(r.alias("r"), c.alias("c"))
    return one.select(
        F.lit(pipeline).alias("pipeline"), F.col("r.n").alias("n_runs"),
        F.round(100.0 * F.col("r.ok") / F.col("r.n"), 1).alias("success_rate_pct"),
        F.col("r.last.status").alias("last_run_status"),
        F.col("r.last.duration_seconds").alias("last_duration_seconds"),
        F.coalesce(F.col("r.records"), F.lit(0)).alias("records_run"),
        F.coalesce(F.col("c.status"), F.lit("never_run")).alias("checkpoint_status"),
        F.coalesce(F.col("c.records"), F.lit(0)).alias("records_committed"),
        as_wall_clock("c.watermark").alias("last_watermark"))


def daily_run_metrics(runs: DataFrame) -> DataFrame:
    """Per day of the run start: runs, failures, success rate, records, mean duration."""
    ok = F.col("status") == "success"
    return runs.groupBy(F.to_date("start_time").alias("run_date")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if(~ok).alias("n_failed"),
        F.round(100.0 * F.count_if(ok) / F.count(F.lit(1)), 1).alias("success_rate_pct"),
        F.sum("records_processed").alias("records_processed"),
        F.round(F.avg("duration_seconds"), 6).alias("avg_duration_seconds"))


def run_trend(runs: DataFrame, by: str = "source_repo", trail: int = 3) -> DataFrame:
    """Per run: previous duration and the trailing average over ``trail`` runs
    of the same source (a window per source, never one global partition)."""
    w = Window.partitionBy(by).orderBy("start_time", "run_id")
    return runs.select(
        by, "run_id", as_wall_clock("start_time").alias("start_time"), "duration_seconds",
        F.lag("duration_seconds").over(w).alias("prev_duration_seconds"),
        F.round(F.avg("duration_seconds").over(w.rowsBetween(-(trail - 1), 0)), 6)
        .alias("trailing_avg_seconds"),
        F.round(F.col("duration_seconds") - F.lag("duration_seconds").over(w), 6)
        .alias("duration_change"))


def error_alerts(runs: DataFrame, window: str = ALERT_WINDOW, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """Tumbling windows over run end times with more than ``threshold`` failures."""
    return (runs.groupBy(F.window("end_time", window).alias("w"))
            .agg(F.count_if(F.col("status") == "failed").alias("n_failed"),
                 F.count(F.lit(1)).alias("n_runs"))
            .filter(F.col("n_failed") > threshold)
            .select(as_wall_clock("w.start").alias("window_start"),
                    as_wall_clock("w.end").alias("window_end"), "n_failed", "n_runs"))


def retention_action(layer: str, age_days) -> F.Column:
    expr = None
    for min_age, action in RETENTION_RULES[layer]:
        cond = age_days >= min_age
        expr = F.when(cond, action) if expr is None else expr.when(cond, action)
    return expr.otherwise("keep") if expr is not None else F.lit("keep")


def retention_plan(layers: dict[str, DataFrame], as_of: str, by: str = "_batch_id") -> DataFrame:
    """Classify each (layer, batch partition) as keep / archive / expire."""
    parts = None
    as_of_date = F.to_date(ts_literal(as_of))
    for layer, df in layers.items():
        age = F.datediff(as_of_date, F.to_date(by))
        p = (df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), by, age.alias("age_days"),
                     retention_action(layer, age).alias("action"), "row_count"))
        parts = p if parts is None else parts.unionByName(p)
    return parts


def retention_of_batches(batches: DataFrame, layers: Sequence[str], as_of: str) -> DataFrame:
    """(layer, batch, age, action, rows) from committed batches, without reading
    a layer: ``batches(_batch_id, batch_date, <layer>_rows)``."""
    age = F.datediff(F.to_date(ts_literal(as_of)), F.col("batch_date"))
    each = F.array(*[F.struct(F.lit(x).alias("layer"), retention_action(x, age).alias("action"),
                              F.col(f"{x}_rows").alias("row_count")) for x in layers])
    return batches.select("_batch_id", age.alias("age_days"), F.inline(each))


def apply_retention(layer: DataFrame, plan: DataFrame, name: str) -> dict[str, DataFrame]:
    """A layer's rows by what is to become of them: ``keep`` stays, ``archive``
    goes to the archive and ``expire`` is not written again."""
    mine = plan.where(F.col("layer") == name).select("_batch_id", "action")
    return {a: layer.join(mine.where(F.col("action") == a), "_batch_id", "left_semi") for a in ("keep", "archive")}
