"""One incremental batch run: Bronze -> labels -> Silver -> Gold -> commit.

Order of effects; each writes the run's own version of the batch:

1. all rows of the batch go to Bronze as they came, before any filter;
2. every row is labelled: failed checks, late (at or before its source's
   watermark, minus an optional ``lateness`` overlap), duplicate, type filter,
   already in Silver (the batch's ids are looked up in the id index);
3. rejected rows go to the quarantine layer with their reason, the counts to
   the quality layer, the others to Silver and their ids to the id index;
4. every Gold table is computed once from the written Silver, and the batch's
   partial aggregates are kept: all-time Gold merges those of all batches and
   doesn't read Silver again;
5. the control rows are appended (watermark = greatest(previous, new)).  Only
   now do readers see the batch; the latest Gold tables are those of the batch
   committed last.  A failure appends a failed row instead and the watermark
   stays where it was; the run record is appended either way.

Batches keep the order in which they were committed first.  A batch that is run
again starts from the batches before it, not from those after it.  If its new
version holds other ids, or moves a watermark elsewhere, later batches that
depend on it are run again too, from their Bronze and with their own
parameters, and all new versions become visible by one append.  So Silver is
always what the batches' last contents give when run once in that order, but that
a batch whose Bronze has gone by retention stays as it is.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import gold, incremental, silver, validate
from tidemark.plans import sinks, state
from tidemark.plans.medallion import write_all, write_bundle
from tidemark.schemas import BRONZE, SILVER_BASE, SILVER_FEATURES
from tidemark.session import discard, materialize, work_dir
from tidemark.sources.testdata import DEFAULT_RUN_TS

IDS = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("_bucket", T.IntegerType())])
QUALITY = T.StructType([T.StructField(c, T.LongType()) for c in (
    "total", "valid", "filtered", "invalid", "late", "duplicates", "type_filtered", "already_in_silver")])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {"bronze": f"{r}/bronze", "silver": f"{r}/silver", "ids": f"{r}/silver_ids",
            "quarantine": f"{r}/quarantine", "quality": f"{r}/quality", "gold": f"{r}/gold", "states": f"{r}/gold_states",
            "control": f"{r}/state/control", "runs": f"{r}/state/runs", "retention": f"{r}/state/retention"}


def silver_schema(spark: SparkSession) -> T.StructType:
    empty = spark.createDataFrame([], BRONZE)
    return silver.to_silver(empty).select(*SILVER_BASE, *SILVER_FEATURES).schema


def quarantine_schema() -> T.StructType:
    return T.StructType([*BRONZE.fields, T.StructField(validate.REASON, T.StringType())])


def gold_schema(spark: SparkSession, table: str) -> T.StructType:
    return gold.metrics_bundle(spark.createDataFrame([], silver_schema(spark)))[table].schema


def committed_batches(spark: SparkSession, root: str, pipeline: str = "events") -> DataFrame:
    """The committed version of each batch (readers use only these)."""
    return state.committed_versions(state.read_control(spark, paths(root)["control"]), pipeline)


def retired_versions(spark: SparkSession, root: str, pipeline: str, layer: str) -> DataFrame:
    return state.retired(state.read_retention(spark, paths(root)["retention"]), pipeline, layer)


def read_silver(spark: SparkSession, root: str, pipeline: str = "events", scope: str = "all",
                as_of_batch: str | None = None) -> DataFrame:
    return sinks.read_layer(spark, paths(root)["silver"], silver_schema(spark),
                            committed_batches(spark, root, pipeline), scope, as_of_batch,
                            retired_versions(spark, root, pipeline, "silver"))


def read_bronze(spark: SparkSession, root: str, pipeline: str = "events", scope: str = "all") -> DataFrame:
    return sinks.read_layer(spark, paths(root)["bronze"], BRONZE, committed_batches(spark, root, pipeline), scope,
                            without=retired_versions(spark, root, pipeline, "bronze"))


def read_quarantine(spark: SparkSession, root: str, pipeline: str = "events", scope: str = "all") -> DataFrame:
    return sinks.read_layer(spark, paths(root)["quarantine"], quarantine_schema(),
                            committed_batches(spark, root, pipeline), scope)


def read_quality(spark: SparkSession, root: str, pipeline: str = "events", scope: str = "all") -> DataFrame:
    return sinks.read_layer(spark, paths(root)["quality"], QUALITY, committed_batches(spark, root, pipeline), scope)


def read_gold(spark: SparkSession, root: str, table: str, pipeline: str = "events", scope: str = "latest",
              as_of_batch: str | None = None) -> DataFrame:
    """A Gold table of the batch committed last, or its history by batch."""
    return sinks.read_layer(spark, f"{paths(root)['gold']}/{table}", gold_schema(spark, table),
                            committed_batches(spark, root, pipeline), scope, as_of_batch)


def state_schema(spark: SparkSession, name: str) -> T.StructType:
    empty = spark.createDataFrame([], silver_schema(spark))
    return (gold.small_cuboid(empty) if name == gold.CUBOID else gold.state_tables(empty)[name]).schema


def read_gold_alltime(spark: SparkSession, root: str, pipeline: str = "events",
                      calculations: Sequence[str] = gold.CALCULATIONS, run_ts: str = DEFAULT_RUN_TS,
                      top_n: int = 10, as_of_batch: str | None = None) -> dict[str, DataFrame]:
    """Gold tables over all committed batches (or those up to ``as_of_batch``),
    merged from the batches' partial aggregates.  A batch that was run again
    counts with its latest version."""
    committed = committed_batches(spark, root, pipeline)
    states = {name: sinks.read_layer(spark, f"{paths(root)['states']}/{name}", state_schema(spark, name), committed,
                                     as_of_batch=as_of_batch).drop("_batch_id")
              for name in (gold.CUBOID, *gold.STATE_DIMS)}
    return gold.merged_tables(states, calculations, run_ts, top_n)


def quality_of(labeled: DataFrame) -> DataFrame:
    r = F.col(validate.REASON)
    counts = [F.count(F.lit(1)), F.count_if(r.isNull()), F.count_if(r.isNotNull()),
              F.count_if(r.isin(*validate.REQUIRED_REASONS)),
              *[F.count_if(r == x) for x in (validate.LATE, validate.DUPLICATE, validate.TYPE_FILTERED, validate.SEEN)]]
    return labeled.agg(*[c.alias(f.name) for c, f in zip(counts, QUALITY.fields)])


class _Run:
    """The versions that one run writes: of its batch, and of later ones that it changes."""

    def __init__(self, spark: SparkSession, root: str, pipeline: str, run_id: str):
        self.spark, self.paths, self.pipeline, self.run_id = spark, paths(root), pipeline, run_id
        self.scratch = work_dir(spark, "runs", run_id)
        control = state.read_control(spark, self.paths["control"])
        # A row a source and batch; written, as each batch asks for it several times.
        self.control = materialize(control, f"{self.scratch}/control")
        self.versions = state.committed_versions(self.control, pipeline)
        self.marks = state.watermark_rows(self.control, pipeline, self.versions)
        self.written: list[str] = []
        self.rows: list[DataFrame] = []

    def _before(self, batch_id: str) -> tuple[DataFrame, DataFrame]:
        """Versions and watermark rows of the batches before one (all others, if
        it has not been committed yet), this run's own versions first."""
        v = self.versions
        first = v.where(F.col("_batch_id") == batch_id).agg(F.max("first_at")).scalar()
        earlier = first.isNull() | (F.struct("first_at", "_batch_id") < F.struct(first, F.lit(batch_id)))
        v = v.where((F.col("_batch_id") != batch_id) & earlier)
        new = F.col("_batch_id").isin(self.written)
        marks = self.marks.where(~new)
        for name in self.written:
            marks = marks.unionByName(self.spark.read.parquet(f"{self.scratch}/moved/{name}"))
        marks = marks.join(v.select("_batch_id"), "_batch_id", "left_semi")
        return (v.select("_batch_id", F.when(new, F.lit(self.run_id)).otherwise(F.col("_run_id")).alias("_run_id")),
                marks.groupBy("source_repo").agg(F.max("watermark").alias("watermark")))

    def write(self, batch_id: str, bronze: DataFrame, params: dict, clock: Callable[[], dt.datetime]) -> int:
        """Write every layer's version of a batch; returns its Silver rows."""
        spark, p, run_id = self.spark, self.paths, self.run_id
        scratch = f"{self.scratch}/{batch_id}"
        run_ts, lateness = params["run_ts"], params["lateness_seconds"]

        def write(df: DataFrame, layer: str) -> None:
            sinks.write_version(df, layer, batch_id, run_id)

        before, prev = self._before(batch_id)
        wm = prev.select("source_repo", (F.col("watermark") - F.make_dt_interval(
            secs=F.lit(lateness))).alias("watermark")) if lateness else prev

        write(bronze, p["bronze"])
        b = sinks.read_version(spark, p["bronze"], BRONZE, batch_id, run_id)
        labeled = materialize(silver.label(incremental.mark_late(b, wm), params["event_types"]).drop("_late"),
                              f"{scratch}/checked")
        asked = materialize(labeled.where(F.col(validate.REASON).isNull()).select(
            F.col("id").alias("event_id"), incremental.id_bucket("id").alias("_bucket")).distinct(), f"{scratch}/asked")
        index = sinks.read_layer(spark, p["ids"], IDS, before)
        known = materialize(incremental.known_ids(index, asked).distinct(), f"{scratch}/known").select(
            F.col("event_id").alias("id"), F.lit(True).alias("_seen"))
        reason = F.coalesce(F.col(validate.REASON), F.when(F.col("_seen"), F.lit(validate.SEEN)))
        labeled = materialize(labeled.join(known, "id", "left").withColumn(validate.REASON, reason).drop("_seen"),
                              f"{scratch}/labeled")

        rejected = F.col(validate.REASON).isNotNull()
        write(labeled.where(rejected), p["quarantine"])
        write(quality_of(labeled), p["quality"])
        kept = labeled.where(~rejected).drop(validate.REASON)
        write(silver.enrich(silver.clean(kept, run_ts)).select(*SILVER_BASE, *SILVER_FEATURES), p["silver"])
        silver_rows = sinks.read_version(spark, p["silver"], silver_schema(spark), batch_id, run_id)
        ids = silver_rows.select("event_id", incremental.id_bucket("event_id").alias("_bucket"))
        sinks.write_version(ids.repartition("_bucket"), p["ids"], batch_id, run_id, ("_bucket",))
        n = silver_rows.count()
        cuboid = sinks.version_path(f"{p['states']}/{gold.CUBOID}", batch_id, run_id)
        write_all(gold.state_tables(silver_rows), lambda df, name: write(df, f"{p['states']}/{name}"))
        write_bundle(silver_rows.drop("_batch_id"), params["calculations"], run_ts, params["top_n"], cuboid,
                     lambda df, name: write(df, f"{p['gold']}/{name}"),
                     lambda name: spark.read.parquet(sinks.version_path(f"{p['gold']}/{name}", batch_id, run_id)))
        new_wm = incremental.watermarks(silver_rows)
        moved = incremental.advance(prev.join(new_wm, "source_repo", "left_semi"), new_wm).join(
            new_wm.select("source_repo", "records_processed"), "source_repo")
        moved = materialize(moved.withColumn("_batch_id", F.lit(batch_id)), f"{self.scratch}/moved-rows/{batch_id}")
        moved.select("_batch_id", "source_repo", "watermark").write.parquet(f"{self.scratch}/moved/{batch_id}")
        self.rows.append(state.success_rows(spark, self.pipeline, run_id, batch_id, moved, clock(),
                                            {"records": n, "params": json.dumps(params)}))
        self.written.append(batch_id)
        return n

    def _changes(self, batch_id: str) -> tuple[DataFrame, DataFrame]:
        """Ids that one of a batch's two versions holds alone, and sources that
        they leave with different watermarks."""
        old = self.versions.where(F.col("_batch_id") == batch_id).select("_batch_id", "_run_id")
        new = self.spark.createDataFrame([(batch_id, self.run_id)], "_batch_id string, _run_id string")
        of = [sinks.read_layer(self.spark, self.paths["ids"], IDS, v).select("event_id") for v in (old, new)]
        ids = of[0].join(of[1], "event_id", "left_anti").unionByName(of[1].join(of[0], "event_id", "left_anti"))
        was = self.marks.where(F.col("_batch_id") == batch_id).select("source_repo", F.col("watermark").alias("was"))
        now = self.spark.read.parquet(f"{self.scratch}/moved/{batch_id}").select("source_repo", "watermark")
        sources = was.join(now, "source_repo", "full").where(~F.col("was").eqNullSafe(F.col("watermark")))
        return (materialize(ids, f"{self.scratch}/{batch_id}/changed-ids"),
                materialize(sources.select("source_repo"), f"{self.scratch}/{batch_id}/changed-sources"))

    def write_dependents(self, batch_id: str, clock: Callable[[], dt.datetime]) -> None:
        """Run the later batches again that a new version of ``batch_id`` changes."""
        meta = state.succeeded(self.control, self.pipeline).where(F.col("source_repo").isNull()).select(
            "_batch_id", F.col("run_id").alias("_run_id"), F.col("metadata")["params"].alias("params"))
        batches = materialize(self.versions.join(meta, ["_batch_id", "_run_id"], "left"), f"{self.scratch}/batches")
        bronze = self.paths["bronze"]
        ids = sources = None
        while True:
            changed = self._changes(batch_id)
            ids = changed[0] if ids is None else ids.unionByName(changed[0])
            sources = changed[1] if sources is None else sources.unionByName(changed[1])
            if ids.isEmpty() and sources.isEmpty():
                return
            at = batches.where(F.col("_batch_id") == batch_id).first()["first_at"]
            later = batches.where(F.struct("first_at", "_batch_id") > F.struct(F.lit(at), F.lit(batch_id)))
            gone = state.retired(state.read_retention(self.spark, self.paths["retention"]), self.pipeline, "bronze")
            rows = sinks.read_layer(self.spark, bronze, BRONZE, later, without=gone).select("id", "source_repo", "_batch_id")
            touched = rows.join(ids.select(F.col("event_id").alias("id")).distinct(), "id", "left_semi").unionByName(
                rows.join(sources.distinct(), "source_repo", "left_semi")).select("_batch_id").distinct()
            following = later.join(touched, "_batch_id", "left_semi").orderBy("first_at", "_batch_id").first()
            if following is None:
                return
            batch_id = following["_batch_id"]
            again = sinks.read_version(self.spark, bronze, BRONZE, batch_id, following["_run_id"])
            self.write(batch_id, again, json.loads(following["params"]), clock)


def run_batch(spark: SparkSession, bronze: DataFrame, root: str, batch_id: str, run_ts: str,
              pipeline: str = "events", event_types: Sequence[str] | None = None,
              lateness_seconds: int = 0, calculations: Sequence[str] = gold.CALCULATIONS,
              top_n: int = 10, clock=_now, before_commit: Callable[[], None] | None = None) -> dict:
    """Run one batch; returns run stats (run_id, status, records, error).

    ``before_commit`` is called when everything is written and nothing is visible yet."""
    p = paths(root)
    tracker = state.RunTracker(spark, p["runs"])
    run_id = tracker.start(clock())
    stats = {"run_id": run_id, "status": "failed", "records_processed": 0, "error": None}
    params = {"run_ts": run_ts, "event_types": None if event_types is None else list(event_types),
              "lateness_seconds": lateness_seconds, "calculations": list(calculations), "top_n": top_n}
    at = clock()
    try:
        run = _Run(spark, root, pipeline, run_id)
        again = not run.versions.where(F.col("_batch_id") == batch_id).isEmpty()
        stats["records_processed"] = run.write(batch_id, bronze, params, lambda: at)
        if again:
            run.write_dependents(batch_id, lambda: at)
        rows = run.rows[0]
        for more in run.rows[1:]:
            rows = rows.unionByName(more)
        if before_commit:
            before_commit()
        state.commit(rows, p["control"])
        stats["status"] = "success"
    except Exception as e:  # noqa: BLE001 - recorded, never silently lost
        stats["records_processed"], stats["error"] = 0, str(e)
        state.mark_failed(spark, p["control"], pipeline, run_id, batch_id, stats["error"], at)
    finally:
        discard(spark, work_dir(spark, "runs", run_id))
        tracker.end(clock(), stats["records_processed"], stats["status"], stats["error"])
    return stats


def load_layers(spark: SparkSession, root: str, pipeline: str = "events") -> dict[str, DataFrame]:
    """Lazy bundle of what a consumer reads: committed Silver, quarantine and
    quality, the latest Gold tables, control table and run history."""
    p = paths(root)
    tables = gold.metrics_bundle(spark.createDataFrame([], silver_schema(spark)))
    return {
        "events": read_silver(spark, root, pipeline),
        "quarantine": read_quarantine(spark, root, pipeline),
        "quality": read_quality(spark, root, pipeline),
        **{f"gold_{name}": read_gold(spark, root, name, pipeline) for name in tables},
        "control": state.read_control(spark, p["control"]),
        "run_history": state.read_runs(spark, p["runs"]),
    }


def status_summary(spark: SparkSession, root: str, pipeline: str = "events") -> DataFrame:
    """One row: data available, total events and last update (latest gold
    summary), last run status (from the run history, not the checkpoint)."""
    runs = state.read_runs(spark, paths(root)["runs"])
    last = runs.agg(F.max_by("status", "end_time").alias("last_run_status"))
    summary = read_gold(spark, root, "summary", pipeline).agg(F.max(F.struct(
        "calculation_timestamp", "total_events")).alias("s")).select("s").scalar()
    return last.select(summary.isNotNull().alias("data_available"),
                       F.coalesce(summary["total_events"], F.lit(0)).alias("total_events"),
                       summary["calculation_timestamp"].alias("last_update"),
                       F.coalesce(F.col("last_run_status"), F.lit("unknown")).alias("last_run_status"))
