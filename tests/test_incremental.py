"""Checkpoint / watermark / incremental run behaviour."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators import incremental, silver, validate
from tidemark.plans import export, incremental_run, state
from tidemark.plans.medallion import run_layers
from tidemark.sources.landing import bronze_from_json, read_landing
from tidemark.sources import testdata
from tidemark.sources.testdata import bronze_from_dir

SF = "/root/testdata/sf0.001"
RUN_TS = "2024-02-01T00:00:00Z"


def clock():
    return dt.datetime(2024, 2, 1, 0, 0, 0)


def later():
    return dt.datetime(2024, 2, 2, 0, 0, 0)


def test_bootstrap_has_no_watermark(spark, tmp_dir):
    c = state.read_control(spark, f"{tmp_dir}/nothing")
    assert state.last_watermarks(c, "events").count() == 0
    assert state.stats(c, "events").collect()[0]["status"] == "never_run"


def test_commit_round_trip_and_advance(spark, tmp_dir):
    path = f"{tmp_dir}/control"
    wm1 = spark.createDataFrame([("a/b", dt.datetime(2024, 1, 15, 10), 100)],
                                "source_repo string, watermark timestamp, records_processed long")
    state.commit(state.success_rows(spark, "events", "r1", "b1", wm1, clock()), path)
    got = state.last_watermarks(state.read_control(spark, path), "events").collect()[0]
    assert got["watermark"] == dt.datetime(2024, 1, 15, 10)
    wm2 = wm1.withColumn("watermark", F.lit(dt.datetime(2024, 1, 15, 11)))
    state.commit(state.success_rows(spark, "events", "r2", "b2", wm2, clock()), path)
    got = state.last_watermarks(state.read_control(spark, path), "events").collect()[0]
    assert got["watermark"] == dt.datetime(2024, 1, 15, 11)
    state.mark_failed(spark, path, "events", "r3", "b3", "boom", clock() + dt.timedelta(hours=1))
    st = state.stats(state.read_control(spark, path), "events").collect()[0]
    assert st["status"] == "failed" and st["last_error"] == "boom"
    assert st["last_processed"] == dt.datetime(2024, 1, 15, 11)


def test_watermark_never_regresses(spark):
    prev = spark.createDataFrame([("a", dt.datetime(2024, 1, 2))], "source_repo string, watermark timestamp")
    new = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 3))],
                                "source_repo string, watermark timestamp")
    got = {r["source_repo"]: r["watermark"] for r in incremental.advance(prev, new).collect()}
    assert got == {"a": dt.datetime(2024, 1, 2), "b": dt.datetime(2024, 1, 3)}


def test_strict_after_watermark(spark):
    b = bronze_from_dir(spark, SF)
    wm = incremental.watermarks(silver.to_silver(b))
    # no valid row is strictly after the max of itself, except unparseable
    # times; rows rejected by validation never set the watermark
    rest = validate.required_ok(incremental.after_watermark(b, wm))
    assert rest.filter(F.try_to_timestamp("created_at").isNotNull()).count() == 0


def test_incremental_equals_one_shot(spark, tmp_dir):
    b = bronze_from_dir(spark, SF)
    s1 = incremental_run.run_batch(spark, b.filter("_batch_id <= '2024-01-15'"), tmp_dir, "r1", RUN_TS,
                                   clock=clock)
    s2 = incremental_run.run_batch(spark, b, tmp_dir, "r2", RUN_TS, clock=clock)
    assert s1["status"] == "success" and s2["status"] == "success", (s1, s2)
    got = incremental_run.read_silver(spark, tmp_dir).select("event_id")
    # events dated years ahead hold up the watermark of their source: the rest of it is late
    late = incremental_run.read_quarantine(spark, tmp_dir).where("_reject_reason = 'late'").select(F.col("id").alias("event_id"))
    want = silver.to_silver(b).select("event_id")
    assert got.count() == got.distinct().count() and got.exceptAll(want).count() == 0
    assert want.exceptAll(got).exceptAll(late.distinct()).count() == 0
    n = got.count()
    # re-running batch 2 changes nothing (idempotent)
    s2b = incremental_run.run_batch(spark, b, tmp_dir, "r2", RUN_TS, clock=later)
    assert s2b["status"] == "success", s2b
    assert incremental_run.read_silver(spark, tmp_dir).count() == n
    assert incremental_run.read_bronze(spark, tmp_dir, scope="latest").count() == b.count()
    runs = state.read_runs(spark, f"{tmp_dir}/state/runs")
    assert runs.count() == 3 and runs.filter("status = 'success'").count() == 3
    latest = incremental_run.read_gold(spark, tmp_dir, "summary").collect()[0]
    assert latest["total_events"] == s2b["records_processed"]
    st = incremental_run.status_summary(spark, tmp_dir).collect()[0]
    assert st["data_available"] and st["last_run_status"] == "success"
    layers = incremental_run.load_layers(spark, tmp_dir)
    assert layers["events"].count() == n and layers["gold_repo_metrics"].count() > 0


def test_failure_keeps_watermark(spark, tmp_dir):
    b = bronze_from_dir(spark, SF)
    incremental_run.run_batch(spark, b.filter("_batch_id <= '2024-01-10'"), tmp_dir, "r1", RUN_TS, clock=clock)
    before = state.last_watermarks(state.read_control(spark, f"{tmp_dir}/state/control"), "events").collect()
    broken = b.withColumn("id", F.raise_error(F.lit("boom")).cast("string"))
    s = incremental_run.run_batch(spark, broken, tmp_dir, "r2", RUN_TS, clock=clock)
    assert s["status"] == "failed" and "boom" in s["error"]
    after = state.last_watermarks(state.read_control(spark, f"{tmp_dir}/state/control"), "events").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    assert state.read_runs(spark, f"{tmp_dir}/state/runs").filter("status = 'failed'").count() == 1


def test_landing_files_multi_source(spark, tmp_dir):
    ev = {"id": "1", "type": "PushEvent", "created_at": "2024-01-15T10:00:00Z",
          "repo": {"id": 1, "name": "apache/spark"}, "actor": {"id": 1, "login": "u"}, "payload": {"size": 1}}
    for src, body in (("apache/spark", json.dumps([ev, dict(ev, id="2")])),
                      ("delta-io/delta", json.dumps([dict(ev, id="3", repo={"id": 2, "name": "delta-io/delta"})])),
                      ("bad/src", "{{{ not json")):
        os.makedirs(f"{tmp_dir}/landing/{src}", exist_ok=True)
        with open(f"{tmp_dir}/landing/{src}/page1.json", "w") as f:
            f.write(body)
    b = read_landing(spark, f"{tmp_dir}/landing", "b1", RUN_TS, "github_api")
    counts = {r["source_repo"]: r["n"] for r in b.groupBy("source_repo").agg(F.count("*").alias("n")).collect()}
    assert counts == {"apache/spark": 2, "delta-io/delta": 1, "bad/src": 1}
    s = silver.to_silver(b)
    assert s.count() == 3 and {r["_source"] for r in s.collect()} == {"github_api"}


def test_medallion_and_export(spark, tmp_dir):
    tables = run_layers(spark, bronze_from_dir(spark, SF), tmp_dir, RUN_TS)
    export.write_document(tables, f"{tmp_dir}/doc")
    doc = {}
    for r in spark.read.json(f"{tmp_dir}/doc").collect():
        doc.setdefault(r["section"], {})[r["key"]] = json.loads(r["value"])
    total = doc["summary"]["all"]["total_events"]
    assert total == silver.to_silver(bronze_from_dir(spark, SF)).count()
    assert sum(v["event_count"] for v in doc["event_types"].values()) == total
    assert sum(v["total_events"] for v in doc["repos"].values()) == total
    assert sorted(map(int, doc["top_repos"])) == list(range(1, 11))


# -- runs that a review found wrong ---------------------------------------------------

def event(i, minute, **more):
    return {"id": str(i), "type": "PushEvent", "created_at": f"2024-01-15T{10 + minute // 60}:{minute % 60:02d}:00Z",
            "repo": {"id": 1, "name": "a/b"}, "actor": {"id": 1, "login": "u"}, "payload": {}, **more}


def batch(spark, *events):
    return bronze_from_json(spark, [json.dumps(list(events))], source="a/b")


def run(spark, root, name, hour, rows, **how):
    s = incremental_run.run_batch(spark, rows, root, name, RUN_TS, clock=lambda: dt.datetime(2024, 2, 1, hour), **how)
    assert s["status"] == "success", s["error"]
    return s


def ids(df, column="event_id"):
    return sorted(r[column] for r in df.collect())


def test_resent_id_with_a_later_time_stays_once(spark, tmp_dir):
    run(spark, tmp_dir, "b1", 1, batch(spark, event(1, 0), event(2, 30)))
    run(spark, tmp_dir, "b2", 2, batch(spark, event(1, 120), event(3, 121)))
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1", "2", "3"]
    q = incremental_run.read_quarantine(spark, tmp_dir).collect()
    assert [(r.id, r._reject_reason, r._batch_id) for r in q] == [("1", "already_in_silver", "b2")]


def test_late_rows_are_in_bronze_and_quarantine(spark, tmp_dir):
    run(spark, tmp_dir, "b1", 1, batch(spark, event(1, 60)))
    run(spark, tmp_dir, "b2", 2, batch(spark, event(2, 30, extra={"kept": 1}), event(3, 61)))
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1", "3"]
    rows = {r.id: r for r in incremental_run.read_bronze(spark, tmp_dir).collect()}
    assert sorted(rows) == ["1", "2", "3"] and json.loads(rows["2"]["_raw"])["extra"] == {"kept": 1}
    q = incremental_run.read_quarantine(spark, tmp_dir).collect()
    assert [(r.id, r._reject_reason) for r in q] == [("2", "late")]
    quality = {r._batch_id: r for r in incremental_run.read_quality(spark, tmp_dir).collect()}
    assert (quality["b2"].total, quality["b2"].valid, quality["b2"].late) == (2, 1, 1)
    # an overlap lets them in, and the anti-join keeps the others single
    run(spark, tmp_dir, "b3", 3, batch(spark, event(1, 60), event(2, 30)), lateness_seconds=7200)
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1", "2", "3"]


def test_empty_and_fully_rejected_first_batches_succeed(spark, tmp_dir):
    for k, (name, rows) in enumerate((("empty", batch(spark)), ("bad", batch(spark, {"id": "1"}))), 1):
        s = run(spark, f"{tmp_dir}/{name}", "b1", k, rows)
        assert s["records_processed"] == 0
        assert incremental_run.read_silver(spark, f"{tmp_dir}/{name}").count() == 0
        assert incremental_run.read_gold(spark, f"{tmp_dir}/{name}", "repo_metrics").count() == 0
        assert incremental_run.read_gold(spark, f"{tmp_dir}/{name}", "summary").collect()[0]["total_events"] == 0
        run(spark, f"{tmp_dir}/{name}", "b2", 5, batch(spark, event(7, 0)))
        assert ids(incremental_run.read_silver(spark, f"{tmp_dir}/{name}")) == ["7"]
    assert incremental_run.status_summary(spark, f"{tmp_dir}/none").collect()[0]["last_run_status"] == "unknown"


def test_rerun_to_empty_removes_the_old_rows(spark, tmp_dir):
    run(spark, tmp_dir, "b1", 1, batch(spark, event(1, 0)))
    run(spark, tmp_dir, "b2", 2, batch(spark, event(2, 30)))
    run(spark, tmp_dir, "b2", 3, batch(spark, {"id": "2"}))
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1"]
    assert incremental_run.read_gold(spark, tmp_dir, "repo_metrics").count() == 0
    assert ids(incremental_run.read_quarantine(spark, tmp_dir), "_reject_reason") == ["missing_type"]


def test_only_a_missing_table_means_bootstrap(spark, tmp_dir):
    run(spark, tmp_dir, "b1", 1, batch(spark, event(1, 0)))
    control = f"{tmp_dir}/state/control"
    for name in os.listdir(control):
        if name.endswith(".parquet"):
            with open(f"{control}/{name}", "wb") as f:
                f.write(b"not parquet")
    s = incremental_run.run_batch(spark, batch(spark, event(1, 0)), tmp_dir, "b2", RUN_TS, clock=clock)
    assert s["status"] == "failed" and len(s["error"]) > 0


def test_failed_write_is_not_visible(spark, tmp_dir):
    run(spark, tmp_dir, "b1", 1, batch(spark, event(1, 0)))
    wrong = batch(spark, event(2, 30)).withColumn("id", F.raise_error(F.lit("x" * 5000)).cast("string"))
    s = incremental_run.run_batch(spark, wrong, tmp_dir, "b2", RUN_TS, clock=later)
    assert s["status"] == "failed" and "x" * 5000 in s["error"]
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1"]
    assert incremental_run.read_gold(spark, tmp_dir, "summary").collect()[0]["_batch_id"] == "b1"


# -- batches run again ------------------------------------------------------------------

def by_batch(spark, root):
    return sorted((r._batch_id, r.event_id) for r in incremental_run.read_silver(spark, root).collect())


def test_earlier_batch_run_again_unchanged_changes_nothing(spark, tmp_dir):
    a, b = batch(spark, event(1, 0), event(2, 10)), batch(spark, event(3, 30))
    run(spark, tmp_dir, "a", 1, a)
    run(spark, tmp_dir, "b", 2, b)
    s = run(spark, tmp_dir, "a", 3, a)
    assert s["records_processed"] == 2
    assert by_batch(spark, tmp_dir) == [("a", "1"), ("a", "2"), ("b", "3")]
    # the later batch did not have to run again
    assert spark.read.parquet(f"{tmp_dir}/silver").select("_batch_id", "_run_id").distinct().count() == 3
    assert ids(incremental_run.read_silver(spark, tmp_dir, as_of_batch="a")) == ["1", "2"]


def test_an_id_that_a_new_version_lacks_goes_to_the_batch_that_gave_it_up(spark, tmp_dir):
    run(spark, tmp_dir, "a", 1, batch(spark, event(1, 0), event(2, 10)))
    run(spark, tmp_dir, "b", 2, batch(spark, event(1, 40), event(3, 41)))
    run(spark, tmp_dir, "c", 3, batch(spark, event(1, 50), event(4, 51)))
    assert by_batch(spark, tmp_dir) == [("a", "1"), ("a", "2"), ("b", "3"), ("c", "4")]
    run(spark, tmp_dir, "a", 4, batch(spark, event(2, 10)))
    assert by_batch(spark, tmp_dir) == [("a", "2"), ("b", "1"), ("b", "3"), ("c", "4")]


def test_an_id_that_moves_to_an_earlier_batch_stays_once(spark, tmp_dir):
    run(spark, tmp_dir, "a", 1, batch(spark, event(1, 0)))
    run(spark, tmp_dir, "b", 2, batch(spark, event(2, 30), event(3, 31)), event_types=["PushEvent"])
    run(spark, tmp_dir, "c", 3, batch(spark, event(4, 60)))
    run(spark, tmp_dir, "a", 4, batch(spark, event(1, 0), event(3, 1)))
    assert by_batch(spark, tmp_dir) == [("a", "1"), ("a", "3"), ("b", "2"), ("c", "4")]
    # a watermark that goes up makes rows of later batches late, and one that goes down lets them in again
    run(spark, tmp_dir, "a", 5, batch(spark, event(1, 45)))
    assert by_batch(spark, tmp_dir) == [("a", "1"), ("c", "4")]
    q = [(r._batch_id, r.id, r._reject_reason) for r in incremental_run.read_quarantine(spark, tmp_dir).collect()]
    assert sorted(q) == [("b", "2", "late"), ("b", "3", "late")]
    run(spark, tmp_dir, "a", 6, batch(spark, event(1, 0)))
    assert by_batch(spark, tmp_dir) == [("a", "1"), ("b", "2"), ("b", "3"), ("c", "4")]
    assert ids(incremental_run.read_bronze(spark, tmp_dir), "id") == ["1", "2", "3", "4"]


def test_a_failed_rerun_leaves_all_batches_as_they_were(spark, tmp_dir):
    run(spark, tmp_dir, "a", 1, batch(spark, event(1, 0)))
    run(spark, tmp_dir, "b", 2, batch(spark, event(1, 30), event(2, 31)))

    def stop():
        raise RuntimeError("stopped before the commit")

    s = incremental_run.run_batch(spark, batch(spark, event(5, 0)), tmp_dir, "a", RUN_TS, clock=later, before_commit=stop)
    assert s["status"] == "failed" and by_batch(spark, tmp_dir) == [("a", "1"), ("b", "2")]


def test_the_id_index_is_scanned_and_never_shuffled(spark, tmp_dir):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("event_id"))
    rows = rows.withColumn("_bucket", incremental.id_bucket("event_id"))
    rows.where("cast(event_id as int) % 2 = 0").write.partitionBy("_bucket").parquet(f"{tmp_dir}/index")
    rows.where("cast(event_id as int) between 100 and 130").write.parquet(f"{tmp_dir}/few")
    index = spark.read.schema(rows.schema).parquet(f"{tmp_dir}/index")
    few = spark.read.parquet(f"{tmp_dir}/few")
    want = sorted(str(i) for i in range(100, 131, 2))
    for most in (1_000_000, 3):
        found = incremental.known_ids(index, few, most)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ids(found) == want and "PartitionFilters: [_bucket" in plan
        if most > 3:  # else single folders hold more ids than may be broadcast
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert ids(incremental.known_ids(index, few.limit(0))) == []


def test_a_large_batch_of_ids_never_passes_the_driver(spark, tmp_dir):
    rows = spark.range(600).select(F.col("id").cast("string").alias("event_id"))
    rows = rows.withColumn("_bucket", incremental.id_bucket("event_id"))
    rows.where("cast(event_id as int) % 2 = 0").write.partitionBy("_bucket").parquet(f"{tmp_dir}/index")
    rows.write.parquet(f"{tmp_dir}/many")
    index = spark.read.schema(rows.schema).parquet(f"{tmp_dir}/index")
    found = incremental.known_ids(index, spark.read.parquet(f"{tmp_dir}/many"), 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "PartitionFilters: [_bucket" in plan
    assert ids(found) == sorted(str(i) for i in range(0, 600, 2))


def test_events_in_one_row_group_are_dealt_to_many_files(spark, tmp_dir):
    spark.read.parquet(f"{SF}/events.parquet").coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    events = testdata.read_events(spark, tmp_dir)
    dealt = testdata.spread(events, 100)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 200
    assert dealt.exceptAll(events).isEmpty() and events.exceptAll(dealt).isEmpty()
    assert testdata.spread_events(spark, tmp_dir).exceptAll(events).isEmpty()
    assert testdata.spread(events.limit(0)).count() == 0


def test_landing_files_of_a_large_source_stay_small_and_few(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(testdata, "LANDING_FILE_EVENTS", 100)
    events = testdata.read_events(spark, SF)
    one = events.where("event_id % 10 <> 0").withColumn("props", F.lit('{"k": 7}'))  # nine rows in ten are of one source
    events.where("event_id % 10 = 0").unionByName(one).write.parquet(f"{tmp_dir}/events.parquet")
    testdata.write_landing(spark, tmp_dir, f"{tmp_dir}/landing", RUN_TS)
    lines = spark.read.text(f"{tmp_dir}/landing/lines/*/*/*.txt").select(F.col("_metadata.file_path").alias("file"))
    per_file = [r["count"] for r in lines.groupBy("file").count().collect()]
    assert max(per_file) < 200 and len(per_file) < 120
    read = read_landing(spark, f"{tmp_dir}/landing/lines", "b", RUN_TS, pattern="*/*/*.txt", lines=True).select("id")
    want = bronze_from_dir(spark, tmp_dir).where("_arrival_seq % 2 = 1").select("id")
    assert want.exceptAll(read).isEmpty()
