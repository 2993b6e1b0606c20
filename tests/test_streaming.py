"""Streaming results equal their batch equivalents."""

import json
import os

import pytest

from tidemark.operators import silver, validate
from tidemark.plans import incremental_run
from tidemark.sources.landing import read_landing, read_landing_stream
from tidemark.sources import testdata
from tidemark.sources.testdata import bronze_from_dir
from tidemark.streaming import events as streaming, stateful

SF = "/root/testdata/sf0.001"
RUN_TS = "2024-02-01T00:00:00Z"


def stream_of(spark, tmp_dir, files):
    """One micro-batch a file; ``files`` are lists of (id, created_at)."""
    os.makedirs(f"{tmp_dir}/landing/a/b")
    for k, events in enumerate(files):
        path = f"{tmp_dir}/landing/a/b/p{k}.json"
        with open(path, "w") as f:
            json.dump([{"id": i, "type": "PushEvent", "created_at": t, "repo": {"id": 1, "name": f"r{i}"},
                        "actor": {"id": 1, "login": "u"}} for i, t in events], f, indent=2)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    s = read_landing_stream(spark, f"{tmp_dir}/landing", "b", RUN_TS, max_files_per_trigger=1)
    streaming.dedup_to_table(s, f"{tmp_dir}/out", RUN_TS)
    return f"{tmp_dir}/out"


def test_six_micro_batches_lose_nothing(spark, tmp_dir):
    root = stream_of(spark, tmp_dir, [
        [("1", "not a time"), ("2", "2024-01-15T12:00:00Z")], [("3", "2024-01-15T10:00:00Z")],
        [("2", "2024-01-15T12:00:00Z"), ("4", "2024-01-14T00:00:00Z")], [("5", "2024-01-15T12:30:00Z")],
        [], [("1", "2024-01-15T12:00:00Z"), ("6", "2024-01-15T12:31:00Z"), ("6", "2024-01-15T12:32:00Z")]])
    rows = {r.id: r for r in spark.read.parquet(f"{root}/events").collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6"]
    assert sorted(i for i, r in rows.items() if r.late) == ["3", "4"]
    assert rows["1"]._ts_fallback and str(rows["6"].event_time) == "2024-01-15 12:31:00"
    panes = spark.read.parquet(f"{root}/panes")
    hourly = streaming.windowed_counts(panes, "1 hour", by=("event_type",))
    assert sorted((str(r.window_start), r.event_count) for r in hourly.collect()) == [
        ("2024-01-14 00:00:00", 1), ("2024-01-15 10:00:00", 1), ("2024-01-15 12:00:00", 3), ("2024-02-01 00:00:00", 1)]
    assert streaming.windowed_counts(panes, "1 hour", "15 minutes").agg({"event_count": "sum"}).collect()[0][0] == 4 * 6
    daily = streaming.daily_distinct(spark.read.parquet(f"{root}/pairs"))
    assert {str(r.event_date): r.active_repos_count for r in daily.collect()} == {
        "2024-01-14": 1, "2024-01-15": 4, "2024-02-01": 1}


def test_events_as_a_folder_of_parts(spark, tmp_dir):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    got = streaming.stream_events(spark, tmp_dir, RUN_TS).select("id")
    want = validate.required_ok(bronze_from_dir(spark, SF)).select("id").distinct()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_landing_stream_equals_batch(spark, tmp_dir):
    ev = {"type": "PushEvent", "created_at": "2024-01-15T10:00:00Z",
          "repo": {"id": 1, "name": "a/b"}, "actor": {"id": 1, "login": "u"}}
    os.makedirs(f"{tmp_dir}/landing/a/b")
    for i in range(3):
        with open(f"{tmp_dir}/landing/a/b/p{i}.json", "w") as f:
            f.write(json.dumps([dict(ev, id=str(i)), dict(ev, id=str(i + 1))]))
    s = read_landing_stream(spark, f"{tmp_dir}/landing", "b1", RUN_TS, max_files_per_trigger=1)
    out, chk = f"{tmp_dir}/out", f"{tmp_dir}/chk"
    streaming.run_available_now(s.select("id", "source_repo"), out, chk)
    got = spark.read.parquet(out)
    assert got.select(streaming.EPOCH).distinct().count() == 3       # one file per micro-batch
    batch = read_landing(spark, f"{tmp_dir}/landing", "b1", RUN_TS).select("id", "source_repo")
    assert got.drop(streaming.EPOCH).exceptAll(batch).count() == 0 and got.count() == 6
    assert silver.to_silver(read_landing(spark, f"{tmp_dir}/landing", "b1", RUN_TS)).count() == 4


def test_stream_to_layers_exactly_once(spark, tmp_dir):
    ev = {"type": "PushEvent", "repo": {"id": 1, "name": "a/b"}, "actor": {"id": 1, "login": "u"}}
    os.makedirs(f"{tmp_dir}/landing/a/b")
    def e(j):  # event j always happens at 10:0j (a re-delivery keeps its time)
        return dict(ev, id=str(j), created_at=f"2024-01-15T10:0{j}:00Z")

    for i in range(3):   # file i carries events i and i+1
        with open(f"{tmp_dir}/landing/a/b/p{i}.json", "w") as f:
            f.write(json.dumps([e(i), e(i + 1)]))
        os.utime(f"{tmp_dir}/landing/a/b/p{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    s = read_landing_stream(spark, f"{tmp_dir}/landing", "unused", RUN_TS, max_files_per_trigger=1)
    root = f"{tmp_dir}/layers"
    streaming.stream_to_layers(spark, s, root, RUN_TS, f"{tmp_dir}/chk", lateness_seconds=60)
    got = incremental_run.read_silver(spark, root)
    # every id once, although ids 1 and 2 arrive twice across micro-batches
    assert sorted(r.event_id for r in got.collect()) == ["0", "1", "2", "3"]
    assert got.select("_batch_id").distinct().count() == 3
    assert incremental_run.read_bronze(spark, root).count() == 6
    ctl = spark.read.parquet(f"{root}/state/control")
    assert ctl.filter("status = 'success'").select("_batch_id").distinct().count() == 3


def stateful_feed(spark, tmp_dir, files, **how):
    os.makedirs(f"{tmp_dir}/landing/a/b")
    for k, events in enumerate(files):
        path = f"{tmp_dir}/landing/a/b/p{k}.json"
        with open(path, "w") as f:
            json.dump([{"id": i, "type": "PushEvent", "created_at": t, "repo": {"id": 1, "name": "r"},
                        "actor": {"id": 1, "login": "u"}} for i, t in events], f)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    source = read_landing_stream(spark, f"{tmp_dir}/landing", "b", RUN_TS, max_files_per_trigger=1)
    feed = stateful.StatefulFeed(spark, f"{tmp_dir}/out", **how)
    feed.run(source, RUN_TS)
    return feed


def test_state_holds_the_delay_and_late_rows_stay_exact(spark, tmp_dir):
    def at(hour, minute=0):
        return f"2024-01-15T{hour:02d}:{minute:02d}:00Z"

    files = [[(f"{h}-{m}", at(h, m)) for m in range(0, 60, 3)] for h in range(5)]
    files[1] += [("0-57", at(0, 57)), ("x", "not a time")]  # a copy on time, an event without a time
    files[3] += [("late", at(0, 5)), ("0-0", at(0)), ("2-57", at(2, 57)), ("late", at(0, 5))]
    files[4] += [("late", at(0, 5)), ("x", "not a time"), ("1-3", at(1, 3)), ("3-57", at(3, 57))]
    feed = stateful_feed(spark, tmp_dir, files, delay="10 minutes", duration="7 minutes")
    got = sorted(r.id for r in feed.events().collect())
    assert got == sorted({i for f in files for i, _ in f})
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/out/late/*").collect()) == ["late", "x"]
    state = [p["stateOperators"][0]["numRowsTotal"] for p in feed.progress]
    assert len(state) == 5 and max(state[1:]) <= 30 < len(got)  # the last hour's ids at most, not the history
    counts = feed.counts().collect()
    assert sum(r.event_count for r in counts) == len(got)
    assert len({r.window_start for r in counts}) == len(counts)


def test_windows_that_panes_cannot_give_are_refused(spark):
    panes = spark.createDataFrame([], streaming.PANES)
    for how in (("10 minutes",), ("1 hour", "20 minutes"), ("50 seconds",)):
        with pytest.raises(ValueError):
            streaming.windowed_counts(panes, *how)
    assert streaming.windowed_counts(panes, "45 minutes", "30 minutes").count() == 0


def test_an_append_of_several_files_is_one_epoch(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(testdata.spread, "__defaults__", (300,))
    spark.read.parquet(f"{SF}/events.parquet").write.parquet(f"{tmp_dir}/events.parquet")
    root = streaming.stream_run(spark, tmp_dir, RUN_TS)
    assert len(os.listdir(f"{root}/feed")) > 2 * (streaming.FEED_FILES + 2)
    epochs = spark.read.parquet(f"{root}/events").select(streaming.EPOCH).distinct().count()
    assert epochs <= streaming.FEED_FILES + 1
    got = streaming.stream_events(spark, tmp_dir, RUN_TS).where("late").select("id")
    want = streaming.stream_events(spark, SF, RUN_TS).where("late").select("id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
