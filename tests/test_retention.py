"""Retention runs over the layers."""

import datetime as dt
import json
import os

import pytest

from tidemark.plans import catalog, incremental_run, retention
from tidemark.sources.landing import bronze_from_json

RUN_TS = "2024-02-01T00:00:00Z"


def run(spark, root, batch, ids, day):
    events = [{"id": str(i), "type": "PushEvent", "created_at": f"{batch}T10:0{i}:00Z",
               "repo": {"id": 1, "name": "a/b"}, "actor": {"id": 1, "login": "u"}} for i in ids]
    stats = incremental_run.run_batch(spark, bronze_from_json(spark, [json.dumps(events)], batch, RUN_TS), root, batch, RUN_TS,
                                      calculations=("event_types",), clock=lambda: dt.datetime(2024, 2, day))
    assert stats["status"] == "success", stats


def ids(df, column="event_id"):
    return sorted(r[column] for r in df.collect())


def test_retired_batches_go_and_can_be_sent_again(spark, tmp_dir):
    run(spark, tmp_dir, "2024-01-01", [1, 2], 1)
    run(spark, tmp_dir, "2024-06-01", [3], 2)
    layer = f"{tmp_dir}/bronze/_batch_id=2024-01-01"

    def stop():
        assert os.listdir(layer)                                    # retired, and still there
        assert ids(incremental_run.read_bronze(spark, tmp_dir), "id") == ["3"]
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        retention.run_retention(spark, tmp_dir, "2024-06-02T00:00:00Z", before_delete=stop)
    assert os.listdir(layer)
    retention.run_retention(spark, tmp_dir, "2024-06-02T00:00:00Z")
    assert not os.listdir(layer)
    assert ids(retention.read_archive(spark, tmp_dir, "bronze"), "id") == ["1", "2"]
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == ["1", "2", "3"]     # 153 days: not yet
    assert ids(incremental_run.read_silver(spark, tmp_dir, as_of_batch="2024-01-01")) == ["1", "2"]
    retention.run_retention(spark, tmp_dir, "2025-01-01T00:00:00Z")                # 366 days
    assert ids(retention.read_archive(spark, tmp_dir, "bronze"), "id") == ["3"]
    assert ids(incremental_run.read_silver(spark, tmp_dir)) == []
    assert ids(retention.read_archive(spark, tmp_dir, "silver")) == ["1", "2", "3"]
    run(spark, tmp_dir, "2024-01-01", [1, 2, 4], 3)                                # the batch is sent again
    assert ids(incremental_run.read_bronze(spark, tmp_dir), "id") == ["1", "2", "4"]


def test_no_batches(spark, tmp_dir):
    retention.run_retention(spark, tmp_dir, "2024-06-02T00:00:00Z")
    assert retention.read_archive(spark, tmp_dir, "silver").count() == 0


def test_the_retention_query_makes_layers_of_its_own(spark, tmp_dir, monkeypatch):
    """What is deleted is its own, and no layer's files pass the driver."""
    made = []
    monkeypatch.setattr(catalog, "_three_runs", lambda s, d, root: made.append(root))
    monkeypatch.setattr(catalog, "runs_root", None)
    monkeypatch.setattr(catalog.retention, "run_retention", lambda *a, **k: None)
    assert catalog.q_retention_run(spark, f"{tmp_dir}/none").collect() == []
    assert len(made) == 1
