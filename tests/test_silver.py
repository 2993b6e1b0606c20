"""Bronze -> Silver: the reference's transformer tests plus the edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, silver, validate
from tidemark.schemas import ORDER
from tidemark.sources.landing import bronze_from_json, read_landing, read_landing_stream
from tidemark.streaming import events as streaming

PUSH = {
    "id": "12345", "type": "PushEvent", "created_at": "2024-01-15T10:00:00Z",
    "repo": {"id": 1, "name": "apache/spark", "url": "https://x"},
    "actor": {"id": 1, "login": "contributor1"},
    "payload": {"size": 3, "commits": []},
    "_ingestion_timestamp": "2024-01-15T10:01:00Z", "_source": "github_api",
}


def docs(*events):
    return [json.dumps(list(events))]


def reasons(spark, event, types=None):
    q = silver.quarantine(bronze_from_json(spark, docs(event)), types)
    return sorted((r["id"], r[validate.REASON]) for r in q.collect())


def test_valid_event_cleaned(spark):
    s = silver.to_silver(bronze_from_json(spark, docs(PUSH)), event_types=["PushEvent", "PullRequestEvent"])
    rows = s.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["event_id"] == "12345" and r["event_type"] == "PushEvent" and r["repo_name"] == "apache/spark"
    assert str(r["event_date"]) == "2024-01-15" and r["event_hour"] == 10
    assert len(r["_content_hash"]) == 32 and r["_source"] == "github_api"


def test_missing_required_field_rejected(spark):
    ev = {"id": "12345", "created_at": "2024-01-15T10:00:00Z"}
    assert reasons(spark, ev) == [("12345", "missing_type")]


def test_type_not_allowed_rejected(spark):
    ev = {"id": "12345", "type": "WatchEvent", "created_at": "2024-01-15T10:00:00Z",
          "repo": {"id": 1, "name": "test/repo"}, "actor": {"id": 1, "login": "user1"}}
    assert reasons(spark, ev, ["PushEvent", "PullRequestEvent"]) == [("12345", "type_filtered")]


def test_batch_dedup_three_to_one(spark):
    ev = {"id": "12345", "type": "PushEvent", "created_at": "2024-01-15T10:00:00Z",
          "repo": {"id": 1, "name": "test/repo"}, "actor": {"id": 1, "login": "user1"}, "payload": {}}
    b = bronze_from_json(spark, docs(ev, ev, ev))
    assert silver.to_silver(b).count() == 1
    q = silver.batch_quality(b, None).collect()[0]
    assert (q["total"], q["valid"], q["filtered"], q["duplicates"]) == (3, 1, 2, 2)


def test_enrichment(spark):
    s = silver.to_silver(bronze_from_json(spark, docs(PUSH))).collect()[0]
    assert s["activity_category"] == "code_change" and s["time_of_day"] == "morning"
    assert s["is_active_contribution"] is True
    assert s["push_size"] == 3 and s["push_commits_count"] == 0 and s["push_ref"] == ""


def test_first_copy_wins_and_precedes_type_filter(spark):
    first = dict(PUSH, type="CreateEvent")
    second = dict(PUSH)
    b = bronze_from_json(spark, docs(first, second))
    # the disallowed first copy consumes the id: nothing reaches Silver
    assert silver.to_silver(b, event_types=["PushEvent"]).count() == 0
    kept = silver.to_silver(b).collect()
    assert [r["event_type"] for r in kept] == ["CreateEvent"]


def test_missing_field_does_not_consume_id(spark):
    bad = {k: v for k, v in PUSH.items() if k != "repo"}
    s = silver.to_silver(bronze_from_json(spark, docs(bad, PUSH))).collect()
    assert len(s) == 1 and s[0]["repo_name"] == "apache/spark"


def test_absent_vs_null(spark):
    base = {"type": "PushEvent", "created_at": "2024-01-15T10:00:00Z", "repo": {"id": 1, "name": "a/b"}}
    evs = [
        dict(base, id="a1", repo=None),                                 # repo: null
        dict(base, id="a2", repo={"id": 1}),                            # no repo.name
        dict(base, id="a3", repo={"name": "a/b"}),                      # no repo.id
        dict(base, id="a4", repo={"id": 1, "name": None}),              # null repo.name
        {k: v for k, v in dict(base, id="a5").items() if k != "created_at"},
        dict(base, id=None),                                            # null id
        dict(base, id="a7", type=None),                                 # null type
    ]
    assert reasons(spark, evs[0]) == [("a1", "repo_not_object")]
    got = sorted(reasons(spark, evs[0], None) + reasons(spark, evs[1]) + reasons(spark, evs[2])
                 + reasons(spark, evs[3]) + reasons(spark, evs[4]) + reasons(spark, evs[6]))
    assert got == sorted([("a1", "repo_not_object"),
                          ("a2", "missing_repo_name"), ("a3", "missing_repo_id"),
                          ("a4", "null_repo_name"), ("a5", "missing_created_at"),
                          ("a7", "null_type")])
    assert reasons(spark, evs[5]) == [(None, "null_id")]


def test_null_created_at_falls_back_to_run_ts(spark):
    ev = dict(PUSH, created_at=None)
    bad = dict(PUSH, id="2", created_at="not-a-timestamp")
    s = silver.to_silver(bronze_from_json(spark, docs(ev, bad)), run_ts="2024-02-01T00:00:00Z")
    rows = s.orderBy("event_id").collect()
    assert all(r["_ts_fallback"] for r in rows)
    assert {str(r["event_date"]) for r in rows} == {"2024-02-01"}


def test_offset_timestamp_is_parsed_to_utc(spark):
    ev = dict(PUSH, created_at="2024-01-15T10:00:00+05:30")
    r = silver.to_silver(bronze_from_json(spark, docs(ev))).collect()[0]
    assert r["event_hour"] == 4 and r["_ts_fallback"] is False


def test_number_and_string_ids_dedup_together(spark):
    a = dict(PUSH, id=1)
    b = dict(PUSH, id="1")
    assert silver.to_silver(bronze_from_json(spark, docs(a, b))).count() == 1


def test_null_actor_and_payload_give_defaults(spark):
    ev = dict(PUSH, actor=None, payload=None)
    r = silver.to_silver(bronze_from_json(spark, docs(ev))).collect()[0]
    assert r["actor_login"] is None and r["push_size"] == 0 and r["push_commits_count"] == 0


def test_feature_defaults_and_types(spark):
    pr = dict(PUSH, id="p", type="PullRequestEvent",
              payload={"action": "opened", "pull_request": {"state": "open", "additions": "x"}})
    iss = dict(PUSH, id="i", type="IssuesEvent",
               payload={"action": "closed", "issue": {"state": "closed", "labels": [{"name": "bug"}]}})
    w = dict(PUSH, id="w", type="WatchEvent", payload={"action": "started"})
    cc = dict(PUSH, id="c", type="CommitCommentEvent", created_at="2024-01-15T23:30:00Z")
    rows = {r["event_id"]: r for r in silver.to_silver(bronze_from_json(spark, docs(pr, iss, w, cc))).collect()}
    assert rows["p"]["pr_merged"] is False and rows["p"]["pr_additions"] == 0 and rows["p"]["pr_deletions"] == 0
    assert rows["p"]["pr_action"] == "opened" and rows["p"]["activity_category"] == "code_review"
    assert rows["i"]["issue_labels"] == ["bug"] and rows["i"]["activity_category"] == "issue_management"
    assert rows["w"]["watch_action"] == "started" and rows["w"]["is_active_contribution"] is False
    assert rows["c"]["activity_category"] == "code_change" and rows["c"]["is_active_contribution"] is True
    assert rows["c"]["time_of_day"] == "evening" and rows["c"]["push_size"] is None


def test_content_hash_ignores_key_order(spark):
    a = dict(PUSH, payload={"size": 3, "ref": "r", "commits": []})
    b = dict(PUSH, id="12345", payload={"commits": [], "ref": "r", "size": 3})
    h = [r["_content_hash"] for r in silver.clean(
        validate.required_ok(bronze_from_json(spark, docs(a) + docs(b)))).collect()]
    assert len(h) == 2 and h[0] == h[1]


def test_corrupt_file_quarantined_others_load(spark):
    b = bronze_from_json(spark, ["[{not json"] + docs(PUSH))
    assert silver.to_silver(b).count() == 1
    q = silver.quarantine(b).collect()
    assert [r[validate.REASON] for r in q] == ["corrupt_record"]


def test_empty_input(spark):
    b = bronze_from_json(spark, ["[]"])
    assert silver.to_silver(b).count() == 0
    assert silver.quarantine(b).count() == 0


def test_all_rows_filtered(spark):
    b = bronze_from_json(spark, docs(dict(PUSH, type="WatchEvent")))
    assert silver.to_silver(b, event_types=["PushEvent"]).count() == 0


def test_window_and_join_dedup_agree(spark):
    from tidemark.sources.testdata import bronze_from_dir
    b = bronze_from_dir(spark, "/root/testdata/sf0.001")
    a = silver.to_silver(b).select("event_id", "_arrival_seq")
    c = silver.label(b).filter(F.col(validate.REASON).isNull()).select(
        F.col("id").alias("event_id"), "_arrival_seq")
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


# -- landing files and content hash ---------------------------------------------------

def write(root, source, name, text, mtime=1_700_000_000):
    import os
    os.makedirs(f"{root}/{source}", exist_ok=True)
    with open(f"{root}/{source}/{name}", "w") as f:
        f.write(text)
    os.utime(f"{root}/{source}/{name}", (mtime, mtime))


def test_indented_arrays_lines_and_bad_files(spark, tmp_dir):
    ev = [dict(PUSH, id=str(i)) for i in range(3)]
    write(tmp_dir, "a/b", "array.json", json.dumps(ev, indent=2))
    write(tmp_dir, "a/b", "lines.json", "\n".join(json.dumps(dict(e, id="l" + e["id"])) for e in ev) + "\n{oops\n\n")
    write(tmp_dir, "a/b", "one.json", json.dumps(dict(PUSH, id="one"), indent=1))
    write(tmp_dir, "c/d", "cut.json", json.dumps(ev, indent=2)[:-40])
    write(tmp_dir, "c/d", "none.json", "[]")
    b = read_landing(spark, tmp_dir, "b", "2024-02-01T00:00:00Z")
    got = sorted((r.source_repo, r.id or "") for r in b.collect())
    assert got == [("a/b", ""), ("a/b", "0"), ("a/b", "1"), ("a/b", "2"), ("a/b", "l0"), ("a/b", "l1"), ("a/b", "l2"),
                   ("a/b", "one"), ("c/d", "")]
    bad = {r._file.rsplit("/")[-1]: r._raw for r in b.where("id is null").collect()}
    assert bad == {"lines.json": "{oops", "cut.json": json.dumps(ev, indent=2)[:-40]}
    assert json.loads(b.where("id = 'one'").collect()[0]._raw) == dict(PUSH, id="one")
    q = silver.quarantine(b).collect()
    assert [r._reject_reason for r in q] == ["corrupt_record"] * 2 and silver.to_silver(b).count() == 7
    stream = read_landing_stream(spark, tmp_dir, "b", "2024-02-01T00:00:00Z")
    streaming.run_available_now(stream.drop("payload"), f"{tmp_dir}/out", f"{tmp_dir}/chk")
    s = spark.read.parquet(f"{tmp_dir}/out").drop(streaming.EPOCH)
    assert s.count() == b.count() and s.exceptAll(b.drop("payload")).count() == 0


def test_equal_file_times_window_and_label_agree(spark, tmp_dir):
    for k in range(4):  # the same id in every file, and twice in each
        write(tmp_dir, "a/b", f"p{k}.json", json.dumps([dict(PUSH, type=f"T{k}a"), dict(PUSH, type=f"T{k}b")], indent=1))
    b = read_landing(spark, tmp_dir, "b", "2024-02-01T00:00:00Z")
    assert [r.event_type for r in silver.to_silver(b).collect()] == ["T0a"]
    lab = silver.label(b).collect()
    assert len(lab) == 8 and [r.type for r in lab if r._reject_reason is None] == ["T0a"]
    assert dedup.later_copies(b).count() == 7


def test_lines_are_split_and_ordered(spark, tmp_dir):
    text = "\n".join(json.dumps(dict(PUSH, id=str(i % 500), type=f"T{i}")) for i in range(2000))
    write(tmp_dir, "a/b", "big.jsonl", text)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        b = read_landing(spark, tmp_dir, "b", "2024-02-01T00:00:00Z", pattern="*/*/*.jsonl", lines=True)
        assert b.rdd.getNumPartitions() > 5 and b.select(*ORDER).distinct().count() == 2000
        types = {r.event_id: r.event_type for r in silver.to_silver(b).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert types == {str(i): f"T{i}" for i in range(500)}


def test_content_hash_tells_contents_apart(spark):
    def hashes(*repos):
        rows = [dict(PUSH, id=str(i), repo=r) for i, r in enumerate(repos)]
        s = silver.to_silver(bronze_from_json(spark, docs(*rows)), dedup_strategy="content_hash_no_id")
        return s.count()

    assert hashes({"id": 1, "name": "a|b", "url": "c"}, {"id": 1, "name": "a", "url": "b|c"}) == 2
    assert hashes({"id": 1, "name": "a", "url": "c"}, {"id": 1, "name": "a", "url": "c"}) == 1
    logins = [dict(PUSH, actor={"id": 1, "login": x}) for x in ("\\N", None)]
    s = silver.to_silver(bronze_from_json(spark, docs(*logins)), dedup_strategy="content_hash")
    assert s.count() == 2


def test_dedup_strategies(spark):
    a, b = PUSH, dict(PUSH, id="other")
    rows = bronze_from_json(spark, docs(a, b, dict(a, type="ForkEvent")))
    count = lambda s: silver.to_silver(rows, dedup_strategy=s).count()
    assert (count("id"), count("content_hash"), count("content_hash_no_id")) == (2, 3, 2)
    with pytest.raises(ValueError):
        count("newest")


def landed(spark, *texts):
    rows = bronze_from_json(spark, list(texts)).select("_file", "id", "_absent_keys", "_raw").collect()
    out = {}
    for r in sorted(rows, key=lambda r: r._file):
        corrupt = "_corrupt_record" in r._absent_keys
        out.setdefault(int(r._file[-11:-5]), []).append(r._raw if corrupt else r.id)
    return [sorted(out.get(i, []), key=str) for i in range(len(texts))]


def test_what_follows_a_value_is_not_lost(spark):
    one, two = '{"id": "1"}', '{"id": "2"}'
    bad = [f"[{one}] trailing garbage", f"[{one}]\n[{two}]", one + two, one + " oops", f"{one},{two}", f"[{one}",
           f"{one}] x [{two}", f'{one},"end"] x [1', "", "nonsense", f"[{one}]]"]
    assert landed(spark, *bad) == [[x] for x in bad]
    good = [f"[{one}, {two}]", f"  [{one},\n {two}\n]\n", one, f"{one}\n{two}\n", "[]"]
    assert landed(spark, *good) == [["1", "2"], ["1", "2"], ["1"], ["1", "2"], []]


def test_bad_first_lines_leave_the_others(spark):
    events = [json.dumps({"id": str(i)}) for i in range(5)]
    text = "\n".join(["# a comment", "{broken", *events, "[1, 2", '{"id": "9"} {"id": "8"}'])
    assert landed(spark, text) == [sorted(["# a comment", "{broken", "0", "1", "2", "3", "4", "[1, 2", '{"id": "9"} {"id": "8"}'])]


def test_a_key_twice_is_no_broken_file(spark):
    text = '[{"id": "1", "type": "a", "type": "b"}, {"id": "2"}]'
    rows = bronze_from_json(spark, [text]).select("id", "type").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "b"), ("2", None)]

