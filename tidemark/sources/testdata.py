"""Dirty Bronze adapter over the driver's clean ``events`` table.

The driver's ``events`` rows (event_id, ts, user_id, event_type, value,
props={"k": n}) are re-shaped into raw repository events with deterministic
dirt, so that validation, dedup and feature operators have work to do.  The
rules are written once here and once as SQL in ``tidemark.oracle``; both are
pure functions of each input row, so the adapter is a single map-only pass
(one scan, one Generate for the duplicate copies, no shuffle).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.timefns import ts_literal
from tidemark.session import configure, materialize, work_dir

DEFAULT_RUN_TS = "2024-02-01T00:00:00Z"

# ---------------------------------------------------------------------------
# Fixed values of the adapter (shared with the SQL oracle).
TYPE_OF = {"click": "PushEvent", "view": "WatchEvent",
           "signup": "PullRequestEvent", "purchase": "IssuesEvent"}
# "error" rows take their type from event_id % 4, in this order.
ERROR_TYPES = ("CommitCommentEvent", "PullRequestReviewEvent", "CreateEvent", "ForkEvent")
TYPE_ABSENT_MOD = 97
BAD_TS_MOD = 101
BAD_TS_TEXT = "not-a-timestamp"
OFFSET_MOD = 67               # the same instant, written with an offset
OFFSET_MINUTES, OFFSET_TEXT = 330, "+05:30"
FUTURE_MOD = 1009             # an event time years ahead
FUTURE_DAYS = 2557
CREATED_ABSENT_MOD = 149
CREATED_NULL_MOD = 151
ID_NULL_MOD = 131
TYPE_NULL_MOD = 103
PAYLOAD_NULL_MOD = 61
REPO_ABSENT_MOD = 89
REPO_NULL_MOD = 107           # present, but null
REPO_ID_ABSENT_MOD = 109
REPO_NAME_ABSENT_MOD = 113
REPO_NAME_NULL_MOD = 127
LOGIN_NULL_MOD = 53
LOGIN_EMPTY_MOD = 59
RETYPE_COPY_MOD = 10          # extra copy with another type
RETYPE_SEQ_OFFSET = 1_000_000_000
EXACT_COPY_MOD = 25           # extra identical copy
EXACT_SEQ_OFFSET = 2_000_000_000
REPO_URL_PREFIX = "https://code.example/repos/"
PUSH_REF = "refs/heads/main"
SOURCE_TAG = "testdata_events"
FILE_TAG = "events"
# ---------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


#: Rows of a part that events are dealt to.
SPREAD_ROWS = 50_000
_SPREAD: dict[tuple, DataFrame] = {}


def spread(events: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """The same rows, dealt to parts of about ``rows`` by a hash of the whole row.

    A Parquet row group is read by one task.  Where a table is one file with few
    of them, the tasks of all that is written from it would stay as few."""
    return events.repartition(max(1, -(-events.count() // rows)), *events.columns)


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in as many files as their number asks for: the input of feeds and
    runs, which read it several times.  Written once a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SPREAD:
        path = work_dir(configure(spark), "events", uuid.uuid4().hex)
        _SPREAD[key] = materialize(spread(read_events(spark, sf_dir)), path)
    return _SPREAD[key]


def spread_bronze(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    return dirty_bronze(spread_events(spark, sf_dir), run_ts)


def _base_type(event_type: Column, event_id: Column) -> Column:
    expr = None
    for src, dst in TYPE_OF.items():
        expr = F.when(event_type == src, dst) if expr is None else expr.when(event_type == src, dst)
    err = F.element_at(F.array(*[F.lit(t) for t in ERROR_TYPES]),
                       (F.pmod(event_id, F.lit(4)) + 1).cast("int"))
    return expr.when(event_type == "error", err)


def _payload(ptype: Column, k: Column, event_id: Column) -> Column:
    opened = (k % 2) == 0
    commits = F.transform(
        F.array_repeat(F.lit(0), k % 5),
        lambda _x, i: F.struct(
            F.concat(F.lit("sha"), event_id.cast("string"), F.lit("-"), i.cast("string")).alias("sha"),
            F.concat(F.lit("commit "), i.cast("string")).alias("message")))
    push = F.to_variant_object(F.struct(
        k.alias("size"), F.lit(PUSH_REF).alias("ref"), commits.alias("commits")))
    pr = F.to_variant_object(F.struct(
        F.when(opened, "opened").otherwise("closed").alias("action"),
        F.struct(F.when(opened, "open").otherwise("closed").alias("state"),
                 ((k % 3) == 0).alias("merged"),
                 k.alias("additions"),
                 (k % 7).alias("deletions")).alias("pull_request")))
    labels = F.slice(F.array(F.struct(F.lit("l0").alias("name")),
                             F.struct(F.lit("l1").alias("name"))), 1, k % 3)
    issue = F.to_variant_object(F.struct(
        F.when(opened, "opened").otherwise("closed").alias("action"),
        F.struct(F.when(opened, "open").otherwise("closed").alias("state"),
                 labels.alias("labels")).alias("issue")))
    watch = F.to_variant_object(F.struct(F.lit("started").alias("action")))
    return (F.when(ptype == "PushEvent", push)
            .when(ptype == "PullRequestEvent", pr)
            .when(ptype == "IssuesEvent", issue)
            .when(ptype == "WatchEvent", watch)
            .otherwise(F.parse_json(F.lit("{}"))))


def dirty_bronze(events: DataFrame, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    """Driver ``events`` -> Bronze rows (schema ``tidemark.schemas.BRONZE``)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    # copy 0 = original, 1 = copy with another type, 2 = exact copy.
    copies = F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda c: (c == 0) | ((c == 1) & (F.pmod(eid, F.lit(RETYPE_COPY_MOD)) == 0))
        | ((c == 2) & (F.pmod(eid, F.lit(EXACT_COPY_MOD)) == 0)))
    x = events.select(
        eid, "ts", "user_id", "event_type", k.alias("k"), F.explode(copies).alias("copy"))
    eid, k, copy = F.col("event_id"), F.col("k"), F.col("copy")
    retyped = F.when((F.floor(eid / RETYPE_COPY_MOD) % 2) == 0, "WatchEvent").otherwise("PushEvent")
    ptype = F.when(copy == 1, retyped).otherwise(_base_type(F.col("event_type"), eid))
    repo_name = F.concat(F.lit("org"), (k % 10).cast("string"), F.lit("/repo"), k.cast("string"))

    def each(mod: int) -> Column:
        return F.pmod(eid, F.lit(mod)) == 0

    no_repo = each(REPO_ABSENT_MOD) | each(REPO_NULL_MOD)
    repo = F.when(~no_repo, F.struct(
        F.when(~each(REPO_ID_ABSENT_MOD), k.cast("long")).alias("id"),
        F.when(~each(REPO_NAME_ABSENT_MOD) & ~each(REPO_NAME_NULL_MOD), repo_name).alias("name"),
        F.when(k % 2 == 0, F.concat(F.lit(REPO_URL_PREFIX), repo_name)).alias("url")))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    created = (F.when(each(CREATED_ABSENT_MOD) | each(CREATED_NULL_MOD), F.lit(None).cast("string"))
               .when(each(BAD_TS_MOD), F.lit(BAD_TS_TEXT))
               .when(each(OFFSET_MOD), F.concat(F.date_format(
                   F.col("ts") + F.make_dt_interval(mins=F.lit(OFFSET_MINUTES)), iso), F.lit(OFFSET_TEXT)))
               .when(each(FUTURE_MOD), F.concat(F.date_format(
                   F.col("ts") + F.make_dt_interval(days=F.lit(FUTURE_DAYS)), iso), F.lit("Z")))
               .otherwise(F.concat(F.date_format("ts", iso), F.lit("Z"))))
    login = (F.when(F.pmod(eid, F.lit(LOGIN_NULL_MOD)) == 0, F.lit(None).cast("string"))
             .when(F.pmod(eid, F.lit(LOGIN_EMPTY_MOD)) == 0, F.lit(""))
             .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))))
    seq = (F.when(copy == 1, eid + RETYPE_SEQ_OFFSET)
           .when(copy == 2, eid + EXACT_SEQ_OFFSET).otherwise(eid))
    absent = F.array_compact(F.array(
        F.when(each(TYPE_ABSENT_MOD), F.lit("type")),
        F.when(each(CREATED_ABSENT_MOD), F.lit("created_at")),
        F.when(each(REPO_ABSENT_MOD), F.lit("repo")),
        F.when(~no_repo & each(REPO_ID_ABSENT_MOD), F.lit("repo.id")),
        F.when(~no_repo & each(REPO_NAME_ABSENT_MOD), F.lit("repo.name"))))
    return x.select(
        F.when(~each(ID_NULL_MOD), eid.cast("string")).alias("id"),
        F.when(~each(TYPE_ABSENT_MOD) & ~each(TYPE_NULL_MOD), ptype).alias("type"),
        created.alias("created_at"),
        repo.alias("repo"),
        F.struct(F.col("user_id").alias("id"), login.alias("login")).alias("actor"),
        F.when(~each(PAYLOAD_NULL_MOD), _payload(ptype, k, eid)).alias("payload"),
        ts_literal(run_ts).alias("_ingestion_timestamp"),
        F.lit(SOURCE_TAG).alias("_source"),
        repo_name.alias("source_repo"),
        F.date_format("ts", "yyyy-MM-dd").alias("_batch_id"),
        seq.alias("_arrival_seq"),
        F.lit(FILE_TAG).alias("_file"),
        F.array(F.lit(0).cast("long")).alias("_pos"),
        absent.alias("_absent_keys"),
        F.lit(None).cast("string").alias("_raw"),
    )


def bronze_from_dir(spark: SparkSession, sf_dir: str, run_ts: str = DEFAULT_RUN_TS) -> DataFrame:
    return dirty_bronze(read_events(spark, sf_dir), run_ts)


# -- the same events as landing files ------------------------------------------

CORRUPT_LINE_MOD, CORRUPT_LINE_REST = 500, 1
#: Rows of a source in one landing file, about: a file is read as one text.
LANDING_FILE_EVENTS = 4_000


def _json_fields(sep: str, *fields: tuple[str, Column, Column]) -> Column:
    """JSON object text of (name, value text or null, present) fields."""
    parts = [F.when(present, F.concat(F.lit(f'"{name}": '), F.coalesce(value, F.lit("null"))))
             for name, value, present in fields]
    return F.concat(F.lit("{" + sep.lstrip(",")), F.concat_ws(sep, *parts), F.lit("}"))


def event_json(sep: str = ", ") -> Column:
    """A Bronze row as the raw JSON event it came from, absent keys left out."""
    def here(key: str) -> Column:
        return ~F.array_contains("_absent_keys", key)

    def quoted(c: str) -> Column:
        return F.concat(F.lit('"'), F.col(c), F.lit('"'))

    always = F.lit(True)
    repo = F.when(F.col("repo").isNotNull(), _json_fields(
        ", ", ("id", F.col("repo.id").cast("string"), here("repo.id")),
        ("name", quoted("repo.name"), here("repo.name")), ("url", quoted("repo.url"), always)))
    return _json_fields(
        sep, ("id", quoted("id"), here("id")), ("type", quoted("type"), here("type")),
        ("created_at", quoted("created_at"), here("created_at")), ("repo", repo, here("repo")),
        ("actor", F.to_json("actor", {"ignoreNullFields": "false"}), always),
        ("payload", F.to_json("payload"), always), ("public", F.lit("true"), always))


def write_landing(spark: SparkSession, sf_dir: str, root: str, run_ts: str = DEFAULT_RUN_TS) -> None:
    """The dirty events as landing files by source: those with even ids as
    indented JSON arrays, the others as JSON Lines with a broken line here and
    there.  All copies of an event are in one file, in arrival order.  A source
    has as many files as its rows ask for, so no text grows with the input."""
    rows = spread_bronze(spark, sf_dir, run_ts).withColumn("eid", F.pmod("_arrival_seq", F.lit(RETYPE_SEQ_OFFSET)))
    sizes = materialize(rows.groupBy(F.col("source_repo").alias("_source_repo")).agg(
        F.ceil(F.count(F.lit(1)) / (2 * LANDING_FILE_EVENTS)).alias("files")))
    rows = rows.join(sizes, F.col("source_repo").eqNullSafe(F.col("_source_repo")))
    rows = rows.select("eid", F.col("_arrival_seq").alias("seq"), F.split("source_repo", "/")[0].alias("owner"),
                       F.split("source_repo", "/")[1].alias("repo_dir"), event_json(",\n    ").alias("indented"),
                       event_json().alias("line"), F.pmod(F.xxhash64("eid"), "files").alias("chunk"))
    broken = (F.pmod("eid", F.lit(CORRUPT_LINE_MOD)) == CORRUPT_LINE_REST) & (F.col("seq") == F.col("eid"))
    line = F.when(broken, F.concat("line", F.lit('\n{"id": "'), F.col("eid").cast("string"), F.lit('", broken'))) \
        .otherwise(F.col("line"))

    def write(part: DataFrame, text: Column, wrap, folder: str) -> None:
        texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", text.alias("text")))), lambda x: x["text"])
        (part.groupBy("owner", "repo_dir", "chunk").agg(wrap(texts).alias("value"))
         .select("value", "owner", F.col("repo_dir").alias("repo"))
         .write.partitionBy("owner", "repo").option("maxRecordsPerFile", 1).text(f"{root}/{folder}"))

    write(rows.where(F.pmod("eid", F.lit(2)) == 0), F.col("indented"), lambda t: F.concat(
        F.lit("[\n  "), F.array_join(t, ",\n  "), F.lit("\n]")), "arrays")
    write(rows.where(F.pmod("eid", F.lit(2)) != 0), line, lambda t: F.array_join(t, "\n"), "lines")


# -- the same events as three batches of an incremental run -----------------------

# Fixed rules (shared with the SQL oracle).  Days 1-10, 11-20 and 21-31; a few
# events of the first batch are withheld until the third, and a few are sent
# again with the second under a later time.
BATCHES = ("2024-01-10", "2024-01-20", "2024-01-30")
WITHHELD_MOD, WITHHELD_REST = 40, 7
RESENT_MOD, RESENT_REST = 50, 3
RESENT_DAYS = 10
RESENT_SEQ_OFFSET = 3_000_000_000


#: Batches that are run again: the first as it was, the second without some of
#: its events and with others that the third sends as well.
LOST_MOD, LOST_REST = 30, 9
MOVED_MOD, MOVED_REST = 70, 5


def changed_batch(bronze: DataFrame) -> DataFrame:
    """The second batch as it is sent again."""
    eid = F.pmod("_arrival_seq", F.lit(RETYPE_SEQ_OFFSET))
    early = bronze.where((F.dayofmonth(F.to_date("_batch_id")) > 20) & (F.pmod(eid, F.lit(MOVED_MOD)) == MOVED_REST))
    return incremental_batches(bronze)[1].where(F.pmod(eid, F.lit(LOST_MOD)) != LOST_REST).unionByName(early)


def incremental_batches(bronze: DataFrame) -> list[DataFrame]:
    eid = F.pmod("_arrival_seq", F.lit(RETYPE_SEQ_OFFSET))
    day = F.dayofmonth(F.to_date("_batch_id"))
    withheld = (F.pmod(eid, F.lit(WITHHELD_MOD)) == WITHHELD_REST) & (day <= 10)
    again = bronze.where((day <= 10) & (F.pmod(eid, F.lit(RESENT_MOD)) == RESENT_REST)).withColumns({
        "created_at": F.concat(F.date_add(F.to_date("_batch_id"), RESENT_DAYS).cast("string"), F.lit("T12:00:00Z")),
        "_arrival_seq": F.col("_arrival_seq") + RESENT_SEQ_OFFSET})
    return [bronze.where((day <= 10) & ~withheld),
            bronze.where((day > 10) & (day <= 20)).unionByName(again),
            bronze.where((day > 20) | withheld)]
