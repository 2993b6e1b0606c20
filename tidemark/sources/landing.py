"""Landing-zone ingestion (batch and stream) into Bronze.

Layout: ``<root>/<owner>/<repo>/<file>`` (folders may be ``key=value``).  A
file is one JSON array of events (a page as returned by the events API,
indented or not), one JSON object, or JSON Lines.  Events are parsed as
Variant, so that

* an absent key differs from an explicit null (validation needs this),
* a malformed file or line becomes ONE quarantined ``corrupt_record`` row, which
  keeps its whole text, and never stops the other files or sources.  What is not
  one JSON value from its first to its last character is malformed: a value with
  anything behind it is not cut short to the part that parses.

Files are read whole, or with ``lines=True`` line by line and split over many
tasks, which is the form for large files.  The arrival order of rows (U1) is
the file's modification time, then its path, then the position in it
(``schemas.ORDER``), so it is unique however coarse the store's times are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.timefns import parse_event_time, ts_literal
from tidemark.schemas import ACTOR, BRONZE, REPO, TRACKED_KEYS

CORRUPT = "_corrupt_record"
SOURCE_FROM_PATH = r"/(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/[^/]+$"

def _present(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant").isNotNull()


def absent_keys(v: Column) -> Column:
    """Tracked keys absent from the raw object (``repo.*`` only when repo is present)."""
    checks = []
    for key in TRACKED_KEYS:
        path = "$." + key
        cond = ~_present(v, path)
        if key.startswith("repo."):
            cond = _present(v, "$.repo") & ~F.is_variant_null(F.try_variant_get(v, "$.repo", "variant")) & cond
        checks.append(F.when(cond, F.lit(key)))
    return F.array_compact(F.array(*checks))


def _is_object(e: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(e), F.lit("OBJECT")), F.lit(False))


def _strict(text: Column) -> Column:
    """The Variant that a text is, from its first to its last character; else null.

    The parser stops behind the first value and says nothing of what follows.
    Between brackets and before a mark, which no text holds of itself, whatever
    follows breaks the list, makes it longer, or closes it before the mark."""
    mark = F.md5(text)
    doc = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    whole = F.try_variant_get(doc, "$", "array<variant>")
    ok = (F.array_size(whole) == 2) & F.coalesce(
        F.try_variant_get(F.get(whole, F.lit(1)), "$", "string") == mark, F.lit(False))
    return F.when(ok, F.get(whole, F.lit(0)))


def _events(text: Column, doc: Column) -> Column:
    """The events of a text as (e, bad): a Variant, or the text that is none.

    ``doc`` is the text parsed as a whole.  A text that is not one value is JSON
    Lines if any line is an object by itself: each line is an event or a bad one.
    Other text is one bad event.
    """
    found = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc))
    none = F.lit(None).cast("string")
    whole = F.transform(found, lambda e: F.struct(e.alias("e"), none.alias("bad")))
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")
    parsed = F.transform(lines, lambda x: F.struct(_strict(x).alias("e"), x.alias("bad")))
    each = F.transform(parsed, lambda x: F.struct(x["e"].alias("e"), F.when(x["e"].isNull(), x["bad"]).alias("bad")))
    is_lines = (F.array_size(lines) > 1) & F.exists(each, lambda x: _is_object(x["e"]))
    bad = F.array(F.struct(F.lit(None).cast("variant").alias("e"), text.alias("bad")))
    return F.when(doc.isNotNull(), whole).when(is_lines, each).otherwise(bad)


def bronze_from_raw(raw: DataFrame, batch_id: str, run_ts: str, source_tag: str = "landing",
                    text_col: str = "value") -> DataFrame:
    """Raw rows (``text_col``: a file's or a line's text, ``_file``, ``_mtime``
    and ``_at``, the place in the file) -> Bronze rows."""
    parsed = raw.select("_file", "_mtime", "_at", F.col(text_col).alias("_text"),
                        _strict(F.col(text_col)).alias("_doc"))
    x = parsed.select("_file", "_mtime", "_at",
                      F.posexplode(_events(F.col("_text"), F.col("_doc"))).alias("_n", "_x"))
    e = F.col("_x.e")
    ingest = F.coalesce(parse_event_time(F.try_variant_get(e, "$._ingestion_timestamp", "string")),
                        ts_literal(run_ts))
    out = x.select(
        F.try_variant_get(e, "$.id", "string").alias("id"),
        F.try_variant_get(e, "$.type", "string").alias("type"),
        F.try_variant_get(e, "$.created_at", "string").alias("created_at"),
        F.try_variant_get(e, "$.repo", REPO.simpleString()).alias("repo"),
        F.try_variant_get(e, "$.actor", ACTOR.simpleString()).alias("actor"),
        F.try_variant_get(e, "$.payload", "variant").alias("payload"),
        ingest.alias("_ingestion_timestamp"),
        F.coalesce(F.try_variant_get(e, "$._source", "string"), F.lit(source_tag)).alias("_source"),
        F.concat_ws("/", F.regexp_extract("_file", SOURCE_FROM_PATH, 1),
                    F.regexp_extract("_file", SOURCE_FROM_PATH, 2)).alias("source_repo"),
        F.lit(batch_id).alias("_batch_id"),
        F.unix_millis("_mtime").alias("_arrival_seq"),
        F.col("_file"),
        F.concat(F.col("_at"), F.array(F.col("_n").cast("long"))).alias("_pos"),
        F.when(e.isNull(), F.array(F.lit(CORRUPT))).otherwise(absent_keys(e)).alias("_absent_keys"),
        F.coalesce(F.to_json(e), F.col("_x.bad")).alias("_raw"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) if f.name != "payload" else F.col(f.name)
                        for f in BRONZE.fields])


def _raw_files(reader: DataFrame) -> DataFrame:
    return reader.select("value", F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.file_modification_time").alias("_mtime"),
                         F.array(F.lit(0).cast("long")).alias("_at"))


def _raw_lines(reader: DataFrame) -> DataFrame:
    """Lines with their place: the split they come from, and their number in it."""
    return reader.where(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_mtime"),
        F.array(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"))


def read_landing(spark: SparkSession, root: str, batch_id: str, run_ts: str,
                 source_tag: str = "landing", pattern: str = "*/*/*.json", lines: bool = False) -> DataFrame:
    """Batch read of every landing file under ``root`` (all sources at once; a
    bad file or source yields quarantined rows, the rest loads)."""
    path = f"{root.rstrip('/')}/{pattern}"
    raw = _raw_lines(spark.read.text(path)) if lines else _raw_files(spark.read.text(path, wholetext=True))
    return bronze_from_raw(raw, batch_id, run_ts, source_tag)


def read_landing_stream(spark: SparkSession, root: str, batch_id: str, run_ts: str,
                        source_tag: str = "landing", max_files_per_trigger: int = 100,
                        pattern: str = "*/*/*.json") -> DataFrame:
    """The same as a file stream: every new landing file joins a micro-batch."""
    raw = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
           .text(f"{root.rstrip('/')}/{pattern}", wholetext=True))
    return bronze_from_raw(_raw_files(raw), batch_id, run_ts, source_tag)


def bronze_from_json(spark: SparkSession, docs: list[str], batch_id: str = "b0",
                     run_ts: str = "2024-02-01T00:00:00Z", source: str = "test/source",
                     mtime_ms: int = 0) -> DataFrame:
    """Bronze rows from in-memory JSON documents (one file each), for tests
    and small fixtures."""
    rows = [(d, f"mem://{source}/f{i:06d}.json", i) for i, d in enumerate(docs)]
    raw = spark.createDataFrame(rows, "value string, _file string, _i int").select(
        "value", "_file", F.timestamp_millis(F.lit(mtime_ms) + F.col("_i")).alias("_mtime"),
        F.array(F.lit(0).cast("long")).alias("_at"))
    return bronze_from_raw(raw, batch_id, run_ts)


def source_counts(bronze: DataFrame) -> DataFrame:
    """Rows, corrupt rows and distinct ids per source (multi-source health)."""
    corrupt = F.array_contains("_absent_keys", CORRUPT)
    return bronze.groupBy("source_repo").agg(
        F.count(F.lit(1)).alias("raw_events"), F.count_if(corrupt).alias("corrupt_rows"),
        F.count_distinct("id").alias("distinct_ids"))
