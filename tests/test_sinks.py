"""Layer reads (scope, committed-only, versioned), CSV sink, small helpers."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import dedup, profile
from tidemark.plans import sinks

SCHEMA = "x int, _batch_id string"


@pytest.fixture()
def layer(spark, tmp_dir):
    for rows, batch, run in (([1], "b1", "r1"), ([2, 3], "b2", "r2"), ([4], "b3", "r3"), ([9], "b3", "lost")):
        sinks.write_version(spark.createDataFrame([(x,) for x in rows], "x int"), f"{tmp_dir}/layer", batch, run)
    return f"{tmp_dir}/layer"


def committed(spark, *rows):
    return spark.createDataFrame([(b, r, dt.datetime(2024, 1, d)) for b, r, d in rows],
                                 "_batch_id string, _run_id string, committed_at timestamp").withColumn("first_at", F.col("committed_at"))


def read(spark, layer, done, **how):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted(r.x for r in sinks.read_layer(spark, layer, schema, done, **how).collect())


def test_read_layer_scopes(spark, layer):
    # b1 was committed again after b2: it is the latest, whatever its name
    done = committed(spark, ("b1", "r1", 5), ("b2", "r2", 2), ("b3", "r3", 3))
    assert read(spark, layer, done) == [1, 2, 3, 4]
    assert read(spark, layer, done, scope="latest") == [1]
    assert read(spark, layer, done, as_of_batch="b3") == [2, 3, 4]
    assert read(spark, layer, committed(spark, ("b2", "r2", 2))) == [2, 3]
    assert read(spark, layer, committed(spark)) == []
    with pytest.raises(ValueError):
        read(spark, layer, done, scope="newest")


def test_empty_version_replaces_rows(spark, layer):
    sinks.write_version(spark.createDataFrame([], "x int"), layer, "b2", "r9")
    assert read(spark, layer, committed(spark, ("b1", "r1", 1), ("b2", "r9", 4))) == [1]


def test_only_a_missing_path_is_empty(spark, tmp_dir):
    assert sinks.read_or_empty(spark, f"{tmp_dir}/none", SCHEMA).count() == 0
    with pytest.raises(AnalysisException):
        sinks.read_or_empty(spark, tmp_dir, "x nosuchtype")


def test_csv_and_union(spark, tmp_dir):
    a = spark.createDataFrame([(1, "a")], "n long, k string")
    b = spark.createDataFrame([("b",)], "k string")
    u = sinks.union_sources([a, b])
    sinks.write_csv(u, f"{tmp_dir}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert sorted(r.k for r in back.collect()) == ["a", "b"]


def test_small_helpers(spark):
    df = spark.createDataFrame([("1", 1), ("1", 1), (None, 2), (None, 3)], "id string, v int")
    assert dedup.drop_identical(df).count() == 3
    c = dedup.duplicate_count(df).collect()[0]
    assert (c.n_rows, c.n_keys, c.n_duplicates) == (4, 2, 2)
    assert profile.shape(df).collect()[0].n_columns == 2


def test_quantiles_equal_percentiles(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 1001).select((F.col("id") * F.col("id") % 97).alias("a"), F.when(
        F.col("id") % 3 == 0, F.col("id") / 7).alias("b"), F.lit(None).cast("double").alias("c"))
    got = {r.column_name: (r.p10, r.p50, r.p99) for r in profile.quantiles(df, ("a", "b", "c"), (0.1, 0.5, 0.99)).collect()}
    want = df.select(*[F.percentile(x, [0.1, 0.5, 0.99]).alias(x) for x in ("a", "b")]).collect()[0]
    assert set(got) == {"a", "b"} and all(got[k] == pytest.approx(want[k]) for k in got)


def test_value_kinds_come_from_the_values(spark):
    df = spark.createDataFrame([("1", 1), ("-2.5e3", None), ("", 3), (None, 4), ("2024-01-05", 5), ("true", 6),
                                ("2024-01-05T10:00:00Z", 7), ("x 1", 8), ("12", 9)], "a string, b long")
    got = {(r.column_name, r.data_type, r.kind): r.n for r in profile.value_kinds(df, ("a", "b")).collect()}
    assert got == {**{("a", "string", k): 1 for k in ("null", "empty", "number", "date", "boolean", "timestamp", "text")},
                   ("a", "string", "integer"): 2, ("b", "bigint", "value"): 8, ("b", "bigint", "null"): 1}
    assert profile.value_kinds(df.where("false"), ("a", "b")).count() == 0


def test_csv_keeps_types_and_nulls(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,b", dt.datetime(2024, 1, 1)), (None, "q", None)], "n long, k string, t timestamp_ntz")
    sinks.write_csv(df, f"{tmp_dir}/csv")
    assert sorted(map(str, sinks.read_csv(spark, f"{tmp_dir}/csv", df.schema).collect())) == sorted(map(str, df.collect()))
