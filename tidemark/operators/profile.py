"""Data profiling: nulls, shape, date span, descriptive statistics, sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.timefns import as_wall_clock
from tidemark.session import materialize

# Numeric Silver columns profiled by describe().
NUMERIC_COLUMNS = ("event_hour", "repo_id", "actor_id", "push_size", "push_commits_count",
                   "pr_additions", "pr_deletions")
# Flat Silver columns profiled for nulls.
FLAT_COLUMNS = ("event_id", "event_type", "created_at", "repo_id", "repo_name", "repo_url",
                "actor_id", "actor_login", "event_date", "event_hour", "push_size", "push_ref",
                "push_commits_count", "pr_action", "pr_state", "pr_merged", "pr_additions",
                "pr_deletions", "issue_action", "issue_state", "watch_action",
                "activity_category", "is_active_contribution", "time_of_day")


def null_profile(df: DataFrame, columns: Sequence[str] = FLAT_COLUMNS) -> DataFrame:
    """(column_name, null_count): one aggregate pass, then unpivot."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_count")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def date_span(df: DataFrame, col: str = "created_at") -> DataFrame:
    micros = F.unix_micros(F.max(col)) - F.unix_micros(F.min(col))
    return df.agg(as_wall_clock(F.min(col)).alias("min_created_at"),
                  as_wall_clock(F.max(col)).alias("max_created_at"),
                  F.floor(micros / F.lit(86_400_000_000)).cast("long").alias("span_days"))


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type): a row a column of the schema."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


# What a text can be read as, the first that fits (shared with the SQL oracle).
KIND_PATTERNS = (
    ("integer", "[+-]?[0-9]+"),
    ("number", "[+-]?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?"),
    ("boolean", "true|false"),
    ("date", "[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("timestamp", "[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?"),
)


def value_kinds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, data_type, kind, n): what the values of each column are, from
    one pass over the rows.  Values of text columns are ``null``, ``empty`` or
    what they can be read as, else ``text``; those of other columns ``value``."""
    kinds = dict(df.dtypes)
    counts, rows = [], []
    for i, c in enumerate(columns):
        v = F.col(c)
        kind = F.when(v.isNull(), "null")
        names = ["null", "value"]
        if kinds[c] == "string":
            kind = kind.when(v == "", "empty")
            for name, pattern in KIND_PATTERNS:
                kind = kind.when(v.rlike(f"^({pattern})$"), name)
            kind, names = kind.otherwise("text"), ["null", "empty", *[k for k, _ in KIND_PATTERNS], "text"]
        else:
            kind = kind.otherwise("value")
        for name in names:
            at = f"n_{i}_{name}"
            counts.append(F.count_if(kind == name).alias(at))
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"),
                                 F.lit(name).alias("kind"), F.col(at).alias("n")))
    return df.agg(*counts).select(F.inline(F.array(*rows))).where("n > 0")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each value of each column once, written sorted by range over many tasks:
    column_name, x, n and the partition it is in."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "x")
    counts = long.where(F.col("x").isNotNull()).groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.repartitionByRange("column_name", "x").sortWithinPartitions("column_name", "x")
                       .withColumn("part", F.spark_partition_id()))


def _statistics(counts: DataFrame, shares: Sequence[float]) -> DataFrame:
    """count, mean, std, min, max and exact quantiles (linear between neighbours)
    of each column.  Values are numbered by running sums inside a partition, set
    off by the partitions before it; no task holds the values of a column."""
    per_part = counts.groupBy("column_name", "part").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.col("x")).alias("s"))
    of_column = Window.partitionBy("column_name")
    total = F.sum("m").over(of_column)
    offsets = per_part.select("column_name", "part", total.alias("total"),
                              (F.sum("s").over(of_column) / total).alias("mean"),
                              (F.sum("m").over(of_column.orderBy("part")) - F.col("m")).alias("before"))
    running = F.sum("n").over(Window.partitionBy("column_name", "part").orderBy("x"))
    placed = counts.withColumn("upto", running).join(offsets, ["column_name", "part"])
    end = F.col("before") + F.col("upto")
    off = F.col("x") - F.col("mean")
    out = [F.first("total").alias("count"), F.first("mean").alias("mean"),
           F.sqrt(F.sum(F.col("n") * off * off) / F.nullif(F.first("total") - 1, F.lit(0))).alias("std"),
           F.min("x").alias("min"), F.max("x").alias("max")]
    for s in shares:
        at = F.lit(float(s)) * (F.col("total") - 1)
        pick = lambda r: F.max(F.when((end - F.col("n") <= r) & (r < end), F.col("x")))
        lo, hi = pick(F.floor(at)), pick(F.ceil(at))
        out.append((lo + (hi - lo) * F.max(at - F.floor(at))).alias(f"p{round(100 * s)}"))
    return placed.groupBy("column_name").agg(*out)


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of each column that has a value, one row each."""
    return _statistics(value_counts(df, columns), shares).drop("count", "mean", "std", "min", "max")


def describe(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per numeric column,
    all from its counted values: one pass over ``df``."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    found = _statistics(value_counts(df, columns), (0.25, 0.5, 0.75))
    return names.join(found, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0)).alias("count"), *[
            F.round(s, digits).alias(s) for s in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def sample_rows(df: DataFrame, n: int = 5, order: str = "_arrival_seq") -> DataFrame:
    """The first ``n`` rows by arrival order (a head() with a defined order)."""
    return df.orderBy(order).limit(n)
