"""The corpus pipeline: documents -> clean, deduplicated, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.

Rows with a null id or text pass the filtering stages like any others, as do
empty texts; an empty ``documents`` gives empty tables, an empty ``labels`` a
lexicon that rejects nothing, an empty ``benchmark`` takes nothing out.  Of equal
rows one stays, as they are near duplicates of each other, but texts without a
word are linked with nothing and all stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from tidemark.llm.common import table
from tidemark.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled ones, calls toxic go."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon).where("predicted = 0")
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by many documents stay in one of them.  All documents stay,
    also those left without a line."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_first(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece: where it is in its document and in which sequence."""
    return packing.pack(docs)


def write_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """What a model trains on: the cleaned documents that a run left in ``folder``
    as pieces with their token ids, written to ``<folder>/sequences``.  The ids of
    a sequence are its pieces' in the order of ``offset``."""
    packing.pack(spark.read.parquet(f"{folder}/{CLEANED}"), with_ids=True).write.mode("overwrite").parquet(
        f"{folder}/sequences")
    return spark.read.parquet(f"{folder}/sequences")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontaminate", drop_benchmark_passages),
    ("pack", pack_sequences),
]

#: The stage whose table has the cleaned documents.
CLEANED = STAGES[-2][0]

#: Learned scores and free sequence numbers have no SQL form; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Apply the stages to ``documents``.  Every stage's table stays in ``folder``
    under the stage's name (without one: in a new folder of the work folder)."""
    docs, folder = table(spark, sf_dir, "documents"), folder or work_dir(spark, "llm", f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
