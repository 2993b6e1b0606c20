"""Driver queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, decontaminate, jaccard_join, lexical, line_dedup, packing, pii, secret_scan, sharding, sql, topk, toxicity,
    warc, whiten,
)
from tidemark.llm import spans as S
from tidemark.llm.common import staged, table
from tidemark.session import work_dir


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "llm", f"warc-{uuid.uuid4().hex}")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    whole = warc.reassemble(warc.read_records(spark, path))
    return warc.resolve_revisits(staged(warc.payloads(whole, with_payload=False), "payloads"))


def _digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select("doc_id", *[S.number_of("base", k).alias(f"n_{k}") for k in kinds],
                        F.sha2(S.text_of("base"), 256).alias("base_sha256"), S.text_of("spans").alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _digest(secret_scan.find(docs, secret_scan.train(docs)), ("assign", "access", "hex"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", (toxicity.fold_of("doc_id") == 0).alias("held_out"), "score", "predicted")


def op5_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find(table(spark, sf_dir, "documents")), ("email", "ip", "card", "phone"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark")).drop("spans")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op9_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, keep_text=False))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_warc": op2_warc,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_label_propagation": op5_label_propagation,
    "op6_pii": op6_pii,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_kd_trees": op9_kd_trees,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_whitening": op11_whitening,
    "op12_bpe": op12_bpe,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = dict(sql.SQL)
