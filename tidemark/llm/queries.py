"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (decontaminate, language_id, lz_fingerprint, minhash_dedup, mixing, passages, pii, prefix_trie,
                          run_index, token_counts, token_files, toxicity, whitening)
from tidemark.llm.oracle import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (toxicity.classified(_table(spark, sf_dir).select("doc_id", "text"), _table(spark, sf_dir, "labels"))
            .select("doc_id", "held_out", "score", "predicted"))


def op2_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(_table(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir)
    model = language_id.train(docs.where(~toxicity.held_out()))
    return (language_id.predict(docs, model).withColumn("held_out", toxicity.held_out())
            .select("doc_id", "held_out", "lang_pred", "score"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_words(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.without_repeats(_table(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir))


def op8_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compared_with_next(_table(spark, sf_dir))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run
    return run(spark, sf_dir)


def queries() -> dict[str, Query]:
    every = (op1_toxicity, op2_near_passages, op3_language_id, op4_benchmark_decontamination, op5_run_index_dedup,
             op6_token_files, op7_personal_data, op8_lz_fingerprint, op9_minhash_near_dedup, op10_source_mixing,
             op11_token_counts, op12_embedding_whitening, op13_prefix_trie, pipeline)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
