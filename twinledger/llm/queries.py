"""The corpus operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from twinledger.llm import (
    decontamination, embedding_dedup, exact_dedup, hard_negatives, html_tree, language_id, mixing, near_dedup, ngram_lm, periodic_runs, sentencepiece_codec,
    token_files, warc,
)
from twinledger.llm.common import read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=4)


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scored_with_holdout(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(spark, read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.main_texts(read(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_with_holdout(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", relabelled), F.col("vec_id") % 100 == 0)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summarised(decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summarised(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(read(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.SQL, "op9_warc": warc.SQL, "op11_hard_negatives": hard_negatives.SQL, "op12_decontamination": decontamination.SQL,
            "op13_periodic_runs": periodic_runs.SQL}
