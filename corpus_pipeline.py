"""A corpus pipeline of stages, each of which works on all that the one before it kept and reads it from a stored table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm import exact_dedup, language_id, mixing, near_dedup, sentencepiece_codec
from twinledger.llm.common import read, stored

# Documents whose best language makes up a smaller share of their words are rejected, as are those without any letter.
LEAST_SHARE = 0.3


# Rows and bytes that go to Python at once. Workers of all stages live side by side, as do the buffers of the JVM.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def in_small_batches(spark: SparkSession) -> None:
    """Sets the session's limits of batches for all that follows; results don't depend on them."""
    for name, most in BATCHES.items():
        spark.conf.set(name, most)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the model knows stay. The text alone decides; labels are only learned from.

    Each row goes by its own text, whatever other rows have its id or none. NULL and letterless texts, empty ones among them, go; an
    empty table stays empty. Columns keep their names, whatever they are.
    """
    in_small_batches(spark)
    model = language_id.fit_on(docs)
    numbered = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    found = language_id.identify(numbered, model, text_col=f"_{docs.columns.index('text')}", keep=numbered.columns)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select(*numbered.columns).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, one document stays: the longest, then that with the smallest id.

    NULL and empty texts are equal to each other. Rows that repeat id and text stay once.
    """
    in_small_batches(spark)
    return exact_dedup.without_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles are similar by 0.8 or more, and what they link, one stays.

    Rows are told apart by id and text, so that texts that share an id are judged on their own. Rows without an id or without words
    are linked with nothing and stay.
    """
    in_small_batches(spark)
    return near_dedup.one_of_each_group(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; texts without words are never taken."""
    in_small_batches(spark)
    return mixing.mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each document, with its id, language and source, a row a row; a NULL or empty text has none."""
    in_small_batches(spark)
    tokens = sentencepiece_codec.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"])
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", languages), ("exact dedup", exact_copies), ("MinHash near-dedup", near_copies), ("mixing to weights", source_mix),
    ("SentencePiece encoding", pieces),
]
# The language model, the draws of the mix and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
