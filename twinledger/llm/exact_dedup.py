"""Exact duplicates by a content sort, with built-in functions only.

Texts are normalised by deleting white space. Sampled splitters deal the rows out by ranges of the normalised text, each
partition is sorted externally, and a row belongs to its neighbour's run if the whole normalised texts are equal. Runs of one
text that were cut apart are joined afterwards by their heads only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import WHITE_SPACE, stored

# Code points of the normalised text that splitters are cut from, so that what the driver samples stays small.
SPLITTER_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Of equal texts the one with most code points before normalisation stays, then the smallest id (a NULL id comes last).
    A NULL text is an empty one; empty texts equal each other. A row that occurs twice counts twice and stays once. Other
    columns are ignored, whatever their names; an empty table gives an empty result.

    A text held by very many rows is cut into ``salts`` runs, which the range splitters may tell apart, so no task gets the
    whole group. Equal rows of one run are adjacent after the sort; run heads, at most ``salts`` a text, then meet by digest.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"),
        F.coalesce(F.length(F.col(text_col)), F.lit(0)).alias("_points"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("_salt"),
    ).withColumns({"_cut": F.substring("_norm", 1, SPLITTER_CHARS), "_hash": F.xxhash64("_norm")})
    keys = ("_cut", "_hash", "_salt")
    run = Window.partitionBy(*keys, "_norm")
    best_first = (F.col("_points").desc(), F.col("_id").asc_nulls_last())
    runs = stored(
        # The window needs no exchange of its own: the ranges already keep equal keys together.
        rows.repartitionByRange(*keys)
        .withColumns({"_place": F.row_number().over(run.orderBy(*best_first)), "_run_size": F.count(F.lit(1)).over(run)})
        .select("_id", "_salt", "_points", "_place", "_run_size", F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha")),
        "exact-runs",
    )
    same_text = Window.partitionBy("_sha")
    heads = stored(
        runs.where("_place = 1").withColumns({
            "_keep": F.first("_id").over(same_text.orderBy(*best_first, "_salt").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "_head_place": F.row_number().over(same_text.orderBy(*best_first, "_salt")),
            "_size": F.sum("_run_size").over(same_text),
        }), "exact-heads",
    )
    followers = runs.where("_place > 1").select("_id", "_salt", "_sha").join(
        heads.where("_run_size > 1").select("_sha", "_salt", "_keep", "_size"), ["_sha", "_salt"])
    columns = lambda kept: (F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                            kept.alias("kept"), F.col("_sha").alias("text_sha256"))
    return heads.select(*columns(F.col("_head_place") == 1)).unionAll(followers.select(*columns(F.lit(False))))


def without_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Ids that occur once with a text need no more than that to be told apart;
    rows that repeat id and text stay once."""
    names = docs.columns
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    keyed = docs.withColumn("_kept_sha", F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    joined = keyed.alias("d").join(kept.alias("k"), F.col(f"d.{id_col}").eqNullSafe(F.col("k._kept_id")) & (F.col("d._kept_sha") == F.col("k._kept_sha")), "left_semi")
    once = Window.partitionBy(id_col, "_kept_sha").orderBy(F.length(text_col).desc_nulls_last(), F.xxhash64(*names))
    return joined.withColumn("_copy", F.row_number().over(once)).where("_copy = 1").select(*names)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) = 1 AS kept,
  sha256(norm) AS text_sha256
FROM d
"""
