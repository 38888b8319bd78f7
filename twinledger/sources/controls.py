"""Control totals: does a loaded table add up to its files?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions.compare import MONEY, null_if_token

# Fixed value: largest difference that still counts as a match.
TOLERANCE = 0.1


@dataclass(frozen=True)
class ControlTotal:
    """``column`` summed over the raw files and over the loaded table."""

    name: str
    raw: DataFrame
    table: DataFrame
    column: str


def control_totals(checks: Sequence[ControlTotal], tolerance: float = TOLERANCE) -> DataFrame:
    """``check``, ``file_total``, ``table_total``, ``diff``, ``n_rejected``, ``is_match``; only the summed column is read.

    ``n_rejected`` counts values of the files that are neither a null token nor a number: the load and the total of the files
    both leave them out, so totals alone would agree. A check matches only if there are none.
    """
    parts = []
    for check in checks:
        text = null_if_token(F.col(check.column).cast("string"))
        number = text.try_cast(MONEY)
        in_files = check.raw.agg(F.sum(number).alias("file_total"), F.count_if(text.isNotNull() & number.isNull()).alias("n_rejected"))
        in_table = check.table.agg(F.sum(F.col(check.column).try_cast(MONEY)).alias("table_total"))
        parts.append(in_files.unionByName(in_table, allowMissingColumns=True).withColumn("check", F.lit(check.name)))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    totals = stacked.groupBy("check").agg(*[
        F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in ("file_total", "table_total")
    ], F.coalesce(F.sum("n_rejected"), F.lit(0)).alias("n_rejected"))
    with_diff = totals.withColumn("diff", F.abs(F.col("file_total") - F.col("table_total")))
    return with_diff.select("check", "file_total", "table_total", "diff", "n_rejected",
                            ((F.col("diff") < tolerance) & (F.col("n_rejected") == 0)).alias("is_match"))


def require_match(totals: DataFrame) -> None:
    """Raises when a check fails. Runs a job; there is one row per check."""
    failed = [row["check"] for row in totals.where(~F.col("is_match")).select("check").collect()]
    if failed:
        raise ValueError(f"control totals differ: {', '.join(failed)}")
