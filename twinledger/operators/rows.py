"""Missing, extra and orphan rows, whole-row differences, and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.compare import ratio
from twinledger.model import TablePair
from twinledger.operators.keys import null_safe_join

# The labels of the findings.
MISSING_MEMBER = "Error: Beneficiary Missing in New File"
EXTRA_MEMBER = "Error: Beneficiary Present in New File, Not in Original File"
MISSING_CLAIM = "Error: Claim Missing in New File"
EXTRA_CLAIM = "Error: Claim Present in New File, Not in Original File"
MISSING_STATUS = "Missing in New"
EXTRA_STATUS = "Extra in New"


def anti_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], nullable_keys: bool = True) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``.

    The right side is reduced to distinct keys first: its copies are then combined before the shuffle.
    """
    wanted = right.select(*keys).distinct()
    if nullable_keys:
        return null_safe_join(left, wanted, keys, "left_anti")
    return left.join(wanted, list(keys), "left_anti")


def missing_rows(pair: TablePair) -> DataFrame:
    """Source rows whose key the new system lacks."""
    return anti_rows(pair.src, pair.new, pair.spec.keys, pair.spec.nullable_keys)


def extra_rows(pair: TablePair) -> DataFrame:
    """New rows whose key the source system lacks (orphans)."""
    return anti_rows(pair.new, pair.src, pair.spec.keys, pair.spec.nullable_keys)


def expected_alive(death_date: str, year: str) -> Column:
    """No death date, or a death year up to the record's year, compared as text."""
    return F.col(death_date).isNull() | (F.left(F.col(death_date), F.lit(4)) <= F.col(year).cast("string"))


def member_findings(pair: TablePair, member: str, year: str, death_date: str, expected: Column | None = None,
                    which: Sequence[str] = ("missing", "extra")) -> DataFrame:
    """Missing and extra members with the finding and the year of death; ``expected`` selects the rows that count."""
    keep = expected_alive(death_date, year) if expected is None else expected

    def labelled(rows: DataFrame, finding: str) -> DataFrame:
        return rows.where(keep).select(
            F.col(member),
            F.coalesce(F.left(F.col(death_date), F.lit(4)), F.lit("")).alias("DEATH_YEAR"),
            F.col(year).cast("string").alias("YEAR"),
            F.lit(finding).alias("FINDING"),
        )

    parts = {
        "missing": lambda: labelled(missing_rows(pair), MISSING_MEMBER),
        "extra": lambda: labelled(extra_rows(pair), EXTRA_MEMBER),
    }
    chosen = [parts[name]() for name in which]
    return chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])


def finding_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("FINDING").agg(F.count("*").alias("n_rows"))


def one_sided_keys(pair: TablePair, missing: str, extra: str, column: str = "FINDING") -> DataFrame:
    """Distinct keys held by one side only, labelled: both directions in a single shuffle of the key columns."""
    keys = pair.spec.keys
    tagged = pair.src.select(*keys, F.lit(1).alias("is_src")).unionByName(pair.new.select(*keys, F.lit(0).alias("is_src")))
    sides = tagged.groupBy(*keys).agg(F.min("is_src").alias("lo"), F.max("is_src").alias("hi"))
    return sides.where("lo = hi").select(*keys, F.when(F.col("lo") == 1, missing).otherwise(extra).alias(column))


def claim_mismatches(pair: TablePair, claim: str) -> DataFrame:
    return one_sided_keys(pair.keyed_by(claim), MISSING_CLAIM, EXTRA_CLAIM)


def row_status(pair: TablePair) -> DataFrame:
    """Keys of missing and extra rows, one output row per input row."""
    keys = pair.spec.keys
    return (
        missing_rows(pair).select(F.lit(MISSING_STATUS).alias("status"), *keys)
        .unionByName(extra_rows(pair).select(F.lit(EXTRA_STATUS).alias("status"), *keys))
    )


def status_of(flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``row_status`` out of the packed flags of all rows that changed."""
    status = F.when(F.col("in_new").isNull(), MISSING_STATUS).otherwise(EXTRA_STATUS).alias("status")
    return flags.where("in_src IS NULL OR in_new IS NULL").select(status, *keys)


def orphan_rates_of(statuses: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``orphan_rate`` of several tables out of their row status and source rows."""
    parts = []
    for subject, (status, src) in statuses.items():
        parts.append(status.agg(F.count_if(F.col("status") == MISSING_STATUS).alias("orphan_rows")).withColumn("subject", F.lit(subject)))
        parts.append(src.agg(F.count("*").alias("src_rows")).withColumn("subject", F.lit(subject)))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    totals = stacked.groupBy("subject").agg(F.sum("src_rows").alias("src_rows"), F.sum("orphan_rows").alias("orphan_rows"))
    return totals.select("subject", "src_rows", "orphan_rows", _orphan_rate())


def _orphan_rate() -> Column:
    return F.round(F.coalesce(ratio(F.col("orphan_rows") * 100, F.col("src_rows")), F.lit(0.0)), 4).alias("orphan_rate")


def orphan_rate(pair: TablePair) -> DataFrame:
    """Missing source rows in percent of all source rows; 0 for an empty source."""
    keys = pair.spec.keys
    known = pair.new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("known", F.lit(1))
    if pair.spec.nullable_keys:
        condition = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    else:
        condition = [F.col(k) == F.col(f"__{k}") for k in keys]
    checked = pair.src.select(*keys).join(known, condition, "left_outer")
    totals = checked.agg(F.count("*").alias("src_rows"), (F.count("*") - F.count("known")).alias("orphan_rows"))
    return totals.select(
        F.lit(pair.spec.subject).alias("subject"), "src_rows", "orphan_rows",
        _orphan_rate(),
    )


def symmetric_difference(src: DataFrame, new: DataFrame, columns: Sequence[str] | None = None,
                         with_side: bool = False) -> DataFrame:
    """Distinct rows found in exactly one of two tables, NULLs being equal: one group-by over tagged rows."""
    columns = list(columns or src.columns)
    tagged = src.select(*columns, F.lit(1).alias("is_src")).unionByName(new.select(*columns, F.lit(0).alias("is_src")))
    sides = tagged.groupBy(*columns).agg(F.min("is_src").alias("lo"), F.max("is_src").alias("hi")).where("lo = hi")
    marks = [F.when(F.col("lo") == 1, "src").otherwise("new").alias("side")] if with_side else []
    return sides.select(*columns, *marks)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
               for name, df in tables.items()]
    return _union(counted)


def row_count_comparison(pairs: Mapping[str, TablePair]) -> DataFrame:
    """Rows per side and the difference new - source."""
    sides = []
    for name, pair in pairs.items():
        sides.append(pair.src.agg(F.count("*").alias("src_count")).withColumn("new_count", F.lit(0).cast("long"))
                     .withColumn("table_name", F.lit(name)))
        sides.append(pair.new.agg(F.count("*").alias("new_count")).withColumn("src_count", F.lit(0).cast("long"))
                     .withColumn("table_name", F.lit(name)))
    totals = _union(sides).groupBy("table_name").agg(F.sum("src_count").alias("src_count"), F.sum("new_count").alias("new_count"))
    return totals.withColumn("diff", F.col("new_count") - F.col("src_count"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
