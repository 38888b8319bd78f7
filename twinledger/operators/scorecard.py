"""Grades and recommendations out of quality, impact and count tables, all of them small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions.sigma import sigma_grade

# Counts above which a finding is critical rather than to be reviewed.
CRITICAL_ABOVE = {
    "missing_members": 100,
    "member_defect_rows": 1000,
    "missing_claims": 1000,
    "claim_defect_rows": 1000,
    "payment_differences": 10000,
}
# Sigma below which a table needs work, and the share of variance that makes a family a priority.
CRITICAL_SIGMA = 3.0
TARGET_SIGMA = 4.0
PRIORITY_SHARE = 0.3
# Recommendation per finding whose count is critical.
COUNT_ADVICE = {
    "missing_members": ("DATA LOSS", "Hold the extract against the load: members are absent from one side."),
    "member_defect_rows": ("DATA DISCREPANCIES", "Compare how each differing column is filled on either side."),
    "missing_claims": ("DATA LOSS", "Hold the extract against the load: claims are absent from one side."),
    "claim_defect_rows": ("DATA DISCREPANCIES", "Compare how each differing column is filled on either side."),
}
# The conclusion per grade.
CONCLUSIONS = {
    "World-class": "Nothing to mend.",
    "Excellent": "Look through the few differences and mend those that matter.",
    "Good": "Mend the differences found.",
    "Acceptable": "Mend the weakest columns before the switch.",
    "Needs Attention": "Do not switch systems with this data.",
}


def count_metrics(findings: Mapping[str, DataFrame]) -> DataFrame:
    """``metric``, ``n_rows``: the number of rows of each finding set."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("metric"), "n_rows") for name, df in findings.items()]
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    return metrics


def _lookup(key: str, table: Mapping[str, object]):
    """A fixed mapping as a column; NULL for other keys."""
    entries = list(table.items())
    column = F.when(F.col(key) == entries[0][0], F.lit(entries[0][1]))
    for name, value in entries[1:]:
        column = column.when(F.col(key) == name, F.lit(value))
    return column


def count_grades(metrics: DataFrame, critical_above: Mapping[str, int] = CRITICAL_ABOVE) -> DataFrame:
    graded = metrics.withColumn("threshold", _lookup("metric", critical_above).cast("long")).where("threshold IS NOT NULL")
    return graded.withColumn("status", F.when(F.col("n_rows") > F.col("threshold"), "Critical").otherwise("Review"))


def quality_grades(quality: DataFrame) -> DataFrame:
    return quality.select("SUBJECT", "DPMO", "YIELD", "SIGMA_LEVEL", sigma_grade(F.col("SIGMA_LEVEL")).alias("status"))


def top_families(families: DataFrame, n: int = 5) -> DataFrame:
    """The field families with the most defects."""
    return families.orderBy(F.desc("TOTAL_DEFECTS"), "FIELD_FAMILY").limit(n)


def sample_rows(rows: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows of a finding set in key order."""
    return rows.orderBy(*keys).limit(n)


def recommendations(quality: DataFrame, families: DataFrame, impact: DataFrame, metrics: DataFrame,
                    critical_above: Mapping[str, int] = CRITICAL_ABOVE) -> DataFrame:
    """``position``, ``priority``, ``subject``, ``value`` (the number behind it) and ``advice``, in reading order of
    ``position`` and ``subject``."""
    sigma = F.col("SIGMA_LEVEL")
    by_sigma = quality.where(sigma < TARGET_SIGMA).select(
        F.lit(1).alias("position"),
        F.when(sigma < CRITICAL_SIGMA, "CRITICAL").otherwise("HIGH PRIORITY").alias("priority"),
        F.col("SUBJECT").alias("subject"),
        sigma.alias("value"),
        F.when(sigma < CRITICAL_SIGMA, "Find out where the defects come from and load this table again.")
        .otherwise("Bring this table to 4 sigma before the switch.").alias("advice"),
    )
    focus = top_families(families, 1).select(
        F.lit(2).alias("position"), F.lit("FOCUS AREA").alias("priority"), F.col("FIELD_FAMILY").alias("subject"),
        F.col("TOTAL_DEFECTS").cast("double").alias("value"),
        F.lit("Most defects are in these columns: look at how they are filled.").alias("advice"),
    )
    largest = impact.orderBy(F.desc("FINANCIAL_VARIANCE"), "FIELD_FAMILY").limit(1)
    financial = largest.where(F.col("RUNNING_PCT_OF_TOTAL") > PRIORITY_SHARE).select(
        F.lit(3).alias("position"), F.lit("FINANCIAL PRIORITY").alias("priority"), F.col("FIELD_FAMILY").alias("subject"),
        F.col("RUNNING_PCT_OF_TOTAL").alias("value"),
        F.lit("Most of the money that differs is here: begin with it.").alias("advice"),
    )
    advised = metrics.where(F.col("n_rows") > _lookup("metric", {m: critical_above[m] for m in COUNT_ADVICE}))
    by_count = advised.select(
        _lookup("metric", {m: 4 + i for i, m in enumerate(COUNT_ADVICE)}).alias("position"),
        _lookup("metric", {m: priority for m, (priority, _) in COUNT_ADVICE.items()}).alias("priority"),
        F.col("metric").alias("subject"),
        F.col("n_rows").cast("double").alias("value"),
        _lookup("metric", {m: advice for m, (_, advice) in COUNT_ADVICE.items()}).alias("advice"),
    )
    return by_sigma.unionByName(focus).unionByName(financial).unionByName(by_count)


def conclusion(quality: DataFrame) -> DataFrame:
    """The grade of the mean sigma level over all tables."""
    mean = quality.agg(F.avg("SIGMA_LEVEL").alias("mean_sigma"))
    graded = mean.withColumn("grade", sigma_grade(F.col("mean_sigma")))
    return graded.withColumn("verdict", _lookup("grade", CONCLUSIONS))
