"""Amount deltas between the systems and their financial impact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions.compare import amount_or_zero, any_of, money_sum, quoted, ratio
from twinledger.functions.families import field_family
from twinledger.functions.shape import as_rows
from twinledger.model import TablePair
from twinledger.operators.keys import join_sides


def cleaned(pair: TablePair) -> TablePair:
    """NULL and NaN amounts become 0 on both sides before the join, so that only absent rows give NULL deltas."""
    def zeroed(df: DataFrame) -> DataFrame:
        amounts = [f"{amount_or_zero(a, pair.type_of(a))} AS {quoted(a)}" for a in pair.spec.amounts]
        return df.selectExpr(*map(quoted, pair.spec.keys), *amounts)

    return TablePair(replace(pair.spec, fields=()), zeroed(pair.src), zeroed(pair.new))


def _delta(amount: str) -> str:
    return f"`new_{amount}` - `src_{amount}`"


def amount_deltas(pair: TablePair, how: str = "full_outer") -> DataFrame:
    """Per key and amount: ``src_``, ``new_``, ``delta_`` (new - source) and ``abs_delta_``."""
    columns = []
    for a in pair.spec.amounts:
        columns += [f"`src_{a}`", f"`new_{a}`", f"{_delta(a)} AS `delta_{a}`", f"abs({_delta(a)}) AS `abs_delta_{a}`"]
    return join_sides(cleaned(pair), how, pair.spec.amounts).selectExpr(*map(quoted, pair.spec.keys), *columns)


def matched_deltas(pair: TablePair) -> DataFrame:
    """Absolute deltas of matched rows that changed. One-sided rows have NULL deltas and unchanged rows add 0 to every
    sum, so that sums need neither; what is left is small."""
    amounts = pair.spec.amounts
    joined = join_sides(cleaned(pair), "inner", amounts).where(any_of([f"`src_{a}` <> `new_{a}`" for a in amounts]))
    return joined.selectExpr(*map(quoted, pair.spec.keys), *[f"abs({_delta(a)}) AS `abs_delta_{a}`" for a in amounts])


def delta_rollup(pair: TablePair, group_keys: Sequence[str] | None = None) -> DataFrame:
    """Absolute deltas summed per group, for groups whose deltas add up to more than 0."""
    names = [f"abs_delta_{a}" for a in pair.spec.amounts]
    grouped = matched_deltas(pair).groupBy(*(group_keys or pair.spec.keys))
    return grouped.agg(*[money_sum(F.col(n)).alias(n) for n in names]).where(any_of([f"`{n}` > 0" for n in names]))


def field_totals(pair: TablePair) -> DataFrame:
    """Total absolute delta per amount field, rounded to cents; no rows when nothing changed.

    Summed side by side first; only the one result row is turned into rows.
    """
    names = [f"abs_delta_{a}" for a in pair.spec.amounts]
    sums = matched_deltas(pair).agg(*[F.round(money_sum(F.col(n)), 2).alias(n) for n in names])
    stacked = as_rows(sums, "metric_name", {"total_abs_delta": {n: n for n in names}})
    return stacked.where("total_abs_delta IS NOT NULL").orderBy(F.desc("total_abs_delta"), "metric_name")


def net_field_totals(pair: TablePair) -> DataFrame:
    """Total signed delta (new - source) per amount field, where over- and underpayments cancel out."""
    amounts = pair.spec.amounts
    sums = amount_deltas(pair, "inner").agg(*[money_sum(F.col(f"delta_{a}")).alias(a) for a in amounts])
    return as_rows(sums, "amount", {"net_delta": {a: a for a in amounts}}).where("net_delta IS NOT NULL")


def family_impact(totals: DataFrame, subject: str) -> DataFrame:
    """Total absolute delta per field family, largest first, with the running share of the grand total."""
    families = (
        totals.groupBy(field_family(F.col("metric_name")).alias("FIELD_FAMILY"))
        .agg(money_sum(F.col("total_abs_delta")).alias("FINANCIAL_VARIANCE"))
        .select(F.lit(subject).alias("DATA_SET"), "FIELD_FAMILY", "FINANCIAL_VARIANCE")
    )
    subject_total = Window.partitionBy("DATA_SET")
    ranked = subject_total.orderBy(F.desc("FINANCIAL_VARIANCE"), "FIELD_FAMILY")
    running = F.sum("FINANCIAL_VARIANCE").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return families.withColumn(
        "RUNNING_PCT_OF_TOTAL", ratio(running, F.sum("FINANCIAL_VARIANCE").over(subject_total))
    ).orderBy(F.desc("FINANCIAL_VARIANCE"), "FIELD_FAMILY")


def impact_shares(impact: DataFrame) -> DataFrame:
    """Each family's share of its data set's grand total."""
    total = F.sum("FINANCIAL_VARIANCE").over(Window.partitionBy("DATA_SET"))
    return impact.select(
        "DATA_SET", "FIELD_FAMILY", "FINANCIAL_VARIANCE",
        total.alias("TOTAL_VARIANCE"), ratio(F.col("FINANCIAL_VARIANCE"), total).alias("SHARE_OF_TOTAL"),
    )
