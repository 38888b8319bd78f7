"""Defects, DPMO, yield and sigma per table, column and field family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions.compare import quoted, ratio
from twinledger.functions.families import field_family
from twinledger.functions.shape import as_rows
from twinledger.functions.sigma import sigma_approx, sigma_exact
from twinledger.model import TablePair, TableSpec
from twinledger.operators import masks
from twinledger.operators.fields import STRATEGIES, flag_names, packed_flags
from twinledger.operators.keys import audited_rows, changed_pair, key_census
from twinledger.sources.tables import write_table

# Fixed value: opportunities per million.
MILLION = 1_000_000


def _plus(columns: Sequence[str]) -> str:
    return " + ".join(map(quoted, columns)) or "0"


# Estimated size of the smaller side from which ``auto`` shuffles fingerprints instead of rows.
FINGERPRINT_BYTES = 16 << 30


def chosen_strategy(pair: TablePair, strategy: str, from_bytes: int = FINGERPRINT_BYTES) -> str:
    """``auto`` by the optimizer's estimate of what would be read, which is exact for stored tables: a second scan of a small table
    costs more than shuffling it, one of a large table less."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy != "auto":
        return strategy
    sizes = [int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in (pair.src, pair.new)]
    return "fingerprint" if min(sizes) >= from_bytes else "direct"


def defect_counts(pair: TablePair, null_mode: str = "coalesce", strategy: str = "direct", workdir: str | None = None) -> DataFrame:
    """One row: ``units`` (audited rows) and the defects per column, key flags included.

    ``direct`` joins whole rows. ``fingerprint`` counts units over narrow keys and joins only rows that changed. ``auto`` takes the latter for
    large tables. ``workdir``, in shared storage: the census is written there instead of being made for the units and for each side.
    """
    if chosen_strategy(pair, strategy) == "direct":
        return packed_flags(pair, null_mode).agg(F.count("*").alias("units"), *masks.sums(flag_names(pair)))
    census = key_census(pair, null_mode)
    if workdir:
        census = write_table(census, workdir)
    return changed_defect_counts(changed_pair(pair, census), audited_rows(census, pair.spec.on_shared_keys == "match"), null_mode)


def changed_defect_counts(changed: TablePair, units: DataFrame, null_mode: str = "coalesce") -> DataFrame:
    """``defect_counts`` out of the changed rows of a pair and the number of audited rows of the whole pair."""
    return counts_of_flags(packed_flags(changed, null_mode), flag_names(changed), units)


def counts_of_flags(flags: DataFrame, names: Sequence[str], units: DataFrame) -> DataFrame:
    """``defect_counts`` out of the packed flags of all rows that changed."""
    both = units.unionByName(flags.agg(*masks.sums(names)), allowMissingColumns=True)
    return both.agg(F.sum("units").alias("units"), *_sums(names))


def _sums(columns: Sequence[str]) -> list[Column]:
    return [F.expr(f"coalesce(sum({quoted(c)}), 0) AS {quoted(c)}") for c in columns]


def with_rates(df: DataFrame) -> DataFrame:
    """DPMO, yield and approximate sigma from ``TOTAL_DEFECTS`` and ``TOTAL_OPPORTUNITIES``."""
    rate = ratio(F.col("TOTAL_DEFECTS"), F.col("TOTAL_OPPORTUNITIES"))
    return df.withColumns({"DPMO": rate * MILLION, "YIELD": F.lit(1.0) - rate, "SIGMA_LEVEL": sigma_approx(F.lit(1.0) - rate)})


def overall_quality(pair: TablePair, opportunities_per_row: int | None = None, null_mode: str = "coalesce",
                    strategy: str = "direct", workdir: str | None = None) -> DataFrame:
    """One row for the table. Every field of a row is one opportunity unless ``opportunities_per_row`` says otherwise;
    key flags are not counted."""
    if chosen_strategy(pair, strategy) == "direct":
        in_row = packed_flags(pair, null_mode).agg(
            F.count("*").alias("units"), F.expr(f"coalesce(sum({masks.n_set(flag_names(pair), pair.spec.fields)}), 0) AS defects"))
        return _overall(in_row, pair.spec, opportunities_per_row)
    return overall_from_counts(defect_counts(pair, null_mode, strategy, workdir), pair.spec, opportunities_per_row)


def overall_from_counts(counts: DataFrame, spec: TableSpec, opportunities_per_row: int | None = None) -> DataFrame:
    return _overall(counts.selectExpr("units", f"{_plus(spec.fields)} AS defects"), spec, opportunities_per_row)


def _overall(totals: DataFrame, spec: TableSpec, opportunities_per_row: int | None) -> DataFrame:
    per_row = len(spec.fields) if opportunities_per_row is None else opportunities_per_row
    named = totals.select(
        F.lit(spec.subject).alias("SUBJECT"),
        F.col("units").alias("TOTAL_UNITS"),
        F.col("defects").alias("TOTAL_DEFECTS"),
        (F.col("units") * per_row).alias("TOTAL_OPPORTUNITIES"),
    )
    return with_rates(named)


def with_exact_sigma(quality: DataFrame) -> DataFrame:
    """``SIX_SIGMA`` next to the approximation, wherever there is a ``YIELD``."""
    return quality.withColumn("SIX_SIGMA", sigma_exact(F.col("YIELD"))) if "YIELD" in quality.columns else quality


def column_quality(pair: TablePair, null_mode: str = "coalesce", strategy: str = "direct") -> DataFrame:
    """One row per audited column, key flags included.

    All columns are summed side by side in one aggregate; its single row is then turned into one row per column. A
    column's opportunities are the audited rows.
    """
    return columns_from_counts(defect_counts(pair, null_mode, strategy), pair.spec)


def columns_from_counts(counts: DataFrame, spec: TableSpec) -> DataFrame:
    columns = [c for c in counts.columns if c != "units"]
    stacked = as_rows(counts, "column_name", {"TOTAL_DEFECTS": {c: c for c in columns}}, carry=["units"])
    named = stacked.where("units > 0").select(
        F.lit(spec.subject).alias("SOURCE"), "column_name", "TOTAL_DEFECTS", F.col("units").alias("TOTAL_OPPORTUNITIES"),
    )
    return with_rates(named).drop("YIELD").orderBy("SOURCE", F.desc("TOTAL_DEFECTS"), "column_name")


def flag_quality(flags: DataFrame, subject: str, columns: list[str]) -> DataFrame:
    """``column_quality`` of flags that are at hand already. NULL flags are no opportunities."""
    wide = flags.agg(*[F.expr(f"{how}({quoted(c)}) AS `{how}_{c}`") for how in ("sum", "count") for c in columns])
    stacked = as_rows(wide, "column_name", {
        "TOTAL_DEFECTS": {c: f"sum_{c}" for c in columns}, "TOTAL_OPPORTUNITIES": {c: f"count_{c}" for c in columns},
    })
    named = stacked.where("TOTAL_OPPORTUNITIES > 0").select(F.lit(subject).alias("SOURCE"), "*")
    return with_rates(named).drop("YIELD").orderBy("SOURCE", F.desc("TOTAL_DEFECTS"), "column_name")


def family_quality(columns: DataFrame) -> DataFrame:
    """Column quality per field family, most defects first, with the running share of all defects.

    ``DPMO`` relates the defects of the whole family to audited rows; ``DPMO_PER_OPPORTUNITY`` to rows times columns.
    """
    families = columns.groupBy("SOURCE", field_family(F.col("column_name")).alias("FIELD_FAMILY")).agg(
        F.sum("TOTAL_DEFECTS").alias("TOTAL_DEFECTS"),
        F.max("TOTAL_OPPORTUNITIES").alias("units"),
        F.sum("TOTAL_OPPORTUNITIES").alias("opportunities"),
    )
    rate = ratio(F.col("TOTAL_DEFECTS"), F.col("units"))
    rated = families.withColumns({
        "DPMO": rate * MILLION,
        "DPMO_PER_OPPORTUNITY": ratio(F.col("TOTAL_DEFECTS"), F.col("opportunities")) * MILLION,
        "SIGMA_LEVEL": sigma_approx(F.lit(1.0) - rate),
    })
    source = Window.partitionBy("SOURCE")
    ranked = source.orderBy(F.desc("TOTAL_DEFECTS"), F.desc("DPMO"), "FIELD_FAMILY")
    running = F.sum("TOTAL_DEFECTS").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rated.select(
        "SOURCE", "FIELD_FAMILY", "TOTAL_DEFECTS",
        ratio(running, F.sum("TOTAL_DEFECTS").over(source)).alias("RUNNING_PCT_OF_TOTAL"),
        "DPMO", "DPMO_PER_OPPORTUNITY", "SIGMA_LEVEL",
    ).orderBy(F.desc("TOTAL_DEFECTS"), F.desc("DPMO"), "FIELD_FAMILY")
