"""Every operator as a query over the given tables. Each callable takes a session and the folder of the tables.

Ratios are rounded so that results can be compared across engines; the operators themselves do not round them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.compare import MONEY
from twinledger.functions.shape import as_rows
from twinledger.functions.sigma import sigma_approx, sigma_exact
from twinledger.model import TablePair
from twinledger.operators import amounts, fields, keys, lines, masks, quality, ranges, rows, scorecard
from twinledger.plans import derived_pairs as pairs
from twinledger.plans.reconciliation import Comparison, compare
from twinledger.session import scratch_dir
from twinledger.sources import controls, loading, lookups, tables
from twinledger.streaming import ledger
from twinledger.streaming.incremental import load_new_csv_files
from twinledger.streaming.metrics import RunningQuality

Query = Callable[[SparkSession, str], DataFrame]

ROUNDED = {"DPMO": 6, "YIELD": 9, "SIGMA_LEVEL": 6, "SIX_SIGMA": 6, "DPMO_PER_OPPORTUNITY": 6, "RUNNING_PCT_OF_TOTAL": 9,
           "SHARE_OF_TOTAL": 9, "mean_sigma": 6}
ATTRIBUTES = ("BIRTH_DT", "SEGMENT_CD", "RISK_CD", "STATE_CODE")
# Opportunities per row that differ from the number of fields, to exercise the override.
FIXED_OPPORTUNITIES = 42


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    wanted = {**ROUNDED, **digits}
    return df.withColumns({c: F.round(c, wanted[c]) for c in df.columns if c in wanted})


def cents(df: DataFrame) -> DataFrame:
    """Amounts and deltas as whole cents, without the binary noise of a subtraction."""
    noisy = ("src_", "new_", "delta_", "abs_delta_", "CALC_")
    return df.selectExpr(*[f"round(`{c}`, 2) AS `{c}`" if c.startswith(noisy) else f"`{c}`" for c in df.columns])


def _csv_copy(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_dir(spark, name)
    tables.write_csv(df, path)
    return path


# Load and checks

def s01_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members written as CSV and loaded with their declared types."""
    members = pairs.members_pair(spark, sf_dir).src
    return tables.read_csv_table(spark, _csv_copy(spark, members, "members-csv"), members.schema)


def s02_multi_file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members written as one folder per year without their year, and loaded in one scan with the year out of each file's path."""
    members = pairs.members_pair(spark, sf_dir).new
    path = scratch_dir(spark, "members-by-year")
    members.withColumn("part", F.col("YEAR")).drop("YEAR").write.partitionBy("part").option("header", True).csv(path)
    loaded = loading.load_csv(spark, path, members.schema, scratch_dir(spark, "members"), {"YEAR": loading.from_path(r"part=(\d+)")})
    return loaded.table.groupBy("YEAR").agg(
        F.count("*").alias("n_rows"), F.sum("COVER_MONS").alias("months"), _money("REIMB_AMT", "reimbursed"),
    )


def s03_null_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with NULLs stored as text tokens, cleaned by the load."""
    members = pairs.members_pair(spark, sf_dir).new
    tokenised = members.select(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in members.columns])
    loaded = tables.read_csv_table(spark, _csv_copy(spark, tokenised, "members-tokens"), members.schema)
    return loaded.agg(
        F.count("*").alias("n_rows"), F.count("DEATH_DT").alias("with_death"), F.count("SEGMENT_CD").alias("with_segment"),
        F.count("REIMB_AMT").alias("with_reimb"), F.count("RESP_AMT").alias("with_resp"),
    )


def s04_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims loaded from CSV files as a stream, in two runs of which the second finds nothing new."""
    claims = pairs.claims_pair(spark, sf_dir).src
    source = _csv_copy(spark, claims, "claims-csv")
    table, checkpoint = scratch_dir(spark, "claims-table"), scratch_dir(spark, "claims-checkpoint")
    for _ in range(2):
        load_new_csv_files(spark, source, claims.columns, claims.schema, table, checkpoint).awaitTermination()
    loaded = spark.read.schema(claims.schema).parquet(table)
    return loaded.agg(F.count("*").alias("n_rows"), F.count_distinct("CLM_ID").alias("n_claims"), _money("LINE_PMT_AMT_1", "paid"))


def s05_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, states = pairs.members_pair(spark, sf_dir).src, pairs.state_names(spark, sf_dir)
    per_code = members.groupBy("STATE_CODE").agg(F.count("*").alias("n"))
    named = per_code.join(states, F.col("STATE_CODE") == F.col("code"), "left_outer")
    return named.groupBy(F.coalesce("name", F.lit("Unknown")).alias("STATE_NAME")).agg(F.sum("n").alias("n_rows"))


def s06_control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables written as CSV, loaded, and added up on both sides of the load."""
    checks, folder = [], scratch_dir(spark, "derived")
    for kind, pair, column in (("members", pairs.members_pair(spark, sf_dir, folder), "COVER_MONS"),
                               ("claims", pairs.claims_pair(spark, sf_dir, folder), "LINE_PMT_AMT_1")):
        for label, df in (("source", pair.src), ("new", pair.new)):
            raw = tables.read_text_csv(spark, _csv_copy(spark, df, f"{label}-{kind}"))
            loaded = tables.write_table(tables.typed(raw, df.schema), scratch_dir(spark, f"{label}-{kind}-table"))
            checks.append(controls.ControlTotal(f"{label} {kind}", raw, loaded, column))
    return controls.control_totals(checks)


def s06_control_totals_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same four checks, the files read once: their totals are observed while the tables are written."""
    checks, folder = {}, scratch_dir(spark, "derived")
    for kind, pair, column in (("members", pairs.members_pair(spark, sf_dir, folder), "COVER_MONS"),
                               ("claims", pairs.claims_pair(spark, sf_dir, folder), "LINE_PMT_AMT_1")):
        for label, df in (("source", pair.src), ("new", pair.new)):
            files = _csv_copy(spark, df, f"{label}-{kind}")
            checks[f"{label} {kind}"] = loading.load_csv(spark, files, df.schema, scratch_dir(spark, f"{label}-{kind}-table"), totals=[column]), column
    return loading.loaded_totals(checks)


def s04_batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims loaded from CSV files in batches with a ledger; what the ledger says of all batches."""
    claims = pairs.claims_pair(spark, sf_dir).src
    source, folder = _csv_copy(spark, claims, "claims-csv"), scratch_dir(spark, "claims-batches")
    batches = ledger.BatchLoad(spark, source, claims.columns, claims.schema, folder, totals=["LINE_PMT_AMT_1"], files_per_batch=3)
    for _ in range(2):
        batches.run()
    entries, table = batches.entries(), batches.table()
    summed = entries.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"), F.sum("file_total").cast(MONEY).cast("double").alias("file_total"))
    return summed.unionByName(table.agg(F.count("*").alias("table_rows"), _money("LINE_PMT_AMT_1", "table_total")), allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("n_rows", "n_rejected", "file_total", "table_rows", "table_total")])


def s06_control_totals_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members whose files hold amounts with a currency sign, which are no numbers, and of which the load lost some."""
    members = pairs.members_pair(spark, sf_dir).src
    text = members.withColumn("REIMB_AMT", F.when(F.col("YEAR") == 1996, F.concat(F.lit("$"), F.col("REIMB_AMT").cast("string"))).otherwise(F.col("REIMB_AMT").cast("string")))
    raw = tables.read_text_csv(spark, _csv_copy(spark, text, "members-signs"))
    loaded = tables.typed(raw, members.schema, on_bad="null")
    checks = [controls.ControlTotal("reimbursed", raw, loaded.where("COVER_MONS <> 1"), "REIMB_AMT"), controls.ControlTotal("months", raw, loaded, "COVER_MONS")]
    return controls.control_totals(checks)


def s01_csv_quoted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, written as CSV and loaded again."""
    docs = pairs.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return tables.read_csv_table(spark, _csv_copy(spark, docs, "documents"), docs.schema, null_tokens=(), multi_line=True)


def _decoded(codes: DataFrame, lookup: DataFrame) -> DataFrame:
    named = codes.groupBy("code").agg(F.count("*").alias("n")).join(lookup, "code", "left_outer")
    return named.groupBy(F.coalesce("description", F.lit("Unknown")).alias("description")).agg(F.sum("n").alias("n_rows"))


def s05_sex_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by a code out of their key, decoded; one code in three is unknown."""
    customers = pairs.read(spark, sf_dir, "customer")
    return _decoded(customers.select((F.col("c_custkey") % 3 + 1).cast("string").alias("code")), lookups.sex_lookup(spark))


def s05_race_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = pairs.read(spark, sf_dir, "customer")
    return _decoded(customers.select((F.col("c_nationkey") % 8).cast("string").alias("code")), lookups.race_lookup(spark))


def s05_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas read from a JSON file, evaluated over all claim lines and summed."""
    path = scratch_dir(spark, "formulas")
    entries = [("PAID_AND_TAX", "Paid with deductible", "LINE_PMT_AMT + LINE_DDCT_AMT"), ("ALLOWED", "Allowed", "LINE_ALLOW_AMT")]
    listed = [{"Variable names": n, "Labels": label, "Sum of": logic, "Type": "NUM"} for n, label, logic in entries]
    spark.createDataFrame([(json.dumps(listed),)], "value string").coalesce(1).write.text(path)
    formulas = lookups.read_payment_formulas(spark, path)
    long = lines.explode_lines(pairs.claims_pair(spark, sf_dir).src, pairs.LINES, ("CLM_ID",))
    rules = lines.measures_from(formulas.select(F.col("variable_name").alias("name"), F.col("calculation_logic").alias("value_expr"), F.lit(None).cast("string").alias("cond_expr")))
    sums = lines.apply_measures(long, rules).agg(*[amounts.money_sum(F.col(r.name)).alias(r.name) for r in rules])
    stacked = as_rows(sums, "variable_name", {"total": {r.name: r.name for r in rules}})
    return stacked.join(formulas.select("variable_name", "label"), "variable_name")


def s05_variable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column profile of members with the label of each column, out of a label file."""
    path = scratch_dir(spark, "labels")
    labels = [(f"Members, {i}, {c}, Column {i}, {c.lower()}",) for i, c in enumerate(pairs.MEMBER_SPEC.fields, 1)]
    spark.createDataFrame([("File Source, #, Variable Names, Labels",), *labels], "value string").coalesce(1).write.text(path)
    profile = fields.column_profile(pairs.members_pair(spark, sf_dir))
    named = lookups.read_variable_labels(spark, path).select(F.col("variable_name").alias("field_name"), "label")
    return profile.join(named, "field_name", "left_outer").select("field_name", "label", "error_count")


def s07_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, members = pairs.claims_pair(spark, sf_dir), pairs.members_pair(spark, sf_dir)
    return rows.table_counts({
        "src_claims": claims.src, "new_claims": claims.new, "src_members": members.src, "new_members": members.new,
    })


def s08_row_count_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.row_count_comparison({"claims": pairs.claims_pair(spark, sf_dir), "members": pairs.members_pair(spark, sf_dir)})


def s09_csv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result written as CSV and read back."""
    found = rows.claim_mismatches(pairs.claims_pair(spark, sf_dir), "CLM_ID")
    return tables.read_csv_table(spark, _csv_copy(spark, found, "claim-mismatches"), found.schema, null_tokens=())


def s10_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(pairs.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _money(column: str, name: str):
    return amounts.money_sum(F.col(column)).alias(name)


# Missing and extra rows

def _findings(which: tuple[str, ...], spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.member_findings(pairs.members_pair(spark, sf_dir), "MEMBER_ID", "YEAR", "DEATH_DT", which=which)


def j03_finding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.finding_counts(_findings(("missing", "extra"), spark, sf_dir))


def j08_orphan_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, members = pairs.claims_pair(spark, sf_dir), pairs.members_pair(spark, sf_dir)
    return rows.orphan_rate(claims).unionByName(rows.orphan_rate(members))


# Value comparison

def v01_attribute_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.attribute_mismatches(pairs.members_pair(spark, sf_dir), ATTRIBUTES)


def v02_date_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = pairs.members_pair(spark, sf_dir)
    return fields.value_differences(pair, {"BIRTH_DT": "dob", "DEATH_DT": "dod"}, keys=["MEMBER_ID"])


def v03_member_symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = pairs.members_pair(spark, sf_dir)
    return rows.symmetric_difference(pair.src, pair.new)


def v03_claim_symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = pairs.claims_pair(spark, sf_dir)
    return rows.symmetric_difference(pair.src, pair.new, with_side=True)


def _kept(pair: TablePair, folder: str) -> TablePair:
    """The pair written once, for what reads it several times."""
    return TablePair(pair.spec, *(tables.write_table(df, f"{folder}/{side}") for side, df in (("src", pair.src), ("new", pair.new))))


def _difference_by_ranges(make_pair: Callable, with_side: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "ranges")
    pair = _kept(make_pair(spark, sf_dir), folder)
    return ranges.symmetric_difference(pair.src, pair.new, pair.spec.keys, folder, with_side=with_side)


def _one_sided_by_ranges(which: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "ranges")
    return ranges.one_sided_rows(_kept(pairs.claims_pair(spark, sf_dir), folder), folder)[which]


def _defects(make_pair: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.field_flags(make_pair(spark, sf_dir), only_defects=True)


def _payments(fanout: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payments_of(pairs.claims_pair(spark, sf_dir), pairs.members_pair(spark, sf_dir), spark, sf_dir, fanout)


def _payments_of(claims: TablePair, members: TablePair, spark: SparkSession, sf_dir: str, fanout: bool) -> DataFrame:
    return lines.line_payment_differences(
        claims, members, pairs.state_names(spark, sf_dir),
        claim="CLM_ID", member="MEMBER_ID", from_date="CLM_FROM_DT", year="YEAR", state_code="STATE_CODE",
        payment="LINE_PMT_AMT_1", indicator="LINE_IND_CD_1", allowed="LINE_ALLOW_AMT_1", fanout=fanout,
    )


def v08_claim_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.column_profile(pairs.claims_pair(spark, sf_dir).keyed_by("CLM_ID"))


def _differences(make_pair: Callable, keys: tuple[str, ...], spark: SparkSession, sf_dir: str) -> fields.Differences:
    return fields.differences(make_pair(spark, sf_dir).keyed_by(*keys), scratch_dir(spark, "differences"))


def v08_claim_profile_of_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column profile out of the rows that one comparison wrote."""
    return _differences(pairs.claims_pair, ("CLM_ID",), spark, sf_dir).profile()


def v09_claim_mismatch_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both values of the columns that differ anywhere, from the same comparison as the profile."""
    return _differences(pairs.claims_pair, ("CLM_ID",), spark, sf_dir).detail()


def v09_member_mismatch_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every differing value of members as a row."""
    pair = pairs.members_pair(spark, sf_dir)
    whole_cents = [F.round(F.col(a) * 100).cast("long").alias(a) for a in pair.spec.amounts]
    others = [c for c in (*pair.spec.keys, *pair.spec.fields) if c not in pair.spec.amounts]
    in_cents = TablePair(pair.spec, *(df.select(*others, *whole_cents) for df in (pair.src, pair.new)))
    return fields.differences(in_cents, scratch_dir(spark, "differences")).cells()


def v04_member_packed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.packed_flags(pairs.members_pair(spark, sf_dir)).drop("in_src", "in_new")


def v05_claim_packed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.packed_flags(pairs.claims_pair(spark, sf_dir)).drop("in_src", "in_new")


def v06_claim_defects_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the number of their defects, which are the set bits of their flags."""
    pair = pairs.claims_pair(spark, sf_dir)
    n_defects = F.expr(masks.n_set(fields.flag_names(pair), pair.spec.fields)).cast("int").alias("n_defects")
    return fields.packed_flags(pair).groupBy(n_defects).agg(F.count("*").alias("n_rows"))


def v10_amount_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.amount_differences(pairs.claims_pair(spark, sf_dir).keyed_by("CLM_ID"), "LINE_PMT_AMT_1")


# Amounts

def f01_member_amount_deltas_by_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas of members matched on their demographics as well, so that a changed birth date leaves two unmatched rows."""
    pair = pairs.members_pair(spark, sf_dir).keyed_by("MEMBER_ID", "YEAR", "BIRTH_DT", "SEGMENT_CD").with_spec(nullable_keys=True)
    return cents(amounts.amount_deltas(pair))


def _impact(make_pair: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = make_pair(spark, sf_dir)
    return amounts.family_impact(amounts.field_totals(pair), pair.spec.subject)


# Quality

def _yields(sigma: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sigma function over the yields of all claim columns."""
    columns = quality.column_quality(pairs.claims_pair(spark, sf_dir))
    process_yield = F.lit(1.0) - quality.ratio(F.col("TOTAL_DEFECTS"), F.col("TOTAL_OPPORTUNITIES"))
    return columns.select("column_name", F.round(process_yield, 9).alias("process_yield"), F.round(sigma(process_yield), 6).alias("sigma"))


def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = (pairs.claims_pair(spark, sf_dir), pairs.members_pair(spark, sf_dir))
    return quality.overall_quality(both[0]).unionByName(quality.overall_quality(both[1]))


def q03_overall_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_overall(spark, sf_dir))


def q03_overall_quality_by_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result by way of narrow fingerprints."""
    folder = scratch_dir(spark, "fingerprints")
    both = (pairs.claims_pair(spark, sf_dir, folder), pairs.members_pair(spark, sf_dir, folder))
    parts = [quality.overall_quality(pair, strategy="fingerprint", workdir=f"{folder}/census-{pair.spec.subject}") for pair in both]
    return rounded(parts[0].unionByName(parts[1]))


def _running(spark: SparkSession, sf_dir: str) -> tuple[TablePair, DataFrame]:
    """Claims that come in three batches, most rows of the two systems at different times, and the counts after them."""
    pair = pairs.claims_pair(spark, sf_dir, scratch_dir(spark, "running-claims"))
    kept = RunningQuality(spark, pair.spec, pair.src.select(*pair.spec.keys, *pair.spec.fields).schema, scratch_dir(spark, "running"))
    dealt = [df.withColumn("part", F.pmod(F.xxhash64("CLM_ID", F.lit(side)), F.lit(3))) for side, df in enumerate((pair.src, pair.new))]
    for number in range(3):
        kept.add(number, *[df.where(F.col("part") == number).drop("part") for df in dealt])
    return pair, kept.counts(3)


def q03_running_claim_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair, counts = _running(spark, sf_dir)
    return rounded(quality.overall_from_counts(counts, pair.spec))


def q05_running_claim_family_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair, counts = _running(spark, sf_dir)
    return rounded(quality.family_quality(quality.columns_from_counts(counts, pair.spec)))


def q03_claim_quality_fixed_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.overall_quality(pairs.claims_pair(spark, sf_dir), FIXED_OPPORTUNITIES))


def _columns(make_pair: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_quality(make_pair(spark, sf_dir))


def _families(make_pair: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.family_quality(_columns(make_pair, spark, sf_dir))


def q07_exact_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.with_exact_sigma(_overall(spark, sf_dir)))


# Lines and rules

def r05_claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.explode_lines(pairs.claims_pair(spark, sf_dir).src, pairs.LINES, ("MEMBER_ID", "CLM_ID", "CLM_FROM_DT"))


def r06_valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = lines.explode_lines(pairs.claims_pair(spark, sf_dir).new, pairs.LINES, ("CLM_ID",))
    valid = lines.valid_line(F.col("LINE_IND_CD"), F.col("LINE_ALLOW_AMT"))
    return long.groupBy(valid.alias("is_valid")).agg(F.count("*").alias("n_lines"), _money("LINE_ALLOW_AMT", "allowed"))


def _annual(claims: DataFrame) -> DataFrame:
    return lines.annual_measures(claims, pairs.LINES, pairs.MEASURES, "MEMBER_ID", "CLM_FROM_DT")


def r07_annual_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annual(pairs.claims_pair(spark, sf_dir).src)


# A rule table as it may be kept next to the data; no rule guards against NULL itself.
RULE_ROWS = (
    ("CALC_ALLOWED", "LINE_ALLOW_AMT", "LINE_IND_CD = 'A'"), ("CALC_COINS", "LINE_COINS_AMT + LINE_DDCT_AMT", None),
    ("CALC_SHARE", "LINE_PMT_AMT - nullif(LINE_PRPAY_AMT, 0) / 2", "LINE_IND_CD IN ('R', 'N')"),
)


def r07_annual_measures_from_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual measures out of a rule table."""
    rules = lines.measures_from(spark.createDataFrame(RULE_ROWS, "name string, value_expr string, cond_expr string"))
    return lines.annual_measures(pairs.claims_pair(spark, sf_dir).src, pairs.LINES, rules, "MEMBER_ID", "CLM_FROM_DT")


def r08_recomputed_vs_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, members = pairs.claims_pair(spark, sf_dir), pairs.members_pair(spark, sf_dir)
    systems = {"src": (members.src, _annual(claims.src)), "new": (members.new, _annual(claims.new))}
    compared = lines.recomputed_vs_reported(systems, "REIMB_AMT", "CALC_REIMB", 1996, 1998)
    return rounded(compared, difference=2)


def a08_line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = lines.explode_lines(pairs.claims_pair(spark, sf_dir).src, pairs.LINES, ("CLM_ID",))
    measured = lines.apply_measures(long, pairs.MEASURES)
    return cents(measured.select("CLM_ID", "LINE_NUM", *[m.name for m in pairs.MEASURES]))


# Scorecard

def _compared(spark: SparkSession, sf_dir: str) -> tuple[Comparison, Comparison]:
    """Members and claims, each derived, stored and compared once; the scorecard is then worked out from what changed."""
    def stored(make_pair: Callable, name: str) -> Comparison:
        folder = scratch_dir(spark, name)
        return compare(make_pair(spark, sf_dir, folder), f"{folder}/compared")

    # Both are derived and compared at the same time: the stages of one fill what those of the other leave idle.
    with ThreadPoolExecutor(2) as pool:
        return tuple(pool.map(lambda part: stored(*part), ((pairs.members_pair, "members"), (pairs.claims_pair, "claims"))))


def _metrics(m: Comparison, c: Comparison, spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.count_metrics({
        "missing_members": rows.member_findings(m.changed, "MEMBER_ID", "YEAR", "DEATH_DT", which=("missing", "extra")),
        "member_defect_rows": m.flags.where(masks.any_set(fields.flag_names(m.whole), m.whole.spec.fields)),
        "missing_claims": rows.claim_mismatches(c.changed, "CLM_ID"),
        "claim_defect_rows": c.flags.where(masks.any_set(fields.flag_names(c.whole), c.whole.spec.fields)),
        "payment_differences": _payments_of(c.changed, m.whole, spark, sf_dir, fanout=False),
    })


def g01_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scorecard.quality_grades(_overall(spark, sf_dir)))


def g02_count_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.count_grades(_metrics(*_compared(spark, sf_dir), spark, sf_dir))


def _top_families(make_pair: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scorecard.top_families(_families(make_pair, spark, sf_dir)))


def g04_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, c = _compared(spark, sf_dir)
    m_counts, c_counts = (quality.counts_of_flags(side.flags, fields.flag_names(side.whole), side.units) for side in (m, c))
    overall = quality.overall_from_counts(c_counts, c.whole.spec).unionByName(quality.overall_from_counts(m_counts, m.whole.spec))
    families = quality.family_quality(quality.columns_from_counts(c_counts, c.whole.spec))
    impact = amounts.family_impact(amounts.field_totals(c.changed), c.whole.spec.subject)
    return rounded(scorecard.recommendations(overall, families, impact, _metrics(m, c, spark, sf_dir)), value=6)


def g05_conclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scorecard.conclusion(_overall(spark, sf_dir)))


def g06_missing_member_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.sample_rows(_findings(("missing",), spark, sf_dir), ["MEMBER_ID", "YEAR"])


def g06_orphan_claim_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.sample_rows(rows.extra_rows(pairs.claims_pair(spark, sf_dir)), pairs.CLAIM_SPEC.keys)


def on_pair(operator: Callable, make_pair: Callable, **options) -> Query:
    """An operator that takes nothing but a pair."""
    return lambda spark, sf_dir: operator(make_pair(spark, sf_dir), **options)


def queries() -> dict[str, Query]:
    members, claims = pairs.members_pair, pairs.claims_pair
    by_claim = lambda spark, sf_dir: claims(spark, sf_dir).keyed_by("CLM_ID")
    found: dict[str, Query] = {
        "s01_csv_load": s01_csv_load,
        "s01_csv_quoted_values": s01_csv_quoted_values,
        "s02_multi_file_union": s02_multi_file_union,
        "s03_null_cleaning": s03_null_cleaning,
        "s04_incremental_load": s04_incremental_load,
        "s05_state_lookup": s05_state_lookup,
        "s05_sex_lookup": s05_sex_lookup,
        "s05_race_lookup": s05_race_lookup,
        "s05_formulas": s05_formulas,
        "s05_variable_labels": s05_variable_labels,
        "s04_batch_ledger": s04_batch_ledger,
        "s06_control_totals": s06_control_totals,
        "s06_control_totals_of_loads": s06_control_totals_of_loads,
        "s06_control_totals_mismatch": s06_control_totals_mismatch,
        "s07_table_counts": s07_table_counts,
        "s08_row_count_comparison": s08_row_count_comparison,
        "s09_csv_results": s09_csv_results,
        "s10_duplicate_keys": s10_duplicate_keys,
        "j01_missing_members": partial(_findings, ("missing",)),
        "j02_extra_members": partial(_findings, ("extra",)),
        "j03_finding_counts": j03_finding_counts,
        "j04_claim_mismatches": on_pair(rows.claim_mismatches, claims, claim="CLM_ID"),
        "j05_orphan_claims": on_pair(rows.extra_rows, claims),
        "j06_missing_member_rows": on_pair(rows.missing_rows, members),
        "j06_extra_member_rows": on_pair(rows.extra_rows, members),
        "j06_missing_claim_rows": on_pair(rows.missing_rows, by_claim),
        "j07_row_status": on_pair(rows.row_status, members),
        "j08_orphan_rate": j08_orphan_rate,
        "v01_attribute_mismatches": v01_attribute_mismatches,
        "v02_date_differences": v02_date_differences,
        "v03_member_symmetric_diff": v03_member_symmetric_diff,
        "v03_claim_symmetric_diff": v03_claim_symmetric_diff,
        "v03_member_symmetric_diff_by_ranges": partial(_difference_by_ranges, members, False),
        "v03_claim_symmetric_diff_by_ranges": partial(_difference_by_ranges, claims, True),
        "j05_orphan_claims_by_ranges": partial(_one_sided_by_ranges, 1),
        "j06_missing_claims_by_ranges": partial(_one_sided_by_ranges, 0),
        "v05_line_flags_of_shared_keys": on_pair(fields.field_flags, pairs.shared_lines_pair),
        "v06_line_defects_of_shared_keys": on_pair(fields.field_flags, pairs.shared_lines_pair, only_defects=True),
        "f02_line_deltas_of_shared_keys": on_pair(amounts.amount_deltas, pairs.shared_lines_pair),
        "q04_line_quality_of_shared_keys": lambda spark, sf_dir: rounded(quality.column_quality(pairs.shared_lines_pair(spark, sf_dir), strategy="fingerprint")),
        "v04_member_field_flags": on_pair(fields.field_flags, members),
        "v05_claim_field_flags": on_pair(fields.field_flags, claims),
        "v04_member_packed_flags": v04_member_packed_flags,
        "v05_claim_packed_flags": v05_claim_packed_flags,
        "v06_claim_defects_per_row": v06_claim_defects_per_row,
        "v06_member_defect_rows": partial(_defects, members),
        "v06_claim_defect_rows": partial(_defects, claims),
        "v07_line_payment_differences": partial(_payments, False),
        "v07_line_payment_differences_fanout": partial(_payments, True),
        "v08_member_column_profile": on_pair(fields.column_profile, members),
        "v08_claim_column_profile": v08_claim_column_profile,
        "v08_claim_profile_of_differences": v08_claim_profile_of_differences,
        "v09_member_mismatch_cells": v09_member_mismatch_cells,
        "v09_claim_mismatch_detail": v09_claim_mismatch_detail,
        "v10_amount_differences": v10_amount_differences,
        "v11_claim_field_flags_source_driven": on_pair(fields.field_flags, claims, one_sided="null_new_only"),
        "f01_member_amount_deltas": lambda spark, sf_dir: cents(amounts.amount_deltas(members(spark, sf_dir))),
        "f01_member_amount_deltas_by_demographics": f01_member_amount_deltas_by_demographics,
        "f02_claim_amount_deltas": lambda spark, sf_dir: cents(amounts.amount_deltas(claims(spark, sf_dir))),
        "f03_member_delta_rollup": on_pair(amounts.delta_rollup, members),
        "f04_claim_delta_rollup": on_pair(amounts.delta_rollup, claims),
        "f03_delta_rollup_fine_amounts": on_pair(amounts.delta_rollup, pairs.fine_charges_pair),
        "f05_field_totals_fine_amounts": on_pair(amounts.field_totals, pairs.fine_charges_pair),
        "f05_member_field_totals": on_pair(amounts.field_totals, members),
        "f06_claim_field_totals": on_pair(amounts.field_totals, claims),
        "f07_claim_family_impact": lambda spark, sf_dir: rounded(_impact(claims, spark, sf_dir)),
        "f08_member_family_impact": lambda spark, sf_dir: rounded(_impact(members, spark, sf_dir)),
        "f09_claim_impact_shares": lambda spark, sf_dir: rounded(amounts.impact_shares(_impact(claims, spark, sf_dir))),
        "f09_member_impact_shares": lambda spark, sf_dir: rounded(amounts.impact_shares(_impact(members, spark, sf_dir))),
        "f10_member_net_totals": on_pair(amounts.net_field_totals, members),
        "q01_sigma_approx": partial(_yields, sigma_approx),
        "q02_sigma_exact": partial(_yields, sigma_exact),
        "q03_overall_quality": q03_overall_quality,
        "q03_running_claim_quality": q03_running_claim_quality,
        "q05_running_claim_family_quality": q05_running_claim_family_quality,
        "q03_overall_quality_by_fingerprint": q03_overall_quality_by_fingerprint,
        "q03_claim_quality_fixed_opportunities": q03_claim_quality_fixed_opportunities,
        "q04_member_column_quality": lambda spark, sf_dir: rounded(_columns(members, spark, sf_dir)),
        "q04_claim_column_quality": lambda spark, sf_dir: rounded(_columns(claims, spark, sf_dir)),
        "q05_claim_family_quality": lambda spark, sf_dir: rounded(_families(claims, spark, sf_dir)),
        "q06_member_family_quality": lambda spark, sf_dir: rounded(_families(members, spark, sf_dir)),
        "q07_exact_quality": q07_exact_quality,
        "r05_claim_lines": r05_claim_lines,
        "r06_valid_lines": r06_valid_lines,
        "r07_annual_measures": r07_annual_measures,
        "r07_annual_measures_from_rules": r07_annual_measures_from_rules,
        "r08_recomputed_vs_reported": r08_recomputed_vs_reported,
        "a08_line_measures": a08_line_measures,
        "g01_quality_grades": g01_quality_grades,
        "g02_count_grades": g02_count_grades,
        "g03_top_claim_families": partial(_top_families, claims),
        "g03_top_member_families": partial(_top_families, members),
        "g04_recommendations": g04_recommendations,
        "g05_conclusion": g05_conclusion,
        "g06_missing_member_sample": g06_missing_member_sample,
        "g06_orphan_claim_sample": g06_orphan_claim_sample,
    }
    return found
