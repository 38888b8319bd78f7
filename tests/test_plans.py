"""Shapes of physical plans, and the whole reconciliation against the operators it stands for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bench import DERIVED_COLUMNS, stored
from helpers import rows_of
from twinledger.operators import amounts, fields, lines, quality, rows
from twinledger.plans import catalogue, derived_pairs as pairs
from twinledger.plans.reconciliation import grade, load_medical_claims, reconcile, reconcile_medical_claims, write_results
from twinledger.session import scratch_dir
from twinledger.sources import schemas

# Queries that write files before they return.
WRITING = ("s01", "s02", "s03", "s04", "s06", "s09")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in catalogue.queries() if not n.startswith(WRITING)))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, sf_dir, name):
    plan = plan_of(catalogue.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_narrow_queries_read_narrow_columns(spark, sf_dir):
    plan = plan_of(catalogue.queries()["j04_claim_mismatches"](spark, sf_dir))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_payment_lookup_comes_after_the_filter_and_needs_no_full_join(spark, sf_dir):
    plan = plan_of(catalogue.queries()["v07_line_payment_differences"](spark, sf_dir))
    assert "FullOuter" not in plan


def test_census_shuffles_keys_and_hashes_only(spark, sf_dir):
    from twinledger.operators.keys import key_census
    pair = stored(spark, pairs.claims_pair(spark, sf_dir), "census-test")
    exchanges = [line for line in plan_of(key_census(pair)).splitlines() if "Exchange" in line]
    assert len(exchanges) == 1


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    members, claims = (stored(spark, p, n) for p, n in ((pairs.members_pair(spark, sf_dir), "members"), (pairs.claims_pair(spark, sf_dir), "claims")))
    results = reconcile(members, claims, pairs.state_names(spark, sf_dir), DERIVED_COLUMNS, (1996, 1998))
    return members, claims, results


def test_results_from_changed_rows_equal_results_from_whole_tables(spark, sf_dir, run):
    members, claims, results = run
    states, c = pairs.state_names(spark, sf_dir), DERIVED_COLUMNS
    direct = {
        "missing_beneficiaries": rows.member_findings(members, c.member, c.year, c.death_date, which=("missing",)),
        "extra_beneficiaries": rows.member_findings(members, c.member, c.year, c.death_date, which=("extra",)),
        "beneficiary_attribute_mismatches": fields.attribute_mismatches(members, c.attributes),
        "comprehensive_beneficiary_differences": rows.symmetric_difference(members.src, members.new),
        "audit_beneficiary_summary": fields.field_flags(members, only_defects=True),
        "missing_claims": rows.claim_mismatches(claims, c.claim),
        "comprehensive_orphan_claims": rows.extra_rows(claims),
        "audit_claim_summary": fields.field_flags(claims, only_defects=True),
        "claim_payment_amount_discrepancies": lines.line_payment_differences(
            claims, members, states, claim=c.claim, member=c.member, from_date=c.from_date, year=c.year, state_code=c.state_code,
            payment=c.payment, indicator=c.indicator, allowed=c.allowed),
        "row_status_beneficiary": rows.row_status(members),
        "row_status_carrier_claim": rows.row_status(claims),
        "orphan_rates": rows.orphan_rate(members).unionByName(rows.orphan_rate(claims)),
        "column_profile_beneficiary": fields.column_profile(members),
        "column_profile_carrier_claim": fields.column_profile(claims.keyed_by(c.claim)),
        "mismatch_detail_carrier_claim": fields.mismatch_detail(claims.keyed_by(c.claim), ("CLM_FROM_DT", "HCPCS_CD_2", "LINE_PMT_AMT_1", "LINE_IND_CD_3")).select(
            results["mismatch_detail_carrier_claim"].columns),
        "amount_differences": fields.amount_differences(claims.keyed_by(c.claim), c.payment),
        "comprehensive_orphan_claims_sample": rows.extra_rows(claims).orderBy(*claims.src.columns).limit(5),
        "six_sigma": quality.with_exact_sigma(quality.overall_quality(claims).unionByName(quality.overall_quality(members))),
        "six_sigma_columns": quality.column_quality(claims).unionByName(quality.column_quality(members)),
        "financial_impact_carrier_claim": amounts.family_impact(amounts.field_totals(claims), claims.spec.subject),
    }
    for name, df in direct.items():
        assert rows_of(results[name]) == rows_of(df), name
        assert results[name].count() > 0, name


def test_counts_come_from_packed_flags_and_details_from_stored_rows(run):
    """Nothing but keys and a few numbers is read for counts; the detail has no join and only the columns that differ."""
    _, claims, results = run
    for name in ("six_sigma_columns", "audit_claim_summary", "row_status_carrier_claim"):
        plan = plan_of(results[name])
        assert "LINE_PMT_AMT_1#" not in plan.replace("AS LINE_PMT_AMT_1#", "") or name != "row_status_carrier_claim"
        assert "src_HCPCS_CD_2" not in plan and "FullOuter" not in plan
    detail = plan_of(results["mismatch_detail_carrier_claim"])
    assert "Join" not in detail and "Exchange" not in detail and "TAX_NUM_1" not in detail


def test_packed_flags_need_one_join_and_no_job_beforehand(spark, sf_dir):
    pair = stored(spark, pairs.claims_pair(spark, sf_dir), "packed-test")
    packed = fields.packed_flags(pair)
    assert [c for c in packed.columns if c not in pair.spec.keys] == ["in_src", "in_new", "flags_0"]
    packed.collect()
    assert plan_of(packed).count("SortMergeJoin") + plan_of(packed).count("ShuffledHashJoin") >= 1 and "WholeStageCodegen" in plan_of(packed) or "*(" in plan_of(packed)


def test_shared_keys_fail_or_are_reported(spark, sf_dir, run):
    members, claims, results = run
    from twinledger.model import TablePair
    twice = TablePair(claims.spec, claims.src.unionByName(claims.src.where("CLM_ID = '5'")), claims.new)
    args = (members, twice, pairs.state_names(spark, sf_dir), DERIVED_COLUMNS, (1996, 1998))
    with pytest.raises(ValueError, match="source claims: rows with a shared key: 2"):
        reconcile(*args)
    reported = reconcile(*args, shared_keys="report")
    assert rows_of(reported["claims_sharing_an_id"].select("side", "CLM_ID")) == [("new", "5"), ("src", "5"), ("src", "5")]
    counts = {r["table_name"]: r for r in reported["row_counts"].collect()}
    assert (counts["claims"].src_count, counts["claims"].new_count) == (twice.src.count(), twice.new.count())
    assert reported["six_sigma"].where("SUBJECT = 'Claims'").first().TOTAL_UNITS == results["six_sigma"].where("SUBJECT = 'Claims'").first().TOTAL_UNITS - 1


def test_scorecard_of_written_results(spark, run):
    written = write_results(run[2], scratch_dir(spark, "results"))
    graded = grade(written)
    assert {r.metric for r in graded["count_grades"].collect()} == {
        "missing_members", "member_defect_rows", "missing_claims", "claim_defect_rows", "payment_differences"}
    assert graded["conclusion"].count() == 1 and graded["recommendations"].count() >= 2


def test_medical_claims_from_files_to_scorecard(spark, sf_dir, tmp_path):
    """The full-width tables, filled from the orders, through files, load, comparison and scorecard."""
    def wide(df, schema, filled):
        columns = {f.name: F.lit(None).cast("string") for f in schema.fields}
        columns.update({name: value.cast("string") for name, value in filled.items()})
        return df.select([v.alias(n) for n, v in columns.items()])

    orders = pairs.read(spark, sf_dir, "orders")
    member = F.col("o_custkey").cast("string")
    members = wide(orders.select("o_custkey").distinct(), schemas.MEMBER_SCHEMA, {
        "DESYNPUF_ID": member, "BENE_BIRTH_DT": F.lit("19400101"), "SP_STATE_CODE": F.lit("05"), "MEDREIMB_CAR": F.col("o_custkey") + 0.5}).drop("YEAR")
    claims = wide(orders, schemas.CLAIM_SCHEMA, {
        "DESYNPUF_ID": member, "CLM_ID": F.col("o_orderkey"), "CLM_FROM_DT": F.lit("20080102"), "CLM_THRU_DT": F.lit("20080103"),
        "LINE_NCH_PMT_AMT_1": F.round("o_totalprice", 2), "LINE_ALOWD_CHRG_AMT_1": F.lit(1), "LINE_PRCSG_IND_CD_1": F.lit("A"),
        "LINE_NCH_PMT_AMT_13": F.lit(2), "LINE_ALOWD_CHRG_AMT_13": F.lit(0), "LINE_PRCSG_IND_CD_13": F.lit("R")})
    n_claims = claims.count()
    changed = claims.where("CLM_ID <> '0'").withColumn("LINE_NCH_PMT_AMT_1", F.when(F.col("CLM_ID") == "1", "1.00").otherwise(F.col("LINE_NCH_PMT_AMT_1")))
    paths = {}
    for name, df in (("src-m", members), ("new-m", members.where("DESYNPUF_ID <> '0'")), ("src-c", claims), ("new-c", changed)):
        paths[name] = str(tmp_path / name)
        df.write.option("header", True).csv(paths[name])
    m, c = load_medical_claims(spark, ({2008: paths["src-m"]}, {2008: paths["new-m"]}), (paths["src-c"], paths["new-c"]), str(tmp_path / "loaded"))
    results = reconcile_medical_claims(spark, m, c, str(tmp_path / "out"))
    overall = {r.SUBJECT: r for r in results["six_sigma"].collect()}
    # The lost claim has five non-empty fields besides its keys, one of which is a 0; the changed one differs in one field.
    assert (overall["Carrier Claims"].TOTAL_UNITS, overall["Carrier Claims"].TOTAL_DEFECTS) == (n_claims, 5 + 1)
    assert overall["Carrier Claims"].TOTAL_OPPORTUNITIES == n_claims * 138
    assert results["missing_claims"].count() == 1 and results["audit_claim_summary"].count() == 2
    assert results["claim_payment_amount_discrepancies"].first().STATE_NAME == "CA"
    impact = results["financial_impact_carrier_claim"].where("FIELD_FAMILY = 'LINE_NCH_PMT_AMT'").first()
    assert impact.FINANCIAL_VARIANCE == pytest.approx(float(claims.where("CLM_ID = '1'").first().LINE_NCH_PMT_AMT_1) - 1.0, abs=0.005)
    paid = results["recomputed_payments"].where("system = 'source'").first().recomputed_total
    assert paid == pytest.approx(claims.agg(F.sum(F.col("LINE_NCH_PMT_AMT_1").cast("decimal(18,2)"))).first()[0].__float__())
