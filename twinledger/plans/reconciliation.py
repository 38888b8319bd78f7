"""A whole reconciliation: two pairs of loaded tables in, all findings, quality, impact and grades out.

The tables are compared once, over keys and fingerprints. What changed is written down, and every finding is then worked
out from these rows; only counts, control totals and annual measures read the whole tables again.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from twinledger.model import TablePair
from twinledger.operators import amounts, fields, keys, lines, quality, rows, scorecard
from twinledger.session import scratch_dir
from twinledger.sources import controls, loading, schemas
from twinledger.sources.lookups import state_lookup
from twinledger.sources.tables import read_csv_table, write_csv, write_table

# NULL counts as a value here, so that the changed rows hold whatever any of the operators regards as a change.
CENSUS_MODE = "distinct"


@dataclass(frozen=True)
class Columns:
    """The columns that rules beyond plain comparison refer to."""

    member: str
    year: str
    birth_date: str
    death_date: str
    state_code: str
    attributes: tuple[str, ...]
    claim: str
    from_date: str
    payment: str
    indicator: str
    allowed: str
    reported: str
    recomputed: str
    lines: lines.LineLayout
    measures: tuple[lines.Measure, ...]
    claim_opportunities: int | None = None


# The columns of the medical claims exports.
MEDICAL_CLAIMS = Columns(
    member="DESYNPUF_ID", year="YEAR", birth_date="BENE_BIRTH_DT", death_date="BENE_DEATH_DT", state_code="SP_STATE_CODE",
    attributes=("BENE_BIRTH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD", "BENE_ESRD_IND"),
    claim="CLM_ID", from_date="CLM_FROM_DT", payment="LINE_NCH_PMT_AMT_1", indicator="LINE_PRCSG_IND_CD_1",
    allowed="LINE_ALOWD_CHRG_AMT_1", reported="MEDREIMB_CAR", recomputed="CALC_MEDREIMB_CAR",
    lines=schemas.CLAIM_LINES, measures=schemas.CARRIER_MEASURES,
)


# Fixed value: the column of the member files whose total is checked, months of coverage.
MEMBER_TOTAL = "BENE_HI_CVRAGE_TOT_MONS"
# Results that are written at the same time: each is a small job over the changed rows, which leaves most of a cluster idle.
WRITERS = 8


@dataclass(frozen=True)
class Comparison:
    """One compared pair: all rows, the rows that changed, how many rows there are to audit, and the packed flags of the changed
    rows (``fields.compared_flags``), from which everything is counted that needs no values."""

    whole: TablePair
    changed: TablePair
    units: DataFrame
    flags: DataFrame


def compare(pair: TablePair, workdir: str, whole: TablePair | None = None) -> Comparison:
    """Finds the changed rows of a pair and writes them below ``workdir``, which must be shared storage.

    A row counts as changed if any column does, since results are worked out from more columns than the compared fields.
    ``whole``: the pair with the rows that are not compared, for counts and lookups.
    """
    census = write_table(keys.key_census(pair, CENSUS_MODE, keys.other_columns(pair)), os.path.join(workdir, "census"))
    changed = keys.changed_pair(pair, census)
    written = TablePair(
        pair.spec, write_table(changed.src, os.path.join(workdir, "changed-src")),
        write_table(changed.new, os.path.join(workdir, "changed-new")),
    )
    flags = write_table(fields.compared_flags(written), os.path.join(workdir, "flags"))
    return Comparison(whole or pair, written, keys.audited_rows(census), flags)


def check_keys(members: TablePair, claims: TablePair, columns: Columns) -> None:
    """Raises unless members are unique by key and claims by id, none of them NULL."""
    keys.require_unique_keys({
        "source members": (members.src, members.spec.keys), "new members": (members.new, members.spec.keys),
        "source claims": (claims.src, [columns.claim]), "new claims": (claims.new, [columns.claim]),
    })


def reconcile(members: TablePair, claims: TablePair, states: DataFrame, columns: Columns, years: tuple[int, int],
              workdir: str | None = None, shared_keys: str = "fail") -> dict[str, DataFrame]:
    """All results by name. Checks the keys and writes the changed rows; the results themselves are lazy.

    ``shared_keys='fail'`` raises on keys that are not unique or NULL; ``'report'`` sets the rows of keys that a side holds
    more than once apart, in results of their own, and compares the others; counts, recomputed payments and lookups of members
    take all rows.
    """
    if shared_keys not in ("fail", "report"):
        raise ValueError(f"shared_keys must be 'fail' or 'report', not {shared_keys!r}")
    workdir = workdir or scratch_dir(members.src.sparkSession, "reconciliation")
    apart, originals = {}, (members, claims)
    if shared_keys == "fail":
        check_keys(members, claims, columns)
        # Checked: joins on members need not match NULLs any more.
        members = members.with_spec(nullable_keys=False)
    else:
        members, apart["members_sharing_a_key"] = keys.set_apart_shared_keys(members, members.spec.keys)
        claims, apart["claims_sharing_an_id"] = keys.set_apart_shared_keys(claims, [columns.claim])
    m, c = (compare(pair, os.path.join(workdir, name), whole)
            for name, pair, whole in (("members", members, originals[0]), ("claims", claims, originals[1])))
    findings = _findings(m, c, states, columns)
    return {**_counts(m, c, columns), **findings, **_samples(findings), **_profiles(m, c, columns, workdir), **_quality(m, c, columns), **_impact(m, c),
            **_recomputed(m, c, columns, years), **apart}


# The findings of which a few rows are shown.
SAMPLED = (
    "missing_beneficiaries", "extra_beneficiaries", "beneficiary_date_differences", "beneficiary_attribute_mismatches", "comprehensive_beneficiary_differences",
    "audit_beneficiary_summary", "claim_payment_amount_discrepancies", "comprehensive_orphan_claims", "audit_claim_summary",
)


def _samples(findings: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The first rows of the findings in the order of all of their columns."""
    return {f"{name}_sample": scorecard.sample_rows(findings[name], findings[name].columns) for name in SAMPLED}


def _profiles(m: Comparison, c: Comparison, columns: Columns, workdir: str) -> dict[str, DataFrame]:
    """Which columns differ, where, and which rows have no partner. Claims are matched by id here, members by their key; each
    pair is compared once more over its changed rows, whose differing ones are written with their values."""
    results = {}
    for name, side, keyed in (("beneficiary", m, ()), ("carrier_claim", c, (columns.claim,))):
        pair = side.changed.keyed_by(*keyed) if keyed else side.changed
        found = fields.differences(pair, os.path.join(workdir, f"differences-{name}"), src_rows=side.whole.src.count())
        results[f"column_profile_{name}"], results[f"mismatch_detail_{name}"] = found.profile(), found.detail()
        if keyed:
            results["amount_differences"] = found.amounts(columns.payment)
    statuses = [rows.status_of(side.flags, side.whole.spec.keys) for side in (m, c)]
    results["row_status_beneficiary"], results["row_status_carrier_claim"] = statuses
    results["orphan_rates"] = rows.orphan_rates_of({side.whole.spec.subject: (status, side.whole.src) for side, status in zip((m, c), statuses)})
    return results


def _counts(m: Comparison, c: Comparison, columns: Columns) -> dict[str, DataFrame]:
    return {
        "row_counts": rows.row_count_comparison({"members": m.whole, "claims": c.whole}),
        "table_counts": rows.table_counts({f"{side}_{name}": df for name, x in (("members", m), ("claims", c)) for side, df in (("src", x.whole.src), ("new", x.whole.new))}),
    }


def _findings(m: Comparison, c: Comparison, states: DataFrame, columns: Columns) -> dict[str, DataFrame]:
    members, claims = m.changed, c.changed

    def found(which: str) -> DataFrame:
        return rows.member_findings(members, columns.member, columns.year, columns.death_date, which=(which,))

    return {
        "missing_beneficiaries": found("missing"),
        "extra_beneficiaries": found("extra"),
        "beneficiary_attribute_mismatches": fields.attribute_mismatches(members, columns.attributes),
        "beneficiary_date_differences": fields.value_differences(
            members, {columns.birth_date: "dob", columns.death_date: "dod"}, keys=[columns.member]),
        "comprehensive_beneficiary_differences": rows.symmetric_difference(members.src, members.new),
        "audit_beneficiary_summary": fields.defects_of(m.flags, members),
        "missing_claims": rows.claim_mismatches(claims, columns.claim),
        # Members are looked up whole: an unchanged member can have a changed claim.
        "claim_payment_amount_discrepancies": lines.line_payment_differences(
            claims, m.whole, states, claim=columns.claim, member=columns.member, from_date=columns.from_date, year=columns.year,
            state_code=columns.state_code, payment=columns.payment, indicator=columns.indicator, allowed=columns.allowed),
        "comprehensive_orphan_claims": rows.extra_rows(claims),
        "audit_claim_summary": fields.defects_of(c.flags, claims),
    }


def _quality(m: Comparison, c: Comparison, columns: Columns) -> dict[str, DataFrame]:
    m_counts, c_counts = (quality.counts_of_flags(side.flags, fields.flag_names(side.whole), side.units) for side in (m, c))
    overall = quality.overall_from_counts(c_counts, c.whole.spec, columns.claim_opportunities).unionByName(
        quality.overall_from_counts(m_counts, m.whole.spec))
    m_columns, c_columns = (quality.columns_from_counts(counts, side.whole.spec) for counts, side in ((m_counts, m), (c_counts, c)))
    return {
        "six_sigma": quality.with_exact_sigma(overall),
        "six_sigma_columns": c_columns.unionByName(m_columns),
        "six_sigma_carrier": quality.family_quality(c_columns),
        "six_sigma_beneficiary": quality.family_quality(m_columns),
    }


def _impact(m: Comparison, c: Comparison) -> dict[str, DataFrame]:
    impact = {
        name: amounts.family_impact(amounts.field_totals(side.changed), side.whole.spec.subject)
        for name, side in (("financial_impact_carrier_claim", c), ("financial_impact_beneficiary", m))
    }
    # Unchanged rows have deltas of 0, so those of the changed ones are all there are.
    for name, side in (("carrier_claim", c), ("beneficiary", m)):
        impact[f"amount_deltas_{name}"] = amounts.amount_deltas(side.changed)
        impact[f"amount_delta_rollup_{name}"] = amounts.delta_rollup(side.changed)
    return impact


def _recomputed(m: Comparison, c: Comparison, columns: Columns, years: tuple[int, int]) -> dict[str, DataFrame]:
    def annual(claims: DataFrame) -> DataFrame:
        return lines.annual_measures(claims, columns.lines, columns.measures, columns.member, columns.from_date, columns.year)

    systems = {"source": (m.whole.src, annual(c.whole.src)), "new": (m.whole.new, annual(c.whole.new))}
    return {"recomputed_payments": lines.recomputed_vs_reported(systems, columns.reported, columns.recomputed, *years, columns.year)}


def write_results(results: dict[str, DataFrame], directory: str) -> dict[str, DataFrame]:
    """Writes every result as CSV, small and large alike as folders of parts, and reads them back."""
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(lambda result: write_csv(result[1], os.path.join(directory, result[0])), results.items()))
    return {
        name: read_csv_table(df.sparkSession, os.path.join(directory, name), df.schema, null_tokens=(), multi_line=True)
        for name, df in results.items()
    }


def grade(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The scorecard out of written results."""
    missing = results["missing_beneficiaries"].unionByName(results["extra_beneficiaries"])
    metrics = scorecard.count_metrics({
        "missing_members": missing,
        "member_defect_rows": results["audit_beneficiary_summary"],
        "missing_claims": results["missing_claims"],
        "claim_defect_rows": results["audit_claim_summary"],
        "payment_differences": results["claim_payment_amount_discrepancies"],
    })
    overall = results["six_sigma"]
    return {
        "quality_grades": scorecard.quality_grades(overall),
        "count_grades": scorecard.count_grades(metrics),
        "top_claim_families": scorecard.top_families(results["six_sigma_carrier"]),
        "top_member_families": scorecard.top_families(results["six_sigma_beneficiary"]),
        "claim_impact_shares": amounts.impact_shares(results["financial_impact_carrier_claim"]),
        "member_impact_shares": amounts.impact_shares(results["financial_impact_beneficiary"]),
        "recommendations": scorecard.recommendations(
            overall, results["six_sigma_carrier"], results["financial_impact_carrier_claim"], metrics),
        "conclusion": scorecard.conclusion(overall),
    }


def load_medical_claims(spark: SparkSession, members: tuple[dict[int, str | Sequence[str]], dict[int, str | Sequence[str]]],
                        claims: tuple[str | Sequence[str], str | Sequence[str]], directory: str) -> tuple[TablePair, TablePair]:
    """Loads the exports of both systems (source, new) into parquet below ``directory``: yearly member files by year, and
    claim files. Malformed rows, values that do not fit and control totals that differ between files and tables fail the load."""
    def every(paths: Mapping[int, str | Sequence[str]]) -> list[str]:
        return [p for some in paths.values() for p in ([some] if isinstance(some, str) else some)]

    def loaded(name: str, paths: str | Sequence[str], schema: StructType, total: str, constants: Mapping[str, Column] | None = None) -> loading.Loaded:
        return loading.load_csv(spark, paths, schema, os.path.join(directory, name), constants, totals=[total])

    # Files are read once: totals are observed while the tables are written.
    m = [loaded(f"{side}-members", every(paths), schemas.MEMBER_SCHEMA, MEMBER_TOTAL, {"YEAR": loading.by_path(spark, paths)}) for side, paths in zip(("src", "new"), members)]
    c = [loaded(f"{side}-claims", paths, schemas.CLAIM_SCHEMA, MEDICAL_CLAIMS.payment) for side, paths in zip(("src", "new"), claims)]
    checks = {f"{side} {name}": (load, total) for name, loads, total in (("members", m, MEMBER_TOTAL), ("claims", c, MEDICAL_CLAIMS.payment)) for side, load in zip(("src", "new"), loads)}
    controls.require_match(loading.loaded_totals(checks))
    m, c = ([load.table for load in loads] for loads in (m, c))
    return TablePair(schemas.MEMBER_SPEC, *m), TablePair(schemas.CLAIM_SPEC, *c)


def reconcile_medical_claims(spark: SparkSession, members: TablePair, claims: TablePair, directory: str,
                             years: tuple[int, int] = (2008, 2010)) -> dict[str, DataFrame]:
    """Results and scorecard of the medical claims exports, written as CSV below ``directory``."""
    results = write_results(reconcile(members, claims, state_lookup(spark), MEDICAL_CLAIMS, years), directory)
    return {**results, **write_results(grade(results), directory)}
