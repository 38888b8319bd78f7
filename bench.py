"""Times the headline queries and one whole reconciliation; prints one line of JSON.

BENCH_SF_DIR: folder of the tables, BENCH_CPUS: cores.
"""

from __future__ import annotations

import json
import os
import time

from twinledger.plans import catalogue, derived_pairs as pairs
from twinledger.plans.reconciliation import Columns, grade, reconcile, write_results
from twinledger.session import build_session, scratch_dir
from twinledger.sources.tables import write_table
from twinledger.model import TablePair

HEADLINES = (
    "j01_missing_members", "j03_finding_counts", "j04_claim_mismatches", "j05_orphan_claims", "j08_orphan_rate",
    "v01_attribute_mismatches", "v03_member_symmetric_diff", "v03_claim_symmetric_diff", "v04_member_field_flags",
    "v05_claim_field_flags", "v06_claim_defect_rows", "v07_line_payment_differences", "v08_claim_column_profile",
    "f02_claim_amount_deltas", "f04_claim_delta_rollup", "f06_claim_field_totals", "f07_claim_family_impact",
    "q03_overall_quality", "q04_claim_column_quality", "q05_claim_family_quality", "q06_member_family_quality",
    "v05_claim_packed_flags", "v05_line_flags_of_shared_keys", "v09_claim_mismatch_detail", "v03_claim_symmetric_diff_by_ranges", "j05_orphan_claims_by_ranges",
    "s02_multi_file_union", "s04_batch_ledger", "s06_control_totals", "s06_control_totals_of_loads", "q03_running_claim_quality", "v07_line_payment_differences_fanout",
    "r05_claim_lines", "r07_annual_measures", "r08_recomputed_vs_reported", "g02_count_grades", "g04_recommendations",
)
DERIVED_COLUMNS = Columns(
    member="MEMBER_ID", year="YEAR", birth_date="BIRTH_DT", death_date="DEATH_DT", state_code="STATE_CODE",
    attributes=catalogue.ATTRIBUTES, claim="CLM_ID", from_date="CLM_FROM_DT", payment="LINE_PMT_AMT_1", indicator="LINE_IND_CD_1",
    allowed="LINE_ALLOW_AMT_1", reported="REIMB_AMT", recomputed="CALC_REIMB", lines=pairs.LINES, measures=pairs.MEASURES,
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored(spark, pair: TablePair, name: str) -> TablePair:
    return TablePair(pair.spec, *(write_table(df, scratch_dir(spark, f"{side}-{name}")) for side, df in (("src", pair.src), ("new", pair.new))))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = catalogue.queries(), {}
    run(catalogue.q03_overall_quality(spark, sf_dir))  # warms up the JVM and the file cache
    for name in HEADLINES:
        started = time.time()
        run(registered[name](spark, sf_dir))
        seconds[name] = round(time.time() - started, 3)

    started = time.time()
    members, claims = stored(spark, pairs.members_pair(spark, sf_dir), "members"), stored(spark, pairs.claims_pair(spark, sf_dir), "claims")
    seconds["store_both_systems"] = round(time.time() - started, 3)
    started = time.time()
    results = write_results(reconcile(members, claims, pairs.state_names(spark, sf_dir), DERIVED_COLUMNS, (1996, 1998)), scratch_dir(spark, "results"))
    write_results(grade(results), scratch_dir(spark, "scorecard"))
    seconds["whole_reconciliation"] = round(time.time() - started, 3)

    print(json.dumps({
        "metric": "total time of the headline queries and one whole reconciliation", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
