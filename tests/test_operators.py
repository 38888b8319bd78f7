"""Operators against brute force on small tables, and the invariants of published results."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SCHEMA, pair_of, rows_of
from twinledger.model import TablePair, TableSpec
from twinledger.operators import amounts, fields, keys, lines, masks, quality, rows, scorecard

KEYS = [(i, y) for i in ("a", "b", "c", None) for y in (1, 2)]
CODES = st.sampled_from([None, "", "x", "y"])
AMTS = st.sampled_from([None, 0.0, 1.5, -2.0, float("nan")])
TABLE = st.dictionaries(st.sampled_from(KEYS), st.tuples(CODES, AMTS, AMTS), max_size=8)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def as_rows(table):
    return [(*key, *values) for key, values in table.items()]


def canonical(value):
    """NaN equals NaN, and -0.0 equals 0.0."""
    return "NaN" if value != value else value


def differ(a, b, default, mode):
    if mode == "coalesce":
        a, b = (default if v is None else v for v in (a, b))
    if mode == "plain" and (a is None or b is None):
        return 0
    return int(canonical(a) != canonical(b))


def expected_flags(src, new, mode):
    result = []
    for key in {*src, *new}:
        s, n = src.get(key, (None,) * 3), new.get(key, (None,) * 3)
        result.append((*key, *(differ(a, b, d, mode) for a, b, d in zip(s, n, ("", 0.0, 0.0)))))
    return sorted(result, key=lambda row: tuple((v is not None, str(v)) for v in row))


@FEW
@given(src=TABLE, new=TABLE, mode=st.sampled_from(["coalesce", "distinct", "plain"]))
def test_field_flags(spark, src, new, mode):
    pair = pair_of(spark, as_rows(src), as_rows(new))
    expected = expected_flags(src, new, mode)
    assert rows_of(fields.field_flags(pair, mode)) == expected
    defects = [row for row in expected if any(row[2:])]
    assert rows_of(fields.field_flags(pair, mode, only_defects=True)) == defects
    assert rows_of(fields.defect_rows(fields.changed_flags(pair, mode), pair.spec.fields)) == defects


@FEW
@given(src=TABLE, new=TABLE)
def test_fingerprints_count_what_the_full_join_counts(spark, src, new):
    pair = pair_of(spark, as_rows(src), as_rows(new), key_flags=("id",))
    for mode in ("coalesce", "distinct"):
        direct, narrow = (rows_of(quality.defect_counts(pair, mode, s)) for s in ("direct", "fingerprint"))
        assert direct == narrow


@FEW
@given(src=st.lists(st.tuples(st.sampled_from(["a", None]), st.just(1), CODES, AMTS, st.just(0.0)), max_size=8),
       new=st.lists(st.tuples(st.sampled_from(["a", None]), st.just(1), CODES, AMTS, st.just(0.0)), max_size=8))
def test_symmetric_difference_is_two_excepts(spark, src, new):
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (src, new))
    plain = a.exceptAll(a).unionByName(a.subtract(b)).unionByName(b.subtract(a))
    assert [tuple(map(canonical, r)) for r in rows_of(rows.symmetric_difference(a, b))] == [tuple(map(canonical, r)) for r in rows_of(plain)]


def test_source_driven_flags_leave_new_only_rows_null(spark):
    pair = pair_of(spark, [("a", 1, "x", 1.0, 1.0)], [("b", 1, "x", 1.0, 1.0)], key_flags=("id",))
    assert rows_of(fields.field_flags(pair, one_sided="null_new_only")) == [("a", 1, 1, 1, 1, 1), ("b", 1, None, None, None, None)]
    assert rows_of(fields.field_flags(pair)) == [("a", 1, 1, 1, 1, 1), ("b", 1, 1, 1, 1, 1)]
    assert rows_of(fields.field_flags(pair, one_sided="null_new_only", only_defects=True)) == [("a", 1, 1, 1, 1, 1)]


def test_null_token_makes_defects_of_absent_nulls(spark):
    pair = pair_of(spark, [("a", 1, None, None, 0.0), ("b", 1, None, None, 0.0)], [("b", 1, None, None, 0.0)])
    assert rows_of(fields.field_flags(pair)) == [("a", 1, 0, 0, 0), ("b", 1, 0, 0, 0)]
    assert rows_of(fields.field_flags(pair, null_token="nan")) == [("a", 1, 1, 1, 0), ("b", 1, 0, 0, 0)]


@pytest.mark.parametrize("nullable", [True, False])
def test_rows_of_one_side(spark, nullable):
    src = [("a", 1, "x", 1.0, 1.0), ("b", 1, "x", 1.0, 1.0), ("b", 2, "x", 1.0, 1.0)]
    new = [("b", 1, "x", 1.0, 1.0), ("c", 3, "x", 1.0, 1.0), ("c", 3, "x", 1.0, 1.0)]
    pair = pair_of(spark, src, new, nullable_keys=nullable)
    assert rows_of(rows.missing_rows(pair).select("id", "year")) == [("a", 1), ("b", 2)]
    assert rows_of(rows.extra_rows(pair).select("id", "year")) == [("c", 3), ("c", 3)]
    assert rows_of(rows.one_sided_keys(pair, "m", "e")) == [("a", 1, "m"), ("b", 2, "m"), ("c", 3, "e")]
    assert rows_of(rows.row_status(pair)) == [
        ("Extra in New", "c", 3), ("Extra in New", "c", 3), ("Missing in New", "a", 1), ("Missing in New", "b", 2)]
    assert rows_of(rows.orphan_rate(pair)) == [("Toy", 3, 2, 66.6667)]


def test_orphan_rate_of_an_empty_source_is_zero(spark):
    assert rows_of(rows.orphan_rate(pair_of(spark, [], [("a", 1, "x", 1.0, 1.0)]))) == [("Toy", 0, 0, 0.0)]


def test_null_keys_match_each_other_only_when_nullable(spark):
    pair = pair_of(spark, [(None, 1, "x", 1.0, 1.0)], [(None, 1, "x", 1.0, 1.0)])
    assert rows_of(fields.field_flags(pair)) == [(None, 1, 0, 0, 0)]
    assert rows_of(rows.missing_rows(pair)) == []
    assert fields.field_flags(pair.with_spec(nullable_keys=False)).count() == 2


def test_key_checks(spark):
    df = pair_of(spark, [("a", 1, "x", 1.0, 1.0)] * 3 + [("b", 1, "x", 1.0, 1.0), (None, 1, "x", 1.0, 1.0)], []).src
    assert rows_of(keys.duplicate_keys(df, ["id"])) == [("a", 3)]
    unique, shared = keys.split_by_key(df, ["id"])
    assert [r[0] for r in rows_of(unique)] == [None, "b"] and shared.count() == 3
    with pytest.raises(ValueError, match="toy: rows with a shared key: 3; toy: rows with a NULL key: 1"):
        keys.require_unique_keys({"toy": (df, ["id"])})


def test_shared_keys_are_set_apart_on_both_sides(spark):
    row = ("x", 1.0, 1.0)
    pair = pair_of(spark, [("a", 1, *row)] * 3 + [("b", 1, *row)], [("a", 1, *row), ("c", 1, *row), ("c", 1, *row), ("d", 1, *row)])
    rest, apart = keys.set_apart_shared_keys(pair, pair.spec.keys)
    assert rows_of(rest.src.select("id")) == [("b",)] and rows_of(rest.new.select("id")) == [("d",)]
    assert rows_of(apart.select("side", "id")) == [("new", "a"), ("new", "c"), ("new", "c"), ("src", "a"), ("src", "a"), ("src", "a")]


def test_profile_and_detail(spark):
    pair = pair_of(spark, [("a", 1, None, 1.0, 1.0), ("b", 1, "x", 1.0, 1.0), ("c", 1, "x", 1.0, 1.0)],
                   [("a", 1, "", 1.0, 1.0), ("b", 1, "y", 2.0, 1.0)])
    profile = fields.column_profile(pair)
    assert [tuple(r) for r in profile.collect()] == [("code", 2, 66.67), ("amt_1", 1, 33.33)]
    assert fields.error_fields(profile) == ["code", "amt_1"]
    assert rows_of(fields.mismatch_detail(pair, ["code", "amt_1"])) == [("a", 1, None, "", 1.0, 1.0), ("b", 1, "x", "y", 1.0, 2.0)]
    assert fields.mismatch_detail(pair, ["code"]).columns == ["id", "year", "code_src", "code_new"]


def test_null_drops_out_of_plain_differences(spark):
    pair = pair_of(spark, [("a", 1, None, 1.0, 5.0), ("b", 1, "x", 1.0, 5.0)], [("a", 1, "y", 1.0, 5.0), ("b", 1, "y", 1.0, 4.0)])
    assert rows_of(fields.value_differences(pair, {"code": "c"}, ["id"])) == [("b", "x", "y")]
    assert rows_of(fields.attribute_mismatches(pair, ["code"]).select("id")) == [("a",), ("b",)]
    assert rows_of(fields.amount_differences(pair, "amt_2")) == [("b", 1, 5.0, 4.0, 1.0)]


def test_many_differing_fields_plan_in_reasonable_time(spark):
    names = [f"f_{i}" for i in range(138)]
    src = spark.range(50).select(F.col("id").cast("string").alias("k"), *[(F.col("id") + i).cast("double").alias(n) for i, n in enumerate(names)])
    new = src.select("k", *[(F.col(n) + 1).alias(n) for n in names])
    from twinledger.model import TablePair, TableSpec
    pair = TablePair(TableSpec("Wide", ("k",), names, amounts=names), src, new)
    assert fields.mismatch_detail(pair, names).count() == 50
    assert fields.field_flags(pair, only_defects=True).count() == 50
    totals = {r.metric_name: r.total_abs_delta for r in amounts.field_totals(pair).collect()}
    assert len(totals) == 138 and set(totals.values()) == {50.0}


def test_deltas(spark):
    nan = float("nan")
    src = [("a", 1, "x", 10.0, nan), ("b", 1, "x", 1.0, 1.0), ("c", 1, "x", 5.0, 5.0)]
    new = [("a", 1, "x", 12.5, 1.0), ("b", 1, "x", 1.0, 1.0), ("d", 1, "x", 7.0, 7.0)]
    pair = pair_of(spark, src, new)
    assert rows_of(amounts.amount_deltas(pair)) == [
        ("a", 1, 10.0, 12.5, 2.5, 2.5, 0.0, 1.0, 1.0, 1.0), ("b", 1, 1.0, 1.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0),
        ("c", 1, 5.0, None, None, None, 5.0, None, None, None), ("d", 1, None, 7.0, None, None, None, 7.0, None, None)]
    assert rows_of(amounts.delta_rollup(pair)) == [("a", 1, 2.5, 1.0)]
    totals = amounts.field_totals(pair)
    assert rows_of(totals) == [("abs_delta_amt_1", 2.5), ("abs_delta_amt_2", 1.0)]
    assert rows_of(amounts.family_impact(totals, "T")) == [("T", "amt", 3.5, 1.0)]
    assert rows_of(amounts.net_field_totals(pair)) == [("amt_1", 2.5), ("amt_2", 1.0)]


def test_no_change_means_no_totals(spark):
    pair = pair_of(spark, [("a", 1, "x", 1.0, 1.0)], [("a", 1, "x", 1.0, 1.0)])
    assert amounts.field_totals(pair).count() == 0 and amounts.delta_rollup(pair).count() == 0


# Published family defects of a claims table, largest first, out of 4,746,577 rows.
PUBLISHED_FAMILIES = {
    "LINE_PRCSG_IND_CD": 75497, "LINE_ICD9_DGNS_CD": 75238, "TAX_NUM": 75176, "PRF_PHYSN_NPI": 75169, "HCPCS_CD": 75106,
    "ICD9_DGNS_CD": 46708, "LINE_NCH_PMT_AMT": 31709, "LINE_BENE_PTB_DDCTBL_AMT": 20828, "LINE_BENE_PRMRY_PYR_PD_AMT": 20639,
    "LINE_ALOWD_CHRG_AMT": 17531, "LINE_COINSRNC_AMT": 16775, "CLM_FROM_DT": 5707, "CLM_THRU_DT": 5707,
}


def test_published_family_quality(spark):
    columns = [("Carrier Claims", f"{family}_{slot}", defects - 1 if slot == 1 else 1, 4746577)
               for family, defects in PUBLISHED_FAMILIES.items() for slot in (1, 2)]
    got = quality.family_quality(spark.createDataFrame(columns, "SOURCE string, column_name string, TOTAL_DEFECTS long, TOTAL_OPPORTUNITIES long")).collect()
    assert [r.FIELD_FAMILY for r in got] == list(PUBLISHED_FAMILIES)
    assert got[0].RUNNING_PCT_OF_TOTAL == pytest.approx(0.13934734860370254) and got[-1].RUNNING_PCT_OF_TOTAL == 1.0
    assert got[0].DPMO == pytest.approx(15905.567317247776) and got[0].SIGMA_LEVEL == pytest.approx(3.655946356770415, abs=1e-6)
    assert got[0].DPMO_PER_OPPORTUNITY == pytest.approx(15905.567317247776 / 2)


def test_published_overall_quality(spark):
    totals = spark.createDataFrame([(530376, 4746577 * 102), (8193, 343803 * 31)], "TOTAL_DEFECTS long, TOTAL_OPPORTUNITIES long")
    claims, members = quality.with_exact_sigma(quality.with_rates(totals)).orderBy(F.desc("TOTAL_DEFECTS")).collect()
    assert (claims.DPMO, members.DPMO) == (pytest.approx(1095.476806640625, rel=1e-6), pytest.approx(768.72607421875, rel=1e-6))
    # The published yields are 32-bit numbers: they are off by up to 6e-8, and the sigma levels by some 2e-6.
    assert claims.SIX_SIGMA == pytest.approx(4.563048218836862, abs=1e-5) and members.SIX_SIGMA == pytest.approx(4.667521728039401, abs=1e-5)


def test_null_flags_are_no_opportunities(spark):
    flags = spark.createDataFrame([("a", 1, None), ("b", 0, 1)], "id string, f int, g int")
    got = {r.column_name: (r.TOTAL_DEFECTS, r.TOTAL_OPPORTUNITIES) for r in quality.flag_quality(flags, "T", ["f", "g"]).collect()}
    assert got == {"f": (1, 2), "g": (1, 1)}


def test_opportunities_can_be_fixed(spark):
    pair = pair_of(spark, [("a", 1, "x", 1.0, 1.0)], [("a", 1, "y", 1.0, 1.0)])
    assert quality.overall_quality(pair).first().TOTAL_OPPORTUNITIES == 3
    assert quality.overall_quality(pair, 102).first().TOTAL_OPPORTUNITIES == 102


def test_line_rule_and_measures(spark):
    layout = lines.LineLayout(("PMT", "ALLOW", "IND"), 2)
    claims = spark.createDataFrame(
        [("m", "20080105", 1.0, 2.0, 5.0, 0.0, "A", "R"), ("m", "20081231", 4.0, None, None, 3.0, "S", "S"), ("m", "20090101", 9.0, 1.0, 1.0, 1.0, None, "N")],
        "m string, d string, PMT_1 double, PMT_2 double, ALLOW_1 double, ALLOW_2 double, IND_1 string, IND_2 string")
    rules = spark.createDataFrame([("paid", "coalesce(PMT, 0)", lines.valid_line_rule("IND", "ALLOW"))], "name string, value_expr string, cond_expr string")
    (measure,) = lines.measures_from(rules)
    long = lines.apply_measures(lines.explode_lines(claims, layout, ["m", "d"]), [measure])
    assert rows_of(long.groupBy(F.left("d", F.lit(4)).cast("int").alias("y")).agg(F.sum("paid"))) == [(2008, 1.0), (2009, 0.0)]
    assert rows_of(lines.annual_measures(claims, layout, [measure], "m", "d")) == [("m", 2008, 1.0), ("m", 2009, 0.0)]
    valid = long.select(lines.valid_line(F.col("IND"), F.col("ALLOW")).alias("v"))
    assert sorted(r.v for r in valid.collect()) == [False, False, False, False, True, True]


def test_one_hot_group_of_copies_is_combined_before_the_shuffle(spark):
    """A third of all rows being copies of one row must not reach one task as such."""
    copies = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit(1).alias("year"),
        F.lit("x").alias("code"), F.lit(1.0).alias("amt_1"), F.lit(1.0).alias("amt_2"))
    from helpers import SPEC
    from twinledger.model import TablePair
    pair = TablePair(SPEC, copies, copies.where("id <> 'hot'"))
    assert rows_of(rows.symmetric_difference(pair.src, pair.new)) == [("hot", 1, "x", 1.0, 1.0)]
    assert rows_of(rows.one_sided_keys(pair, "m", "e")) == [("hot", 1, "m")]
    assert rows.missing_rows(pair).count() == 10_000
    assert rows_of(keys.duplicate_keys(pair.src, ["id"])) == [("hot", 10_000)]
    assert quality.defect_counts(pair, strategy="fingerprint").first().units == 30_000


def test_scorecard(spark):
    metrics = spark.createDataFrame([("missing_members", 101), ("claim_defect_rows", 1000), ("other", 5)], "metric string, n_rows long")
    graded = {r.metric: r.status for r in scorecard.count_grades(metrics).collect()}
    assert graded == {"missing_members": "Critical", "claim_defect_rows": "Review"}
    overall = spark.createDataFrame([("A", 2.5), ("B", 3.5), ("C", 4.5)], "SUBJECT string, SIGMA_LEVEL double")
    families = spark.createDataFrame([("F", 7), ("G", 9)], "FIELD_FAMILY string, TOTAL_DEFECTS long")
    impact = spark.createDataFrame([("P", 7.0, 0.7), ("Q", 3.0, 1.0)], "FIELD_FAMILY string, FINANCIAL_VARIANCE double, RUNNING_PCT_OF_TOTAL double")
    got = scorecard.recommendations(overall, families, impact, metrics).orderBy("position", "subject").collect()
    assert [(r.position, r.priority, r.subject) for r in got] == [
        (1, "CRITICAL", "A"), (1, "HIGH PRIORITY", "B"), (2, "FOCUS AREA", "G"), (3, "FINANCIAL PRIORITY", "P"), (4, "DATA LOSS", "missing_members")]
    assert tuple(scorecard.conclusion(overall).first())[:2] == (3.5, "Acceptable")


def test_all_pairs_of_presence_for_payments(spark):
    """Only claims the new system regards as valid count, whichever side they are on."""
    from twinledger.model import TablePair, TableSpec
    schema = "id string, mem string, d string, pay double, ind string, ok double"
    src = spark.createDataFrame([("1", "m", "20080101", 5.0, "A", 1.0), ("2", "m", "20080101", 5.0, "A", 1.0), ("3", "m", "20080101", 5.0, "A", 1.0)], schema)
    new = spark.createDataFrame([("1", "m", "20080101", 4.0, "A", 1.0), ("2", "m", "20080101", 4.0, "N", 1.0), ("4", "u", "20090101", 4.0, "R", 1.0)], schema)
    claims = TablePair(TableSpec("C", ("id",), ("mem", "d", "pay", "ind", "ok")), src, new)
    mem = spark.createDataFrame([("m", 2008, "01"), ("m", 2009, "02")], "mem string, year int, state string")
    members = TablePair(TableSpec("M", ("mem", "year"), ("state",)), mem, mem)
    states = spark.createDataFrame([("01", "AL"), ("02", "AK")], "code string, name string")
    def got(fanout):
        df = lines.line_payment_differences(claims, members, states, claim="id", member="mem", from_date="d", year="year", state_code="state",
                                            payment="pay", indicator="ind", allowed="ok", fanout=fanout)
        return rows_of(df.select("id", "record_status", "STATE_NAME", "variance"))
    assert got(False) == [("1", "Matched", "AL", 1.0), ("4", "New Only", "Unknown/Orphan", -4.0)]
    fan = [("1", "Matched", s, 1.0) for s, _ in itertools.product(("AK", "AL"), range(2))]
    assert got(True) == [*fan, ("4", "New Only", "Unknown/Orphan", -4.0)]


def test_fractions_of_a_cent_are_summed_before_they_are_rounded(spark):
    data = [(str(i), 1, "x", 1.0, 1e17) for i in range(100)]
    pair = pair_of(spark, data, [(i, y, c, 1.004, 1e17 + 1e6) for i, y, c, _, _ in data])
    totals = {r["metric_name"]: r["total_abs_delta"] for r in amounts.field_totals(pair).collect()}
    assert totals == {"abs_delta_amt_1": 0.4, "abs_delta_amt_2": 1e8}
    assert {round(r["abs_delta_amt_1"], 6) for r in amounts.delta_rollup(pair).collect()} == {0.004}


def test_fingerprints_see_nulls_of_every_type(spark):
    import datetime
    import decimal

    values = {"date": datetime.date(2020, 1, 1), "boolean": True, "timestamp": datetime.datetime(2020, 1, 1), "decimal(10,2)": decimal.Decimal("1.50"), "double": 2.5, "string": "s"}
    for kind, value in values.items():
        schema = f"id int, a {kind}, b {kind}"
        spec = TableSpec("T", keys=("id",), fields=("a", "b"))
        pair = TablePair(spec, spark.createDataFrame([(1, None, value), (2, value, value)], schema), spark.createDataFrame([(1, value, None), (2, value, value)], schema))
        for mode in ("coalesce", "distinct"):
            changed = {r["id"] for r in keys.key_census(pair, mode).where("is_changed").collect()}
            assert changed == {1}, (kind, mode)


def test_the_census_sees_amounts_outside_the_fields(spark):
    spec = TableSpec("T", keys=("id",), fields=("a",), amounts=("m",))
    pair = TablePair(spec, spark.createDataFrame([(1, "x", 5.0, "p")], "id int, a string, m double, other string"),
                     spark.createDataFrame([(1, "x", 9.0, "p")], "id int, a string, m double, other string"))
    assert amounts.field_totals(keys.changed_pair(pair, keys.key_census(pair))).collect()[0]["total_abs_delta"] == 4.0
    other = TablePair(spec, pair.src, pair.src.withColumn("other", F.lit("q")))
    assert keys.key_census(other, "distinct", keys.other_columns(other)).where("is_changed").count() == 1


def test_a_slot_without_a_number_leaves_the_others(spark):
    layout = lines.LineLayout(("V", "I"), 3)
    claims = spark.createDataFrame([("m", "20080101", 5.0, None, float("nan"), "A", "A", "A")], "member string, day string, V_1 double, V_2 double, V_3 double, I_1 string, I_2 string, I_3 string")
    found = lines.annual_measures(claims, layout, [lines.Measure("total", "V", "I = 'A'")], "member", "day").collect()
    assert [r["total"] for r in found] == [5.0]


def test_a_key_with_a_third_of_all_rows_is_never_paired(spark):
    hot = [("hot", 1, "x", 1.0, 1.0)] * 30 + [(str(i), 1, "x", 1.0, 1.0) for i in range(60)]
    pair = pair_of(spark, hot, hot)
    assert fields.field_flags(pair).count() == 30 * 30 + 60
    with pytest.raises(ValueError, match="more than one row"):
        fields.field_flags(pair.with_spec(on_shared_keys="fail"))
    apart = pair.with_spec(on_shared_keys="set_apart")
    assert fields.field_flags(apart).count() == 60 and amounts.amount_deltas(apart).count() == 60
    assert keys.set_apart_shared_keys(pair, pair.spec.keys)[1].count() == 60


@FEW
@given(src=TABLE, new=TABLE, mode=st.sampled_from(["coalesce", "distinct", "plain"]), one_sided=st.sampled_from(["flag", "null_new_only"]))
def test_packed_flags_are_the_flags(spark, src, new, mode, one_sided):
    pair = pair_of(spark, as_rows(src), as_rows(new), key_flags=("id",))
    names, packed = fields.flag_names(pair), fields.packed_flags(pair, mode, one_sided)
    plain = fields.field_flags(pair, mode, one_sided)
    assert rows_of(masks.unpacked(packed, names, pair.spec.keys)) == rows_of(plain)
    assert rows_of(packed.agg(*masks.sums(names))) == rows_of(plain.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in names]))
    counted = packed.selectExpr(f"{masks.n_set(names, pair.spec.fields)} AS n")
    assert sorted(r.n for r in counted.collect()) == sorted(sum(v or 0 for v in row[3:]) for row in rows_of(plain))


def test_strategy_goes_by_the_size_of_stored_tables(spark, tmp_path):
    rows = [(str(i), 1, "x" * 50 + str(i), 1.0, 1.0) for i in range(200)]
    for side in ("src", "new"):
        pair_of(spark, rows, rows).src.write.parquet(str(tmp_path / side))
    pair = TablePair(pair_of(spark, [], []).spec, *(spark.read.parquet(str(tmp_path / side)) for side in ("src", "new")))
    assert (quality.chosen_strategy(pair, "auto"), quality.chosen_strategy(pair, "auto", 1000), quality.chosen_strategy(pair, "direct", 0)) == ("direct", "fingerprint", "direct")
    assert rows_of(quality.overall_quality(pair, strategy="auto")) == rows_of(quality.overall_quality(pair))
    with pytest.raises(ValueError, match="strategy"):
        quality.chosen_strategy(pair, "guess")


def test_masks_of_more_columns_than_one_number_holds(spark):
    names = [f"c{i}" for i in range(138)]
    df = spark.range(300).selectExpr("id", *masks.packed([f"(id * {i + 7}) % 11 = 0" for i in range(138)]))
    expected = [[int(i * (k + 7) % 11 == 0) for k in range(138)] for i in range(300)]
    assert [list(r)[1:] for r in masks.unpacked(df, names, ["id"]).orderBy("id").collect()] == expected
    assert [r[0] for r in df.orderBy("id").selectExpr(masks.n_set(names, names[60:70])).collect()] == [sum(e[60:70]) for e in expected]
    assert df.where(masks.any_set(names, ["c63", "c64", "c137"])).count() == sum(any((e[63], e[64], e[137])) for e in expected)
    only = spark.range(1).selectExpr(*masks.packed([str(i in (0, 63, 64, 137)).lower() for i in range(138)]))
    assert masks.names_set(names, only.agg(*masks.combined(names)).first().asDict()) == ["c0", "c63", "c64", "c137"]


@FEW
@given(src=TABLE, new=TABLE)
def test_one_comparison_gives_profile_detail_and_amounts(spark, tmp_path_factory, src, new):
    pair = pair_of(spark, as_rows(src), as_rows(new))
    found = fields.differences(pair, str(tmp_path_factory.mktemp("d") / "rows"))
    assert rows_of(found.profile()) == rows_of(fields.column_profile(pair)) and found.src_rows == len(src)
    assert set(found.fields) == {r[0] for r in rows_of(fields.column_profile(pair))}
    same = lambda df: [tuple(map(canonical, row)) for row in rows_of(df)]
    assert same(found.detail()) == same(fields.mismatch_detail(pair, found.fields))
    assert same(found.amounts("amt_1")) == same(fields.amount_differences(pair, "amt_1"))
    assert found.cells().count() == sum(r[1] for r in rows_of(fields.column_profile(pair)))
