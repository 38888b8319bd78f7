from __future__ import annotations

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from twinledger.functions.families import family_name, field_family
from twinledger.functions.sigma import register_sql_functions, sigma_approx, sigma_exact, sigma_grade


def test_exact_sigma_is_the_normal_quantile_plus_shift(spark):
    ps = [1e-12, 1e-6, 0.01, 0.074, 0.075, 0.076, 0.3, 0.5, 0.7, 0.924, 0.925, 0.926, 0.99, 0.9989045262336731, 0.999999, 1 - 1e-13]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", sigma_exact(F.col("p")).alias("s")).collect()
    for row in got:
        assert row.s == pytest.approx(NormalDist().inv_cdf(row.p) + 1.5, abs=1e-9)


@pytest.mark.parametrize("p", [0.0, 1.0, -0.1, 1.1, None])
def test_exact_sigma_is_null_outside_of_the_open_interval(spark, p):
    assert spark.createDataFrame([(p,)], "p double").select(sigma_exact(F.col("p")).alias("s")).first().s is None


@pytest.mark.parametrize("process_yield, approx, exact", [
    (0.9989045262336731, 4.580300442011229, 4.563048218836862),
    (0.9992312788963318, 4.682133264565543, 4.667521728039401),
])
def test_published_sigma_levels(spark, process_yield, approx, exact):
    row = spark.range(1).select(sigma_approx(F.lit(process_yield)).alias("a"), sigma_exact(F.lit(process_yield)).alias("e")).first()
    assert row.a == pytest.approx(approx, abs=1e-9) and row.e == pytest.approx(exact, abs=1e-9)


def test_sigma_for_sql_users(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT sigma_level(0.9989045262336731D) AS s").first().s == pytest.approx(4.580300442011229, abs=1e-9)


def test_grades(spark):
    levels = [6.0, 5.99, 5.0, 4.5, 3.0, 2.99, None]
    got = spark.createDataFrame([(i, s) for i, s in enumerate(levels)], "i int, s double").orderBy("i").select(sigma_grade(F.col("s")).alias("g"))
    assert [r.g for r in got.collect()] == [
        "World-class", "Excellent", "Excellent", "Good", "Acceptable", "Needs Attention", "Needs Attention"]


def test_families(spark):
    names = ["ICD9_DGNS_CD_8", "abs_delta_LINE_NCH_PMT_AMT_13", "KEY_ONE_SIDED_CLM_FROM_DT", "BENE_BIRTH_DT"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(field_family(F.col("n")).alias("f")).collect()
    assert [r.f for r in got] == ["ICD9_DGNS_CD", "LINE_NCH_PMT_AMT", "CLM_FROM_DT", "BENE_BIRTH_DT"]
    assert family_name("KEY_ONE_SIDED_CLM_FROM_DT") == "CLM_FROM_DT"
