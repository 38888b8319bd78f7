"""Pairs whose rows are read several times are derived once."""

from __future__ import annotations

import os

import pytest

from helpers import rows_of
from twinledger.operators import quality
from twinledger.plans import catalogue, derived_pairs as pairs


def test_lines_reach_their_slots_in_one_shuffle(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pairs._claims(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum("Exchange hashpartitioning" in line and "l_orderkey" in line for line in plan.split("\n")) == 1


def test_a_line_outside_of_the_slots_fails_whatever_is_asked_for(spark, sf_dir, tmp_path):
    for name in ("orders", "lineitem"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(20)
        (rows.selectExpr("* EXCEPT (l_linenumber)", "8 AS l_linenumber") if name == "lineitem" else rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    with pytest.raises(Exception, match="line number 8"):
        pairs._claims(spark, str(tmp_path)).select("CLM_ID").collect()


@pytest.mark.parametrize("make_pair", (pairs.claims_pair, pairs.members_pair))
def test_a_stored_pair_is_the_pair(spark, sf_dir, tmp_path, make_pair):
    plain, stored = make_pair(spark, sf_dir), make_pair(spark, sf_dir, str(tmp_path))
    for a, b in ((plain.src, stored.src), (plain.new, stored.new)):
        assert a.dtypes == b.dtypes and a.count() == b.count() and a.exceptAll(b).isEmpty()
        assert all("lineitem" not in f and "orders" not in f for f in b.inputFiles())


def test_the_census_of_fingerprints_is_made_once(spark, sf_dir, tmp_path):
    pair = pairs.members_pair(spark, sf_dir, str(tmp_path / "pair"))
    counted = quality.overall_quality(pair, strategy="fingerprint", workdir=str(tmp_path / "census"))
    assert os.path.exists(tmp_path / "census" / "_SUCCESS")
    assert rows_of(counted) == rows_of(quality.overall_quality(pair))


@pytest.mark.parametrize("name", ("s06_control_totals", "s06_control_totals_of_loads", "q03_overall_quality_by_fingerprint", "g02_count_grades"))
def test_claims_are_derived_once(spark, sf_dir, name, monkeypatch):
    derived, claims = [], pairs._claims
    monkeypatch.setattr(pairs, "_claims", lambda *args: derived.append(claims(*args)) or derived[-1])
    found = catalogue.queries()[name](spark, sf_dir)
    assert len(derived) == 1 and all("lineitem" not in f for f in found.inputFiles())
