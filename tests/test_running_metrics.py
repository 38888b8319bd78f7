"""Metrics of batches against a run over everything, and lookups of members with many years."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from helpers import SCHEMA, pair_of, rows_of
from twinledger.model import TablePair, TableSpec
from twinledger.operators import lines, quality
from twinledger.streaming.metrics import RunningQuality


def test_batches_add_up_to_a_whole_run_whenever_rows_come(spark, tmp_path):
    rng = random.Random(1)
    src = [(f"k{i}" if i else None, i % 3, rng.choice(["x", "", None]), rng.choice([0.0, 1.0]), 2.0) for i in range(40)]
    new = [(i, y, rng.choice([c, "z"]), a, b) for i, y, c, a, b in src if rng.random() < 0.9] + [("extra", 1, None, None, 1.0)]
    whole = pair_of(spark, src, new, key_flags=("id",))
    kept = RunningQuality(spark, whole.spec, SCHEMA, str(tmp_path / "running"))
    assert rows_of(kept.counts(0)) == [(0, 0, 0, 0, 0)]
    rng.shuffle(src)
    rng.shuffle(new)
    for number, (a, b) in enumerate((((0, 15), (20, 41)), ((15, 40), (0, 0)), ((0, 0), (0, 20)))):
        parts = [spark.createDataFrame(rows[x:y], SCHEMA) if y > x else None for rows, (x, y) in ((src, a), (new, b))]
        kept.add(number, *parts)
        kept.add(number, *parts)
        seen = [[r for k, (x, y) in enumerate(cuts) if k <= number for r in rows[x:y]] for rows, cuts in ((src, ((0, 15), (15, 40), (0, 0))), (new, ((20, 41), (0, 0), (0, 20))))]
        so_far = pair_of(spark, *seen, key_flags=("id",))
        assert rows_of(kept.counts(number + 1)) == rows_of(quality.defect_counts(so_far)), number
    assert len(seen[0]) == len(src) and len(seen[1]) == len(new)
    plan = kept.counts(3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "code" in plan and "amt_1_src" not in plan


def payments(spark, n_years, n_claims, fanout):
    columns = ("member string, day string, pay double, ind string, allowed double")
    rows = lambda pay: spark.createDataFrame([(f"c{i}", "hot" if i % 4 else f"m{i}", "20010101", pay, "A", 1.0) for i in range(n_claims)], f"claim string, {columns}")
    claims = TablePair(TableSpec("C", ("claim",), ("member", "day", "pay", "ind", "allowed")), rows(1.0), rows(2.0))
    member_rows = [("hot", 2000 + y, f"0{y % 2}") for y in range(n_years)] + [("m0", 2001, "01")]
    members = spark.createDataFrame(member_rows, "member string, year int, state string")
    states = spark.createDataFrame([("00", "Zero")], "code string, name string")
    pair = TablePair(TableSpec("M", ("member", "year"), ("state",)), members, members.where("member <> 'm0'"))
    return member_rows, lines.line_payment_differences(
        claims, pair, states, claim="claim", member="member", from_date="day", year="year", state_code="state", payment="pay", indicator="ind", allowed="allowed", fanout=fanout)


def test_claims_of_members_with_many_years_are_repeated_as_a_join_would(spark):
    n_years, n_claims = 6, 40
    _, found = payments(spark, n_years, n_claims, fanout=True)
    counted = {(r.claim, r.STATE_NAME): r.n for r in found.groupBy("claim", "STATE_NAME").agg(F.count("*").alias("n")).collect()}
    expected = {}
    for i in range(n_claims):
        if i % 4:
            # Of 36 combinations of years the source state is known in 18, else the new one in 9.
            expected[f"c{i}", "Zero"], expected[f"c{i}", "Unknown/Orphan"] = 27, 9
        else:
            expected[f"c{i}", "Unknown/Orphan"] = 1
    assert counted == expected
    _, one = payments(spark, n_years, n_claims, fanout=False)
    assert one.count() == n_claims and one.where("STATE_NAME = 'Zero'").count() == 0


def test_members_meet_claims_as_one_row_each(spark):
    """Neither join multiplies: a member comes with a list of its states, whatever number of years it has."""
    plan = payments(spark, 50, 10, fanout=True)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") >= 2 and plan.index("Generate explode(sequence") < plan.index("collect_list")


def test_rows_of_a_batch_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Looked up and compared by the same keys: one exchange a side. Rows whose promised keys are NULL still count, each for itself."""
    from twinledger.streaming import metrics

    plans, flags = [], metrics.packed_flags
    monkeypatch.setattr(metrics, "packed_flags", lambda pair, mode: plans.append(flags(pair, mode)) or plans[-1])
    rows = [("a", 1, "x", 1.0, 2.0), (None, 1, "y", 1.0, 2.0)]
    whole = pair_of(spark, rows, rows, nullable_keys=False)
    kept = RunningQuality(spark, whole.spec, SCHEMA, str(tmp_path / "running"))
    kept.add(0, whole.src)
    kept.add(1, None, whole.new)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plans[-2].select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum("Exchange hashpartitioning" in line and "code" in line for line in plan.split("\n")) <= 2
    assert plan.count("Exchange hashpartitioning") <= 4 and rows_of(kept.counts(2)) == rows_of(quality.defect_counts(whole)) and kept.counts(2).first()["units"] == 3
