"""Rows of shared keys matched one to one, and tables compared range by range, against plain versions."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SCHEMA, pair_of, rows_of
from twinledger.model import TablePair, TableSpec
from twinledger.operators import amounts, fields, keys, quality, ranges, rows
from twinledger.session import scratch_dir

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2]), st.sampled_from([None, "", "x", "y"]), st.sampled_from([0.0, 1.5, -2.0]),
                          st.sampled_from([None, 3.0])), max_size=14)


def text(value):
    return "" if value is None else str(value)


def plain_match(src, new, n_keys=2):
    """Pairs (key, source values or None, new values or None)."""
    out = []
    for key in {r[:n_keys] for r in (*src, *new)}:
        left, right = ([r[n_keys:] for r in side if r[:n_keys] == key] for side in (src, new))
        for row in list(left):
            if row in right:
                left.remove(row)
                right.remove(row)
                out.append((key, row, row))
        digest = lambda row: hashlib.md5("|".join(map(text, row)).encode()).hexdigest()
        left, right = sorted(left, key=digest), sorted(right, key=digest)
        for k in range(max(len(left), len(right))):
            out.append((key, left[k] if k < len(left) else None, right[k] if k < len(right) else None))
    return out


def matching(spark, src, new):
    return pair_of(spark, src, new, on_shared_keys="match")


@FEW
@given(src=ROWS, new=ROWS)
def test_rows_of_shared_keys_are_matched_one_to_one(spark, src, new):
    pair, expected = matching(spark, src, new), plain_match(src, new)
    joined = keys.join_sides(pair, "full_outer", ("code", "amt_1", "amt_2"))
    shown = [(r.id, r.year, (r.src_code, r.src_amt_1, r.src_amt_2) if r.in_src else None, (r.new_code, r.new_amt_1, r.new_amt_2) if r.in_new else None) for r in joined.collect()]
    assert sorted(shown, key=str) == sorted(((*k, s, n) for k, s, n in expected), key=str)
    for how, kept in (("inner", lambda s, n: s and n), ("left_outer", lambda s, n: s)):
        assert keys.join_sides(pair, how, ("code", "amt_1", "amt_2")).count() == sum(bool(kept(s, n)) for _, s, n in expected)
    direct, narrow = (rows_of(quality.defect_counts(pair, strategy=s)) for s in ("direct", "fingerprint"))
    assert direct == narrow and direct[0][0] == len(expected)


def test_a_hot_key_is_spread_and_not_multiplied(spark):
    src = spark.range(4000).select(F.lit("hot").alias("id"), F.lit(1).alias("year"), F.col("id").cast("string").alias("code"), F.lit(0.0).alias("amt_1"), F.lit(0.0).alias("amt_2"))
    new = src.where("CAST(code AS INT) % 10 <> 0").withColumn("amt_1", F.when(F.col("code") % 2 == 0, 1.0).otherwise(0.0))
    pair = TablePair(TableSpec("Hot", ("id", "year"), ("code", "amt_1", "amt_2"), ("amt_1",), on_shared_keys="match"), src, new)
    flags = fields.field_flags(pair)
    assert flags.count() == 4000
    joined = keys.join_sides(pair, "full_outer")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(sizes) < 4000 * 0.3
    assert rows_of(joined.agg(F.count_if("in_src"), F.count_if("in_new"))) == [(4000, 3600)]


def test_matching_is_refused_where_it_means_nothing(spark):
    with pytest.raises(ValueError, match="full_outer, inner or left_outer"):
        keys.join_sides(matching(spark, [], []), "right_outer")
    with pytest.raises(ValueError, match="'match'"):
        matching(spark, [], []).with_spec(on_shared_keys="cross")
    assert fields.field_flags(matching(spark, [], [])).count() == 0
    assert amounts.amount_deltas(matching(spark, [("a", 1, "x", 1.0, 1.0)] * 3, [("a", 1, "x", 1.0, 1.0)] * 2)).count() == 3


@FEW
@given(src=ROWS, new=ROWS, bits=st.sampled_from([1, 3, 12]))
def test_difference_by_ranges_is_the_difference(spark, src, new, bits):
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (src, new))
    by_ranges = ranges.symmetric_difference(a, b, ["id", "year"], scratch_dir(spark, "t"), with_side=True, bits=bits)
    assert rows_of(by_ranges) == rows_of(rows.symmetric_difference(a, b, with_side=True))
    missing, extra = ranges.one_sided_rows(pair_of(spark, src, new), scratch_dir(spark, "t"), bits)
    assert rows_of(missing) == rows_of(rows.missing_rows(pair_of(spark, src, new))) and rows_of(extra) == rows_of(rows.extra_rows(pair_of(spark, src, new)))


def wide(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("year"), F.lit("c").alias("code"), F.lit(1.0).alias("amt_1"), F.col("id").cast("double").alias("amt_2"))


def test_rows_of_equal_ranges_are_dropped_before_the_exchange(spark):
    src = wide(spark, 20_000)
    new = src.where("id <> '77'").withColumn("amt_2", F.when(F.col("id") == "5", -1.0).otherwise(F.col("amt_2")))
    pair = TablePair(TableSpec("Wide", ("id", "year"), ("code", "amt_1", "amt_2")), src, new)
    near = ranges.narrowed(pair, ["id", "year"], scratch_dir(spark, "t"))
    assert 1 <= near.src.count() < 100 and near.src.where("id = '77'").count() == 1
    missing, extra = ranges.one_sided_rows(pair, scratch_dir(spark, "t"))
    plan = missing._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("LeftAnti"):]
    assert "LeftSemi" in left and left.index("LeftSemi") > left.index("LeftAnti")
    assert [r.id for r in missing.collect()] == ["77"] and extra.count() == 0
    found = ranges.symmetric_difference(src, new, ["id", "year"], scratch_dir(spark, "t"), with_side=True)
    assert sorted((r.id, r.side) for r in found.collect()) == [("5", "new"), ("5", "src"), ("77", "src")]
    # Where most ranges differ nothing is narrowed.
    other = TablePair(pair.spec, src, src.withColumn("id", F.concat("id", F.lit("x"))))
    assert ranges.narrowed(other, ["id"], scratch_dir(spark, "t")) is other


def test_levels_add_up(spark):
    src = wide(spark, 5000)
    sums = ranges.range_sums(src, src.where("id <> '9'"), ["id", "year"], src.columns, 8)
    found = {r.level: (r.n_ranges, r.n_differing) for r in ranges.levels(sums, 8).collect()}
    assert found == {0: (1, 1), 4: (16, 1), 8: (256, 1)}
    assert ranges.bits_for(0) == 1 and ranges.bits_for(10**12) == ranges.MAX_BITS
