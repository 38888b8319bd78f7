"""Two systems' exports derived from order tables, with known changes between them.

An order with its lines becomes a claim, a customer's orders of a year a member-year. Lines are summed up per order
before they meet the orders, so that neither a huge order nor a huge customer makes a huge join group.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.functions.families import slots
from twinledger.model import TablePair, TableSpec
from twinledger.operators.lines import LineLayout, Measure, valid_line_rule
from twinledger.sources.tables import write_table

N_SLOTS = 7
CODES = ("HCPCS_CD", "TAX_NUM", "LINE_IND_CD")
AMOUNTS = ("LINE_ALLOW_AMT", "LINE_PMT_AMT", "LINE_DDCT_AMT", "LINE_COINS_AMT", "LINE_PRPAY_AMT")
LINES = LineLayout((*CODES, *AMOUNTS), N_SLOTS)

CLAIM_SPEC = TableSpec(
    subject="Claims",
    keys=("MEMBER_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT"),
    fields=LINES.columns(),
    amounts=LineLayout(AMOUNTS, N_SLOTS).columns(),
    key_flags=("CLM_FROM_DT", "CLM_THRU_DT"),
    nullable_keys=False,
)
MEMBER_SPEC = TableSpec(
    subject="Members",
    keys=("MEMBER_ID", "YEAR"),
    fields=("STATE_CODE", "SEGMENT_CD", "RISK_CD", "BIRTH_DT", "DEATH_DT", "COVER_MONS", "REIMB_AMT", "RESP_AMT"),
    amounts=("REIMB_AMT", "RESP_AMT"),
    nullable_keys=False,
)
VALID_LINE = valid_line_rule("LINE_IND_CD", "LINE_ALLOW_AMT")
MEASURES = (
    Measure("CALC_REIMB", "coalesce(LINE_PMT_AMT, 0)", VALID_LINE),
    Measure("CALC_RESP", "coalesce(LINE_DDCT_AMT, 0) + coalesce(LINE_COINS_AMT, 0)", VALID_LINE),
    Measure("CALC_PRPAY", "coalesce(LINE_PRPAY_AMT, 0)", VALID_LINE),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def _cents(value: str) -> str:
    """Money as whole cents: exact and cheap to add up."""
    return f"CAST(round({value} * 100) AS BIGINT)"


# How a slot's value comes out of its lines, and how it is shown. Indicators are single letters whose minimum is taken as
# a number, which keeps the aggregation hash-based.
SLOT_VALUES = {
    "HCPCS_CD": ("min", "l_partkey", "CAST({} AS STRING)"),
    "TAX_NUM": ("min", "l_suppkey", "CAST({} AS STRING)"),
    "LINE_IND_CD": ("min", "ascii(l_returnflag)", "char({})"),
    "LINE_ALLOW_AMT": ("sum", _cents("l_extendedprice"), "{} / 100"),
    "LINE_PMT_AMT": ("sum", _cents("l_quantity"), "{} / 100"),
    "LINE_DDCT_AMT": ("sum", _cents("l_tax"), "{} / 100"),
    "LINE_COINS_AMT": ("sum", _cents("l_discount"), "{} / 100"),
    "LINE_PRPAY_AMT": ("sum", _cents("CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END"), "{} / 100"),
}


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source claims and the numeric order key ``k`` that decides what the new system changed."""
    # A line that no slot holds would be lost without a word.
    checked = F.expr(f"CASE WHEN l_orderkey IS NULL OR l_linenumber BETWEEN 1 AND {N_SLOTS} THEN true "
                     f"ELSE raise_error(concat('line number ', coalesce(CAST(l_linenumber AS STRING), 'NULL'), ' is not between 1 and {N_SLOTS}')) END")
    lines = read(spark, sf_dir, "lineitem").where(checked.cast("boolean")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", *[F.expr(f"{value} AS {family}") for family, (_, value, _) in SLOT_VALUES.items()])
    # Lines go straight to the slots of their order, combined before the only shuffle: the lines of a huge order are few rows by then.
    side_by_side = [
        F.expr(f"{how}(CASE WHEN l_linenumber = {i} THEN {family} END) AS {family}_{i}")
        for family, (how, _, _) in SLOT_VALUES.items() for i in range(1, N_SLOTS + 1)
    ]
    per_order = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"), *side_by_side)
    claims = read(spark, sf_dir, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return claims.selectExpr(
        "o_orderkey AS k",
        "CAST(o_custkey AS STRING) AS MEMBER_ID",
        "CAST(o_orderkey AS STRING) AS CLM_ID",
        "date_format(o_orderdate, 'yyyyMMdd') AS CLM_FROM_DT",
        "date_format(last_ship, 'yyyyMMdd') AS CLM_THRU_DT",
        *[f"{shown.format(c)} AS {c}" for family, (_, _, shown) in SLOT_VALUES.items() for c in slots(family, N_SLOTS)],
    )


def _kept_and_copied(k: Column, dropped_every: int, copied_every: int) -> Column:
    """One id prefix per row of the new side: '' unless dropped, 'X' for the extra copy."""
    return F.explode(F.array_compact(F.array(F.when(k % dropped_every != 0, ""), F.when(k % copied_every == 0, "X"))))


def claims_pair(spark: SparkSession, sf_dir: str, folder: str | None = None) -> TablePair:
    """With ``folder``, which must be shared storage, source claims are written there; both sides are then read from this one table."""
    claims = _claims(spark, sf_dir)
    if folder:
        claims = write_table(claims, f"{folder}/claims")
    k = F.col("k")
    new = claims.withColumn("prefix", _kept_and_copied(k, 97, 89)).withColumns({
        "CLM_ID": F.concat("prefix", "CLM_ID"),
        "CLM_FROM_DT": F.when(k % 83 == 0, "20991231").otherwise(F.col("CLM_FROM_DT")),
        "LINE_PMT_AMT_1": F.when(k % 53 == 0, F.col("LINE_PMT_AMT_1") * 0.5).otherwise(F.col("LINE_PMT_AMT_1")),
        "HCPCS_CD_2": F.when(k % 61 == 0, "X").otherwise(F.col("HCPCS_CD_2")),
        "LINE_IND_CD_3": F.when(k % 71 != 0, F.col("LINE_IND_CD_3")),
    })
    return TablePair(CLAIM_SPEC, claims.drop("k"), new.drop("k", "prefix"))


def members_pair(spark: SparkSession, sf_dir: str, folder: str | None = None) -> TablePair:
    """``folder``: as for ``claims_pair``."""
    orders = read(spark, sf_dir, "orders")

    def paid(status: str) -> Column:
        return F.expr(f"sum(CASE WHEN o_orderstatus = '{status}' THEN {_cents('o_totalprice')} END) / 100")

    yearly = orders.groupBy("o_custkey", F.year("o_orderdate").alias("YEAR")).agg(
        F.count("*").alias("n_orders"),
        F.min(F.left("o_orderpriority", F.lit(1)).cast("int")).alias("risk"),
        paid("F").alias("REIMB_AMT"), paid("O").alias("RESP_AMT"),
    )
    customer = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    members = yearly.join(customer, F.col("o_custkey") == k).select(
        k.alias("k"),
        F.col("o_custkey").cast("string").alias("MEMBER_ID"), "YEAR",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATE_CODE"),
        F.col("c_mktsegment").alias("SEGMENT_CD"),
        F.col("risk").cast("string").alias("RISK_CD"),
        F.concat(F.lit("19"), F.lpad((k % 40 + 30).cast("string"), 2, "0"), F.lit("0101")).alias("BIRTH_DT"),
        F.when(k % 37 == 0, "19990601").alias("DEATH_DT"),
        F.least(F.col("n_orders"), F.lit(12)).cast("int").alias("COVER_MONS"),
        "REIMB_AMT", "RESP_AMT",
    )
    if folder:
        members = write_table(members, f"{folder}/members")
    k = F.col("k")
    original = F.col("prefix") == ""  # extra copies are otherwise unchanged
    new = members.withColumn("prefix", _kept_and_copied(k, 41, 43)).withColumns({
        "MEMBER_ID": F.concat("prefix", "MEMBER_ID"),
        "BIRTH_DT": F.when(original & (k % 47 == 0), "19000101").otherwise(F.col("BIRTH_DT")),
        "REIMB_AMT": F.when(original & (k % 31 == 0), F.col("REIMB_AMT") + 10).otherwise(F.col("REIMB_AMT")),
        "SEGMENT_CD": F.when(~original | (k % 29 != 0), F.col("SEGMENT_CD")),
    })
    return TablePair(MEMBER_SPEC, members.drop("k"), new.drop("k", "prefix"))


FINE_SPEC = TableSpec("Line charges", keys=("ORDER_ID", "LINE_NUM"), fields=("CHARGE", "TAX_PART"), amounts=("CHARGE", "TAX_PART"), nullable_keys=False)


def fine_charges_pair(spark: SparkSession, sf_dir: str) -> TablePair:
    """Charges of order lines with fractions of a cent; some are off by less than half a cent in the new system."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_extendedprice").alias("price"), F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    src = lines.select(F.col("l_orderkey").alias("ORDER_ID"), F.col("l_linenumber").alias("LINE_NUM"),
                       F.expr("price * discount * tax").alias("CHARGE"), F.expr("price * tax").alias("TAX_PART"))
    off = F.when(F.col("LINE_NUM") % 3 == 0, 0.004).otherwise(0.0)
    return TablePair(FINE_SPEC, src, src.withColumn("CHARGE", F.col("CHARGE") + off))


SHARED_SPEC = TableSpec(
    "Order lines", keys=("ORDER_ID", "LINE_NUM"), fields=("PART", "SUPPLIER", "QUANTITY", "FLAG", "STATUS", "CENTS"), amounts=("CENTS", "QUANTITY"),
    nullable_keys=False, on_shared_keys="match")


def shared_lines_pair(spark: SparkSession, sf_dir: str) -> TablePair:
    """Order lines, whose keys are not unique; the new system lost, repeated and changed some of them."""
    src = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_ID"), F.col("l_linenumber").alias("LINE_NUM"), F.col("l_partkey").alias("PART"), F.col("l_suppkey").alias("SUPPLIER"),
        F.col("l_quantity").cast("long").alias("QUANTITY"), F.col("l_returnflag").alias("FLAG"), F.col("l_linestatus").alias("STATUS"),
        F.expr(_cents("l_extendedprice")).alias("CENTS"))
    part, supplier = F.col("PART"), F.col("SUPPLIER")
    times = F.when((part + supplier) % 97 == 0, 0).when(part % 89 == 0, 2).otherwise(1)
    new = src.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).drop("copy").withColumns({
        "QUANTITY": F.when(part % 53 == 0, F.col("QUANTITY") + 1).otherwise(F.col("QUANTITY")),
        "FLAG": F.when(supplier % 71 != 0, F.col("FLAG")),
        "CENTS": F.when(supplier % 37 == 0, F.col("CENTS") - 5).otherwise(F.col("CENTS")),
    })
    return TablePair(SHARED_SPEC, src, new)


def state_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a state lookup that lacks two codes, so that some states stay unknown."""
    nation = read(spark, sf_dir, "nation")
    lacking = reduce(lambda a, b: a & b, [F.col("n_nationkey") != n for n in (3, 11)])
    return nation.where(lacking).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), F.col("n_name").alias("name"),
    )
