"""The derived exports of both systems as common table expressions."""

from __future__ import annotations

SLOTS = range(1, 8)
CODE_FAMILIES = ("HCPCS_CD", "TAX_NUM", "LINE_IND_CD")
AMOUNT_FAMILIES = ("LINE_ALLOW_AMT", "LINE_PMT_AMT", "LINE_DDCT_AMT", "LINE_COINS_AMT", "LINE_PRPAY_AMT")
CLAIM_KEYS = ("MEMBER_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT")
CLAIM_FIELDS = tuple(f"{f}_{i}" for f in (*CODE_FAMILIES, *AMOUNT_FAMILIES) for i in SLOTS)
CLAIM_AMOUNTS = tuple(f"{f}_{i}" for f in AMOUNT_FAMILIES for i in SLOTS)
MEMBER_KEYS = ("MEMBER_ID", "YEAR")
MEMBER_TEXTS = ("STATE_CODE", "SEGMENT_CD", "RISK_CD", "BIRTH_DT", "DEATH_DT")
MEMBER_FIELDS = (*MEMBER_TEXTS, "COVER_MONS", "REIMB_AMT", "RESP_AMT")
MEMBER_AMOUNTS = ("REIMB_AMT", "RESP_AMT")

_SLOT_SQL = {
    "HCPCS_CD": "CAST(min(l_partkey) FILTER (l_linenumber = {i}) AS VARCHAR)",
    "TAX_NUM": "CAST(min(l_suppkey) FILTER (l_linenumber = {i}) AS VARCHAR)",
    "LINE_IND_CD": "min(l_returnflag) FILTER (l_linenumber = {i})",
    "LINE_ALLOW_AMT": "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linenumber = {i}) AS DOUBLE)",
    "LINE_PMT_AMT": "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linenumber = {i}) AS DOUBLE)",
    "LINE_DDCT_AMT": "CAST(sum(CAST(l_tax AS DECIMAL(18,2))) FILTER (l_linenumber = {i}) AS DOUBLE)",
    "LINE_COINS_AMT": "CAST(sum(CAST(l_discount AS DECIMAL(18,2))) FILTER (l_linenumber = {i}) AS DOUBLE)",
    "LINE_PRPAY_AMT": "CAST(sum(CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS DECIMAL(18,2))) "
                      "FILTER (l_linenumber = {i}) AS DOUBLE)",
}
_slot_columns = ",\n    ".join(f"{sql.format(i=i)} AS {family}_{i}" for family, sql in _SLOT_SQL.items() for i in SLOTS)
_CHANGED_CLAIM = {
    "CLM_FROM_DT": "CASE WHEN k % 83 = 0 THEN '20991231' ELSE CLM_FROM_DT END",
    "LINE_PMT_AMT_1": "CASE WHEN k % 53 = 0 THEN LINE_PMT_AMT_1 * 0.5::DOUBLE ELSE LINE_PMT_AMT_1 END",
    "HCPCS_CD_2": "CASE WHEN k % 61 = 0 THEN 'X' ELSE HCPCS_CD_2 END",
    "LINE_IND_CD_3": "CASE WHEN k % 71 = 0 THEN NULL ELSE LINE_IND_CD_3 END",
}


def _new_claims(clm_id: str, condition: str) -> str:
    columns = [f"{_CHANGED_CLAIM[c]} AS {c}" if c in _CHANGED_CLAIM else c
               for c in ("MEMBER_ID", "CLM_FROM_DT", "CLM_THRU_DT", *CLAIM_FIELDS)]
    return f"SELECT {clm_id} AS CLM_ID, {', '.join(columns)} FROM base_claims WHERE {condition}"


CLAIMS = f"""
slot_values AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship,
    {_slot_columns}
  FROM lineitem GROUP BY l_orderkey
),
base_claims AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS MEMBER_ID, CAST(o_orderkey AS VARCHAR) AS CLM_ID,
    replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS CLM_FROM_DT,
    replace(CAST(CAST(last_ship AS DATE) AS VARCHAR), '-', '') AS CLM_THRU_DT,
    {', '.join(CLAIM_FIELDS)}
  FROM orders JOIN slot_values ON o_orderkey = l_orderkey
),
src_claims AS (SELECT {', '.join((*CLAIM_KEYS, *CLAIM_FIELDS))} FROM base_claims),
new_claims AS (
  SELECT {', '.join((*CLAIM_KEYS, *CLAIM_FIELDS))} FROM (
    {_new_claims('CLM_ID', 'k % 97 <> 0')}
    UNION ALL
    {_new_claims("'X' || CLM_ID", 'k % 89 = 0')}
  )
)"""

MEMBERS = f"""
yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS YEAR, count(*) AS n_orders, min(left(o_orderpriority, 1)) AS RISK_CD,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS REIMB_AMT,
    CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS RESP_AMT
  FROM orders GROUP BY ALL
),
base_members AS (
  SELECT c_custkey AS k, CAST(o_custkey AS VARCHAR) AS MEMBER_ID, YEAR, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS STATE_CODE,
    c_mktsegment AS SEGMENT_CD, RISK_CD, '19' || lpad(CAST(30 + c_custkey % 40 AS VARCHAR), 2, '0') || '0101' AS BIRTH_DT,
    CASE WHEN c_custkey % 37 = 0 THEN '19990601' END AS DEATH_DT, CAST(least(n_orders, 12) AS INTEGER) AS COVER_MONS,
    REIMB_AMT, RESP_AMT
  FROM yearly JOIN customer ON o_custkey = c_custkey
),
src_members AS (SELECT {', '.join((*MEMBER_KEYS, *MEMBER_FIELDS))} FROM base_members),
new_members AS (
  SELECT MEMBER_ID, YEAR, STATE_CODE, CASE WHEN k % 29 = 0 THEN NULL ELSE SEGMENT_CD END AS SEGMENT_CD, RISK_CD,
    CASE WHEN k % 47 = 0 THEN '19000101' ELSE BIRTH_DT END AS BIRTH_DT, DEATH_DT, COVER_MONS,
    CASE WHEN k % 31 = 0 THEN REIMB_AMT + 10 ELSE REIMB_AMT END AS REIMB_AMT, RESP_AMT
  FROM base_members WHERE k % 41 <> 0
  UNION ALL
  SELECT 'X' || MEMBER_ID, YEAR, {', '.join(MEMBER_FIELDS)} FROM base_members WHERE k % 43 = 0
)"""

STATES = """
states AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name FROM nation WHERE n_nationkey NOT IN (3, 11)
)"""
