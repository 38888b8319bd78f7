"""The two audited tables of the medical claims exports: member-year summary and carrier claims."""

from __future__ import annotations

from pyspark.sql import types as T

from twinledger.functions.families import slots
from twinledger.model import TableSpec
from twinledger.operators.lines import LineLayout, Measure, valid_line_rule

# Columns of the member-year summary. Dates are text, YYYYMMDD.
MEMBER_KEYS = ("DESYNPUF_ID", "YEAR")
MEMBER_CODES = (
    "BENE_BIRTH_DT", "BENE_DEATH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD", "BENE_ESRD_IND", "SP_STATE_CODE", "BENE_COUNTY_CD",
)
MEMBER_MONTHS = ("BENE_HI_CVRAGE_TOT_MONS", "BENE_SMI_CVRAGE_TOT_MONS", "BENE_HMO_CVRAGE_TOT_MONS", "PLAN_CVRG_MOS_NUM")
MEMBER_CONDITIONS = (
    "SP_ALZHDMTA", "SP_CHF", "SP_CHRNKIDN", "SP_CNCR", "SP_COPD", "SP_DEPRESSN", "SP_DIABETES", "SP_ISCHMCHT", "SP_OSTEOPRS",
    "SP_RA_OA", "SP_STRKETIA",
)
MEMBER_AMOUNTS = (
    "MEDREIMB_IP", "BENRES_IP", "PPPYMT_IP", "MEDREIMB_OP", "BENRES_OP", "PPPYMT_OP", "MEDREIMB_CAR", "BENRES_CAR", "PPPYMT_CAR",
)
# Columns of the carrier claims; a family has one column per line, 1 to 13 (diagnoses: 1 to 8).
CLAIM_KEYS = ("DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT")
N_DIAGNOSES = 8
N_LINES = 13
DIAGNOSIS_FAMILY = "ICD9_DGNS_CD"
PROVIDER_FAMILIES = ("PRF_PHYSN_NPI", "TAX_NUM", "HCPCS_CD")
AMOUNT_FAMILIES = (
    "LINE_NCH_PMT_AMT", "LINE_BENE_PTB_DDCTBL_AMT", "LINE_BENE_PRMRY_PYR_PD_AMT", "LINE_COINSRNC_AMT", "LINE_ALOWD_CHRG_AMT",
)
CODE_FAMILIES = ("LINE_PRCSG_IND_CD", "LINE_ICD9_DGNS_CD")
# Fixed value: opportunities per claim in published results, although 138 fields are compared.
PUBLISHED_CLAIM_OPPORTUNITIES = 102

LINE_FAMILIES = (*PROVIDER_FAMILIES, *AMOUNT_FAMILIES, *CODE_FAMILIES)
CLAIM_LINES = LineLayout(LINE_FAMILIES, N_LINES)
CLAIM_AMOUNTS = LineLayout(AMOUNT_FAMILIES, N_LINES).columns()

MEMBER_SPEC = TableSpec(
    subject="Beneficiary Summary",
    keys=MEMBER_KEYS,
    fields=(*MEMBER_CODES, *MEMBER_MONTHS, *MEMBER_CONDITIONS, *MEMBER_AMOUNTS),
    amounts=MEMBER_AMOUNTS,
)
CLAIM_SPEC = TableSpec(
    subject="Carrier Claims",
    keys=CLAIM_KEYS,
    fields=(*slots(DIAGNOSIS_FAMILY, N_DIAGNOSES), *CLAIM_LINES.columns()),
    amounts=tuple(CLAIM_AMOUNTS),
    key_flags=("CLM_FROM_DT", "CLM_THRU_DT"),
)


def _schema(columns: tuple[str, ...], integers: tuple[str, ...], doubles: tuple[str, ...]) -> T.StructType:
    def type_of(column: str) -> T.DataType:
        return T.IntegerType() if column in integers else T.DoubleType() if column in doubles else T.StringType()

    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


MEMBER_SCHEMA = _schema((*MEMBER_KEYS, *MEMBER_SPEC.fields), ("YEAR", *MEMBER_MONTHS), MEMBER_AMOUNTS)
CLAIM_SCHEMA = _schema((*CLAIM_KEYS, *CLAIM_SPEC.fields), (), tuple(CLAIM_AMOUNTS))

VALID_LINE = valid_line_rule("LINE_PRCSG_IND_CD", "LINE_ALOWD_CHRG_AMT")
CARRIER_MEASURES = (
    Measure("CALC_MEDREIMB_CAR", "coalesce(LINE_NCH_PMT_AMT, 0)", VALID_LINE),
    Measure("CALC_BENRES_CAR", "coalesce(LINE_BENE_PTB_DDCTBL_AMT, 0) + coalesce(LINE_COINSRNC_AMT, 0)", VALID_LINE),
    Measure("CALC_PPPYMT_CAR", "coalesce(LINE_BENE_PRMRY_PYR_PD_AMT, 0)", VALID_LINE),
)
