"""One SQL statement per registered query, written the long way round: key unions, outer joins, EXCEPT, UNPIVOT."""

from __future__ import annotations

from oracle.pairs_sql import (
    AMOUNT_FAMILIES, CLAIM_AMOUNTS, CLAIM_FIELDS, CLAIM_KEYS, CLAIMS, CODE_FAMILIES, MEMBER_AMOUNTS, MEMBER_FIELDS, MEMBER_KEYS,
    MEMBER_TEXTS, MEMBERS, SLOTS, STATES,
)

TABLES = {
    "claims": (CLAIM_KEYS, CLAIM_FIELDS, CLAIM_AMOUNTS),
    "members": (MEMBER_KEYS, MEMBER_FIELDS, MEMBER_AMOUNTS),
}
SUBJECTS = {"claims": "Claims", "members": "Members"}
KEY_FLAGS = {"claims": ("CLM_FROM_DT", "CLM_THRU_DT"), "members": ()}


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


BOTH = with_ctes(CLAIMS, MEMBERS)
ONLY = {"claims": with_ctes(CLAIMS), "members": with_ctes(MEMBERS)}


def is_text(field: str) -> bool:
    return field in MEMBER_TEXTS or field.rsplit("_", 1)[0] in CODE_FAMILIES or field in (*CLAIM_KEYS, "MEMBER_ID")


def on(keys, left="s", right="n") -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def sigma(rate: str) -> str:
    return f"(5.5556::DOUBLE * (1 - power({rate}, 0.1186::DOUBLE)) + 1.5::DOUBLE)"


def flags(table: str, suffix: str = "") -> str:
    """The field audit as a CTE, in the form of a key union and two left joins."""
    keys, fields, _ = TABLES[table]

    def flag(f, s, n, name):
        default = "''" if is_text(f) else "0"
        return f"CASE WHEN coalesce({s}, {default}) <> coalesce({n}, {default}) THEN 1 ELSE 0 END AS {name}"

    columns = [flag(k, f"s.{k}", f"n.{k}", f"KEY_ONE_SIDED_{k}") for k in KEY_FLAGS[table]]
    columns += [flag(f, f"s.{f}", f"n.{f}", f) for f in fields]
    return f"""
{table}_keys AS (SELECT DISTINCT {', '.join(keys)} FROM src_{table} UNION SELECT DISTINCT {', '.join(keys)} FROM new_{table}),
{table}_flags AS (
  SELECT {', '.join(f'k.{k}' for k in keys)}, s.{keys[0]} IS NOT NULL AS in_src,
    {', '.join(columns)}
  FROM {table}_keys k LEFT JOIN src_{table} s ON {on(keys, 'k', 's')} LEFT JOIN new_{table} n ON {on(keys, 'k', 'n')}
)"""


def flag_names(table: str) -> list[str]:
    return [f"KEY_ONE_SIDED_{k}" for k in KEY_FLAGS[table]] + list(TABLES[table][1])


def flag_query(table: str, tail: str) -> str:
    return with_ctes(CLAIMS if table == "claims" else MEMBERS, flags(table)) + tail


def any_flag(table: str) -> str:
    return " OR ".join(f"{f} = 1" for f in TABLES[table][1])


def overall(table: str, per_row: int | None = None, exact: str = "") -> str:
    fields = TABLES[table][1]
    rate = "(TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES)"
    return f"""
  SELECT '{SUBJECTS[table]}' AS SUBJECT, TOTAL_UNITS, TOTAL_DEFECTS, TOTAL_OPPORTUNITIES, round({rate} * 1000000, 6) AS DPMO,
    round(1 - {rate}, 9) AS YIELD, round({sigma(rate)}, 6) AS SIGMA_LEVEL{exact.format(p=f'(1 - {rate})') if exact else ''}
  FROM (SELECT count(*) AS TOTAL_UNITS, CAST(sum({' + '.join(fields)}) AS BIGINT) AS TOTAL_DEFECTS,
    count(*) * {per_row or len(fields)} AS TOTAL_OPPORTUNITIES FROM {table}_flags)"""


def column_quality(table: str) -> str:
    """Column quality as a CTE."""
    rate = "(TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES)"
    return f"""
{table}_long AS (UNPIVOT (SELECT {', '.join(flag_names(table))} FROM {table}_flags) ON COLUMNS(*) INTO NAME column_name VALUE def),
{table}_columns AS (
  SELECT *, {rate} * 1000000 AS DPMO, {sigma(rate)} AS SIGMA_LEVEL FROM (
    SELECT '{SUBJECTS[table]}' AS SOURCE, column_name, CAST(sum(def) AS BIGINT) AS TOTAL_DEFECTS, count(*) AS TOTAL_OPPORTUNITIES
    FROM {table}_long GROUP BY column_name
  )
)"""


def families(table: str) -> str:
    """Family quality as a CTE."""
    return f"""
{table}_family_sums AS (
  SELECT SOURCE, regexp_replace(replace(column_name, 'KEY_ONE_SIDED_', ''), '_[0-9]+$', '') AS FIELD_FAMILY,
    CAST(sum(TOTAL_DEFECTS) AS BIGINT) AS TOTAL_DEFECTS, max(TOTAL_OPPORTUNITIES) AS units, sum(TOTAL_OPPORTUNITIES) AS opps
  FROM {table}_columns GROUP BY 1, 2
),
{table}_families AS (
  SELECT SOURCE, FIELD_FAMILY, TOTAL_DEFECTS,
    round(CAST(sum(TOTAL_DEFECTS) OVER (PARTITION BY SOURCE ORDER BY TOTAL_DEFECTS DESC, TOTAL_DEFECTS::DOUBLE / units DESC, FIELD_FAMILY
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(sum(TOTAL_DEFECTS) OVER (PARTITION BY SOURCE) AS DOUBLE), 9)
      AS RUNNING_PCT_OF_TOTAL,
    round(TOTAL_DEFECTS::DOUBLE / units * 1000000, 6) AS DPMO,
    round(TOTAL_DEFECTS::DOUBLE / CAST(opps AS DOUBLE) * 1000000, 6) AS DPMO_PER_OPPORTUNITY,
    round({sigma('(TOTAL_DEFECTS::DOUBLE / units)')}, 6) AS SIGMA_LEVEL
  FROM {table}_family_sums
)"""


def deltas(table: str, keys=None) -> str:
    """The amount audit as a CTE."""
    keys = keys or TABLES[table][0]
    amounts = TABLES[table][2]
    clean = ", ".join(f"CASE WHEN isnan({a}) THEN 0 ELSE coalesce({a}, 0) END AS {a}" for a in amounts)
    columns = ", ".join(
        f"s.{a} AS src_{a}, n.{a} AS new_{a}, n.{a} - s.{a} AS delta_{a}, abs(n.{a} - s.{a}) AS abs_delta_{a}" for a in amounts
    )
    k = ", ".join(keys)
    return f"""
{table}_akeys AS (SELECT DISTINCT {k} FROM src_{table} UNION SELECT DISTINCT {k} FROM new_{table}),
{table}_asrc AS (SELECT {k}, {clean} FROM src_{table}),
{table}_anew AS (SELECT {k}, {clean} FROM new_{table}),
{table}_deltas AS (
  SELECT {', '.join(f'k.{c}' for c in keys)}, {columns}
  FROM {table}_akeys k LEFT JOIN {table}_asrc s ON {on(keys, 'k', 's')} LEFT JOIN {table}_anew n ON {on(keys, 'k', 'n')}
)"""


def rollup(table: str) -> str:
    keys, _, amounts = TABLES[table]
    names = [f"abs_delta_{a}" for a in amounts]
    return f"""
{table}_rollup AS (
  SELECT * FROM (
    SELECT {', '.join(keys)}, {', '.join(f'CAST(sum(CAST({n} AS DECIMAL(38,6))) AS DOUBLE) AS {n}' for n in names)}
    FROM {table}_deltas GROUP BY {', '.join(keys)}
  ) WHERE list_sum(list_value({', '.join(names)})) > 0
)"""


def totals(table: str) -> str:
    amounts = TABLES[table][2]
    return f"""
{table}_metrics AS (
  UNPIVOT (SELECT {', '.join(f'abs_delta_{a}' for a in amounts)} FROM {table}_rollup) ON COLUMNS(*) INTO NAME metric_name VALUE v
),
{table}_totals AS (
  SELECT metric_name, round(CAST(sum(CAST(v AS DECIMAL(38,6))) AS DOUBLE), 2) AS total_abs_delta FROM {table}_metrics GROUP BY metric_name
)"""


def impact(table: str) -> str:
    return f"""
{table}_impact AS (
  SELECT '{SUBJECTS[table]}' AS DATA_SET, FIELD_FAMILY, FINANCIAL_VARIANCE,
    round(sum(FINANCIAL_VARIANCE) OVER (ORDER BY FINANCIAL_VARIANCE DESC, FIELD_FAMILY ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      / sum(FINANCIAL_VARIANCE) OVER (), 9) AS RUNNING_PCT_OF_TOTAL
  FROM (
    SELECT regexp_replace(regexp_replace(metric_name, '^abs_delta_', ''), '_[0-9]+$', '') AS FIELD_FAMILY,
      CAST(sum(CAST(total_abs_delta AS DECIMAL(38,6))) AS DOUBLE) AS FINANCIAL_VARIANCE
    FROM {table}_totals GROUP BY 1
  )
)"""


def amount_query(table: str, tail: str, *more) -> str:
    base = CLAIMS if table == "claims" else MEMBERS
    return with_ctes(base, deltas(table), *[m(table) for m in more]) + tail


def anti(table: str, left: str, right: str, select: str, where: str = "", keys=None) -> str:
    keys = keys or TABLES[table][0]
    return (f"SELECT {select} FROM {left}_{table} s LEFT JOIN {right}_{table} n ON {on(keys)} "
            f"WHERE n.{keys[0]} IS NULL {where}")


ALIVE = "AND (s.DEATH_DT IS NULL OR left(s.DEATH_DT, 4) <= CAST(s.YEAR AS VARCHAR))"
MISSING_MEMBER = "Error: Beneficiary Missing in New File"
EXTRA_MEMBER = "Error: Beneficiary Present in New File, Not in Original File"


def finding(left: str, right: str, label: str) -> str:
    select = (f"s.MEMBER_ID, coalesce(left(s.DEATH_DT, 4), '') AS DEATH_YEAR, CAST(s.YEAR AS VARCHAR) AS YEAR, '{label}' AS FINDING")
    return anti("members", left, right, select, ALIVE)


MISSING = finding("src", "new", MISSING_MEMBER)
EXTRA = finding("new", "src", EXTRA_MEMBER)
CLAIM_MISMATCHES = (
    anti("claims", "src", "new", "s.CLM_ID, 'Error: Claim Missing in New File' AS FINDING", keys=("CLM_ID",))
    + "\nUNION\n"
    + anti("claims", "new", "src", "s.CLM_ID, 'Error: Claim Present in New File, Not in Original File' AS FINDING", keys=("CLM_ID",))
)
ORPHAN_CLAIMS = anti("claims", "new", "src", ", ".join(f"s.{c}" for c in (*CLAIM_KEYS, *CLAIM_FIELDS)))

VALID = "({ind} = 'A' OR ({ind} IN ('R', 'S') AND {allowed} > 0))"


def orphan_rate(table: str) -> str:
    keys = TABLES[table][0]
    orphans = f"SELECT count(*) FROM src_{table} s LEFT JOIN new_{table} n ON {on(keys)} WHERE n.{keys[0]} IS NULL"
    return (f"SELECT '{SUBJECTS[table]}' AS subject, (SELECT count(*) FROM src_{table}) AS src_rows, ({orphans}) AS orphan_rows, "
            f"round(({orphans}) * 100::DOUBLE / (SELECT count(*) FROM src_{table}), 4) AS orphan_rate")


def row_status(table: str) -> str:
    keys = ", ".join(f"s.{k}" for k in TABLES[table][0])
    return (anti(table, "src", "new", f"'Missing in New' AS status, {keys}") + "\nUNION ALL\n"
            + anti(table, "new", "src", f"'Extra in New' AS status, {keys}"))


def symmetric(table: str, with_side: bool = False) -> str:
    keys, fields, _ = TABLES[table]
    columns = ", ".join((*keys, *fields))

    def one_way(a, b):
        side = f", '{a}' AS side" if with_side else ""
        return f"(SELECT *{side} FROM (SELECT {columns} FROM {a}_{table} EXCEPT SELECT {columns} FROM {b}_{table}))"

    return one_way("src", "new") + "\nUNION ALL\n" + one_way("new", "src")


def pair_select(table: str, fields, select: str, operator: str, keys=None) -> str:
    keys = keys or TABLES[table][0]
    condition = " OR ".join(f"s.{f} {operator} n.{f}" for f in fields)
    return f"SELECT {select} FROM src_{table} s JOIN new_{table} n ON {on(keys)} WHERE {condition}"


def side_by_side(fields, pattern="{s}_{f}") -> str:
    return ", ".join(f"{s[0]}.{f} AS {pattern.format(s=s, f=f)}" for f in fields for s in ("src", "new"))


def profile(table: str, keys, fields) -> str:
    counts = ", ".join(f"count(*) FILTER (s.{f} IS DISTINCT FROM n.{f}) AS {f}" for f in fields)
    return (f"SELECT field_name, error_count, round(error_count * 100::DOUBLE / (SELECT count(*) FROM src_{table}), 2) AS error_pct "
            f"FROM (UNPIVOT (SELECT {counts} FROM src_{table} s JOIN new_{table} n ON {on(keys)}) ON COLUMNS(*) "
            "INTO NAME field_name VALUE error_count) WHERE error_count > 0")


def lines(side: str) -> str:
    """Claim lines as a CTE of one SELECT per slot."""
    families_ = (*CODE_FAMILIES, *AMOUNT_FAMILIES)
    return f"{side}_lines AS (" + "\nUNION ALL\n".join(
        f"SELECT MEMBER_ID, CLM_ID, CLM_FROM_DT, {i} AS LINE_NUM, {', '.join(f'{f}_{i} AS {f}' for f in families_)} FROM {side}_claims"
        for i in SLOTS
    ) + ")"


LINE_VALID = VALID.format(ind="LINE_IND_CD", allowed="LINE_ALLOW_AMT")
MEASURE_SQL = {
    "CALC_REIMB": "coalesce(LINE_PMT_AMT, 0)",
    "CALC_RESP": "coalesce(LINE_DDCT_AMT, 0) + coalesce(LINE_COINS_AMT, 0)",
    "CALC_PRPAY": "coalesce(LINE_PRPAY_AMT, 0)",
}
MEASURE_COLUMNS = ", ".join(f"CASE WHEN {LINE_VALID} THEN {v} ELSE 0 END AS {m}" for m, v in MEASURE_SQL.items())


SHARED_FIELDS = ("PART", "SUPPLIER", "QUANTITY", "FLAG", "STATUS", "CENTS")
SHARED_LINES = """
src_shared AS (
  SELECT l_orderkey AS ORDER_ID, l_linenumber AS LINE_NUM, l_partkey AS PART, l_suppkey AS SUPPLIER, CAST(l_quantity AS BIGINT) AS QUANTITY,
    l_returnflag AS FLAG, l_linestatus AS STATUS, CAST(round(l_extendedprice * 100) AS BIGINT) AS CENTS
  FROM lineitem
),
new_shared AS (
  SELECT ORDER_ID, LINE_NUM, PART, SUPPLIER, CASE WHEN PART % 53 = 0 THEN QUANTITY + 1 ELSE QUANTITY END AS QUANTITY,
    CASE WHEN SUPPLIER % 71 = 0 THEN NULL ELSE FLAG END AS FLAG, STATUS, CASE WHEN SUPPLIER % 37 = 0 THEN CENTS - 5 ELSE CENTS END AS CENTS
  FROM src_shared, range(2) AS t(copy)
  WHERE (PART + SUPPLIER) % 97 <> 0 AND (copy = 0 OR PART % 89 = 0)
)"""


def matched_lines(fields) -> str:
    """Rows of shared keys: equal ones paired off one by one, the others by the order of a digest of their values."""
    columns = ", ".join(fields)
    digest = "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields) + "))"
    key, same = "ORDER_ID, LINE_NUM", " AND ".join(f"s.{f} IS NOT DISTINCT FROM n.{f}" for f in ("ORDER_ID", "LINE_NUM", *fields, "nth"))

    def numbered(side):
        return f"{side}_copies AS (SELECT *, row_number() OVER (PARTITION BY {key}, {columns}) AS nth, {digest} AS digest FROM {side}_shared)"

    def rest(side, other):
        return (f"{side}_rest AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY digest, nth) AS place FROM {side}_copies s "
                f"WHERE NOT EXISTS (SELECT 1 FROM {other}_copies n WHERE {same}))")

    return f"""{SHARED_LINES},
{numbered('src')},
{numbered('new')},
{rest('src', 'new')},
{rest('new', 'src')},
matched AS (
  SELECT s.ORDER_ID, s.LINE_NUM, {side_by_side(fields)} FROM src_copies s JOIN new_copies n ON {same}
  UNION ALL
  SELECT coalesce(s.ORDER_ID, n.ORDER_ID), coalesce(s.LINE_NUM, n.LINE_NUM), {side_by_side(fields)}
  FROM src_rest s FULL JOIN new_rest n ON s.ORDER_ID = n.ORDER_ID AND s.LINE_NUM = n.LINE_NUM AND s.place = n.place
)"""


def annual(side: str) -> str:
    sums = ", ".join(
        f"CAST(sum(CAST(CASE WHEN {LINE_VALID} THEN {v} ELSE 0 END AS DECIMAL(38,6))) AS DOUBLE) AS {m}" for m, v in MEASURE_SQL.items()
    )
    return (f"{side}_annual AS (SELECT MEMBER_ID, CAST(left(CLM_FROM_DT, 4) AS INTEGER) AS YEAR, {sums} "
            f"FROM {side}_lines GROUP BY 1, 2)")


def payment_differences(fanout: bool) -> str:
    year = "" if fanout else "AND CAST(left(c.CLM_FROM_DT, 4) AS INTEGER) = {m}.YEAR"
    return f"""
payments AS (
  SELECT CLM_ID, record_status, STATE_NAME, CLM_FROM_DT, src_pmt, new_pmt, processing_ind, allowed_amt, business_rule_status,
    src_pmt - new_pmt AS variance
  FROM (
    SELECT c.CLM_ID, c.record_status, coalesce(ss.name, sn.name, 'Unknown/Orphan') AS STATE_NAME, c.CLM_FROM_DT,
      coalesce(c.src_pmt, 0) AS src_pmt, coalesce(c.new_pmt, 0) AS new_pmt, c.processing_ind, c.allowed_amt,
      CASE WHEN c.processing_ind = 'A' OR (c.processing_ind IN ('R', 'S') AND c.allowed_amt > 0) THEN 'Valid'
        ELSE 'Denied/Invalid' END AS business_rule_status
    FROM (
      SELECT coalesce(s.CLM_ID, n.CLM_ID) AS CLM_ID, coalesce(s.MEMBER_ID, n.MEMBER_ID) AS MEMBER_ID,
        s.LINE_PMT_AMT_1 AS src_pmt, n.LINE_PMT_AMT_1 AS new_pmt, n.LINE_IND_CD_1 AS processing_ind,
        n.LINE_ALLOW_AMT_1 AS allowed_amt, coalesce(s.CLM_FROM_DT, n.CLM_FROM_DT) AS CLM_FROM_DT,
        CASE WHEN s.CLM_ID IS NULL THEN 'New Only' WHEN n.CLM_ID IS NULL THEN 'Src Only' ELSE 'Matched' END AS record_status
      FROM src_claims s FULL OUTER JOIN new_claims n ON s.CLM_ID = n.CLM_ID
    ) c
    LEFT JOIN src_members sb ON c.MEMBER_ID = sb.MEMBER_ID {year.format(m='sb')}
    LEFT JOIN new_members nb ON c.MEMBER_ID = nb.MEMBER_ID {year.format(m='nb')}
    LEFT JOIN states ss ON sb.STATE_CODE = ss.code
    LEFT JOIN states sn ON nb.STATE_CODE = sn.code
  ) WHERE business_rule_status = 'Valid' AND src_pmt <> new_pmt
)"""


METRICS = f"""
metrics AS (
  SELECT 'missing_members' AS metric, count(*) AS n_rows FROM ({MISSING} UNION ALL {EXTRA})
  UNION ALL SELECT 'member_defect_rows', count(*) FROM members_flags WHERE {any_flag('members')}
  UNION ALL SELECT 'missing_claims', count(*) FROM ({CLAIM_MISMATCHES})
  UNION ALL SELECT 'claim_defect_rows', count(*) FROM claims_flags WHERE {any_flag('claims')}
  UNION ALL SELECT 'payment_differences', count(*) FROM payments
)"""
SCORECARD = with_ctes(CLAIMS, MEMBERS, STATES, flags("claims"), flags("members"), payment_differences(False), METRICS)
GRADE = ("CASE WHEN {s} >= 6 THEN 'World-class' WHEN {s} >= 5 THEN 'Excellent' WHEN {s} >= 4 THEN 'Good' "
         "WHEN {s} >= 3 THEN 'Acceptable' ELSE 'Needs Attention' END")
THRESHOLDS = ("(VALUES ('missing_members', 100), ('member_defect_rows', 1000), ('missing_claims', 1000), ('claim_defect_rows', 1000), "
              "('payment_differences', 10000)) AS t(metric, threshold)")
QUALITY_BOTH = overall("claims") + "\nUNION ALL" + overall("members")


# Coefficients of algorithm AS 241 (Wichura 1988, PPND16), lowest power first, for the three ranges.
CENTRAL = (
    (3.3871328727963665, 133.14166789178438, 1971.5909503065513, 13731.69376550946, 45921.95393154987, 67265.7709270087, 33430.57558358813, 2509.0809287301227),
    (1.0, 42.31333070160091, 687.1870074920579, 5394.196021424751, 21213.794301586597, 39307.89580009271, 28729.085735721943, 5226.495278852854),
)
MIDDLE = (
    (1.4234371107496835, 4.630337846156546, 5.769497221460691, 3.6478483247632045, 1.2704582524523684, 0.2417807251774506, 0.022723844989269184, 0.0007745450142783414),
    (1.0, 2.053191626637759, 1.6763848301838038, 0.6897673349851, 0.14810397642748008, 0.015198666563616457, 0.0005475938084995345, 1.0507500716444169e-09),
)
TAIL = (
    (6.657904643501103, 5.463784911164114, 1.7848265399172913, 0.29656057182850487, 0.026532189526576124, 0.0012426609473880784, 2.7115555687434876e-05, 2.0103343992922881e-07),
    (1.0, 0.599832206555888, 0.1369298809227358, 0.014875361290850615, 0.0007868691311456133, 1.8463183175100548e-05, 1.421511758316446e-07, 2.0442631033899397e-15),
)


def _poly(x: str, coefficients) -> str:
    text = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text.replace(repr(coefficients[-1]), f"{coefficients[-1]!r}::DOUBLE", 1)


def normal_quantile(p: str) -> str:
    """Inverse normal distribution for yields of at least one half, after Wichura (1988)."""
    q, r = f"({p} - 0.5::DOUBLE)", f"sqrt(-ln(1 - {p}))"
    rational = lambda x, c: f"({_poly(x, c[0])} / {_poly(x, c[1])})"
    return (f"CASE WHEN {q} <= 0.425 THEN {q} * {rational(f'(0.180625::DOUBLE - {q} * {q})', CENTRAL)} "
            f"WHEN {r} <= 5 THEN {rational(f'({r} - 1.6::DOUBLE)', MIDDLE)} ELSE {rational(f'({r} - 5::DOUBLE)', TAIL)} END")


EXACT = ", CASE WHEN {p} > 0 AND {p} < 1 THEN round(" + normal_quantile("QQ").replace("QQ", "{p}") + " + 1.5::DOUBLE, 6) END AS SIX_SIGMA"

RECOMMEND_COUNTS = (
    ("missing_members", 4, "DATA LOSS", "Hold the extract against the load: members are absent from one side."),
    ("member_defect_rows", 5, "DATA DISCREPANCIES",
     "Compare how each differing column is filled on either side."),
    ("missing_claims", 6, "DATA LOSS", "Hold the extract against the load: claims are absent from one side."),
    ("claim_defect_rows", 7, "DATA DISCREPANCIES",
     "Compare how each differing column is filled on either side."),
)


def recommendations() -> str:
    counts = ", ".join(f"('{m}', {i}, '{p}', '{a}')" for m, i, p, a in RECOMMEND_COUNTS)
    return with_ctes(
        CLAIMS, MEMBERS, STATES, flags("claims"), flags("members"), payment_differences(False), METRICS,
        column_quality("claims"), families("claims"), deltas("claims"), rollup("claims"), totals("claims"), impact("claims"),
    ) + f"""
SELECT 1 AS position, CASE WHEN SIGMA_LEVEL < 3 THEN 'CRITICAL' ELSE 'HIGH PRIORITY' END AS priority, SUBJECT AS subject,
  SIGMA_LEVEL AS value, CASE WHEN SIGMA_LEVEL < 3 THEN 'Find out where the defects come from and load this table again.'
    ELSE 'Bring this table to 4 sigma before the switch.' END AS advice
FROM ({QUALITY_BOTH}) WHERE SIGMA_LEVEL < 4
UNION ALL
SELECT 2, 'FOCUS AREA', FIELD_FAMILY, TOTAL_DEFECTS::DOUBLE,
  'Most defects are in these columns: look at how they are filled.'
FROM (SELECT * FROM claims_families ORDER BY TOTAL_DEFECTS DESC, FIELD_FAMILY LIMIT 1)
UNION ALL
SELECT 3, 'FINANCIAL PRIORITY', FIELD_FAMILY, round(RUNNING_PCT_OF_TOTAL, 6), 'Most of the money that differs is here: begin with it.'
FROM (SELECT * FROM claims_impact ORDER BY FINANCIAL_VARIANCE DESC, FIELD_FAMILY LIMIT 1) WHERE RUNNING_PCT_OF_TOTAL > 0.3
UNION ALL
SELECT r.position, r.priority, m.metric, m.n_rows::DOUBLE, r.advice
FROM metrics m JOIN (VALUES {counts}) AS r(metric, position, priority, advice) ON m.metric = r.metric
JOIN {THRESHOLDS} ON t.metric = m.metric WHERE m.n_rows > t.threshold"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    c_all, m_all = ", ".join((*CLAIM_KEYS, *CLAIM_FIELDS)), ", ".join((*MEMBER_KEYS, *MEMBER_FIELDS))

    # Load and checks
    q["s01_csv_load"] = ONLY["members"] + f"SELECT {m_all} FROM src_members"
    q["s02_multi_file_union"] = ONLY["members"] + (
        "SELECT YEAR, count(*) AS n_rows, CAST(sum(COVER_MONS) AS BIGINT) AS months, "
        "CAST(sum(CAST(REIMB_AMT AS DECIMAL(38,6))) AS DOUBLE) AS reimbursed FROM new_members GROUP BY YEAR")
    q["s03_null_cleaning"] = ONLY["members"] + (
        "SELECT count(*) AS n_rows, count(DEATH_DT) AS with_death, count(SEGMENT_CD) AS with_segment, count(REIMB_AMT) AS with_reimb, "
        "count(RESP_AMT) AS with_resp FROM new_members")
    q["s04_incremental_load"] = ONLY["claims"] + (
        "SELECT count(*) AS n_rows, count(DISTINCT CLM_ID) AS n_claims, "
        "CAST(sum(CAST(LINE_PMT_AMT_1 AS DECIMAL(38,6))) AS DOUBLE) AS paid FROM src_claims")
    q["s05_state_lookup"] = with_ctes(MEMBERS, STATES) + (
        "SELECT coalesce(name, 'Unknown') AS STATE_NAME, count(*) AS n_rows FROM src_members LEFT JOIN states ON STATE_CODE = code GROUP BY 1")
    control = ("SELECT '{n}' AS check, coalesce(CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE), 0) AS file_total, "
               "coalesce(CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE), 0) AS table_total, 0::DOUBLE AS diff, 0::BIGINT AS n_rejected, true AS is_match FROM {t}")
    q["s06_control_totals"] = BOTH + "\nUNION ALL\n".join([
        control.format(n="source members", c="COVER_MONS", t="src_members"),
        control.format(n="new members", c="COVER_MONS", t="new_members"),
        control.format(n="source claims", c="LINE_PMT_AMT_1", t="src_claims"),
        control.format(n="new claims", c="LINE_PMT_AMT_1", t="new_claims"),
    ])
    q["s06_control_totals_of_loads"] = q["s06_control_totals"]
    paid = "CAST(sum(CAST(LINE_PMT_AMT_1 AS DECIMAL(38,6))) AS DOUBLE)"
    q["s04_batch_ledger"] = ONLY["claims"] + (
        f"SELECT count(*) AS n_rows, 0::BIGINT AS n_rejected, {paid} AS file_total, count(*) AS table_rows, {paid} AS table_total FROM src_claims")
    q["s06_control_totals_mismatch"] = ONLY["members"] + """
SELECT *, abs(file_total - table_total) AS diff, abs(file_total - table_total) < 0.1 AND n_rejected = 0 AS is_match FROM (
  SELECT 'reimbursed' AS check, CAST(sum(CAST(REIMB_AMT AS DECIMAL(38,6))) FILTER (YEAR <> 1996) AS DOUBLE) AS file_total,
    CAST(sum(CAST(REIMB_AMT AS DECIMAL(38,6))) FILTER (YEAR <> 1996 AND COVER_MONS <> 1) AS DOUBLE) AS table_total,
    count(REIMB_AMT) FILTER (YEAR = 1996) AS n_rejected FROM src_members
  UNION ALL
  SELECT 'months', CAST(sum(COVER_MONS) AS DOUBLE), CAST(sum(COVER_MONS) AS DOUBLE), 0 FROM src_members
)"""
    q["s01_csv_quoted_values"] = "SELECT doc_id, text, lang FROM documents"
    decoded = "SELECT coalesce(d, 'Unknown') AS description, count(*) AS n_rows FROM customer LEFT JOIN (VALUES {v}) AS l(c, d) ON l.c = {code} GROUP BY 1"
    q["s05_sex_lookup"] = decoded.format(v="(1, 'Male'), (2, 'Female')", code="c_custkey % 3 + 1")
    q["s05_race_lookup"] = decoded.format(
        v="(1, 'White'), (2, 'Black'), (3, 'Other'), (4, 'Asian/Pacific Islander'), (5, 'Hispanic'), (6, 'North American Native')", code="c_nationkey % 8")
    q["s05_formulas"] = with_ctes(CLAIMS, lines("src")) + """
SELECT 'PAID_AND_TAX' AS variable_name, 'Paid with deductible' AS label, CAST(sum(CAST(LINE_PMT_AMT + LINE_DDCT_AMT AS DECIMAL(38,6))) AS DOUBLE) AS total FROM src_lines
UNION ALL SELECT 'ALLOWED', 'Allowed', CAST(sum(CAST(LINE_ALLOW_AMT AS DECIMAL(38,6))) AS DOUBLE) FROM src_lines"""
    q["s05_variable_labels"] = ONLY["members"] + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field_name, 'Column {i}, {f.lower()}' AS label, count(*) AS error_count FROM src_members s JOIN new_members n USING (MEMBER_ID, YEAR) "
        f"WHERE s.{f} IS DISTINCT FROM n.{f} HAVING count(*) > 0" for i, f in enumerate(MEMBER_FIELDS, 1))
    q["s07_table_counts"] = BOTH + "\nUNION ALL\n".join(
        f"SELECT '{side}_{t}' AS table_name, count(*) AS n_rows FROM {side}_{t}" for t in TABLES for side in ("src", "new"))
    q["s08_row_count_comparison"] = BOTH + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM src_{t}) AS src_count, (SELECT count(*) FROM new_{t}) AS new_count, "
        f"(SELECT count(*) FROM new_{t}) - (SELECT count(*) FROM src_{t}) AS diff" for t in TABLES)
    q["s09_csv_results"] = BOTH + CLAIM_MISMATCHES
    q["s10_duplicate_keys"] = ("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
                               "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")

    # Missing and extra rows
    q["j01_missing_members"] = ONLY["members"] + MISSING
    q["j02_extra_members"] = ONLY["members"] + EXTRA
    q["j03_finding_counts"] = ONLY["members"] + f"SELECT FINDING, count(*) AS n_rows FROM ({MISSING} UNION ALL {EXTRA}) GROUP BY FINDING"
    q["j04_claim_mismatches"] = ONLY["claims"] + CLAIM_MISMATCHES
    q["j05_orphan_claims"] = ONLY["claims"] + ORPHAN_CLAIMS
    q["j06_missing_member_rows"] = ONLY["members"] + anti("members", "src", "new", ", ".join(f"s.{c}" for c in (*MEMBER_KEYS, *MEMBER_FIELDS)))
    q["j06_extra_member_rows"] = ONLY["members"] + anti("members", "new", "src", ", ".join(f"s.{c}" for c in (*MEMBER_KEYS, *MEMBER_FIELDS)))
    q["j06_missing_claim_rows"] = ONLY["claims"] + anti(
        "claims", "src", "new", ", ".join(f"s.{c}" for c in (*CLAIM_KEYS, *CLAIM_FIELDS)), keys=("CLM_ID",))
    q["j07_row_status"] = ONLY["members"] + row_status("members")
    q["j08_orphan_rate"] = BOTH + orphan_rate("claims") + "\nUNION ALL\n" + orphan_rate("members")

    # Value comparison
    attributes = ("BIRTH_DT", "SEGMENT_CD", "RISK_CD", "STATE_CODE")
    q["v01_attribute_mismatches"] = ONLY["members"] + pair_select(
        "members", attributes, f"s.MEMBER_ID, s.YEAR, {side_by_side(attributes)}, 'Error: Beneficiary Attributes Changed' AS FINDING",
        "IS DISTINCT FROM")
    q["v02_date_differences"] = ONLY["members"] + pair_select(
        "members", ("BIRTH_DT", "DEATH_DT"),
        "s.MEMBER_ID, s.BIRTH_DT AS src_dob, n.BIRTH_DT AS new_dob, s.DEATH_DT AS src_dod, n.DEATH_DT AS new_dod", "<>")
    q["v03_member_symmetric_diff"] = ONLY["members"] + symmetric("members")
    q["v03_claim_symmetric_diff"] = ONLY["claims"] + symmetric("claims", with_side=True)
    for op, table in (("v04_member", "members"), ("v05_claim", "claims")):
        columns = ", ".join((*TABLES[table][0], *flag_names(table)))
        q[f"{op}_field_flags"] = flag_query(table, f"SELECT {columns} FROM {table}_flags")
    for table, op in (("members", "v06_member"), ("claims", "v06_claim")):
        columns = ", ".join((*TABLES[table][0], *flag_names(table)))
        q[f"{op}_defect_rows"] = flag_query(table, f"SELECT {columns} FROM {table}_flags WHERE {any_flag(table)}")
    for op, table in (("v04_member", "members"), ("v05_claim", "claims")):
        names = flag_names(table)
        bits = ", ".join(
            f"CAST({' + '.join(f'{name} * {1 << i}::BIGINT' for i, name in enumerate(names[k:k + 63]))} AS BIGINT) AS flags_{k // 64}" for k in range(0, len(names), 64))
        q[f"{op}_packed_flags"] = flag_query(table, f"SELECT {', '.join(TABLES[table][0])}, {bits} FROM {table}_flags")
    q["v06_claim_defects_per_row"] = flag_query(
        "claims", f"SELECT CAST({' + '.join(CLAIM_FIELDS)} AS INTEGER) AS n_defects, count(*) AS n_rows FROM claims_flags GROUP BY 1")
    q["v07_line_payment_differences"] = with_ctes(CLAIMS, MEMBERS, STATES, payment_differences(False)) + "SELECT * FROM payments"
    q["v07_line_payment_differences_fanout"] = with_ctes(CLAIMS, MEMBERS, STATES, payment_differences(True)) + "SELECT * FROM payments"
    q["v08_member_column_profile"] = ONLY["members"] + profile("members", MEMBER_KEYS, MEMBER_FIELDS)
    by_id = ("MEMBER_ID", "CLM_FROM_DT", "CLM_THRU_DT", *CLAIM_FIELDS)
    q["v08_claim_column_profile"] = ONLY["claims"] + profile("claims", ("CLM_ID",), by_id)
    q["v08_claim_profile_of_differences"] = q["v08_claim_column_profile"]
    text = {a: f"CAST(CAST(round({{s}}.{a} * 100) AS BIGINT) AS VARCHAR)" for a in MEMBER_AMOUNTS}
    q["v09_member_mismatch_cells"] = ONLY["members"] + "\nUNION ALL\n".join(
        f"SELECT s.MEMBER_ID, s.YEAR, '{f}' AS field_name, {text.get(f, f'CAST({{s}}.{f} AS VARCHAR)').format(s='s')} AS src_value, "
        f"{text.get(f, f'CAST({{s}}.{f} AS VARCHAR)').format(s='n')} AS new_value FROM src_members s JOIN new_members n USING (MEMBER_ID, YEAR) "
        f"WHERE s.{f} IS DISTINCT FROM n.{f}" for f in MEMBER_FIELDS)
    changed = ("CLM_FROM_DT", "HCPCS_CD_2", "LINE_PMT_AMT_1", "LINE_IND_CD_3")
    q["v09_claim_mismatch_detail"] = ONLY["claims"] + pair_select(
        "claims", changed, f"s.CLM_ID, {side_by_side(changed, '{f}_{s}')}", "IS DISTINCT FROM", ("CLM_ID",))
    q["v10_amount_differences"] = ONLY["claims"] + pair_select(
        "claims", ("LINE_PMT_AMT_1",),
        "s.CLM_ID, s.LINE_PMT_AMT_1 AS src_amt, n.LINE_PMT_AMT_1 AS new_amt, abs(s.LINE_PMT_AMT_1 - n.LINE_PMT_AMT_1) AS variance",
        "<>", ("CLM_ID",))
    nulled = ", ".join(f"CASE WHEN in_src THEN {f} END AS {f}" for f in flag_names("claims"))
    q["v11_claim_field_flags_source_driven"] = flag_query("claims", f"SELECT {', '.join(CLAIM_KEYS)}, {nulled} FROM claims_flags")

    shared_flags = ", ".join(
        f"CAST(coalesce(src_{f}, {d}) <> coalesce(new_{f}, {d}) AS INTEGER) AS {f}" for f in SHARED_FIELDS for d in ["''" if f in ("FLAG", "STATUS") else "0"])
    with_flags = with_ctes(matched_lines(SHARED_FIELDS)) + "SELECT * FROM (SELECT ORDER_ID, LINE_NUM, " + shared_flags + " FROM matched)"
    q["v05_line_flags_of_shared_keys"] = with_flags
    q["v06_line_defects_of_shared_keys"] = f"{with_flags} WHERE {' + '.join(SHARED_FIELDS)} > 0"
    q["q04_line_quality_of_shared_keys"] = "\nUNION ALL\n".join(
        f"SELECT 'Order lines' AS SOURCE, '{f}' AS column_name, d AS TOTAL_DEFECTS, n AS TOTAL_OPPORTUNITIES, round(d::DOUBLE / n * 1000000, 6) AS DPMO, "
        f"round({sigma('(d::DOUBLE / n)')}, 6) AS SIGMA_LEVEL FROM (SELECT CAST(sum({f}) AS BIGINT) AS d, count(*) AS n FROM ({with_flags}))" for f in SHARED_FIELDS)
    money = ("CENTS", "QUANTITY")
    q["f02_line_deltas_of_shared_keys"] = with_ctes(matched_lines(money)) + "SELECT ORDER_ID, LINE_NUM, " + ", ".join(
        f"src_{a}, new_{a}, new_{a} - src_{a} AS delta_{a}, abs(new_{a} - src_{a}) AS abs_delta_{a}" for a in money) + " FROM matched"
    q["v03_member_symmetric_diff_by_ranges"] = q["v03_member_symmetric_diff"]
    q["v03_claim_symmetric_diff_by_ranges"] = q["v03_claim_symmetric_diff"]
    q["j05_orphan_claims_by_ranges"] = q["j05_orphan_claims"]
    q["j06_missing_claims_by_ranges"] = ONLY["claims"] + anti("claims", "src", "new", ", ".join(f"s.{c}" for c in (*CLAIM_KEYS, *CLAIM_FIELDS)))

    # Amounts
    for table, op in (("members", "f01_member"), ("claims", "f02_claim")):
        rounded = ", ".join(
            [*TABLES[table][0], *[f"round({p}_{a}, 2) AS {p}_{a}" for a in TABLES[table][2] for p in ("src", "new", "delta", "abs_delta")]])
        q[f"{op}_amount_deltas"] = amount_query(table, f"SELECT {rounded} FROM {table}_deltas")
    wide_keys = (*MEMBER_KEYS, "BIRTH_DT", "SEGMENT_CD")
    rounded = ", ".join([*wide_keys, *[f"round({p}_{a}, 2) AS {p}_{a}" for a in MEMBER_AMOUNTS for p in ("src", "new", "delta", "abs_delta")]])
    null_safe = deltas("members", wide_keys).replace("k.SEGMENT_CD = s.SEGMENT_CD", "k.SEGMENT_CD IS NOT DISTINCT FROM s.SEGMENT_CD").replace(
        "k.SEGMENT_CD = n.SEGMENT_CD", "k.SEGMENT_CD IS NOT DISTINCT FROM n.SEGMENT_CD")
    q["f01_member_amount_deltas_by_demographics"] = with_ctes(MEMBERS, null_safe) + f"SELECT {rounded} FROM members_deltas"
    for table, op in (("members", "f03_member"), ("claims", "f04_claim")):
        columns = ", ".join([*TABLES[table][0], *[f"abs_delta_{a}" for a in TABLES[table][2]]])
        q[f"{op}_delta_rollup"] = amount_query(table, f"SELECT {columns} FROM {table}_rollup", rollup)
    for table, op in (("members", "f05_member"), ("claims", "f06_claim")):
        q[f"{op}_field_totals"] = amount_query(table, f"SELECT * FROM {table}_totals", rollup, totals)
    for table, op in (("claims", "f07_claim"), ("members", "f08_member")):
        q[f"{op}_family_impact"] = amount_query(table, f"SELECT * FROM {table}_impact", rollup, totals, impact)
    share = ("SELECT DATA_SET, FIELD_FAMILY, FINANCIAL_VARIANCE, sum(FINANCIAL_VARIANCE) OVER () AS TOTAL_VARIANCE, "
             "round(FINANCIAL_VARIANCE / sum(FINANCIAL_VARIANCE) OVER (), 9) AS SHARE_OF_TOTAL FROM {t}_impact")
    q["f09_claim_impact_shares"] = amount_query("claims", share.format(t="claims"), rollup, totals, impact)
    q["f09_member_impact_shares"] = amount_query("members", share.format(t="members"), rollup, totals, impact)
    net = ", ".join(f"CAST(sum(CAST(delta_{a} AS DECIMAL(38,6))) AS DOUBLE) AS {a}" for a in MEMBER_AMOUNTS)
    q["f10_member_net_totals"] = amount_query(
        "members", f"UNPIVOT (SELECT {net} FROM members_deltas) ON COLUMNS(*) INTO NAME amount VALUE net_delta")

    # Quality
    q["q01_sigma_approx"] = with_ctes(CLAIMS, flags("claims"), column_quality("claims")) + (
        "SELECT column_name, round(1 - TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES, 9) AS process_yield, "
        f"round({sigma('(TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES)')}, 6) AS sigma FROM claims_columns")
    p = "(1 - TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES)"
    q["q02_sigma_exact"] = with_ctes(CLAIMS, flags("claims"), column_quality("claims")) + (
        f"SELECT column_name, round({p}, 9) AS process_yield, round({normal_quantile(p)} + 1.5::DOUBLE, 6) AS sigma FROM claims_columns")
    both_flags = with_ctes(CLAIMS, MEMBERS, flags("claims"), flags("members"))
    q["q03_overall_quality"] = both_flags + QUALITY_BOTH
    q["q03_running_claim_quality"] = flag_query("claims", overall("claims"))
    q["q03_overall_quality_by_fingerprint"] = q["q03_overall_quality"]
    q["q03_claim_quality_fixed_opportunities"] = flag_query("claims", overall("claims", per_row=42))
    for table, op in (("members", "q04_member"), ("claims", "q04_claim")):
        q[f"{op}_column_quality"] = with_ctes(CLAIMS if table == "claims" else MEMBERS, flags(table), column_quality(table)) + (
            "SELECT SOURCE, column_name, TOTAL_DEFECTS, TOTAL_OPPORTUNITIES, round(DPMO, 6) AS DPMO, round(SIGMA_LEVEL, 6) AS SIGMA_LEVEL "
            f"FROM {table}_columns")
    for table, op in (("claims", "q05_claim"), ("members", "q06_member")):
        q[f"{op}_family_quality"] = with_ctes(
            CLAIMS if table == "claims" else MEMBERS, flags(table), column_quality(table), families(table)
        ) + f"SELECT * FROM {table}_families"
    q["q05_running_claim_family_quality"] = q["q05_claim_family_quality"]
    q["q07_exact_quality"] = both_flags + overall("claims", exact=EXACT) + "\nUNION ALL" + overall("members", exact=EXACT)

    # Lines and rules
    q["r05_claim_lines"] = with_ctes(CLAIMS, lines("src")) + "SELECT * FROM src_lines"
    q["r06_valid_lines"] = with_ctes(CLAIMS, lines("new")) + (
        f"SELECT coalesce({LINE_VALID}, false) AS is_valid, count(*) AS n_lines, "
        "CAST(sum(CAST(LINE_ALLOW_AMT AS DECIMAL(38,6))) AS DOUBLE) AS allowed FROM new_lines GROUP BY 1")
    rules = (("CALC_ALLOWED", "LINE_IND_CD = 'A'", "LINE_ALLOW_AMT"), ("CALC_COINS", "true", "LINE_COINS_AMT + LINE_DDCT_AMT"),
             ("CALC_SHARE", "LINE_IND_CD IN ('R', 'N')", "LINE_PMT_AMT - nullif(LINE_PRPAY_AMT, 0) / 2"))
    sums = ", ".join(f"coalesce(CAST(sum(CAST(CASE WHEN {c} THEN {v} ELSE 0 END AS DECIMAL(38,6))) AS DOUBLE), 0) AS {m}" for m, c, v in rules)
    q["r07_annual_measures_from_rules"] = with_ctes(CLAIMS, lines("src")) + (
        f"SELECT MEMBER_ID, YEAR, CALC_ALLOWED, CALC_COINS, CALC_SHARE FROM (SELECT MEMBER_ID, CAST(left(CLM_FROM_DT, 4) AS INTEGER) AS YEAR, {sums} "
        "FROM src_lines GROUP BY 1, 2)")
    fine = """WITH fine AS (
  SELECT l_orderkey AS ORDER_ID, l_linenumber AS LINE_NUM, max(l_extendedprice) * max(l_discount) * max(l_tax) AS charge FROM lineitem GROUP BY 1, 2
), deltas AS (
  SELECT ORDER_ID, LINE_NUM, abs(charge + 0.004::DOUBLE - charge) AS d FROM fine WHERE LINE_NUM % 3 = 0
)
"""
    q["f03_delta_rollup_fine_amounts"] = fine + (
        "SELECT ORDER_ID, LINE_NUM, CAST(CAST(d AS DECIMAL(38,6)) AS DOUBLE) AS abs_delta_CHARGE, 0::DOUBLE AS abs_delta_TAX_PART FROM deltas WHERE CAST(d AS DECIMAL(38,6)) > 0")
    q["f05_field_totals_fine_amounts"] = fine + (
        "SELECT 'abs_delta_CHARGE' AS metric_name, round(CAST(sum(CAST(d AS DECIMAL(38,6))) AS DOUBLE), 2) AS total_abs_delta FROM deltas "
        "UNION ALL SELECT 'abs_delta_TAX_PART', 0 FROM deltas HAVING count(*) > 0")
    q["r07_annual_measures"] = with_ctes(CLAIMS, lines("src"), annual("src")) + "SELECT * FROM src_annual"

    def recomputed(side):
        reported = f"(SELECT coalesce(sum(CAST(REIMB_AMT AS DECIMAL(38,6))), 0) FROM {side}_members WHERE YEAR BETWEEN 1996 AND 1998)"
        calculated = f"(SELECT coalesce(sum(CAST(CALC_REIMB AS DECIMAL(38,6))), 0) FROM {side}_annual)"
        return (f"SELECT '{side}' AS system, CAST({reported} AS DOUBLE) AS reported_total, CAST({calculated} AS DOUBLE) AS recomputed_total, "
                f"round(abs(CAST({reported} AS DOUBLE) - CAST({calculated} AS DOUBLE)), 2) AS difference")

    q["r08_recomputed_vs_reported"] = with_ctes(CLAIMS, MEMBERS, lines("src"), lines("new"), annual("src"), annual("new")) + (
        recomputed("src") + "\nUNION ALL\n" + recomputed("new"))
    q["a08_line_measures"] = with_ctes(CLAIMS, lines("src")) + (
        "SELECT CLM_ID, LINE_NUM, " + ", ".join(
            f"round(CASE WHEN {LINE_VALID} THEN {v} ELSE 0 END, 2) AS {m}" for m, v in MEASURE_SQL.items()) + " FROM src_lines")

    # Scorecard
    q["g01_quality_grades"] = both_flags + (
        f"SELECT SUBJECT, DPMO, YIELD, SIGMA_LEVEL, {GRADE.format(s='SIGMA_LEVEL')} AS status FROM ({QUALITY_BOTH})")
    q["g02_count_grades"] = SCORECARD + (
        "SELECT m.metric, m.n_rows, CAST(t.threshold AS BIGINT) AS threshold, "
        f"CASE WHEN m.n_rows > t.threshold THEN 'Critical' ELSE 'Review' END AS status FROM metrics m JOIN {THRESHOLDS} ON m.metric = t.metric")
    q["g03_top_claim_families"] = with_ctes(CLAIMS, flags("claims"), column_quality("claims"), families("claims")) + (
        "SELECT * FROM claims_families ORDER BY TOTAL_DEFECTS DESC, FIELD_FAMILY LIMIT 5")
    q["g03_top_member_families"] = with_ctes(MEMBERS, flags("members"), column_quality("members"), families("members")) + (
        "SELECT * FROM members_families ORDER BY TOTAL_DEFECTS DESC, FIELD_FAMILY LIMIT 5")
    q["g04_recommendations"] = recommendations()
    verdicts = {
        "World-class": "Nothing to mend.",
        "Excellent": "Look through the few differences and mend those that matter.",
        "Good": "Mend the differences found.",
        "Acceptable": "Mend the weakest columns before the switch.",
        "Needs Attention": "Do not switch systems with this data.",
    }
    verdict = "CASE grade " + " ".join(f"WHEN '{g}' THEN '{v}'" for g, v in verdicts.items()) + " END"
    q["g05_conclusion"] = both_flags + (
        f"SELECT mean_sigma, grade, {verdict} AS verdict FROM (SELECT mean_sigma, {GRADE.format(s='mean_sigma')} AS grade "
        f"FROM (SELECT round(avg({sigma('(TOTAL_DEFECTS::DOUBLE / TOTAL_OPPORTUNITIES)')}), 6) AS mean_sigma FROM ({QUALITY_BOTH})))")
    q["g06_missing_member_sample"] = ONLY["members"] + f"SELECT * FROM ({MISSING}) ORDER BY MEMBER_ID, YEAR LIMIT 5"
    q["g06_orphan_claim_sample"] = ONLY["claims"] + f"SELECT {c_all} FROM ({ORPHAN_CLAIMS}) ORDER BY {', '.join(CLAIM_KEYS)} LIMIT 5"
    return q
