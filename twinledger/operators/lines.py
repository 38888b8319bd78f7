"""Repeating line columns as rows, line rules, and annual measures recomputed from lines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.compare import money_sum, quoted
from twinledger.functions.families import slots
from twinledger.model import TablePair
from twinledger.operators.keys import IN_NEW, IN_SRC, join_sides

# Processing indicators that are valid outright, and those valid with an allowed amount.
ALWAYS_VALID = "A"
VALID_IF_ALLOWED = ("R", "S")


@dataclass(frozen=True)
class LineLayout:
    """Columns ``<family>_1 .. <family>_<n_slots>`` hold one claim line per slot."""

    families: tuple[str, ...]
    n_slots: int

    def columns(self) -> list[str]:
        return [c for family in self.families for c in slots(family, self.n_slots)]


@dataclass(frozen=True)
class Measure:
    """A rule: ``value`` counts on lines that meet ``condition``, both being SQL expressions over line families."""

    name: str
    value: str
    condition: str = "true"

    def sql(self, layout: LineLayout | None = None, slot: int | None = None) -> str:
        """The rule over long lines, or over one slot of the wide layout."""
        value, condition = (_in_slot(e, layout, slot) for e in (self.value, self.condition))
        return f"CASE WHEN {condition} THEN {value} ELSE 0 END"


def measures_from(rules: DataFrame) -> tuple[Measure, ...]:
    """Measures out of a rule table ``name, value_expr, cond_expr``. Runs a job; there is one row per rule."""
    return tuple(Measure(r["name"], r["value_expr"], r["cond_expr"] or "true") for r in rules.orderBy("name").collect())


def _in_slot(expression: str, layout: LineLayout | None, slot: int | None) -> str:
    if layout is None or slot is None:
        return expression
    names = "|".join(sorted(map(re.escape, layout.families), key=len, reverse=True))
    return re.sub(rf"\b({names})\b", rf"\1_{slot}", expression)


def valid_line_rule(indicator: str, allowed: str) -> str:
    """The validity rule of a line as a SQL condition."""
    allowed_only = ", ".join(f"'{code}'" for code in VALID_IF_ALLOWED)
    return f"{indicator} = '{ALWAYS_VALID}' OR ({indicator} IN ({allowed_only}) AND {allowed} > 0)"


def valid_line(indicator: Column, allowed: Column) -> Column:
    """True for a valid line, False otherwise; never NULL."""
    return F.coalesce((indicator == ALWAYS_VALID) | (indicator.isin(*VALID_IF_ALLOWED) & (allowed > 0)), F.lit(False))


def explode_lines(claims: DataFrame, layout: LineLayout, carry: Sequence[str], line: str = "LINE_NUM") -> DataFrame:
    """One row per claim and slot with the slot's columns side by side, from a single scan. Empty slots are kept."""
    entries = [
        f"named_struct('{line}', {i}, " + ", ".join(f"'{family}', `{family}_{i}`" for family in layout.families) + ")"
        for i in range(1, layout.n_slots + 1)
    ]
    return claims.selectExpr(*map(quoted, carry), f"inline(array({', '.join(entries)}))")


def apply_measures(lines: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Adds one calculated column per rule to long lines; 0 where a line does not qualify."""
    return lines.withColumns({m.name: F.expr(m.sql()) for m in measures})


def annual_measures(claims: DataFrame, layout: LineLayout, measures: Sequence[Measure], member: str, from_date: str,
                    year: str = "YEAR") -> DataFrame:
    """Measures summed per member and year of the from-date (text ``YYYYMMDD``).

    The slots of a claim are added up inside its row, so no row per line is made, and claims are summed before the
    shuffle on member and year.
    """
    per_claim = claims.select(
        F.col(member),
        F.left(F.col(from_date), F.lit(4)).try_cast("int").alias(year),
        # A slot without a number adds nothing; it must not take the others of its claim with it.
        *[F.expr(" + ".join(f"coalesce(nanvl(CAST({m.sql(layout, i)} AS DOUBLE), 0D), 0D)" for i in range(1, layout.n_slots + 1))).alias(m.name) for m in measures],
    )
    return per_claim.groupBy(member, year).agg(*[money_sum(F.col(m.name)).alias(m.name) for m in measures])


def recomputed_vs_reported(systems: Mapping[str, tuple[DataFrame, DataFrame]], reported: str, recomputed: str,
                           first_year: int, last_year: int, year: str = "YEAR") -> DataFrame:
    """Per system the reported amount over a range of years, the recomputed amount over all of its years, and how far
    they are apart. ``systems``: name -> (members, annual measures)."""
    parts = []
    for name, (members, measures) in systems.items():
        actual = members.where(F.col(year).between(first_year, last_year)).agg(money_sum(F.col(reported)).alias("reported_total"))
        calculated = measures.agg(money_sum(F.col(recomputed)).alias("recomputed_total"))
        both = actual.unionByName(calculated, allowMissingColumns=True)
        parts.append(both.select(F.lit(name).alias("system"), "reported_total", "recomputed_total"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    totals = stacked.groupBy("system").agg(*[
        F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("reported_total", "recomputed_total")
    ])
    return totals.withColumn("difference", F.abs(F.col("reported_total") - F.col("recomputed_total")))


def line_payment_differences(claims: TablePair, members: TablePair, states: DataFrame, *, claim: str, member: str,
                             from_date: str, year: str, state_code: str, payment: str, indicator: str, allowed: str,
                             fanout: bool = False) -> DataFrame:
    """Valid claims whose payment on one line differs, with the member's state.

    Claims are matched by id. The new system's indicator and allowed amount decide validity, so that claims of the
    source system alone never qualify. The state comes from the source member, else the new member, else
    'Unknown/Orphan', of the claim's year; ``fanout=True`` instead joins every year of the member and repeats the claim.
    Differing claims are filtered out before any member is looked up.

    Members are reduced to how often they have each state before they meet the claims, so that a claim finds one row a member (and year):
    a member of many years and many claims does not multiply them in one task. Copies are made of the finished rows at the end.
    """
    joined = join_sides(claims.keyed_by(claim), "full_outer", (member, from_date, payment, indicator, allowed))
    src_paid, new_paid = (F.coalesce(F.col(f"{s}_{payment}"), F.lit(0.0)) for s in ("src", "new"))
    status = F.when(F.col(IN_SRC) & F.col(IN_NEW), "Matched").when(F.col(IN_SRC), "Src Only").otherwise("New Only")
    found = joined.where(valid_line(F.col(f"new_{indicator}"), F.col(f"new_{allowed}")) & (src_paid != new_paid)).select(
        claim,
        F.coalesce(f"src_{member}", f"new_{member}").alias("member"),
        status.alias("record_status"),
        F.coalesce(f"src_{from_date}", f"new_{from_date}").alias("CLM_FROM_DT"),
        src_paid.alias("src_pmt"),
        new_paid.alias("new_pmt"),
        F.col(f"new_{indicator}").alias("processing_ind"),
        F.col(f"new_{allowed}").alias("allowed_amt"),
        F.lit("Valid").alias("business_rule_status"),
        (src_paid - new_paid).alias("variance"),
    )
    found = found.withColumn("claim_year", F.left("CLM_FROM_DT", F.lit(4)).try_cast("int"))
    for name, df in (("src", members.src), ("new", members.new)):
        by = [F.col(member).alias("m")] if fanout else [F.col(member).alias("m"), F.col(year).alias("y")]
        held = df.groupBy(*by, F.col(state_code).alias("code")).agg(F.count("*").alias("times"))
        # At most as many entries as there are states.
        listed = held.groupBy(*(["m"] if fanout else ["m", "y"])).agg(F.collect_list(F.struct("code", "times")).alias(f"{name}_states"))
        condition = [F.col("member") == F.col("m")] + ([] if fanout else [F.col("claim_year") == F.col("y")])
        found = found.join(listed, condition, "left_outer").drop("m", "y")
    # Names are looked up last, for the claims found only.
    for name in ("src", "new"):
        found = found.select("*", F.explode_outer(f"{name}_states").alias("s")).select("*", F.col("s.code").alias(f"{name}_code"), F.coalesce("s.times", F.lit(1)).alias(f"{name}_times")).drop("s")
        found = found.join(states.select(F.col("code").alias(f"{name}_code"), F.col("name").alias(f"{name}_state")), f"{name}_code", "left_outer")
    repeated = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("src_times") * F.col("new_times"))))
    return repeated.select(
        claim, "record_status", F.coalesce("src_state", "new_state", F.lit("Unknown/Orphan")).alias("STATE_NAME"),
        "CLM_FROM_DT", "src_pmt", "new_pmt", "processing_ind", "allowed_amt", "business_rule_status", "variance",
    )
