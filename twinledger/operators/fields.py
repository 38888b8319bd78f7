"""Field-by-field comparison of matched and one-sided rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from twinledger.functions.compare import any_of, differs, quoted, ratio, side_differs, with_null_token
from twinledger.functions.families import ONE_SIDED_PREFIX
from twinledger.functions.shape import as_rows
from twinledger.model import TablePair, TableSpec
from twinledger.operators import masks
from twinledger.operators.keys import IN_NEW, IN_SRC, changed_pair, join_sides, key_census

# Fixed value: the label of changed attributes.
ATTRIBUTE_FINDING = "Error: Beneficiary Attributes Changed"

ONE_SIDED_MODES = ("flag", "null_new_only")
STRATEGIES = ("direct", "fingerprint", "auto")


def flag_conditions(pair: TablePair, null_mode: str = "coalesce") -> list[str]:
    """Conditions over the columns of ``join_sides``, in the order of ``flag_names``; none is ever NULL."""
    only_one_side = f"({IN_SRC} IS NULL OR {IN_NEW} IS NULL)"
    key_flags = [f"{only_one_side} AND {differs(quoted(k), 'NULL', pair.type_of(k), null_mode)}" for k in pair.spec.key_flags]
    return key_flags + [side_differs(f, pair.type_of(f), null_mode) for f in pair.spec.fields]


def flag_columns(pair: TablePair, null_mode: str = "coalesce", one_sided: str = "flag") -> list[str]:
    """0/1 flags over the columns of ``join_sides``; key flags first, then one per field."""
    check_one_sided(one_sided)

    def flag(condition: str, name: str) -> str:
        value = f"CASE WHEN {condition} THEN 1 ELSE 0 END"
        if one_sided == "null_new_only":
            value = f"CASE WHEN {IN_SRC} THEN {value} END"
        return f"{value} AS {quoted(name)}"

    return [flag(condition, name) for condition, name in zip(flag_conditions(pair, null_mode), flag_names(pair))]


def check_one_sided(one_sided: str) -> None:
    if one_sided not in ONE_SIDED_MODES:
        raise ValueError(f"one_sided must be one of {ONE_SIDED_MODES}, not {one_sided!r}")


def packed_flags(pair: TablePair, null_mode: str = "coalesce", one_sided: str = "flag") -> DataFrame:
    """``field_flags`` with the flags of 64 columns in one LONG: keys, ``in_src``, ``in_new``, ``flags_0``, ... (see ``masks``).

    Bits are those of ``flag_names``, the first one lowest.
    """
    check_one_sided(one_sided)
    where = IN_SRC if one_sided == "null_new_only" else None
    columns = masks.packed(flag_conditions(pair, null_mode), where=where)
    return join_sides(pair, "full_outer").selectExpr(*map(quoted, pair.spec.keys), IN_SRC, IN_NEW, *columns)


def flag_names(pair: TablePair) -> list[str]:
    return [ONE_SIDED_PREFIX + k for k in pair.spec.key_flags] + list(pair.spec.fields)


def untokenised(pair: TablePair, token: str) -> TablePair:
    """The pair as a load without null cleaning would leave it (see ``with_null_token``)."""
    def restore(df: DataFrame) -> DataFrame:
        restored = [f"{with_null_token(f, pair.type_of(f), token)} AS {quoted(f)}" for f in pair.spec.fields]
        return df.selectExpr(*map(quoted, pair.spec.keys), *restored)

    return TablePair(pair.spec, restore(pair.src), restore(pair.new))


def field_flags(pair: TablePair, null_mode: str = "coalesce", one_sided: str = "flag", null_token: str | None = None,
                only_defects: bool = False) -> DataFrame:
    """The field audit: keys of both sides and a 0/1 flag per field, 1 where the two systems differ.

    A row of one side is compared with NULLs. ``one_sided='null_new_only'`` instead leaves the flags of new-only rows
    NULL. ``null_token`` first turns NULLs back into the token a load without null cleaning would have stored.
    ``only_defects`` keeps the rows with at least one field flag set, found by their packed flags.
    """
    if null_token is not None:
        pair = untokenised(pair, null_token)
    if only_defects:
        return defects_of(packed_flags(pair, null_mode, one_sided), pair)
    joined = join_sides(pair, "full_outer")
    return joined.selectExpr(*map(quoted, pair.spec.keys), *flag_columns(pair, null_mode, one_sided))


def defects_of(flags: DataFrame, pair: TablePair) -> DataFrame:
    """Rows of ``packed_flags`` with at least one field flag set, as 0/1 columns."""
    names = flag_names(pair)
    return masks.unpacked(flags.where(masks.any_set(names, pair.spec.fields)), names, pair.spec.keys)


def changed_flags(pair: TablePair, null_mode: str = "coalesce", census: DataFrame | None = None) -> DataFrame:
    """``field_flags`` of the keys that the narrow census reports as changed. All other keys have flags of 0 only."""
    census = key_census(pair, null_mode) if census is None else census
    return field_flags(changed_pair(pair, census), null_mode)


def defect_rows(flags: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of a stored audit with at least one of the flags set. Straight from a pair, use ``only_defects``."""
    return flags.where(any_of([f"{quoted(f)} = 1" for f in fields]))


def attribute_mismatches(pair: TablePair, fields: Sequence[str], finding: str = ATTRIBUTE_FINDING) -> DataFrame:
    """Matched rows of which one of ``fields`` differs, NULL being a value; both sides next to each other."""
    joined = join_sides(pair, "inner", fields)
    changed = any_of([side_differs(f, pair.type_of(f), "distinct") for f in fields])
    shown = [f"{s}_{f}" for f in fields for s in ("src", "new")]
    return joined.where(changed).select(*pair.spec.keys, *shown, F.lit(finding).alias("FINDING"))


def value_differences(pair: TablePair, labels: Mapping[str, str], keys: Sequence[str] | None = None) -> DataFrame:
    """Matched rows of which one of the fields differs, rows with a NULL dropping out; ``labels``: field -> suffix."""
    joined = join_sides(pair, "inner", {label: f for f, label in labels.items()})
    changed = any_of([side_differs(label, pair.type_of(f), "plain") for f, label in labels.items()])
    shown = [f"{s}_{label}" for label in labels.values() for s in ("src", "new")]
    return joined.where(changed).select(*(pair.spec.keys if keys is None else keys), *shown)


def amount_differences(pair: TablePair, amount: str) -> DataFrame:
    """Matched rows with another amount and the size of the difference."""
    found = value_differences(pair, {amount: "amt"})
    return found.withColumn("variance", F.abs(F.col("src_amt") - F.col("new_amt")))


def compared_flags(pair: TablePair, null_mode: str = "coalesce") -> DataFrame:
    """``packed_flags`` and, for matched rows, ``diff_0``, ...: a bit a field that differs with NULL being a value.

    One comparison that counts, audits, profiles and the status of rows are worked out from; few columns, whatever the width.
    """
    differing = masks.packed([side_differs(f, pair.type_of(f), "distinct") for f in pair.spec.fields], "diff", where=f"{IN_SRC} AND {IN_NEW}")
    return join_sides(pair, "full_outer").selectExpr(*map(quoted, pair.spec.keys), IN_SRC, IN_NEW, *masks.packed(flag_conditions(pair, null_mode)), *differing)


@dataclass(frozen=True)
class Differences:
    """Matched rows that differ, stored once: keys, ``<field>_src`` and ``<field>_new``, a bit a field in ``diff_0``, ...

    ``fields``: those that differ in any row; ``src_rows``: all source rows, matched or not.
    """

    spec: TableSpec
    rows: DataFrame
    fields: tuple[str, ...]
    src_rows: int

    def profile(self) -> DataFrame:
        """What ``column_profile`` gives, from the bits alone."""
        names = self.spec.fields
        counts = self.rows.agg(*masks.sums(names, prefix="diff"))
        stacked = as_rows(counts, "field_name", {"error_count": {f: f for f in names}})
        pct = F.round(ratio(F.col("error_count") * 100, F.lit(self.src_rows)), 2)
        return stacked.where("error_count > 0").withColumn("error_pct", pct).orderBy(F.desc("error_count"), "field_name")

    def detail(self) -> DataFrame:
        """Keys and both values of the fields that differ anywhere."""
        return self.rows.select(*self.spec.keys, *[f"{f}_{s}" for f in self.fields for s in ("src", "new")])

    def cells(self) -> DataFrame:
        """One row a differing value: keys, ``field_name``, ``src_value`` and ``new_value`` as text."""
        cells = [f"named_struct('field_name', '{f}', 'src_value', CAST({quoted(f + '_src')} AS STRING), 'new_value', CAST({quoted(f + '_new')} AS STRING), "
                 f"'differs', {masks.is_set(self.spec.fields, f, 'diff')})" for f in self.fields]
        if not cells:
            return self.rows.selectExpr(*map(quoted, self.spec.keys), "'' AS field_name", "'' AS src_value", "'' AS new_value").where("false")
        return self.rows.selectExpr(*map(quoted, self.spec.keys), f"inline(filter(array({', '.join(cells)}), c -> c.differs))").drop("differs")

    def amounts(self, amount: str) -> DataFrame:
        """What ``amount_differences`` gives."""
        src, new = f"{amount}_src", f"{amount}_new"
        found = self.rows.where(F.col(src) != F.col(new))
        return found.select(*self.spec.keys, F.col(src).alias("src_amt"), F.col(new).alias("new_amt"), F.abs(F.col(src) - F.col(new)).alias("variance"))


def differences(pair: TablePair, path: str, src_rows: int | None = None) -> Differences:
    """Compares matched rows once and writes those that differ, NULL being a value, as parquet to ``path`` in shared storage.

    Which fields differ and how many source rows there are is observed while the rows are written, so that the profile, the detail
    and its columns need no second join. ``src_rows``: the source rows of the whole table, where the pair holds changed rows only.
    """
    fields = pair.spec.fields
    joined = join_sides(pair, "left_outer", naming="{name}_{side}")
    bits = masks.packed([differs(quoted(f"{f}_src"), quoted(f"{f}_new"), pair.type_of(f), "distinct") for f in fields], "diff", where=IN_NEW)
    values = [quoted(f"{f}_{s}") for f in fields for s in ("src", "new")]
    seen = Observation()
    observed = joined.selectExpr(*map(quoted, pair.spec.keys), *values, *bits).observe(seen, F.count("*").alias("src_rows"), *masks.combined(fields, "diff"))
    rows = observed.where(masks.any_set(fields, fields, "diff"))
    rows.write.mode("overwrite").parquet(path)
    found = seen.get
    return Differences(pair.spec, rows.sparkSession.read.schema(rows.schema).parquet(path), tuple(masks.names_set(fields, found, "diff")),
                       found["src_rows"] if src_rows is None else src_rows)


def column_profile(pair: TablePair) -> DataFrame:
    """Per field: matched rows that differ, in numbers and in percent of all source rows; fields with none left out.

    Fields are counted side by side in one aggregate and turned into rows afterwards; the same join counts the source rows.
    """
    fields = pair.spec.fields
    joined = join_sides(pair, "left_outer")
    differing = [F.expr(f"count_if({IN_NEW} AND {side_differs(f, pair.type_of(f), 'distinct')}) AS {quoted(f)}") for f in fields]
    return _profile(joined.agg(F.count("*").alias("__src_rows"), *differing), fields)


def _profile(counts: DataFrame, fields: Sequence[str]) -> DataFrame:
    stacked = as_rows(counts, "field_name", {"error_count": {f: f for f in fields}, "__src_rows": {f: "__src_rows" for f in fields}})
    return (
        stacked.where("error_count > 0")
        .withColumn("error_pct", F.round(ratio(F.col("error_count") * 100, F.col("__src_rows")), 2)).drop("__src_rows")
        .orderBy(F.desc("error_count"), "field_name")
    )


def error_fields(profile: DataFrame) -> list[str]:
    """The field names of a column profile, most errors first. Runs a job; the result is at most one name per field."""
    return [row["field_name"] for row in profile.select("field_name").collect()]


def mismatch_detail(pair: TablePair, fields: Sequence[str]) -> DataFrame:
    """Keys and both values of ``fields`` for matched rows where any of them differs, NULL being a value."""
    joined = join_sides(pair, "inner", fields, naming="{name}_{side}")
    changed = any_of([differs(quoted(f"{f}_src"), quoted(f"{f}_new"), pair.type_of(f), "distinct") for f in fields])
    shown = [f"{f}_{s}" for f in fields for s in ("src", "new")]
    return joined.where(changed).select(*pair.spec.keys, *shown)
