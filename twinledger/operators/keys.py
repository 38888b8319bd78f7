"""Key checks, the two-sided join, and the narrow search for keys that changed.

Every wide operator joins on keys that are unique per side. With that promise kept, no join group can hold more than
one row a side, so a skewed member, day or source never becomes a skewed join partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.functions.compare import normalised, quoted
from twinledger.model import TablePair, TableSpec

IN_SRC = "in_src"
IN_NEW = "in_new"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the row count. Copies are counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(" OR ".join(f"`{k}` IS NULL" for k in keys))


def require_unique_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Raises when a table has duplicate keys or NULLs in its keys. Runs one job; there are two counts per table."""
    parts = []
    for name, (df, keys) in tables.items():
        found = {"rows with a shared key": duplicate_keys(df, keys).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")),
                 "rows with a NULL key": null_key_rows(df, keys).agg(F.count("*").alias("n"))}
        parts += [counted.select(F.lit(f"{name}: {what}").alias("problem"), "n") for what, counted in found.items()]
    problems = parts[0]
    for part in parts[1:]:
        problems = problems.unionByName(part)
    broken = [f"{row['problem']}: {row['n']}" for row in problems.where("n > 0").collect()]
    if broken:
        raise ValueError("; ".join(broken))


def split_by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a key of their own, rows that share a key); together they are all of ``df``."""
    shared = duplicate_keys(df, keys).drop("n_rows")
    return null_safe_join(df, shared, keys, "left_anti"), null_safe_join(df, shared, keys, "left_semi")


def set_apart_shared_keys(pair: TablePair, keys: Sequence[str]) -> tuple[TablePair, DataFrame]:
    """(the pair without keys that any side holds more than once, the rows set apart with their side).

    Pairing such rows would multiply them, and a key with a third of all rows would do so in one task. They are reported
    whole instead: no row is lost. The shared keys are few or, at worst, a few hot ones, so that the joins against them
    spread the rows of a hot key wherever they are.
    """
    shared = duplicate_keys(pair.src, keys).drop("n_rows").unionByName(duplicate_keys(pair.new, keys).drop("n_rows")).distinct()
    src, new = (null_safe_join(df, shared, keys, "left_anti") for df in (pair.src, pair.new))
    apart = [null_safe_join(df, shared, keys, "left_semi").select(F.lit(side).alias("side"), "*")
             for side, df in (("src", pair.src), ("new", pair.new))]
    return TablePair(pair.spec, src, new), apart[0].unionByName(apart[1])


def guarded(pair: TablePair) -> TablePair:
    """The pair as its ``on_shared_keys`` asks for; ``fail`` runs a job."""
    keys = pair.spec.keys
    if pair.spec.on_shared_keys == "fail":
        shared = [f"{side}: {key}" for side, df in (("source", pair.src), ("new", pair.new)) for key in duplicate_keys(df, keys).limit(1).collect()]
        if shared:
            raise ValueError(f"{pair.spec.subject}: keys held by more than one row, such as {'; '.join(shared)}")
    if pair.spec.on_shared_keys == "set_apart":
        return set_apart_shared_keys(pair, keys)[0]
    return pair


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which NULL keys match each other."""
    renamed = right.select([F.col(k).alias(f"__{k}") for k in keys])
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how)


def join_sides(pair: TablePair, how: str, columns: Sequence[str] | Mapping[str, str] | None = None,
               naming: str = "{side}_{name}") -> DataFrame:
    """keys, both sides' ``columns`` and the presence marks ``in_src``, ``in_new`` (TRUE or NULL).

    A mapping gives columns other names. Names are given below the join: a filter on joined values must not meet a later
    projection that renames them, because the optimizer would derive the filter anew for every combination of renames.
    """
    pair = guarded(pair)
    keys = pair.spec.keys
    columns = pair.spec.fields if columns is None else columns
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    if pair.spec.on_shared_keys == "match":
        return matched_sides(pair, how, names, naming)

    def one_side(df: DataFrame, side: str, marker: str) -> DataFrame:
        values = [f"{quoted(column)} AS {quoted(naming.format(side=side, name=name))}" for name, column in names.items()]
        return df.selectExpr(*map(quoted, keys), *values, f"true AS {marker}")

    src, new = one_side(pair.src, "src", IN_SRC), one_side(pair.new, "new", IN_NEW)
    if not pair.spec.nullable_keys:
        return src.join(new, list(keys), how)
    new = new.withColumnsRenamed({k: f"__{k}" for k in keys})
    joined = src.join(new, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how)
    values = [naming.format(side=side, name=name) for side in ("src", "new") for name in names]
    return joined.selectExpr(*[f"coalesce(`{k}`, `__{k}`) AS `{k}`" for k in keys], *map(quoted, values), IN_SRC, IN_NEW)


# Digits of a row's digest that deal the rows of a key over tasks: 256 parts a key and side.
DEALT_DIGITS = 2


def row_digest(columns: Sequence[str]) -> str:
    """The order in which rows of one key are paired: MD5 of their values as text, NULL as an empty one, joined by bars."""
    values = [f"coalesce(CAST({quoted(c)} AS STRING), '')" for c in columns]
    return f"md5(concat_ws('|', {', '.join(values)}))"


def matched_sides(pair: TablePair, how: str, names: Mapping[str, str], naming: str) -> DataFrame:
    """``join_sides`` for keys that a side may hold more than once: n and m rows of a key make max(n, m) rows, not n * m.

    Rows that are equal in all of the columns are paired as often as both sides hold them. What is left of a key is put in the
    order of ``row_digest`` (ties by the columns) on each side, and the k-th row of one side goes with the k-th of the other; rows
    beyond stay alone. Copies are combined before the shuffle, the ranks of a key are counted in parts by their digest, and rows
    meet by key and rank, so that a key with a large part of all rows is spread over many tasks.
    """
    if how not in ("full_outer", "inner", "left_outer"):
        raise ValueError(f"rows of shared keys can be matched for full_outer, inner or left_outer, not {how!r}")
    keys, columns = list(pair.spec.keys), list(names)
    sides = pair.src.select(*keys, *columns, F.lit(1).alias("__s")).unionByName(pair.new.select(*keys, *columns, F.lit(-1).alias("__s")))
    counted = sides.groupBy(*keys, *columns).agg(F.count_if(F.col("__s") > 0).alias("__n_src"), F.count_if(F.col("__s") < 0).alias("__n_new"))

    def shown(side: str) -> list[str]:
        return [f"{quoted(column)} AS {quoted(naming.format(side=side, name=name))}" for column, name in names.items()]

    in_both = counted.where("__n_src > 0 AND __n_new > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("__n_src", "__n_new"))))
    equal = in_both.selectExpr(*map(quoted, keys), *shown("src"), *shown("new"), f"true AS {IN_SRC}", f"true AS {IN_NEW}")

    left = counted.where("__n_src <> __n_new").withColumns({
        "__is_src": F.col("__n_src") > F.col("__n_new"), "__digest": F.expr(row_digest(columns)),
        "__copy": F.explode(F.sequence(F.lit(1).cast("long"), F.abs(F.col("__n_src") - F.col("__n_new")))),
    }).withColumn("__part", F.left("__digest", F.lit(DEALT_DIGITS)))
    within = Window.partitionBy(*keys, "__is_src", "__part").orderBy("__digest", *columns, "__copy")
    earlier = Window.partitionBy(*keys, "__is_src").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = left.groupBy(*keys, "__is_src", "__part").agg(F.count("*").alias("__size")).withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    placed = left.withColumn("__place", F.row_number().over(within))
    renamed = parts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__is_src").alias("__of_src"), F.col("__part").alias("__of_part"), "__before")
    same_part = [*[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("__is_src") == F.col("__of_src"), F.col("__part") == F.col("__of_part")]
    ranked = placed.join(renamed, same_part).select(*keys, *columns, "__is_src", (F.col("__before") + F.col("__place")).alias("__rank"))
    src = ranked.where("__is_src").selectExpr(*map(quoted, keys), "__rank", *shown("src"), f"true AS {IN_SRC}")
    new = ranked.where("NOT __is_src").selectExpr(*[f"{quoted(k)} AS `__{k}`" for k in keys], "__rank AS __new_rank", *shown("new"), f"true AS {IN_NEW}")
    joined = src.join(new, [*[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("__rank") == F.col("__new_rank")], how)
    its_keys = [f"CASE WHEN {IN_SRC} THEN {quoted(k)} ELSE `__{k}` END AS {quoted(k)}" for k in keys]
    values = [quoted(naming.format(side=side, name=name)) for side in ("src", "new") for name in names.values()]
    return equal.unionByName(joined.selectExpr(*its_keys, *values, IN_SRC, IN_NEW))


def fingerprint(pair: TablePair, null_mode: str, columns: Sequence[str] | None = None) -> list[Column]:
    """Two independent 64-bit hashes of the compared values of a row: of ``columns``, by default fields and amounts.

    NULLs are hashed as what they count as. Hashes skip a NULL that counts as itself, so its place is hashed too.
    """
    columns = list(dict.fromkeys((*pair.spec.fields, *pair.spec.amounts))) if columns is None else columns
    values = [normalised(quoted(f), pair.type_of(f), null_mode) for f in columns]
    values += [f"{quoted(f)} IS NULL" for f, value in zip(columns, list(values)) if value == quoted(f)]
    return [F.expr(f"xxhash64({seed}, {', '.join(values)})") for seed in (1, 2)]


def other_columns(pair: TablePair) -> list[str]:
    """Columns of both sides that are no keys."""
    return [c for c in pair.src.columns if c in pair.new.columns and c not in pair.spec.keys]


def key_census(pair: TablePair, null_mode: str = "coalesce", columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key of either side with ``n_src``, ``n_new`` and ``is_changed``, which is about ``columns``, by default
    fields and amounts. Where rows of shared keys are matched, a key changed as well if the sides hold it unequally often.

    Only the keys and two hashes are shuffled, whatever the width of the table, and copies of a row are combined before
    the shuffle. ``is_changed`` is FALSE only where both sides have the key and all hashes agree.
    """
    keys = pair.spec.keys
    prints = fingerprint(pair, null_mode, columns)

    def narrow(df: DataFrame, is_src: int) -> DataFrame:
        return df.select(*keys, *[p.alias(f"h{i}") for i, p in enumerate(prints)], F.lit(is_src).alias("is_src"))

    both = narrow(pair.src, 1).unionByName(narrow(pair.new, 0))
    hashes = [f"h{i}" for i in range(len(prints))]
    counted = both.groupBy(*keys).agg(
        F.sum("is_src").alias("n_src"),
        F.sum(F.lit(1) - F.col("is_src")).alias("n_new"),
        *[F.min(h).alias(f"min_{h}") for h in hashes],
        *[F.max(h).alias(f"max_{h}") for h in hashes],
    )
    often = ["n_src = n_new"] if pair.spec.on_shared_keys == "match" else []
    same = " AND ".join(["n_src > 0", "n_new > 0", *often, *[f"min_{h} = max_{h}" for h in hashes]])
    return counted.select(*keys, "n_src", "n_new", (~F.expr(same)).alias("is_changed"))


def audited_rows(census: DataFrame, matched: bool = False) -> DataFrame:
    """One row, ``units``: the rows a full outer join on the keys has. A key held n times by one side and m times by the
    other stands for n * m of them, or for the larger of both if rows are ``matched``."""
    rows = F.greatest("n_src", "n_new") if matched else F.greatest("n_src", F.lit(1)) * F.greatest("n_new", F.lit(1))
    return census.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("units"))


def changed_pair(pair: TablePair, census: DataFrame) -> TablePair:
    """The pair cut down to rows whose key changed. The few changed keys filter both wide scans; where they are small
    AQE broadcasts them, and then no wide row is shuffled before it is known to matter."""
    changed = census.where("is_changed").select(*pair.spec.keys)
    return TablePair(pair.spec, *(rows_of_keys(df, changed, pair.spec) for df in (pair.src, pair.new)))


def rows_of_keys(df: DataFrame, wanted: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows whose key is among ``wanted``, joined as ``join_sides`` joins, which then finds them where they are."""
    return null_safe_join(df, wanted, spec.keys, "left_semi") if spec.nullable_keys else df.join(wanted, list(spec.keys), "left_semi")
