"""Tables compared range by range, so that what is equal on both sides never leaves the tasks that read it.

Keys are spread over ranges of their hash. Each side's rows of a range are added up to a fingerprint, which depends neither on their
order nor on how they are partitioned; fingerprints of the two sides cancel out where their rows are equal. Since they are
sums, those of neighbouring ranges add up to that of the range they make up, which gives a tree of ranges (``levels``).
Only rows of ranges that differ are shuffled, first as keys and hashes, then, for keys that differ, at full width.

That pays where few rows differ. Ranges are sized by the measured number of rows, and where most ranges differ the plain way is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.compare import quoted
from twinledger.model import TablePair, TableSpec
from twinledger.operators import rows
from twinledger.operators.keys import changed_pair, key_census
from twinledger.sources.tables import write_table

# Rows a range is meant to hold, and the most bits of a range number: 2^20 numbers are what is broadcast at most, 8 MB.
ROWS_PER_RANGE = 8
MAX_BITS = 20
# Share of ranges that differ above which nothing is gained.
WORTHWHILE = 0.5

PRINTS = ("p0", "p1", "p2", "p3")


def bits_for(n_rows: int) -> int:
    """Bits of a range number for a table of so many rows."""
    return min(MAX_BITS, max(1, (n_rows // ROWS_PER_RANGE).bit_length()))


def range_of(keys: Sequence[str], bits: int) -> Column:
    return F.expr(f"shiftrightunsigned(xxhash64({', '.join(map(quoted, keys))}), {64 - bits})").alias("range")


def range_sums(src: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int) -> DataFrame:
    """Per range: source rows less new rows (``n``) and what is left of the fingerprints (all 0 where the rows are equal).

    A row's two 64-bit hashes are added up in halves: a sum then holds 2^31 rows of a range and fails beyond. A range takes one narrow
    row a task through the shuffle.
    """
    values = ", ".join([*map(quoted, columns), *[f"{quoted(c)} IS NULL" for c in columns]])

    def signed(df: DataFrame, sign: int) -> DataFrame:
        hashed = df.select(range_of(keys, bits), *[F.expr(f"xxhash64({seed}, {values})").alias(f"h{seed}") for seed in (1, 2)])
        halves = [half for seed in (1, 2) for half in (F.expr(f"h{seed} & 4294967295L"), F.expr(f"shiftrightunsigned(h{seed}, 32)"))]
        return hashed.select("range", F.lit(sign).cast("long").alias("n"), *[(half * sign).alias(name) for name, half in zip(PRINTS, halves)])

    return signed(src, 1).unionByName(signed(new, -1)).groupBy("range").agg(*[F.sum(c).alias(c) for c in ("n", *PRINTS)])


def differs() -> str:
    return " OR ".join(f"{c} <> 0" for c in ("n", *PRINTS))


def levels(sums: DataFrame, bits: int, step: int = 4) -> DataFrame:
    """The tree above the ranges, by level (0 is the whole table): ``n_ranges`` that hold rows and ``n_differing`` of them."""
    found = None
    for level in sorted({*range(0, bits, step), bits}):
        above = sums.groupBy(F.shiftright("range", bits - level).alias("range")).agg(*[F.sum(c).alias(c) for c in ("n", *PRINTS)])
        counted = above.agg(F.count("*").alias("n_ranges"), F.count_if(F.expr(differs())).alias("n_differing")).select(F.lit(level).alias("level"), "*")
        found = counted if found is None else found.unionByName(counted)
    return found


def narrowed(pair: TablePair, columns: Sequence[str], workdir: str, bits: int | None = None) -> TablePair:
    """The pair cut down to ranges of keys in which the sides differ in ``columns``, which may be the keys alone.

    Counts both tables, adds up the ranges and writes those that differ below ``workdir`` in shared storage.
    """
    keys = pair.spec.keys
    bits = bits_for(max(pair.src.count(), pair.new.count())) if bits is None else bits
    if not 1 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be between 1 and {MAX_BITS}, not {bits}")
    differing = write_table(range_sums(pair.src, pair.new, keys, columns, bits).where(differs()).select("range"), f"{workdir}/ranges")
    if differing.count() > WORTHWHILE * 2**bits:
        return pair
    # At most 2^MAX_BITS numbers.
    cut = [df.withColumn("__range", range_of(keys, bits)).join(F.broadcast(differing.withColumnRenamed("range", "__range")), "__range", "left_semi").select(*df.columns)
           for df in (pair.src, pair.new)]
    return TablePair(pair.spec, *cut)


def symmetric_difference(src: DataFrame, new: DataFrame, keys: Sequence[str], workdir: str, columns: Sequence[str] | None = None,
                         with_side: bool = False, bits: int | None = None) -> DataFrame:
    """``rows.symmetric_difference`` by ranges, then keys, then whole rows.

    Keys need not be unique: a key stays as long as any two of its rows differ. Two different ranges or rows would have to agree in
    128 bits to be missed.
    """
    columns = list(columns or src.columns)
    others = [c for c in columns if c not in keys]
    pair = TablePair(TableSpec("", tuple(keys), tuple(others)), src.select(*dict.fromkeys([*keys, *columns])), new.select(*dict.fromkeys([*keys, *columns])))
    near = narrowed(pair, columns, workdir, bits)
    census = write_table(key_census(near, "distinct", others or list(keys)).where("is_changed"), f"{workdir}/keys")
    changed = changed_pair(near, census)
    return rows.symmetric_difference(changed.src, changed.new, columns, with_side)


def one_sided_rows(pair: TablePair, workdir: str, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(missing, extra) rows as ``rows.missing_rows`` and ``rows.extra_rows`` give them; rows are dropped before the exchange where a
    range holds the same keys as often on both sides, and matched exactly in the others."""
    near = narrowed(pair, pair.spec.keys, workdir, bits)
    return rows.missing_rows(near), rows.extra_rows(near)
