"""Field comparisons packed into bits: one LONG holds the flags of 64 fields.

A compared row is then its key and a few numbers, however wide the table. Rows with a defect are those with a number other than 0,
defects of a row are its set bits, and the columns that differ anywhere are the numbers combined by OR.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.functions.compare import quoted

# Flags of a LONG.
BITS = 64


def mask_names(n_flags: int, prefix: str = "flags") -> list[str]:
    return [f"{prefix}_{k}" for k in range(-(-n_flags // BITS))]


def _literal(bits: int) -> str:
    """64 bits as a BIGINT of SQL."""
    return f"CAST({bits - (1 << 64) if bits >> 63 else bits} AS BIGINT)"


def packed(conditions: Sequence[str], prefix: str = "flags", where: str | None = None) -> list[str]:
    """The conditions, none of which may be NULL, as SQL for ``mask_names``; NULL where ``where`` does not hold."""
    columns = []
    for k, name in enumerate(mask_names(len(conditions), prefix)):
        bits = [f"CASE WHEN {c} THEN {_literal(1 << i)} ELSE 0L END" for i, c in enumerate(conditions[k * BITS: (k + 1) * BITS])]
        value = " | ".join(bits)
        columns.append(f"{f'CASE WHEN {where} THEN {value} END' if where else value} AS {quoted(name)}")
    return columns


def selected(names: Sequence[str], wanted: Sequence[str]) -> list[int]:
    """The bits of some flags, per LONG."""
    chosen = set(wanted)
    return [sum(1 << i for i, name in enumerate(names[k * BITS: (k + 1) * BITS]) if name in chosen) for k in range(-(-len(names) // BITS))]


def _parts(names: Sequence[str], wanted: Sequence[str], prefix: str) -> list[str]:
    return [f"({quoted(mask)} & {_literal(bits)})" for mask, bits in zip(mask_names(len(names), prefix), selected(names, wanted)) if bits]


def any_set(names: Sequence[str], wanted: Sequence[str], prefix: str = "flags") -> str:
    """A condition: one of the wanted flags is set. NULL masks count as 0."""
    return " OR ".join(f"coalesce({part} <> 0, false)" for part in _parts(names, wanted, prefix)) or "false"


def n_set(names: Sequence[str], wanted: Sequence[str], prefix: str = "flags") -> str:
    """How many of the wanted flags are set."""
    return " + ".join(f"coalesce(bit_count({part}), 0)" for part in _parts(names, wanted, prefix)) or "0"


def _bit(names: Sequence[str], name: str, prefix: str) -> str:
    place = list(names).index(name)
    return f"(shiftrightunsigned({quoted(mask_names(len(names), prefix)[place // BITS])}, {place % BITS}) & 1)"


def is_set(names: Sequence[str], name: str, prefix: str = "flags") -> str:
    """A condition: one flag is set."""
    return f"{_bit(names, name, prefix)} = 1"


def unpacked(masks: DataFrame, names: Sequence[str], carry: Sequence[str], wanted: Sequence[str] | None = None, prefix: str = "flags") -> DataFrame:
    """One 0/1 column a flag again; NULL where the mask is."""
    return masks.selectExpr(*map(quoted, carry), *[f"CAST({_bit(names, name, prefix)} AS INT) AS {quoted(name)}" for name in wanted or names])


def sums(names: Sequence[str], wanted: Sequence[str] | None = None, prefix: str = "flags") -> list[Column]:
    """An aggregate a flag: in how many rows it is set."""
    return [F.expr(f"coalesce(sum({_bit(names, name, prefix)}), 0) AS {quoted(name)}") for name in wanted or names]


def combined(names: Sequence[str], prefix: str = "flags") -> list[Column]:
    """Aggregates: the flags set in any row."""
    return [F.expr(f"coalesce(bit_or({quoted(mask)}), 0L) AS {quoted(mask)}") for mask in mask_names(len(names), prefix)]


def names_set(names: Sequence[str], masks: Mapping[str, int], prefix: str = "flags") -> list[str]:
    """The names of the flags in masks that ``combined`` gave."""
    values = [masks[mask] for mask in mask_names(len(names), prefix)]
    return [name for place, name in enumerate(names) if values[place // BITS] >> (place % BITS) & 1]
