"""Turning the one wide row of an aggregate into rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from twinledger.functions.compare import quoted


def as_rows(wide: DataFrame, name: str, values: Mapping[str, Mapping[str, str]], carry: Sequence[str] = ()) -> DataFrame:
    """One row per label: ``name`` holds the label, each entry of ``values`` maps labels to the column to take.

    Meant for results that are aggregated already; doing this to the rows before would multiply them by the columns.
    """
    labels = list(next(iter(values.values())))
    structs = [
        f"named_struct('{name}', '{label}', " + ", ".join(f"'{out}', {quoted(columns[label])}" for out, columns in values.items()) + ")"
        for label in labels
    ]
    return wide.selectExpr(*map(quoted, carry), f"inline(array({', '.join(structs)}))")
