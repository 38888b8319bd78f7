"""Value comparison, null cleaning and money helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MODES = ("coalesce", "distinct", "plain")
# What amounts are added up in: exact whatever the order, with fractions of a cent.
MONEY = T.DecimalType(38, 6)


def quoted(name: str) -> str:
    return f"`{name}`"


def normalised(value: str, data_type: T.DataType, null_mode: str) -> str:
    """The value as it takes part in a comparison: in ``coalesce`` mode NULL text is '' and a NULL number is 0."""
    if null_mode == "coalesce" and isinstance(data_type, T.StringType):
        return f"coalesce({value}, '')"
    if null_mode == "coalesce" and isinstance(data_type, T.NumericType):
        return f"coalesce({value}, CAST(0 AS {data_type.simpleString()}))"
    return value


def differs(left: str, right: str, data_type: T.DataType, null_mode: str = "coalesce") -> str:
    """A condition that is true where two values differ; it is never NULL.

    ``coalesce``: NULL equals '' or 0; ``distinct``: NULL equals only NULL; ``plain``: NULL makes no difference at all.
    Conditions over many columns are built as SQL text, which takes one call per column instead of one per operator.
    """
    if null_mode not in NULL_MODES:
        raise ValueError(f"null_mode must be one of {NULL_MODES}, not {null_mode!r}")
    if null_mode == "plain":
        return f"coalesce({left} <> {right}, false)"
    return f"NOT ({normalised(left, data_type, null_mode)} <=> {normalised(right, data_type, null_mode)})"


def side_differs(field: str, data_type: T.DataType, null_mode: str = "coalesce") -> str:
    """``differs`` for the two sides of a field in a joined row."""
    return differs(quoted(f"src_{field}"), quoted(f"new_{field}"), data_type, null_mode)


def any_of(conditions: list[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions) or "false"


def null_if_token(value: Column, tokens: tuple[str, ...] = ("nan", "")) -> Column:
    """Text with null tokens (compared trimmed and in lower case) replaced by NULL."""
    return F.when(~F.lower(F.trim(value)).isin(*tokens), value)


def with_null_token(column: str, data_type: T.DataType, token: str) -> str:
    """The reverse of cleaning, as a load without null cleaning leaves it: text NULL as a token, float NULL as NaN."""
    if isinstance(data_type, T.StringType):
        return f"coalesce({quoted(column)}, '{token}')"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"coalesce({quoted(column)}, CAST('NaN' AS {data_type.simpleString()}))"
    return quoted(column)


def amount_or_zero(column: str, data_type: T.DataType) -> str:
    """NULL and NaN amounts count as 0."""
    zero = f"CAST(0 AS {data_type.simpleString()})"
    value = quoted(column)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = f"nanvl({value}, {zero})"
    return f"coalesce({value}, {zero})"


def money_sum(value: Column) -> Column:
    """A sum of unrounded amounts as decimals, so that it does not depend on the order in which partitions are added up."""
    return F.sum(value.cast(MONEY)).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE, NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
