"""Repeating columns ``NAME_1 .. NAME_n`` form one field family ``NAME``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that make a family name out of a column or metric name.
SLOT_SUFFIX = "_[0-9]+$"
DELTA_PREFIX = "^abs_delta_"
ONE_SIDED_PREFIX = "KEY_ONE_SIDED_"


def family_name(column: str) -> str:
    return re.sub(SLOT_SUFFIX, "", column.removeprefix(ONE_SIDED_PREFIX))


def field_family(name: Column) -> Column:
    without_prefix = F.regexp_replace(name, f"{DELTA_PREFIX}|^{ONE_SIDED_PREFIX}", "")
    return F.regexp_replace(without_prefix, SLOT_SUFFIX, "")


def slots(family: str, n: int) -> tuple[str, ...]:
    return tuple(f"{family}_{i}" for i in range(1, n + 1))
