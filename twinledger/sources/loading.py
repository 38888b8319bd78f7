"""One scan from CSV files to a table: lines are checked, parsed, typed, added up and written in the same pass.

Files are read as lines, so that a line that begins or ends within a quoted value is seen where it is, files of any number and size are
split over tasks, and what a file's name says (such as its year) comes with each line. Counts and control totals are observed
while the table is written; only the loaded column is read again to hold it against them.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.compare import MONEY, null_if_token, quoted
from twinledger.sources.controls import TOLERANCE
from twinledger.sources.tables import NULL_TOKENS, READ_OPTIONS, typed

FILE = "__file"
LINE = "__line"
BOM = "﻿"


@dataclass(frozen=True)
class Loaded:
    """A written table with what was observed on the way: lines of data, files, and per totalled column the sum of its numbers in the
    files and how many of its values are neither a null token nor a number."""

    table: DataFrame
    n_rows: int
    n_files: int
    totals: Mapping[str, float]
    rejected: Mapping[str, int]


def from_path(pattern: str, data_type: str = "int") -> Column:
    """A constant out of the path of a line's file: the first group of the pattern, which must be found in every path."""
    found = F.regexp_extract(F.col(FILE), pattern, 1)
    missing = F.raise_error(F.concat(F.lit(f"{pattern} is not in the path "), F.col(FILE)))
    return F.when(found == "", missing.cast(data_type)).otherwise(found.try_cast(data_type))


def by_path(spark: SparkSession, values: Mapping[object, str | Sequence[str]]) -> Column:
    """A constant per group of files: value -> its paths."""
    column = None
    # Local files are named with one slash or three, depending on who names them.
    named = F.regexp_replace(FILE, "^file:/+", "file:/")
    for value, paths in values.items():
        files = spark.read.text([paths] if isinstance(paths, str) else list(paths)).inputFiles()
        here = named.isin([f"file:/{f.removeprefix('file:').lstrip('/')}" if f.startswith("file:") else f for f in files])
        column = F.when(here, F.lit(value)) if column is None else column.when(here, F.lit(value))
    return column


def header_of(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first line of the first file. Reads no more than that."""
    first = spark.read.text(spark.read.text(list(paths)).inputFiles()[:1]).first()
    if first is None:
        raise ValueError(f"no header in {list(paths)[0]}")
    return first["value"].removeprefix(BOM)


def parsed_lines(spark: SparkSession, paths: Sequence[str], header: str) -> DataFrame:
    """Lines of data as text columns named by the header, with the path of the file and the number of quotes checked."""
    columns = next(csv.reader([header]))
    if len({c.lower() for c in columns}) < len(columns):
        raise ValueError(f"the header names a column twice: {header}")
    # Named by place while they are parsed: a header may hold any character.
    text = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(columns))])
    lines = spark.read.text(list(paths)).select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    quotes = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit('"'), F.lit("")))
    torn = F.raise_error(F.concat(F.lit("a quoted value holds a line break, or a quote is missing, in "), F.col(FILE), F.lit(": "), F.col(LINE)))
    whole = F.when(quotes % 2 == 1, torn.cast("string")).otherwise(F.col(LINE))
    options = {k: v for k, v in READ_OPTIONS.items() if k != "header"}
    parsed = lines.where(F.col(LINE) != "").withColumn("__row", F.from_csv(whole, text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {**options, "mode": "FAILFAST"}))
    return parsed.select(FILE, LINE, *[F.col(f"__row.c{k}").alias(name) for k, name in enumerate(columns)])


def load_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, path: str, constants: Mapping[str, Column] | None = None,
             totals: Sequence[str] = (), null_tokens: Sequence[str] = NULL_TOKENS, on_bad: str = "fail") -> Loaded:
    """Loads CSV files into parquet at ``path``, reading them once.

    Every file begins with the header of the first one; a file with another one fails the load, as does a line that is no whole row
    or, unless ``on_bad='null'``, a value that does not fit its type. ``constants``: columns the files lack, such as
    ``from_path(r'year=(\\d+)')``. ``totals``: columns that are added up over the files. Files whose quoted values hold line breaks are
    refused; ``tables.read_csv_table(multi_line=True)`` reads them. Blank lines are skipped.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header, n_files = header_of(spark, paths), len(spark.read.text(paths).inputFiles())
    raw = parsed_lines(spark, paths, header)
    is_header = F.col(LINE).isin(header, BOM + header)
    known = {c.lower(): c for c in raw.columns}
    numbers = []
    for k, name in enumerate(totals):
        text = null_if_token(F.col(quoted(known[name.lower()])), tuple(null_tokens))
        number = text.try_cast(MONEY)
        numbers += [F.when(~is_header, number).alias(f"__n{k}"), (~is_header & text.isNotNull() & number.isNull()).alias(f"__r{k}")]
    kept = raw.withColumns({name: value for name, value in (constants or {}).items()})
    # Headers go through the observation as lines of NULLs, so that every file's is counted.
    blank = [F.when(~is_header, F.col(quoted(c))).alias(c) for c in kept.columns if c not in (FILE, LINE)]
    marked = kept.select(is_header.alias("__header"), *numbers, *blank)
    fitted = typed(marked, T.StructType([T.StructField("__header", T.BooleanType()), *[T.StructField(f"__n{k}", MONEY) for k in range(len(totals))],
                                         *[T.StructField(f"__r{k}", T.BooleanType()) for k in range(len(totals))], *schema.fields]), null_tokens, on_bad)
    seen = Observation()
    observed = fitted.observe(
        seen, F.count_if("__header").alias("headers"), F.count("*").alias("lines"),
        *[F.coalesce(F.sum(f"__n{k}"), F.lit(0)).cast("double").alias(f"total{k}") for k in range(len(totals))],
        *[F.count_if(f"__r{k}").alias(f"rejected{k}") for k in range(len(totals))])
    observed.where("NOT __header").select(*[f.name for f in schema.fields]).write.mode("overwrite").parquet(path)
    found = seen.get
    if found["headers"] != n_files:
        raise ValueError(f"{n_files} files, but the header {header!r} occurs {found['headers']} times")
    return Loaded(spark.read.schema(schema).parquet(path), found["lines"] - found["headers"], n_files,
                  {name: found[f"total{k}"] for k, name in enumerate(totals)}, {name: found[f"rejected{k}"] for k, name in enumerate(totals)})


def loaded_totals(checks: Mapping[str, tuple[Loaded, str]], tolerance: float = TOLERANCE) -> DataFrame:
    """``controls.control_totals`` of loads: check name -> (load, column). Reads one column of each table and no file."""
    parts = []
    for name, (load, column) in checks.items():
        total = load.table.agg(F.coalesce(F.sum(F.col(quoted(column)).try_cast(MONEY)), F.lit(0)).cast("double").alias("table_total"))
        parts.append(total.select(F.lit(name).alias("check"), F.lit(load.totals[column]).alias("file_total"), "table_total",
                                  F.lit(load.rejected[column]).cast("long").alias("n_rejected")))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    compared = stacked.withColumn("diff", F.abs(F.col("file_total") - F.col("table_total")))
    return compared.select("check", "file_total", "table_total", "diff", "n_rejected", ((F.col("diff") < tolerance) & (F.col("n_rejected") == 0)).alias("is_match"))
