"""Small dimensions. They are joined without a broadcast hint: Spark broadcasts them by their known size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State codes, kept as published; codes 40 and 48 do not occur and 54 repeats AZ.
STATES = (
    ("01", "AL"), ("02", "AK"), ("03", "AZ"), ("04", "AR"), ("05", "CA"), ("06", "CO"), ("07", "CT"), ("08", "DE"),
    ("09", "DC"), ("10", "FL"), ("11", "GA"), ("12", "HI"), ("13", "ID"), ("14", "IL"), ("15", "IN"), ("16", "IA"),
    ("17", "KS"), ("18", "KY"), ("19", "LA"), ("20", "ME"), ("21", "MD"), ("22", "MA"), ("23", "MI"), ("24", "MN"),
    ("25", "MS"), ("26", "MO"), ("27", "MT"), ("28", "NE"), ("29", "NV"), ("30", "NH"), ("31", "NJ"), ("32", "NM"),
    ("33", "NY"), ("34", "NC"), ("35", "ND"), ("36", "OH"), ("37", "OK"), ("38", "OR"), ("39", "PA"), ("41", "RI"),
    ("42", "SC"), ("43", "SD"), ("44", "TN"), ("45", "TX"), ("46", "UT"), ("47", "VT"), ("49", "VA"), ("50", "WA"),
    ("51", "WV"), ("52", "WI"), ("53", "WY"), ("54", "AZ"),
)
# Sex codes.
SEXES = (("1", "Male"), ("2", "Female"))
# Race codes.
RACES = (
    ("1", "White"), ("2", "Black"), ("3", "Other"), ("4", "Asian/Pacific Islander"), ("5", "Hispanic"),
    ("6", "North American Native"),
)


def lookup_table(spark: SparkSession, rows: tuple[tuple[str, ...], ...], *columns: str) -> DataFrame:
    """Fixed rows as a table that is part of the plan, so that its size is known when a join is planned."""
    return spark.createDataFrame(pa.table(dict(zip(columns, (list(values) for values in zip(*rows))))))


def state_lookup(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, STATES, "code", "name")


def sex_lookup(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, SEXES, "code", "description")


def race_lookup(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, RACES, "code", "description")


def read_payment_formulas(spark: SparkSession, path: str) -> DataFrame:
    """The payment formulas out of a JSON array file."""
    raw = spark.read.option("multiLine", True).schema(
        "`Variable names` STRING, Labels STRING, `Sum of` STRING, Type STRING"
    ).json(path)
    return raw.select(
        F.col("Variable names").alias("variable_name"), F.col("Labels").alias("label"),
        F.col("Sum of").alias("calculation_logic"), F.col("Type").alias("variable_type"),
    )


def read_variable_labels(spark: SparkSession, path: str) -> DataFrame:
    """The variable labels out of a CSV file; labels may hold commas, so everything after the third is the label."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split(F.regexp_replace("value", "^﻿", ""), ",", 4)
    names = ("source_file", "original_order", "variable_name", "label")
    columns = lines.select(*[F.trim(parts[i]).alias(name) for i, name in enumerate(names)])
    return columns.where("NOT (source_file = 'File Source' AND original_order = '#')")
