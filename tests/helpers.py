from __future__ import annotations

from pyspark.sql import types as T

from twinledger.model import TablePair, TableSpec

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("code", T.StringType()),
    T.StructField("amt_1", T.DoubleType()), T.StructField("amt_2", T.DoubleType()),
])
SPEC = TableSpec("Toy", keys=("id", "year"), fields=("code", "amt_1", "amt_2"), amounts=("amt_1", "amt_2"))


def pair_of(spark, src, new, **spec) -> TablePair:
    return TablePair(SPEC, spark.createDataFrame(src, SCHEMA), spark.createDataFrame(new, SCHEMA)).with_spec(**spec)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is not None, str(v)) for v in row))
