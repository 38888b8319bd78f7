"""CSV loading with declared types, and table and result writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.compare import null_if_token

# Texts that stand for NULL in the exports, compared trimmed and in lower case.
NULL_TOKENS = ("nan", "")
# The wider set that spreadsheet and data frame tools read as NULL; pass it as ``null_tokens`` where it is wanted.
COMMON_NULL_TOKENS = ("", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan", "<na>", "n/a", "na", "nan", "none", "null")
# Quotes within quoted values are doubled; blanks at the ends of a value belong to it.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# What stands for a missing value while a file is read: no value at all, unlike a pair of quotes, which is an empty text.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\u0000"}
CORRUPT = "_corrupt_record"


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False, on_malformed: str = "fail") -> DataFrame:
    """CSV files as they are: columns by header name, every value text. Files whose header differs fail the read.

    A row with more or fewer values than the header fails the read; ``on_malformed='report'`` keeps it and puts its text into
    the column ``_corrupt_record``. ``multi_line`` allows line breaks in quoted values; a file is then read by one task. Without
    it, a line with an odd number of quotes is refused by a scan of the lines beforehand, since it would be read as two rows.
    """
    if on_malformed not in ("fail", "report"):
        raise ValueError(f"on_malformed must be 'fail' or 'report', not {on_malformed!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not multi_line and not unbalanced_lines(spark, paths).isEmpty():
        raise ValueError("quoted values hold line breaks, or a quote is missing: read with multi_line=True")
    reader = spark.read.options(**READ_OPTIONS).option("enforceSchema", False).option("multiLine", multi_line).option("columnPruning", False)
    columns = reader.csv(paths).schema
    if on_malformed == "fail":
        return reader.schema(columns).option("mode", "FAILFAST").csv(paths)
    columns = T.StructType([*columns.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(columns).option("columnNameOfCorruptRecord", CORRUPT).csv(paths)


def unbalanced_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the files that begin or end within a quoted value."""
    return spark.read.text(list(paths)).where(unbalanced(F.col("value")))


def unbalanced(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()}) if constants else df


def typed(raw: DataFrame, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS, on_bad: str = "fail") -> DataFrame:
    """The declared columns with their types. Null tokens become NULL. A value that does not fit its type fails the job that
    reads it; with ``on_bad='null'`` it becomes NULL, and ``cast_failures`` counts such values."""
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    present = {c.lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"columns {missing} are not in the input")
    columns = []
    for field in schema.fields:
        value = F.col(present[field.name.lower()])
        if isinstance(raw.schema[present[field.name.lower()]].dataType, T.StringType):
            value = null_if_token(value, tuple(null_tokens))
        fitting = value.try_cast(field.dataType)
        if on_bad == "fail" and not isinstance(field.dataType, T.StringType):
            bad = F.raise_error(F.concat(F.lit(f"{field.name}: not {field.dataType.simpleString()}: "), value.cast("string")))
            fitting = F.when(value.isNotNull() & fitting.isNull(), bad.cast(field.dataType)).otherwise(fitting)
        columns.append(fitting.alias(field.name))
    return raw.select(*columns)


def cast_failures(raw: DataFrame, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Per non-text column the values that are neither a null token nor of the declared type; columns without any are
    left out."""
    checked = [f for f in schema.fields if not isinstance(f.dataType, T.StringType) and f.name in raw.columns]
    bad = [
        F.count_if(null_if_token(F.col(f.name).cast("string"), tuple(null_tokens)).isNotNull()
                   & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in checked
    ]
    row = raw.agg(*bad)
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("n_bad")) for f in checked])
    return row.select(F.inline(pairs)).where("n_bad > 0")


def read_csv_table(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   constants: Mapping[str, object] | None = None, null_tokens: Sequence[str] = NULL_TOKENS,
                   multi_line: bool = False, on_bad: str = "fail") -> DataFrame:
    """One table out of one or more CSV files, with constant columns (such as the year of a yearly file) added. Malformed rows
    and values that do not fit their type fail the load."""
    return typed(with_constants(read_text_csv(spark, paths, multi_line), constants or {}), schema, null_tokens, on_bad)


def read_yearly_csv_table(spark: SparkSession, paths_by_year: Mapping[int, str | Sequence[str]], schema: T.StructType,
                          year: str = "YEAR", null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """The union of yearly files that do not hold their year."""
    return union_tables([
        read_csv_table(spark, paths, schema, {year: value}, null_tokens) for value, paths in paths_by_year.items()
    ])


def union_tables(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name."""
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result as a folder of CSV parts with a header each; no part is gathered in one task. NULL is written as nothing and an
    empty text as a pair of quotes, so both come back as they were."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """The table as written to parquet and read back: its lineage ends in files that outlive lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], n_buckets: int) -> DataFrame:
    """A catalogue table bucketed and sorted by ``keys``. Two such tables join on these keys without a shuffle; with
    ``spark.sql.requireAllClusterKeysForCoPartition=false`` also on these and further keys."""
    df.write.mode("overwrite").bucketBy(n_buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
