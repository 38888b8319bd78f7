"""Load files as they arrive: each run takes the files added since the last one, exactly once."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from twinledger.sources.tables import READ_OPTIONS, NULL_TOKENS, typed, with_constants


def load_new_csv_files(spark: SparkSession, directory: str, file_columns: Sequence[str], schema: T.StructType,
                       table: str, checkpoint: str, constants: Mapping[str, object] | None = None,
                       null_tokens: Sequence[str] = NULL_TOKENS, files_per_batch: int | None = None, multi_line: bool = False) -> StreamingQuery:
    """Appends the CSV files of a directory that no earlier run has loaded to a parquet table, and ends.

    ``file_columns`` is the header of the files. Cleaning and typing are those of the batch load: a malformed row or a value that
    does not fit fails the run, which can be repeated once the file is mended. ``checkpoint``
    remembers what is loaded and must be in shared storage, as must ``table``.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in file_columns])
    reader = spark.readStream.schema(text).options(**READ_OPTIONS, mode="FAILFAST", multiLine=str(multi_line).lower()).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    loaded = typed(with_constants(reader.csv(directory), constants or {}), schema, null_tokens)
    return append_available(loaded, table, checkpoint)


def append_available(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Writes everything a stream holds now to a parquet table; a rerun with the same checkpoint adds only what is new."""
    return (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", os.path.join(checkpoint, "load"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
