"""Incremental load in batches with a ledger: what each batch brought, written so that a repeated batch changes nothing.

A batch is written to a folder of its own, which a repetition overwrites; then its line of the ledger is written. A run that dies
in between leaves a folder without a line, which nobody reads and the next run writes anew; one that dies before the stream
has noted the batch finds the line and skips it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.compare import MONEY, null_if_token, quoted
from twinledger.sources.tables import NULL_TOKENS, READ_OPTIONS, typed, unbalanced

ENTRY = "batch long, n_rows long, n_files long, n_rejected long, column string, file_total double"


@dataclass
class BatchLoad:
    """Loads the CSV files of a directory that no earlier run has loaded into ``folder``, which is in shared storage.

    ``file_columns`` is the header of the files. ``totals`` are columns that are added up over a batch's files; values of them that
    are neither a null token nor a number are counted as rejected. With ``on_bad='null'`` values that do not fit become NULL, else
    they fail the batch. A line that begins or ends within a quoted value fails the batch; nothing of it is then read.
    """

    spark: SparkSession
    directory: str
    file_columns: Sequence[str]
    schema: T.StructType
    folder: str
    totals: Sequence[str] = ()
    constants: Mapping[str, Column] | None = None
    null_tokens: Sequence[str] = NULL_TOKENS
    files_per_batch: int | None = None
    on_bad: str = "fail"
    # Called with the number of a batch when its rows are written and its line of the ledger is not.
    before_entry: Callable[[int], None] | None = None

    def run(self) -> None:
        """Loads what is there now and ends; raises what a batch raises."""
        # Lines only: a batch is parsed once, by the job that writes it.
        reader = self.spark.readStream
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        stream = reader.text(self.directory).select("value", F.col("_metadata.file_path").alias("__file"))
        query = stream.writeStream.foreachBatch(self._write).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    def entries(self) -> DataFrame:
        """The ledger: a line a batch and totalled column (one with an empty column where there is none)."""
        return self._read(f"{self.folder}/ledger", T.StructType.fromDDL(ENTRY))

    def table(self) -> DataFrame:
        """The rows of all batches that have their line."""
        known = self.entries().select(F.col("batch").alias("__batch")).distinct()
        rows = self._read(f"{self.folder}/table", T.StructType([*self.schema.fields, T.StructField("__batch", T.LongType())]))
        # One number a batch.
        return rows.join(F.broadcast(known), "__batch", "left_semi").select(*self.schema.names)

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        spark = self.spark
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)

    def _write(self, batch: DataFrame, number: int) -> None:
        if not self.entries().where(F.col("batch") == number).isEmpty():
            return
        line = F.col("value")
        found = batch.groupBy("__file").agg(F.count_if(line.rlike(r"[^\x00-\x20]")).alias("lines"), F.count_if(unbalanced(line)).alias("torn")).collect()
        if not found:
            return
        # One line is the header.
        files = [row["__file"] for row in found if row["lines"] > 1]
        if any(row["torn"] for row in found if row["lines"] > 1):
            raise ValueError("quoted values hold line breaks, or a quote is missing")
        text = T.StructType([T.StructField(c, T.StringType()) for c in self.file_columns])
        parsed = batch.sparkSession.read.schema(text).options(**READ_OPTIONS, mode="FAILFAST").option("enforceSchema", False).csv([row["__file"] for row in found])
        if not files:
            parsed.isEmpty()  # headers of files without rows are checked as well
            return
        # A constant may come out of a line's path.
        batch = parsed.select("*", F.col("_metadata.file_path").alias("__file"))
        names = {c.lower(): c for c in batch.columns}
        numbers = []
        for k, name in enumerate(self.totals):
            value = null_if_token(F.col(quoted(names[name.lower()])), tuple(self.null_tokens))
            numbers += [value.try_cast(MONEY).alias(f"__n{k}"), (value.isNotNull() & value.try_cast(MONEY).isNull()).alias(f"__r{k}")]
        extra = [T.StructField(f"__{c}{k}", t) for k in range(len(self.totals)) for c, t in (("n", MONEY), ("r", T.BooleanType()))]
        marked = batch.withColumns(dict(self.constants or {})).select("*", *numbers)
        fitted = typed(marked, T.StructType([*self.schema.fields, *extra]), self.null_tokens, self.on_bad)
        seen = Observation()
        observed = fitted.observe(seen, F.count("*").alias("n"), *[F.coalesce(F.sum(f"__n{k}"), F.lit(0)).cast("double").alias(f"t{k}") for k in range(len(self.totals))],
                                  *[F.count_if(f"__r{k}").alias(f"r{k}") for k in range(len(self.totals))])
        observed.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.folder}/table/__batch={number}")
        if self.before_entry:
            self.before_entry(number)
        found = seen.get
        lines = [(found["n"], len(files), found[f"r{k}"], name, found[f"t{k}"]) for k, name in enumerate(self.totals)] or [(found["n"], len(files), 0, "", 0.0)]
        entry = batch.sparkSession.createDataFrame(lines, "n_rows long, n_files long, n_rejected long, column string, file_total double")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/batch={number}")
