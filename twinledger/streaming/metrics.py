"""Quality metrics kept up to date as batches of rows arrive, instead of being worked out anew from all of them.

A batch brings rows of either side. Only keys that it holds are compared again; what was counted for them before is taken back and
what they count now is added. Counts of a batch, with what they take back, are one row, and the metrics are the sum of these rows. Nothing
is ever changed in place: rows, flags and counts of a batch are folders of their own, which a repetition of the batch overwrites
with the same content.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.compare import quoted
from twinledger.model import TablePair, TableSpec
from twinledger.operators import masks
from twinledger.operators.fields import flag_names, packed_flags
from twinledger.operators.keys import null_key_rows, null_safe_join, rows_of_keys

BATCH = "__batch"


@dataclass
class RunningQuality:
    """Batches are numbered from 0 and added in this order; ``folder`` is in shared storage. ``schema`` holds the keys and fields of
    both sides. Keys must be unique on a side over all batches, as everywhere in this package."""

    spark: SparkSession
    spec: TableSpec
    schema: T.StructType
    folder: str
    null_mode: str = "coalesce"

    @property
    def _names(self) -> list[str]:
        empty = self.spark.createDataFrame([], self.schema)
        return flag_names(TablePair(self.spec, empty, empty))

    def _log(self, name: str, fields: list[T.StructField], batches: range) -> DataFrame:
        """What some batches have written under a name."""
        schema = T.StructType(fields)
        if not len(batches):
            return self.spark.createDataFrame([], schema.add(BATCH, T.LongType()))
        paths = [f"{self.folder}/{name}/{BATCH}={n}" for n in batches]
        return self.spark.read.schema(schema.add(BATCH, T.LongType())).option("basePath", f"{self.folder}/{name}").parquet(*paths)

    def _flag_fields(self) -> list[T.StructField]:
        return [*[self.schema[k] for k in self.spec.keys], *[T.StructField(m, T.LongType()) for m in masks.mask_names(len(self._names))]]

    def _of_keys(self, log: DataFrame, wanted: DataFrame) -> list[DataFrame]:
        """The rows of a log whose key is among ``wanted``, in parts without a common key.

        Where keys are promised not to be NULL, sides meet by plain equality; their rows are then looked up in the same way, so that one
        shuffle serves both. Rows that break the promise meet nothing there and are a part of their own.
        """
        spec, keys = self.spec, self.spec.keys
        if spec.nullable_keys:
            return [rows_of_keys(log, wanted, spec)]
        whole = " AND ".join(f"{quoted(k)} IS NOT NULL" for k in keys)
        return [rows_of_keys(log.where(whole), wanted, spec), null_safe_join(null_key_rows(log, keys), null_key_rows(wanted, keys), keys, "left_semi")]

    def add(self, number: int, src: DataFrame | None = None, new: DataFrame | None = None) -> None:
        """Takes the rows of a batch in. Reads the rows of its keys only; repeating the last batch changes nothing."""
        spec, keys, names = self.spec, list(self.spec.keys), self._names
        columns = [*keys, *spec.fields]
        empty = self.spark.createDataFrame([], self.schema)
        for side, df in (("src", src), ("new", new)):
            (empty if df is None else df).select(*columns).write.mode("overwrite").parquet(f"{self.folder}/{side}/{BATCH}={number}")
        fields = [self.schema[c] for c in columns]
        now = {side: self._log(side, fields, range(number, number + 1)).select(*keys) for side in ("src", "new")}
        touched = now["src"].unionByName(now["new"]).distinct()
        sides = [[rows.select(*columns) for rows in self._of_keys(self._log(side, fields, range(number + 1)), touched)] for side in ("src", "new")]
        packed = [packed_flags(TablePair(spec, *both), self.null_mode).drop("in_src", "in_new") for both in zip(*sides)]
        reduce(DataFrame.unionByName, packed).write.mode("overwrite").parquet(f"{self.folder}/flags/{BATCH}={number}")
        fresh = self._log("flags", self._flag_fields(), range(number, number + 1))
        # Of what earlier batches counted for these keys, the last counts.
        mask_columns = masks.mask_names(len(names))
        before = reduce(DataFrame.unionByName, [
            earlier.groupBy(*keys).agg(F.max_by(F.struct(*mask_columns), BATCH).alias("m")).select(*keys, "m.*")
            for earlier in self._of_keys(self._log("flags", self._flag_fields(), range(number)), touched)])
        counts = [df.agg((F.count("*") * sign).alias("units"), *masks.sums(names)).select("units", *[(F.col(quoted(n)) * sign).alias(n) for n in names])
                  for sign, df in ((1, fresh), (-1, before))]
        summed = counts[0].unionByName(counts[1]).agg(*[F.sum(quoted(c)).alias(c) for c in ("units", *names)])
        summed.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/counts/{BATCH}={number}")

    def counts(self, batches: int) -> DataFrame:
        """``quality.defect_counts`` after so many batches: the sum of their rows. No key and no row of the tables is read."""
        columns = ["units", *self._names]
        log = self._log("counts", [T.StructField(c, T.LongType()) for c in columns], range(batches))
        return log.agg(*[F.coalesce(F.sum(quoted(c)), F.lit(0)).alias(c) for c in columns])
