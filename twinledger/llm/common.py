"""What the corpus operators share: reading tables, shared files, word hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that ends a word, as code points: space and TAB to CR.
WHITE_SPACE = " \t\n\x0b\f\r"

# Bytes of text hashed at once; a longer document is hashed alone.
CHUNK_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Only a session in one process (``local``, ``local[n]``) may leave that setting out; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="corpus-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once as a table in the shared folder and read from there: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_training(id_col: str, folds: int, fold: int):
    """Whether a row is not in the held-out fold: crc32 of the id as text, modulo ``folds``. A NULL id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != fold, F.lit(True))


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, for tasks that write or read files of their own format there."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith(("file:", "/")) else f"/{uri}")


def as_large_text(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """Text without NULLs (empty instead), with 64-bit offsets."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the texts in them)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


_RANDOM = np.random.default_rng(20240607).integers(0, 2**64, size=256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = _RANDOM[_LOWER]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in WHITE_SPACE]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (splitmix64's finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chunk_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = ~_IS_SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | first[:n]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power("up", MULTIPLIER, n), out=sums[1:])
    down = _power("down", pow(MULTIPLIER, -1, 2**64), n)
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, offsets))


def word_hashes(column: pa.LargeStringArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, 64-bit hashes of the words of some rows in order, number of words of each of these rows).

    Words are runs of other characters than ``WHITE_SPACE``, with A-Z lower-cased. A polynomial over random byte values makes
    one hash of a word, wherever it stands, from two prefix sums.
    """
    data, offsets = text_bytes(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1)
        cut = offsets[row: end + 1]
        yield row, *_chunk_words(data[cut[0]: cut[-1]], cut - cut[0])
        row = end


class Remembered:
    """What a worker has worked out before, by key: the keys used since it last held ``limit`` of them, and those before."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def turn(self) -> None:
        """Lets the older keys go once there are enough newer ones; called before a part of the work, never within."""
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new

    def missing(self, wanted: Iterator) -> set:
        """Those of the keys that aren't known; afterwards the known ones are all in ``new``."""
        new, old = self.new, self.old
        absent = {key for key in wanted if key not in new}
        if old:
            again = {key for key in absent if key in old}
            new.update((key, old[key]) for key in again)
            absent -= again
        return absent


def tidy(run: Callable) -> Callable:
    """A task function that hands freed memory back to the system when it is done: later stages reuse its worker."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return rows
