"""Scores by an interpolated modified Kneser-Ney bigram model, counted in Spark and looked up in memory-mapped arrays.

Words and bigrams are counted by aggregates that tasks combine beforehand. The counts are written as sorted arrays of hashes
(words) and keys (bigrams), one pair of files a shard, into the shared folder; scoring tasks map them into memory and search
them, so a worker holds only the pages it touches. The driver gets one row a shard and a handful of constants.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import as_large_text, file_system, in_training, shared_folder, stored, tidy, word_hashes

# Hash of the end of a text, which counts as a word.
END = np.uint64(0x5BD1E995A0761D65)
# Words and bigrams that a counting task combines before it passes them on.
COMBINE = 4 << 20
# Bigrams of a shard whose contexts and continuations are combined at once, which takes about 100 bytes each.
COMBINE_OF_SHARD = 1 << 20
# Rows of a batch that a counting task passes on.
BATCH = 1 << 18
# A word that makes up more than this share of all words has its bigrams spread over SPREAD shards; there are at most 1000.
HOT_SHARE = 0.001
SPREAD = 64
# Words of a block of the per-word arrays.
WORD_BLOCK = 1 << 20


def local_path(uri: str) -> str:
    """The path under which workers can map a file of the shared folder into memory."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise RuntimeError(f"{uri}: the shared folder must be a mounted file system for files to be mapped into memory")
    return uri


_mapped: dict[str, np.ndarray] = {}


def mapped(uri: str, dtype: str) -> np.ndarray:
    if uri not in _mapped:
        if len(_mapped) > 10_000:
            _mapped.clear()
        _mapped[uri] = np.memmap(local_path(uri), dtype=dtype, mode="r")
    return _mapped[uri]


@dataclass
class Sorted:
    """Sorted keys with a value each, in shards; ``place`` gives the global index of keys, -1 for those that aren't there."""

    folder: str
    files: list[str]
    sizes: list[int]
    shard_of: Callable[[np.ndarray], np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(global index or -1, value or 0) of sorted or unsorted keys."""
        index, value = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        shard, offsets = self.shard_of(keys), self.offsets
        order = np.argsort(shard, kind="stable")
        limits = np.searchsorted(shard[order], np.arange(len(self.sizes) + 1))
        for s, size in enumerate(self.sizes):
            mine = order[limits[s]: limits[s + 1]]
            if not size or not len(mine):
                continue
            known = mapped(f"{self.folder}/{self.files[s]}.keys", "<u8")
            place = np.minimum(np.searchsorted(known, keys[mine]), size - 1)
            hit = known[place] == keys[mine]
            index[mine[hit]] = place[hit] + offsets[s]
            value[mine[hit]] = mapped(f"{self.folder}/{self.files[s]}.values", "<u4")[place[hit]]
        return index, value


@dataclass
class Words:
    """Per-word arrays in blocks of WORD_BLOCK: count, continuations, context total, back-off weight."""

    folder: str
    files: list[str]
    n: int

    def get(self, column: str, dtype: str, ids: np.ndarray) -> np.ndarray:
        """Values of ids; 0 for ids that are no word."""
        out = np.zeros(len(ids), dtype)
        known = (ids >= 0) & (ids < self.n)
        for block in np.unique(ids[known] // WORD_BLOCK):
            mine = np.flatnonzero(known & (ids // WORD_BLOCK == block))
            if self.files[block]:
                out[mine] = mapped(f"{self.folder}/{self.files[block]}.{column}", dtype)[ids[mine] % WORD_BLOCK]
        return out


@dataclass
class LanguageModel:
    vocabulary: Sorted
    bigrams: Sorted
    words: Words
    total: int  # tokens learned from
    distinct: int  # distinct tokens
    bigram_types: int
    bigram_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_backoff: float

    @property
    def begin(self) -> int:
        """The id that stands for the begin of a text; it is a context only."""
        return self.distinct

    def word_probability(self, continuations: np.ndarray) -> np.ndarray:
        """Lower-order probability; a word that was never seen has no continuations and gets one share of the rest."""
        kept = np.maximum(continuations - discounted(continuations, self.word_discounts), 0) / max(1, self.bigram_types)
        return kept + self.word_backoff / (self.distinct + 1)

    def probability(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """P(word | before) by ids; -1 is an unknown word."""
        lower = self.word_probability(self.words.get("continuations", "<u4", word).astype(np.int64))
        total, backoff = self.words.get("context", "<u8", before).astype(np.float64), self.words.get("backoff", "<f8", before)
        both = (before >= 0) & (word >= 0)
        keys, inverse = np.unique(np.where(both, (before << 32) | word, -1).view(np.uint64), return_inverse=True)
        count = np.where(both, self.bigrams.find(keys)[1][inverse], 0)
        seen = total > 0
        kept = np.maximum(count - discounted(count, self.bigram_discounts), 0) / np.where(seen, total, 1)
        return np.where(seen, kept + backoff * lower, lower)


def discounted(count: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.array((0.0, *discounts))[np.minimum(count, 3)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from how many n-grams occur once, twice, three and four times; fixed ones where these are too few."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))


def _combined(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (key, n) of the distinct values and their counts of COMBINE values at a time, which are sorted where they are held."""
    held, size = np.empty(COMBINE, np.uint64), 0
    for part in parts:
        while len(part):
            taken = part[: len(held) - size]
            held[size: size + len(taken)] = taken
            size, part = size + len(taken), part[len(taken):]
            if size == len(held):
                yield from _counts(held)
                size = 0
    yield from _counts(held[:size])


def _counts(values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorts the values in place; rows (key, n) of about BATCH values at a time."""
    values.sort()
    at = 0
    while at < len(values):
        # Up to the last of equal values.
        end = int(np.searchsorted(values, values[min(at + BATCH, len(values)) - 1], side="right"))
        some = values[at:end]
        starts = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
        yield pa.RecordBatch.from_arrays([pa.array(some[starts].view(np.int64)), pa.array(np.diff(starts, append=len(some)))], names=["key", "n"])
        at = end


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word hashes, words per document) of some documents at a time."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for _, hashes, counts in word_hashes(as_large_text(batch.column(0))):
                yield hashes, counts


def with_ends(words: np.ndarray, counts: np.ndarray, end) -> np.ndarray:
    """The sequences with an end behind each."""
    return np.insert(words, np.cumsum(counts), np.full(len(counts), end, words.dtype))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _combined(with_ends(hashes, n, END) for hashes, n in _texts(batches))


@dataclass
class TopBits:
    """Shard by the upper bits of a hash."""

    bits: int

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)


@dataclass
class ByFirstWord:
    """Shard of a bigram by its first word; by both words where the first is a hot one."""

    shards: int
    hot: np.ndarray

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        first, second = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        with np.errstate(over="ignore"):
            spread = np.where(np.isin(first, self.hot), second % np.uint64(SPREAD) + np.uint64(1), np.uint64(0))
            h = (first * np.uint64(SPREAD + 1) + spread + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(40)) % np.uint64(self.shards)).astype(np.int64)


WRITTEN = "kind string, shard int, path string, id long, a long, b long, c long, d long, e long"


def _written(kind: str, shards, ids, columns, path: str = "") -> pa.RecordBatch:
    n = len(ids)
    arrays = [pa.array([kind] * n), pa.array(np.full(n, shards, np.int32)), pa.array([path] * n), pa.array(np.asarray(ids, np.int64))]
    arrays += [pa.array(np.asarray(c, np.int64)) if c is not None else pa.array(np.zeros(n, np.int64)) for c in (*columns, *[None] * (5 - len(columns)))]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "shard", "path", "id", "a", "b", "c", "d", "e"])


def _write_sorted(folder: str, statistics: bool):
    """Writes rows (shard, key, n), sorted, as arrays; passes on a row 'file' a shard, and the contexts and continuations of
    bigrams, combined within the shard as far as COMBINE_OF_SHARD goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        current, name, out, rows, total, tallies = None, "", (), 0, 0, np.zeros(5, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            keys, n = (np.concatenate(x) for x in zip(*held))
            held.clear()
            first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            sums = [np.add.reduceat(x.astype(np.int64), starts) for x in (n, n == 1, n == 2, n >= 3)]
            seconds, times = np.unique(second, return_counts=True)
            for kind, ids, columns in (("context", first[starts], sums), ("word", seconds, [times])):
                for at in range(0, len(ids), 1 << 18):
                    yield _written(kind, current, ids[at: at + (1 << 18)], [c[at: at + (1 << 18)] for c in columns])

        def closed() -> Iterator[pa.RecordBatch]:
            for stream in out:
                stream.close()
            if statistics and held:
                yield from flushed()
            yield _written("file", current, [rows], [[total], *[[t] for t in tallies[1:]]], name)

        for batch in batches:
            shards, keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(shards[1:] != shards[:-1]) + 1, [len(shards)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if shards[a] != current:
                    if current is not None:
                        yield from closed()
                    current, name, rows, total, tallies = int(shards[a]), f"{int(shards[a]):06d}-{uuid.uuid4().hex}", 0, 0, np.zeros(5, np.int64)
                    system.create_dir(root, recursive=True)
                    out = tuple(system.open_output_stream(f"{root}/{name}.{part}") for part in ("keys", "values"))
                out[0].write(keys[a:b].astype("<u8").tobytes())
                if n[a:b].max() >= 2**32:
                    raise OverflowError("a word or pair of words occurs 2^32 times or more")
                out[1].write(n[a:b].astype("<u4").tobytes())
                rows, total = rows + int(b - a), total + int(n[a:b].sum())
                tallies += np.bincount(np.minimum(n[a:b], 5), minlength=6)[:5]
                if statistics:
                    held.append((keys[a:b], n[a:b]))
                    if sum(len(k) for k, _ in held) >= COMBINE_OF_SHARD:
                        yield from flushed()
        if current is not None:
            yield from closed()
    return run


def _sorted_files(counts: DataFrame, folder: str, shards: int, shard_of, statistics: bool) -> tuple[Sorted, list, DataFrame]:
    """Sums rows (key, n), writes them sorted by shard; gives the arrays, their rows in the manifest, and all rows passed on."""
    spark = counts.sparkSession

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys).astype(np.int32)), batch.column(0), batch.column(1)], names=["shard", "key", "n"])

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One shuffle: rows combined by the tasks are dealt out by shard, and a shard's rows are summed and sorted where they are.
    summed = counts.mapInArrow(sharded, "shard int, key long, n long").repartition(partitions, "shard").groupBy("shard", "key").agg(F.sum("n").alias("n"))
    # As unsigned numbers, the negative keys come last.
    ordered = summed.sortWithinPartitions("shard", F.col("key") < 0, "key").select("shard", "key", "n")
    written = stored(ordered.mapInArrow(tidy(_write_sorted(folder, statistics)), WRITTEN), "lm-written")
    files = written.where("kind = 'file'").collect()
    names, sizes = [""] * shards, [0] * shards
    for row in files:
        names[row["shard"]], sizes[row["shard"]] = row["path"], row["id"]
    return Sorted(folder, names, sizes, shard_of), files, written


def train(docs: DataFrame, text_col: str = "text") -> LanguageModel:
    """Counts the model over all the given documents. A NULL text is empty; it still has an end."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "lm")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards, bits = 4 * partitions, max(4, (4 * partitions - 1).bit_length())
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    vocabulary, files, _ = _sorted_files(texts.mapInArrow(tidy(_counted), "key long, n long"), f"{folder}/words", 1 << bits, TopBits(bits), False)
    total, distinct = sum(row["a"] for row in files), sum(vocabulary.sizes)
    if distinct >= 2**32:
        raise OverflowError("2^32 distinct words or more")
    hot = _hot_words(spark, vocabulary, total)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[np.ndarray]:
            for hashes, counts in _texts(batches):
                before, word = id_pairs(vocabulary, distinct, hashes, counts)
                yield ((before << 32) | word).view(np.uint64)
        yield from _combined(pairs())

    bigrams, files, written = _sorted_files(texts.mapInArrow(tidy(paired), "key long, n long"), f"{folder}/bigrams", shards, ByFirstWord(shards, np.array(sorted(hot), np.uint64)), True)
    bigram_discounts = discounts([sum(row[c] for row in files) for c in "bcde"])
    d1, d2, d3 = bigram_discounts
    contexts = written.where("kind = 'context'").groupBy("id").agg(F.sum("a").alias("context"), F.sum(F.col("b") * d1 + F.col("c") * d2 + F.col("d") * d3).alias("held"))
    continued = written.where("kind = 'word'").groupBy("id").agg(F.sum("a").alias("continuations"))
    rows = stored(contexts.join(continued, "id", "full_outer").select("id", F.coalesce("continuations", F.lit(0)).alias("continuations"), F.coalesce("context", F.lit(0)).alias("context"),
                                                                      F.coalesce(F.col("held") / F.col("context"), F.lit(0.0)).alias("backoff")), "lm-contexts")
    tally = rows.agg(*[F.sum((F.col("continuations") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)], F.sum((F.col("continuations") >= 3).cast("long")).alias("n3up")).first()
    word_discounts = discounts([tally[f"n{k}"] or 0 for k in (1, 2, 3, 4)])
    types = sum(bigrams.sizes)
    held = sum(d * (tally[name] or 0) for d, name in zip(word_discounts, ("n1", "n2", "n3up")))
    words = _word_files(rows, f"{folder}/per-word", distinct + 1)
    return LanguageModel(vocabulary, bigrams, words, total, distinct, types, bigram_discounts, word_discounts, held / types if types else 1.0)


def _hot_words(spark: SparkSession, vocabulary: Sorted, total: int) -> list[int]:
    """Ids of the words that make up more than HOT_SHARE of all; a task a shard looks through its values."""
    least, offsets = max(1, int(total * HOT_SHARE)), vocabulary.offsets.tolist()
    folder, files = vocabulary.folder, vocabulary.files

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                if files[shard]:
                    at = np.flatnonzero(mapped(f"{folder}/{files[shard]}.values", "<u4") > least)
                    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + offsets[shard])], names=["id"])

    return [row["id"] for row in spark.range(len(files)).mapInArrow(found, "id long").collect()]


def id_pairs(vocabulary: Sorted, begin: int, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id before, id) of all words and ends; -1 for unknown words, ``begin`` before the first of a text."""
    sequence = with_ends(hashes, counts, END)
    known, inverse = np.unique(sequence, return_inverse=True)
    ids = vocabulary.find(known)[0][inverse]
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(counts + 1) - counts - 1] = begin
    return before, ids


def _word_files(rows: DataFrame, folder: str, n: int) -> Words:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        kinds = {"continuations": "<u4", "context": "<u8", "backoff": "<f8"}
        current, arrays = None, {}

        def closed() -> pa.RecordBatch:
            system.create_dir(root, recursive=True)
            name = f"{current:06d}-{uuid.uuid4().hex}"
            for column, values in arrays.items():
                with system.open_output_stream(f"{root}/{name}.{column}") as out:
                    out.write(values.tobytes())
            return _written("file", current, [0], [], name)

        for batch in batches:
            blocks, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in np.unique(blocks):
                if block != current:
                    if current is not None:
                        yield closed()
                    current, arrays = int(block), {c: np.zeros(min(WORD_BLOCK, n - int(block) * WORD_BLOCK), k) for c, k in kinds.items()}
                mine = blocks == block
                for column, values in arrays.items():
                    values[ids[mine] % WORD_BLOCK] = batch.column(column).to_numpy()[mine]
        if current is not None:
            yield closed()

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = rows.select(F.floor(F.col("id") / WORD_BLOCK).cast("int").alias("block"), "id", "continuations", "context", "backoff")
    files = [""] * max(1, -(-n // WORD_BLOCK))
    for row in stored(blocked.repartition(partitions, "block").sortWithinPartitions("block", "id").mapInArrow(tidy(run), WRITTEN), "lm-words").collect():
        files[row["shard"]] = row["path"]
    return Words(folder, files, n)


def scored(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_tokens (words and the end), n_known, train_tokens, base_score (add-half unigram) and score.

    Both scores are log10 probabilities of the whole text. A NULL or empty text has the end only. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        half = lm.total + 0.5 * (lm.distinct + 1)
        with np.errstate(over="ignore"):
            for batch in batches:
                for row, hashes, counts in word_hashes(as_large_text(batch.column(1))):
                    known, inverse = np.unique(with_ends(hashes, counts, END), return_inverse=True)
                    found, times = lm.vocabulary.find(known)
                    word, count = found[inverse], np.where(found >= 0, times, 0)[inverse]
                    starts = np.cumsum(counts + 1) - counts - 1
                    before = np.empty_like(word)
                    before[1:] = word[:-1]
                    before[starts] = lm.begin
                    score, base = np.log10(lm.probability(before, word)), np.log10((count + 0.5) / half)
                    n = len(counts)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(row, n), pa.array((counts + 1).astype(np.int64)), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                        pa.array(np.full(n, lm.total, np.int64)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts)),
                    ], names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = T.StructType().add(id_col, docs.schema[id_col].dataType)
    for name, kind in (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())):
        schema = schema.add(name, kind)
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(tidy(rows), schema)


def scored_with_holdout(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """All documents scored by a model of those outside the held-out fold, with held_out. Perplexity is 10^(-score / n_tokens)."""
    model = train(docs.where(in_training(id_col, folds, fold)), text_col)
    found = scored(docs, model, id_col, text_col)
    return found.select(id_col, (~in_training(id_col, folds, fold)).alias("held_out"), *found.columns[1:])
