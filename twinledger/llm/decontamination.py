"""Benchmark passages in training documents: an index per shard of documents, phrases looked up backwards, spans merged."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import as_large_text, file_system, shared_folder, text_bytes, tidy
from twinledger.llm.fm_index import FmIndex
from twinledger.llm.words import Words, hashed_words

# Words of a phrase; an item with fewer is one phrase.
PHRASE_WORDS = 10
# Bytes of text and words of one index; a longer document is cut into overlapping pieces.
SHARD_BYTES = 6 << 20
SHARD_WORDS = 1 << 20
# Phrases looked up at once.
PHRASES = 1 << 15

_WORD = np.zeros(256, dtype=bool)
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_WORD[0x80:] = True

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("clean_text", T.StringType()),
])


def _phrases(size: int):
    """Rows (item, text) to (item, words of a phrase as bytes)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, phrases = [], []
            words = hashed_words(*text_bytes(as_large_text(batch.column(1))), _WORD, lower=True)
            at = 0
            for item, count in zip(batch.column(0).to_pylist(), words.counts):
                for start in range(at, at + max(count - size + 1, min(count, 1))):
                    items.append(item)
                    phrases.append(words.hashes[start: min(start + size, at + count)].tobytes())
                at += count
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(phrases, pa.binary())], names=["item", "phrase"])
    return rows


def _phrase_blocks(path: str) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(distinct phrases of one length as rows of words, per phrase the names of its items)."""
    fs, folder = file_system(path)
    for batch in pads.dataset(folder, filesystem=fs, format="parquet").to_batches(batch_size=PHRASES, batch_readahead=1, fragment_readahead=1, use_threads=False):
        by_length: dict[int, dict[bytes, set]] = {}
        for item, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_length.setdefault(len(phrase) // 8, {}).setdefault(phrase, set()).add(item)
        for length, phrases in by_length.items():
            yield np.frombuffer(b"".join(phrases), np.uint64).reshape(-1, length), [sorted(i for i in items if i is not None) for items in phrases.values()]


class _Benchmark:
    """The phrases in the shared folder, kept by the task if they are few, else read again for each shard."""

    def __init__(self, path: str):
        self.path, self.kept = path, None
        fs, folder = file_system(path)
        self.few = pads.dataset(folder, filesystem=fs, format="parquet").count_rows() <= 4 * PHRASES

    def __iter__(self):
        if not self.few:
            return _phrase_blocks(self.path)
        if self.kept is None:
            self.kept = list(_phrase_blocks(self.path))
        return iter(self.kept)


def _shards(counts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first text, its first word in this shard, words of each text); pieces of a long text overlap by a phrase less a word."""
    if counts.sum() <= SHARD_WORDS or len(counts) > 1:
        yield 0, 0, counts
        return
    for start in range(0, max(1, int(counts[0]) - size + 1), SHARD_WORDS):
        yield 0, start, np.array([min(SHARD_WORDS + size - 1, counts[0] - start)])


def _looked_up(words: Words, benchmark: _Benchmark, size: int) -> tuple[np.ndarray, list[set]]:
    """(which words are hit, the items found in each text)."""
    hit, items = np.zeros(len(words.hashes), dtype=bool), [set() for _ in words.counts]
    for _, start, counts in _shards(words.counts, size):
        part = words.hashes[start: start + counts.sum()]
        index, edges = FmIndex(part, counts), np.zeros(len(part) + 1, np.int64)
        for phrases, names in benchmark:
            phrase, text, place = index.occurrences(phrases)
            edges += np.bincount(place, minlength=len(edges)) - np.bincount(place + phrases.shape[1], minlength=len(edges))
            for pair in np.unique(text * len(phrases) + phrase).tolist():
                items[pair // len(phrases)].update(names[pair % len(phrases)])
        hit[start: start + len(part)] |= np.cumsum(edges)[:-1] > 0
    return hit, items


def _of_documents(path: str, size: int, names: Sequence[str], text_at: int, cleaned: bool):
    def chunk(column: pa.LargeStringArray, benchmark: _Benchmark) -> list[tuple]:
        data, offsets = text_bytes(column)
        words = hashed_words(data, offsets, _WORD, lower=True)
        hit, items = _looked_up(words, benchmark, size)
        out, at = [], 0
        for row, count in enumerate(words.counts.tolist()):
            mine = hit[at: at + count]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
            text = None
            if cleaned and spans:
                cuts = [(words.starts[at + a], words.ends[at + b - 1]) for a, b in spans]
                bounds = [offsets[row], *[x for cut in cuts for x in cut], offsets[row + 1]]
                text = b"".join(data[a:b].tobytes() for a, b in zip(bounds[::2], bounds[1::2])).decode()
            out.append((count, int(mine.sum()), sorted(items[row]), [{"start": a, "end": b} for a, b in spans], text))
            at += count
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = _Benchmark(path)
        types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        for batch in batches:
            column = as_large_text(batch.column(text_at))
            _, offsets = text_bytes(column)
            row = 0
            while row < len(column):
                end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SHARD_BYTES, side="right")) - 1)
                found = list(zip(*chunk(column.slice(row, end - row), benchmark)))
                kept = [batch.column(k).slice(row, end - row) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, t) for c, t in zip(found, types)]], names=[*names, *FOUND.names])
                row = end
    return tidy(rows)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", phrase_words: int = PHRASE_WORDS, keep: Sequence[str] | None = None, cleaned: bool = False) -> DataFrame:
    """Per document what of it occurs in benchmark items: the columns ``keep`` (by default its id), ``n_words``, ``n_hit``, ``items``
    (their ids as text, sorted), merged ``spans`` of hit words [start, end) and, if ``cleaned``, ``clean_text`` without them.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z as a-z. A phrase is ``phrase_words`` consecutive words of an
    item, or all words of a shorter one. Words are compared by 64-bit hashes. ``clean_text`` is NULL where nothing is cut.

    NULL and empty texts have no words; an item without words, or an empty benchmark, finds nothing. Words of an item without an id
    are hit, but the item is not listed. Items that share an id are listed once; repeated documents are rows of their own. A document
    of any length is looked through whole, in overlapping pieces. Columns named like a result cannot be kept.
    """
    names = [id_col] if keep is None else list(keep)
    clashing = sorted(set(names) & set(FOUND.names))
    if clashing or len(set(names)) < len(names):
        raise ValueError(f"columns {clashing or names} cannot be kept next to the results")
    path = shared_folder(docs.sparkSession, "phrases")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    items.mapInArrow(_phrases(phrase_words), "item string, phrase binary").write.parquet(path)
    given = docs.select(*dict.fromkeys([*names, text_col]))
    schema = T.StructType([*given.schema.fields[: len(names)], *FOUND.fields])
    return given.mapInArrow(_of_documents(path, phrase_words, names, given.columns.index(text_col), cleaned), schema)


def without_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, the spans of benchmark passages cut out of their texts.

    A document that holds nothing else keeps what stands around its words, down to an empty text. NULL stays NULL.
    """
    numbered = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    text = numbered.columns[docs.columns.index(text_col)]
    found = contamination(numbered, benchmark, text_col=text, keep=numbered.columns, cleaned=True, **options)
    return found.withColumn(text, F.coalesce("clean_text", text)).select(*numbered.columns).toDF(*docs.columns)


def summarised(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of the items instead of lists."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows))
),
hits AS (SELECT doc_id, item, i, k FROM places JOIN windows USING (k, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
