"""Periodic runs of words: tiles per octave of periods, solved on their own, fragments stitched by document and period.

A run of period q has at least 4q words, so its words agree with those q places on over a stretch of 3q or more. For periods of
an octave [s, 2s) such a stretch holds a whole core of 2s places that begins at a multiple of s. At every such boundary the forward
Z-values of all periods of the octave are compared with 2s at once: by prefix hashes, one comparison a place. What passes
is compared word by word to its ends, at most s places beyond the first and the last core.

A document of many words is cut into tiles per octave, which are dealt over the cluster; other documents are one tile, and many of
them are solved side by side. Fragments of a tile that reach its edge meet those of the next one by (document, period).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm import common
from twinledger.llm.common import WHITE_SPACE, as_large_text, stored, text_bytes, tidy
from twinledger.llm.words import hashed_words

# Least length of a run: this many words and this many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words of a tile; a longer document is cut. Octaves whose boundaries are at most a sixteenth of it apart share a tile.
TILE_WORDS = 1 << 16
# Bytes of text solved side by side.
CHUNK_BYTES = 4 << 20

_WORD = np.ones(256, dtype=bool)
_WORD[[ord(c) for c in WHITE_SPACE]] = False
_MASK = (1 << 64) - 1
_FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
SOLVED = "id long, n_words long, words_sha256 string, text string, fragments array<struct<period: bigint, start: bigint, end: bigint>>"
RUNS = "array<struct<start: bigint, period: bigint, length: bigint>>"
FOUND = f"id long, n_words long, runs {RUNS}, collapsed_text string, collapsed_sha256 string"


@functools.lru_cache(maxsize=1 << 16)
def _primes(n: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*found, n) if n > 1 else tuple(found)


class Tile:
    """Words as hashes; stretches of places i with words[i] == words[i + q]."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(common.mixed(words) * common._power("up", common.MULTIPLIER, n), out=self.sums[1:])
        self.down = common._power("down", pow(common.MULTIPLIER, -1, 2**64), n + 1)
        self.sure: dict[tuple[int, int], int] = {}

    def _hash(self, start: int, length: int) -> int:
        return ((int(self.sums[start + length]) - int(self.sums[start])) * int(self.down[start])) & _MASK

    def _repeats(self, start: int, length: int, period: int) -> bool:
        return self._hash(start, length - period) == self._hash(start + period, length - period)

    def _is_power(self, start: int, length: int, period: int) -> bool:
        """Whether a stretch repeats with a proper divisor of ``period`` already, whose octave then has the run."""
        least = period
        for p in _primes(period):
            while least % p == 0 and self._repeats(start, length, least // p):
                least //= p
        if least == period:
            return False
        if self.sure.get((start, least), 0) < length:
            if not np.array_equal(self.words[start: start + length - least], self.words[start + least: start + length]):
                return False
            self.sure[start, least] = length
        return True

    def fragments(self, s: int, first: int, boundaries: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
        """(period, start, end, whether it may go on outside of the tile) for periods [s, 2s) with a core at first + s * boundary."""
        n = len(self.words)
        if n < 4 * s or not len(boundaries):
            return
        hashes = common.mixed(np.arange(n + 2 * s, dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        hashes[: n - 2 * s + 1] = (self.sums[2 * s:] - self.sums[: n - 2 * s + 1]) * self.down[: n - 2 * s + 1]
        boundaries = boundaries[first + boundaries * s + 4 * s <= n + s]
        shifted = hashes[first + s: first + s + (len(hashes) - first - s) // s * s].reshape(-1, s)
        boundaries = boundaries[boundaries < len(shifted)]
        place, offset = np.nonzero(shifted[boundaries] == hashes[first + boundaries * s][:, None])
        order = np.lexsort((place, offset))
        at, period = boundaries[place[order]], s + offset[order]
        cut = np.flatnonzero((np.diff(period) != 0) | (np.diff(at) != 1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
            if a == b:
                continue
            q, core, last = int(period[a]), first + s * int(at[a]), first + s * int(at[b - 1])
            if self._is_power(core, 2 * s + q, q):
                continue
            low, high = max(0, core - s), min(last + 3 * s, n - q)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], self.words[low:high] == self.words[low + q: high + q], [False]]).astype(np.int8)))
            for x, y in zip(edges[::2] + low, edges[1::2] + low):
                # Cores are found by hashes; stretches that hold none were none.
                if y - x >= 2 * s and x <= last and y >= core + 2 * s:
                    yield q, int(x), int(y), bool(x == low or y == high)


def is_run(period: int, length: int) -> bool:
    return length >= max(LEAST_WORDS, LEAST_PERIODS * period)


def _octaves(n_words: int) -> Iterator[int]:
    s = 1
    while LEAST_PERIODS * s <= n_words:
        yield s
        s *= 2


def solved(words: np.ndarray, counts: np.ndarray) -> list[list[dict]]:
    """Fragments of each of some whole texts, whose words follow each other in ``words``."""
    n, texts = len(words) + len(counts), len(counts)
    ends = np.cumsum(counts) + np.arange(texts)
    starts = np.concatenate([[0], ends[:-1] + 1]) if texts else np.zeros(0, np.int64)
    is_end = np.zeros(n, dtype=bool)
    is_end[ends] = True
    joined = np.empty(n, np.uint64)
    joined[~is_end] = words
    joined[is_end] = common.mixed(np.arange(texts, dtype=np.uint64) + np.uint64(0xD1B54A32D192ED03))
    size_at, found, tile = np.repeat(counts, counts + 1), [[] for _ in range(texts)], Tile(joined)
    for s in _octaves(int(counts.max(initial=0))):
        boundaries = np.flatnonzero(size_at[::s] >= LEAST_PERIODS * s)
        for q, x, y, open_ in tile.fragments(s, 0, boundaries):
            if open_ or is_run(q, y - x + q):
                text = int(np.searchsorted(starts, x, side="right")) - 1
                found[text].append({"period": q, "start": x - int(starts[text]), "end": y - int(starts[text])})
    return found


def _solved(tile_words: int):
    """Rows (id, text) to (id, n_words, digest of the words, text, fragments). Documents of more than a tile have NULL fragments;
    those with none need their text no more."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = as_large_text(batch.column(1))
            _, offsets = text_bytes(column)
            row = 0
            while row < len(column):
                end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1)
                part = column.slice(row, end - row)
                data, cuts = text_bytes(part)
                words = hashed_words(data, cuts, _WORD, lower=False)
                short = words.counts <= tile_words
                found = iter(solved(words.hashes[np.repeat(short, words.counts)], words.counts[short]))
                fragments = [next(found) if s else None for s in short]
                digests = [hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest() if f == [] else None for a, b, f in zip(cuts[:-1], cuts[1:], fragments)]
                texts = [None if d else part[k].as_py() for k, d in enumerate(digests)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), pa.array(words.counts.astype(np.int64)), pa.array(digests, pa.string()), pa.array(texts, pa.string()),
                    pa.array(fragments, pa.list_(_FRAGMENT))], names=["id", "n_words", "words_sha256", "text", "fragments"])
                row = end
    return tidy(rows)


def tiles(n_words: int, tile_words: int) -> Iterator[tuple[list[int], int, int, int, int]]:
    """(octaves, first word, end word, first boundary, end of the boundaries) of the tiles of a long document."""
    octaves = list(_octaves(n_words))
    shared = [s for s in octaves if 16 * s <= tile_words]
    groups = ([shared] if shared else []) + [[s] for s in octaves if 16 * s > tile_words]
    for group in groups:
        s = group[-1]
        stride = max(tile_words // s * s, 4 * s)
        for start in range(0, n_words, stride):
            yield group, max(0, start - s), min(n_words, start + stride + 5 * s), start, min(n_words, start + stride)


def _tiled(tile_words: int):
    """Rows (row, text) to tiles (row, octaves, first, low, high, words): boundaries [low, high), counted from the tile's first word."""
    names = ["row", "octaves", "first", "low", "high", "words"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                words = hashed_words(data, np.array([0, len(data)]), _WORD, lower=False).hashes
                for octaves, first, end, low, high in tiles(len(words), tile_words):
                    values = ([row], [octaves], [first], [low - first], [high - first], [words[first:end].tobytes()])
                    kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=names)
    return tidy(rows)


def _of_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles to fragments (row, period, start, end)."""
    for batch in batches:
        for row, octaves, first, low, high, words in zip(*(batch.column(k) for k in range(6))):
            tile, out = Tile(np.frombuffer(words.as_py(), np.uint64)), []
            for s in octaves.as_py():
                for q, x, y, open_ in tile.fragments(s, low.as_py(), np.arange(-(-(high.as_py() - low.as_py()) // s))):
                    if open_ or is_run(q, y - x + q):
                        out.append((row.as_py(), q, x + first.as_py(), y + first.as_py()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "period", "start", "end"])


def _collapsed(with_text: bool):
    """Rows (id, n_words, text, runs) to (id, n_words, runs, text without repetitions, its digest)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, digests = [], []
            for text, runs in zip(batch.column(2), batch.column(3).to_pylist()):
                words = text.as_py().encode().split()
                dropped = np.zeros(len(words), dtype=bool)
                for run in runs:
                    dropped[run["start"] + run["period"]: run["start"] + run["length"]] = True
                collapsed = b" ".join(word for word, gone in zip(words, dropped) if not gone)
                texts.append(collapsed.decode() if with_text and runs else None)
                digests.append(hashlib.sha256(collapsed).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                names=["id", "n_words", "runs", "collapsed_text", "collapsed_sha256"])
    return tidy(rows)


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs (row, start, length, period) out of fragments (row, period, start, end) that overlap or touch."""
    by_start = Window.partitionBy("row", "period").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = fragments.withColumn("begins", F.when(reached >= F.col("start"), 0).otherwise(1))
    numbered = begins.withColumn("stretch", F.sum("begins").over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = numbered.groupBy("row", "period", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = whole.select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_PERIODS))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, tile_words: int = TILE_WORDS) -> DataFrame:
    """Per document: its id, ``n_words``, ``runs`` (start, period and length in words; by start, then period), ``collapsed_text`` (the
    words joined by one space, every run cut to its first period; NULL without ``with_text`` or without a run), ``collapsed_sha256``.

    Words are runs of other characters than white space and are compared by 64-bit hashes of their bytes. A run is a stretch of at
    least LEAST_WORDS words and LEAST_PERIODS of its smallest period that neither neighbour extends.

    NULL and empty texts have no words and no runs. Every row counts by itself, whether ids are NULL or repeated. A text of any length
    is searched whole. Other columns are ignored; an empty table gives an empty result.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Numbers of rows hold because they are read from what was written.
    kept = stored(given.mapInArrow(_solved(tile_words), SOLVED).withColumn("row", F.monotonically_increasing_id()), "runs-solved")
    here = kept.select("row", F.explode("fragments").alias("f")).select("row", "f.*")
    cut = kept.where("fragments IS NULL").select("row", "text").repartition("row").mapInArrow(
        _tiled(tile_words), "row long, octaves array<bigint>, first long, low long, high long, words binary")
    there = cut.repartition("row", "octaves", "first").mapInArrow(tidy(_of_tiles), "row long, period long, start long, end long")
    runs = stitched(here.unionByName(there)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    none = F.expr(f"CAST(array() AS {RUNS})")
    repeating = kept.where("text IS NOT NULL").join(runs, "row", "left").select("id", "n_words", "text", F.coalesce("runs", none).alias("runs"))
    others = kept.where("text IS NULL").select("id", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed_text"), F.col("words_sha256").alias("collapsed_sha256"))
    return others.unionByName(repeating.mapInArrow(_collapsed(with_text), FOUND)).withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with a repetition in those whose id has a checksum divisible by ten: words from some place on repeat with some
    period. Others, and those without an id or a word, stay as they are."""
    checksum = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = docs.withColumn("_g", F.when(checksum % 10 == 0, F.floor(checksum / 10)))
    split = chosen.withColumn("_w", F.when(F.col("_g").isNotNull(), F.expr(rf"filter(split(`{text_col}`, '[\\x20\\x09-\\x0D]+'), x -> x <> '')")))
    placed = split.withColumn("_n", F.size("_w").cast("long")).withColumn("_a", F.expr("CASE WHEN _n > 0 THEN _g % _n END"))
    timed = placed.withColumn("_p", F.expr("1 + (_n - _a) DIV (3 + _g % 8)"))
    planted = "array_join(transform(sequence(0L, _n - 1), i -> _w[CAST(CASE WHEN i < _a THEN i ELSE _a + (i - _a) % _p END AS INT)]), ' ')"
    return timed.withColumn(text_col, F.expr(f"CASE WHEN _n > 0 THEN {planted} ELSE `{text_col}` END")).select(*docs.columns)


def summarised(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The greatest run of each document and digests of all of them."""
    greater = "x.length * best.period > best.length * x.period"
    best = found.withColumn("best", F.expr(f"CASE WHEN size(runs) > 0 THEN aggregate(slice(runs, 2, size(runs)), element_at(runs, 1), (best, x) -> CASE WHEN {greater} THEN x ELSE best END) END"))
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return best.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


SQL = r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda acc, x: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(acc, x)), 4294967295), 4294967295) AS h
  FROM documents
),
chosen AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM hashed),
placed AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM chosen),
timed AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM placed),
d AS (
  SELECT doc_id, n, unnest(CASE WHEN planted THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END) AS word,
    unnest(range(n)) AS i
  FROM timed
),
matched AS (
  SELECT x.doc_id, y.i - x.i AS period, x.i FROM d x JOIN d y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM matched),
stretches AS (
  SELECT doc_id, period, min(i) AS start, count(*) + period AS length FROM islands GROUP BY doc_id, period, island
  HAVING count(*) + period >= greatest(6, 4 * period)
),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM stretches GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id
),
best AS (
  SELECT doc_id, start, length, period, 1000 * length // period AS exponent_milli FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DECIMAL(38, 20)) / period DESC, start, period) = 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
collapsed AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM d ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM timed LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""
