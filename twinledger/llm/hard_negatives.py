"""Hard negatives by a secondary sort: scores packed into (anchor, descending score, id) keys, read off one after the other.

Rows are scored against anchors in blocks: a task holds a block of rows and streams the anchors past it from the shared folder, so
neither side is ever broadcast or held whole. Each block passes on only what can still count: first the best rows of an anchor's
label, later the best rows of every window that the anchor's positives open. These keys are dealt by anchor and sorted within
partitions; one pass opens a window at each positive and gives it the next negatives, holding the open windows and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import file_system, shared_folder, stored, tidy

# Bytes of the vectors of one block of rows, and of the scores worked out at once.
BLOCK_BYTES = 16 << 20
TILE_BYTES = 32 << 20
# Anchors read from storage at once.
ANCHORS = 1024
# Sums of products below this are exact in doubles, packed scores below the other fit a key.
EXACT = 1 << 53
LARGEST = 1 << 61

KEY = "no long, anchor_id long, down long, id long"


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places, vectors) for each dimension of a list column without NULLs."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for dim in np.unique(lengths):
        places = np.flatnonzero(lengths == dim)
        yield int(dim), places, values[starts[places][:, None] + np.arange(dim)]


def _blocks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimension, ids in ascending order, labels, quantised vectors) of as many rows as fit a block."""
    held: dict[int, list] = {}

    def block(dim: int):
        ids, labels, vectors = (np.concatenate(part) for part in zip(*held.pop(dim)))
        order = np.argsort(ids, kind="stable")
        return dim, ids[order], labels[order], vectors[order]

    for batch in batches:
        ids, labels = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=object)
        for dim, places, vectors in _vectors(batch.column(2)):
            held.setdefault(dim, []).append((ids[places], labels[places], np.floor(scale * vectors)))
            if sum(part[2].nbytes for part in held[dim]) + 64 * sum(len(part[0]) for part in held[dim]) > BLOCK_BYTES:
                yield block(dim)
    for dim in list(held):
        yield block(dim)


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, one row an anchor: int64, or whole Python numbers where these could be too small."""
    largest = [float(np.abs(m).max(initial=0)) for m in (rows, anchors)]
    if largest[0] * largest[1] * max(1, rows.shape[1]) < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = [np.array([[int(x) for x in v] for v in m], dtype=object).reshape(m.shape) for m in (anchors, rows)]
    return np.array([[sum((x * y for x, y in zip(a, r)), 0) for r in whole[1]] for a in whole[0]], dtype=object).reshape(len(anchors), len(rows))


def _tiles(path: str, dim: int, rows: np.ndarray, scale: float) -> Iterator[tuple[dict, np.ndarray]]:
    """(an anchor, its scores of all rows), the anchors streamed from the shared folder."""
    fs, folder = file_system(path)
    for batch in pads.dataset(folder, filesystem=fs, format="parquet").to_batches(batch_size=ANCHORS, batch_readahead=1, fragment_readahead=1, use_threads=False):
        anchors = batch.drop_columns(["vec"]).to_pylist()
        for d, places, vectors in _vectors(batch.column(batch.schema.get_field_index("vec"))):
            if d != dim:
                continue
            quantised, step = np.floor(scale * vectors), max(1, TILE_BYTES // (8 * len(rows)))
            for at in range(0, len(places), step):
                for place, scores in zip(places[at: at + step], _scores(rows, quantised[at: at + step])):
                    yield anchors[place], scores


def _best(scores: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Of ``places`` in id order, the first ``most`` by descending score."""
    return places[np.argsort(-scores[places], kind="stable")[:most]]


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the largest score of a negative: low * positive <= 100 * negative <= high * positive."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _keys(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Keys of (anchor number, anchor id, packed scores, ids)."""
    sizes = [len(f[3]) for f in found]
    scores = [int(s) for f in found for s in f[2]]
    if any(abs(s) > 2 * LARGEST for s in scores):
        raise OverflowError("a score does not fit 62 bits")
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)), pa.array(np.repeat(np.array([f[1] for f in found], np.int64), sizes)),
        pa.array(scores, pa.int64()), pa.array(np.concatenate([f[3] for f in found]).astype(np.int64))], names=["no", "anchor_id", "down", "id"])


def _of_block(path: str, scale: float, pick) -> object:
    """A task function that passes on the keys that ``pick(anchor, label codes, ids, scores, code)`` finds in each block."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, labels, vectors in _blocks(batches, scale):
            names, codes = np.unique(labels.astype(str), return_inverse=True)
            code_of, found, waiting = {name: k for k, name in enumerate(names)}, [], 0
            for anchor, scores in _tiles(path, dim, vectors, scale):
                places, kinds = pick(anchor, codes, ids, scores, code_of.get(anchor["label"], -1))
                if len(places):
                    found.append((anchor["no"], anchor["anchor_id"], -2 * scores[places] + kinds, ids[places]))
                    waiting += len(places)
                if waiting > 1 << 16:
                    yield _keys(found)
                    found, waiting = [], 0
            if found:
                yield _keys(found)
    return tidy(rows)


def _positives(most: int):
    def pick(anchor, codes, ids, scores, code):
        same = np.flatnonzero((codes == code) & (ids != anchor["anchor_id"]))
        return _best(scores, same, most), 0
    return pick


def _negatives(most: int, low: int, high: int):
    def pick(anchor, codes, ids, scores, code):
        windows = sorted({w for p in anchor["positives"] if (w := window(p, low, high))[0] <= w[1]})
        none = np.zeros(0, np.int64)
        if not windows:
            return none, 1
        inside = np.flatnonzero((codes != code) & (ids != anchor["anchor_id"]) & (scores >= windows[0][0]) & (scores <= max(w[1] for w in windows)))
        ordered = _best(scores, inside, len(inside))
        down, taken = -scores[ordered], []
        for least, largest in windows:
            start = np.searchsorted(down, -largest, side="left")
            taken.append(np.arange(start, min(start + most, np.searchsorted(down, -least, side="right"))))
        return ordered[np.unique(np.concatenate(taken)).astype(np.int64)] if len(inside) else none, 1
    return pick


def _emitted(most: int, low: int, high: int):
    """Sorted keys to (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, opened = None, []
        for batch in batches:
            out = []
            for no, anchor_id, down, id_ in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if no != current:
                    current, opened = no, []
                score = -(down >> 1)
                if not down & 1:
                    least, largest = window(score, low, high)
                    if least <= largest:
                        opened.append([id_, score, least, largest, 0])
                    continue
                opened = [w for w in opened if w[2] <= score and w[4] < most]
                for w in opened:
                    if score <= w[3]:
                        w[4] += 1
                        out.append((anchor_id, w[0], w[4], id_, w[1], score))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, columns)], names=names)
    return rows


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0) -> DataFrame:
    """For each row that ``anchors`` marks and each of its positives: the first negatives within the positive's window.

    A component x counts as floor(``scale`` * x), a score is the whole inner product with the anchor; higher scores come first, ties
    by smaller id. Positives are the first rows of the anchor's label, negatives the first of other labels whose score is between
    ``low`` and ``high`` percent of the positive's (none below a negative score). Scores are exact; one beyond 62 bits fails the job.

    Rows without id, label or vector, or with a NULL or non-finite component, take no part. Rows are compared if their vectors are
    equally long; empty vectors score 0. Every row counts by itself: repeated rows take several places, an anchor that occurs twice
    gives its results twice, and rows with the anchor's own id are neither its positives nor its negatives. Other columns are
    ignored; an empty table, no anchors or a single label give an empty result.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("0 <= low <= high <= 100 is needed: a window opens at its positive")
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vec"), F.coalesce(anchors, F.lit(False)).alias("chosen"))
    usable = given.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND abs(x) < double('infinity'))")
    rows, first = usable.select("id", "label", "vec"), shared_folder(spark, "anchors-first")
    # Numbers of anchors hold because they are read from what was written.
    usable.where("chosen").select(F.monotonically_increasing_id().alias("no"), F.col("id").alias("anchor_id"), "label", "vec").write.parquet(first)
    listed = spark.read.parquet(first)
    best = rows.mapInArrow(_of_block(first, scale, _positives(positives)), KEY)
    place = F.row_number().over(Window.partitionBy("no").orderBy("down", "id"))
    opening = stored(best.withColumn("place", place).where(F.col("place") <= positives).drop("place"), "positives")
    # Positives of an anchor are few by definition; their scores go with the anchor into the second pass.
    scored = opening.groupBy("no").agg(F.collect_list((-F.shiftright("down", 1)).cast("long")).alias("positives"))
    second = shared_folder(spark, "anchors-second")
    listed.join(scored, "no").write.parquet(second)
    following = rows.mapInArrow(_of_block(second, scale, _negatives(negatives, low, high)), KEY)
    dealt = opening.unionByName(following).repartition("no").sortWithinPartitions("no", "down", "id")
    return dealt.mapInArrow(tidy(_emitted(negatives, low, high)), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT * FROM negatives WHERE rank <= 5
"""
