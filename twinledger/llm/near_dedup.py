"""Near duplicates: minima of many universal hashes over word shingles, banding, signature check, full check, components.

Equal shingle sets become one class first. In each bucket of a band every class is compared with the bucket's lead, the class
that shares most buckets with others (the original of a family of edited copies is nearer to all of them than they are to each
other). What these links connect needs no further comparison. A second lead is taken from what the first left apart. Buckets that
hold several components still are joined to clusters, whose members are compared in blocks inside tasks, which pass on links but
no pairs. So every pair that shares a bucket is connected or compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import as_large_text, mixed, stored, tidy, word_hashes
from twinledger.llm.components import connected_components

# 32 bands of 5 minima miss a pair of similarity 0.8 with a chance of 0.672^32 = 3e-6.
BANDS = 32
ROWS = 5
# Pairs whose signatures agree in a share this far below the threshold aren't checked in full: 4 standard deviations.
SLACK = 0.13
# Members of a cluster that are compared as one block.
BLOCK = 1024

_generator = np.random.default_rng(77)
_FACTORS = _generator.integers(0, 2**63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _generator.integers(0, 2**64, size=BANDS * ROWS, dtype=np.uint64)
_CHAIN = np.uint64(0x9E6C63D0876A9A47)
_HALF = np.uint64(32)


def _sets(words: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each document, sorted; of a shorter document one hash of all its words."""
    n = max(0, len(words) - size + 1)
    chained = np.zeros(n, np.uint64)
    for k in range(size):
        chained = chained * _CHAIN + words[k: k + n]
    chained = mixed(chained)
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(np.unique(chained[at: at + count - size + 1]))
        elif count:
            whole = np.uint64(count)
            for word in words[at: at + count]:
                whole = whole * _CHAIN + word
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal hashes (a*x + b, upper half), one row of 32-bit values per set that isn't empty."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    values = np.concatenate(sets)
    out = np.empty((len(sets), len(_FACTORS)), np.uint32)
    for j, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS)):
        out[:, j] = np.minimum.reduceat((values * factor + shift) >> _HALF, starts)
    return out


def _doc_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    with np.errstate(over="ignore"):
        for row, words, counts in word_hashes(as_large_text(batch.column(1))):
            yield row, _sets(words, counts, size)


def _signed(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for row, sets in _doc_sets(batch, size):
                    n = np.array([len(s) for s in sets], np.int64)
                    full = [s for s in sets if len(s)]
                    one, two, signature = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64), [None] * len(sets)
                    if full:
                        where = np.flatnonzero(n)
                        one[where] = [np.add.reduce(mixed(s ^ _SHIFTS[0])) for s in full]
                        two[where] = [np.bitwise_xor.reduce(mixed(s * _FACTORS[1])) for s in full]
                        for k, values in zip(where.tolist(), _signatures(full)):
                            signature[k] = values.tobytes()
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(signature, pa.binary())],
                                                     names=["_id", "_n", "_f1", "_f2", "_sig"])
    return rows


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            if not len(batch):
                continue
            signatures = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(batch), BANDS, ROWS).astype(np.uint64)
            buckets = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), signatures.shape[:2]).copy()
            for k in range(ROWS):
                buckets = mixed(buckets * _CHAIN + signatures[:, :, k])
            yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS))], names=["bucket", "rep"])


@F.pandas_udf(T.DoubleType())
def _agreement(one: pd.Series, two: pd.Series) -> pd.Series:
    width = BANDS * ROWS
    a, b = (np.frombuffer(b"".join(x), np.uint32).reshape(-1, width) for x in (one, two))
    return pd.Series((a == b).mean(axis=1))


def _similar(percent: float):
    """Pairs (a, b, set of a, set of b) to those whose sets are similar enough; sets are read where Arrow has them."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for row, (one, two) in enumerate(zip(batch.column(2), batch.column(3))):
                one, two = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep[row] = 100 * common >= percent * (len(one) + len(two) - common)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])
    return rows


def _set_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in _doc_sets(batch, size):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["_id", "_set"])
    return rows


def _apart(percent: float):
    """Of blocks of classes (id, component, set size, signature, set): links between components, as many as join them."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                members = batch.column(0)[row].values
                ids, sizes = members.field("rep").to_numpy(), members.field("_n").to_numpy()
                _, parts = np.unique(members.field("part").to_numpy(), return_inverse=True)
                signatures = np.frombuffer(b"".join(members.field("_sig").to_pylist()), np.uint32).reshape(len(ids), -1)
                sets = [np.frombuffer(x, np.uint64) for x in members.field("_set").to_pylist()]
                found = []
                for i in range(len(ids) - 1):
                    small, large = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
                    rest = np.flatnonzero((parts[i + 1:] != parts[i]) & (100 * small >= percent * large)) + i + 1
                    near = rest[(signatures[rest] == signatures[i]).mean(axis=1) >= percent / 100 - SLACK]
                    for j in near.tolist():
                        if parts[i] != parts[j]:
                            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                                found.append((ids[i], ids[j]))
                                parts[parts == parts[j]] = parts[i]
                if found:
                    a, b = np.array(found, np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: its id, n_shingles, component_id (smallest id reachable by links), kept (it is that id).

    Linked are documents whose sets of word shingles have 100 * intersection >= percent * union. Text is lower-cased (A-Z) and
    split at white space. A document with fewer words than a shingle is one shingle; one without words, or a NULL text, has
    none and links with nothing. Rows that share an id are one node, with the links of the
    one with most shingles. Rows without an id are linked with nothing: their
    component is NULL and they are kept. Other columns are ignored. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    signed = stored(texts.mapInArrow(tidy(_signed(shingle_words)), "_id long, _n long, _f1 long, _f2 long, _sig binary"), "near-signatures")
    linkable = signed.where("_n > 0 AND _id IS NOT NULL")
    # Equal sets are one class; combined before the shuffle, so a large group of copies is one row per task.
    classes = stored(linkable.groupBy("_n", "_f1", "_f2").agg(F.min("_id").alias("rep")), "near-sets")
    members = stored(linkable.select("_id", "_n", "_f1", "_f2").join(classes, ["_n", "_f1", "_f2"]).select("_id", "_n", "rep"), "near-members")
    own = members.where("_id = rep").select("_id").distinct()
    reps = stored(linkable.join(own, "_id", "left_semi").groupBy(F.col("_id").alias("rep")).agg(F.max(F.struct("_n", "_sig")).alias("x")).select("rep", "x._n", "x._sig"), "near-classes")
    bands = reps.select("rep", "_sig").mapInArrow(tidy(_banded), "bucket long, rep long")
    sizes = stored(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
    shared = stored(bands.join(sizes, "bucket"), "near-buckets")
    weights = stored(shared.groupBy("rep").agg(F.sum("size").alias("weight")), "near-weights")
    ranked = stored(shared.join(weights, "rep").select("bucket", "size", "rep", "weight"), "near-ranked")

    # The full sets of all classes that share a bucket with another one, worked out once.
    sets = stored(texts.join(weights.select(F.col("rep").alias("_id")), "_id", "left_semi").mapInArrow(tidy(_set_rows(shingle_words)), "_id long, _set binary"), "near-sets")
    sets = sets.groupBy(F.col("_id").alias("rep")).agg(F.max(F.struct(F.octet_length("_set").alias("n"), "_set")).alias("x")).select("rep", "x._set")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those whose signatures and then whose full sets are similar enough."""
        side = lambda df, name: df.select(*[F.col(c).alias(name if c == "rep" else f"{c}_{name}") for c in df.columns])
        sized = pairs.join(side(reps, "a"), "a").join(side(reps, "b"), "b").where(100 * F.least("_n_a", "_n_b") >= percent * F.greatest("_n_a", "_n_b"))
        likely = stored(sized.where(_agreement("_sig_a", "_sig_b") >= percent / 100 - SLACK).select("a", "b"), "near-pairs")
        both = likely.join(side(sets, "a"), "a").join(side(sets, "b"), "b").select("a", "b", "_set_a", "_set_b")
        return stored(both.mapInArrow(tidy(_similar(percent)), "a long, b long"), "near-links")

    def parted(parts: DataFrame | None) -> DataFrame:
        """The rows of buckets that hold several components."""
        if parts is None:
            return ranked.withColumn("part", F.col("rep"))
        now = stored(ranked.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "size", "rep", "weight", F.coalesce("component", "rep").alias("part")), "near-parted")
        unsettled = stored(now.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket"), "near-unsettled")
        return now.join(unsettled, "bucket")

    def led(rows: DataFrame, name: str) -> DataFrame:
        first = F.max(F.struct("weight", (-F.col("rep")).alias("minus"), "part"))
        return stored(rows.groupBy("bucket").agg(first.alias("lead")).select("bucket", (-F.col("lead.minus")).alias(name), F.col("lead.part").alias(f"{name}_part")), "near-leads")

    ordered = lambda one, two: (F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    open_rows = parted(None)
    stars = open_rows.join(led(open_rows, "lead"), "bucket").where("rep <> lead").select(*ordered("lead", "rep")).distinct()
    stars = stored(stars, "near-stars")
    first = stored(connected_components(linked(stars)), "near-first")
    open_rows = stored(parted(first), "near-open")
    rest = open_rows.join(led(open_rows, "lead"), "bucket").where("part <> lead_part").drop("lead", "lead_part")
    again = stored(open_rows.join(led(rest, "lead"), "bucket").where("part <> lead_part").select(*ordered("lead", "rep")).distinct().join(stars, ["a", "b"], "left_anti"), "near-stars")
    star_links = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    first = stored(connected_components(star_links.unionAll(linked(again))), "near-first")
    open_rows = stored(parted(first), "near-open")
    heads = stored(open_rows.groupBy("bucket").agg(F.min("part").alias("head")), "near-heads")
    clusters = stored(connected_components(open_rows.join(heads, "bucket").where("part <> head").select(F.col("part").alias("a"), F.col("head").alias("b")).distinct()), "near-clusters")
    clustered = stored(open_rows.select("rep", "part").distinct().join(clusters.select(F.col("node").alias("part"), F.col("component").alias("cluster")), "part"), "near-clustered")
    counts = stored(clustered.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "near-counts")
    # Each block meets itself and every other block of its cluster once.
    dealt = clustered.join(counts, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "part")
    described = dealt.join(reps, "rep").join(sets, "rep").select("cluster", "i", "j", F.struct("rep", "part", "_n", "_sig", "_set").alias("m"))
    second = stored(described.groupBy("cluster", "i", "j").agg(F.collect_list("m").alias("members")).select("members").mapInArrow(tidy(_apart(percent)), "a long, b long"), "near-links")
    links = first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(second)
    parts = connected_components(links).withColumnRenamed("node", "rep")
    found = members.join(parts, "rep", "left").select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    rest = signed.where("_n = 0 OR _id IS NULL").select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.col("_id").alias("component_id"))
    return found.unionAll(rest).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: the one with the smallest id of each group, with all their columns.

    Different texts that share an id are documents of their own, each judged by its own text; in a group they come after those whose
    id is theirs alone. Rows that repeat id and text are one document and stay or go together. Rows without an id stay.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_key"))
    apart = keyed.where("_id IS NOT NULL").groupBy("_id").agg(F.min("_key").alias("x"), F.max("_key").alias("y")).where("x <> y").select("_id")
    # Numbers hold because they are read from what was written.
    named = stored(keyed.join(apart, "_id").distinct().withColumn("_number", F.monotonically_increasing_id()), "near-shared-ids")
    if named.isEmpty():
        gone = near_duplicates(docs, id_col, text_col, shingle_words, percent).where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
        return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti").select(*docs.columns)
    top = keyed.agg(F.max("_id")).first()[0]
    numbered = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    its_id, its_text = (F.col(f"_{docs.columns.index(c)}") for c in (id_col, text_col))
    noded = numbered.withColumns({"_id": its_id.cast("long"), "_key": F.xxhash64(its_text.cast("string"))}).join(named, ["_id", "_key"], "left").withColumn(
        "_node", F.coalesce(F.col("_number") + (top + 1), "_id"))
    gone = near_duplicates(noded.select("_node", its_text.alias("_text")), "_node", "_text", shingle_words, percent).where("NOT kept").select(F.col("_node").alias("_gone"))
    return noded.join(gone.distinct(), F.col("_node") == F.col("_gone"), "left_anti").select(*numbered.columns).toDF(*docs.columns)
