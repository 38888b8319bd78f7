"""Near duplicates of embeddings by lattice hashing, verified by cosine.

Each table projects unit vectors at random to 8 dimensions and decodes them to the nearest point of the lattice E8. A vector owns
its cell and visits the next nearest cells, so a pair meets if one of them owns a cell that the other owns or visits. Pairs of a
cell are compared in blocks inside tasks, which pass on numbers of links and local components but no pairs; a pair that meets in
several cells counts in the first only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import mixed, stored
from twinledger.llm.components import connected_components

# At cosine 0.9 a pair meets in one table with probability 0.47 (simulated), in none of 12 with 0.0005.
TABLES = 12
VISITS = 2
CELL = 1.6
# Members of a cell that are compared as one block.
BLOCK = 512

_projections: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _projection(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    if dimensions not in _projections:
        generator = np.random.default_rng([8, dimensions])
        _projections[dimensions] = generator.normal(size=(dimensions, TABLES * 8)) / CELL, generator.uniform(0, 2, size=TABLES * 8)
    return _projections[dimensions]


def nearest_points(x: np.ndarray, visits: int) -> np.ndarray:
    """The nearest point of E8 and some of the next nearest, nearest first, in half units: [n, 1 + visits, 8] of integers.

    E8 is D8 (integers of even sum) and D8 shifted by a half. In each of the two the nearest point rounds every coordinate and,
    if the sum is odd, the worst one to its other side; the next ones round another coordinate to its other side instead.
    """
    points, distances, row = [], [], np.arange(len(x))
    for shift in (0.0, 0.5):
        y = x - shift
        rounded = np.round(y)
        error = y - rounded
        worst = np.argsort(-np.abs(error), axis=1, kind="stable")
        other = np.where(error >= 0, 1.0, -1.0)
        odd = rounded.sum(axis=1) % 2 != 0

        def turned(*places: int) -> np.ndarray:
            out = rounded.copy()
            for place in places:
                k = worst[:, place]
                out[row, k] += other[row, k]
            return out

        for if_odd, if_even in (((0,), ()), ((1,), (0, 1)), ((2,), (0, 2)), ((0, 1, 2), (1, 2))):
            point = np.where(odd[:, None], turned(*if_odd), turned(*if_even))
            points.append(2 * (point + shift))
            distances.append(((y - point) ** 2).sum(axis=1))
    order = np.argsort(np.stack(distances, axis=1), axis=1, kind="stable")[:, : 1 + visits]
    return np.stack(points, axis=1)[row[:, None], order].astype(np.int64)


def cells(unit: np.ndarray) -> np.ndarray:
    """Keys of the cells of unit vectors: [n, tables, 1 + visits], the owned one first."""
    weights, offsets = _projection(unit.shape[1])
    projected = (unit @ weights + offsets).reshape(-1, 8)
    points = nearest_points(projected, VISITS).astype(np.uint64)
    keys = np.repeat(np.tile(np.arange(1, TABLES + 1, dtype=np.uint64), len(unit)), 1 + VISITS).reshape(-1, 1 + VISITS) + np.uint64(unit.shape[1] << 8)
    with np.errstate(over="ignore"):
        for k in range(8):
            keys = mixed(keys * np.uint64(0x9E6C63D0876A9A47) + points[:, :, k])
    return keys.reshape(len(unit), TABLES, 1 + VISITS)


def _unit(data: list[bytes], dtype: str) -> np.ndarray:
    values = np.frombuffer(b"".join(data), dtype).reshape(len(data), -1).astype(np.float64)
    # A power of two changes no digit; squares of the largest or the smallest numbers would be infinite or 0 otherwise.
    values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1, keepdims=True))[1])
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _packed(dtype: str):
    """Rows (id, vector) to (id, vector as bytes, or NULL where it can't link)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = np.asarray(pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False), np.float64)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            limits = np.concatenate([[0], np.cumsum(sizes)])
            out = []
            for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
                vector = values[a:b]
                usable = b > a and np.isfinite(vector).all() and vector.any()
                out.append((vector + 0.0).astype(dtype).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["_id", "_vec"])
    return rows


def _celled(dtype: str):
    """Rows (rep, vector) to (key, owner, rep)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, reps = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                keys = cells(_unit([vectors[k] for k in mine], dtype))
                owner = np.zeros(keys.shape, dtype=bool)
                owner[:, :, 0] = True
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(owner.ravel()), pa.array(np.repeat(reps[mine], keys[0].size))], names=["key", "owner", "rep"])
    return rows


def _meeting(own: np.ndarray, all_: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (a, b): per table whether they meet in the cell that a owns, and in the one that b owns."""
    return (all_[b] == own[a][:, :, None]).any(axis=2), (all_[a] == own[b][:, :, None]).any(axis=2)


def _compared(dtype: str, least: float):
    """Rows (key, i, j, block, owner, rep, times, vector) sorted by (key, i, j) to (rep, links, root)."""
    def of_group(key: int, i: int, j: int, block: np.ndarray, owner: np.ndarray, rep: np.ndarray, times: np.ndarray, vectors: list[bytes]):
        unit = _unit(vectors, dtype)
        near = unit @ unit.T >= least
        near &= owner[:, None] | owner[None, :]
        if i != j:
            near &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(near, 1))
        if not len(a):
            return None
        used, places = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = places[: len(a)], places[len(a):]
        all_ = cells(unit[used])
        own = all_[:, :, 0]
        ids = rep[used]
        smaller = ids[a] < ids[b]
        a, b = np.where(smaller, a, b), np.where(smaller, b, a)
        # The first cell of a pair: the lowest table in which they meet; in it the cell of the smaller id, if they meet there.
        in_a, in_b = _meeting(own, all_, a, b)
        table = (in_a | in_b).argmax(axis=1)
        n = np.arange(len(a))
        first = np.where(in_a[n, table], own[a, table], own[b, table])
        mine = first == np.uint64(key & 0xFFFFFFFFFFFFFFFF)
        a, b = a[mine], b[mine]
        if not len(a):
            return None
        weight = times[used]
        links = np.bincount(a, weight[b], minlength=len(used)) + np.bincount(b, weight[a], minlength=len(used))
        root = ids.copy()
        while True:
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            if (before == root).all():
                break
        found = links > 0
        return ids[found], links[found].astype(np.int64), root[found]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table, last: bool) -> tuple[list, pa.Table | None]:
            key, i, j = (table.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            limits = np.concatenate([[0], cuts, [len(key)]] if last else [[0], cuts]).astype(int)
            columns = [table.column(k).to_numpy() for k in range(3, 7)]
            vectors = table.column(7).to_pylist()
            out = [r for x, y in zip(limits[:-1], limits[1:]) if y - x > 1 and (r := of_group(int(key[x]), int(i[x]), int(j[x]), *[c[x:y] for c in columns], vectors[x:y])) is not None]
            return out, None if last else table.slice(limits[-1])

        def batch_of(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(3)], names=["rep", "links", "root"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            found, held = groups(pa.concat_tables([held, table]).combine_chunks() if held is not None else table, False)
            if found:
                yield batch_of(found)
        if held is not None and len(held):
            found, _ = groups(held.combine_chunks(), True)
            if found:
                yield batch_of(found)
    return rows


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9) -> DataFrame:
    """One row per vector: its id, n_links (other vectors linked directly), component_id (smallest id reachable), kept.

    Vectors of equal length with cosine >= ``least``, in double precision, are linked. A vector that is NULL, empty, zero or has
    a NULL or non-finite component links with nothing, as does a row without an id (its component is NULL and it is kept). Equal
    vectors are one class, whose members are linked with each other; rows that share an id count as vectors of their own.
    Other columns are ignored; an empty table gives an empty result.
    """
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    dtype = "<f4" if element == "float" else "<f8"
    given = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    packed = stored(given.mapInArrow(_packed(dtype), "_id long, _vec binary"), "vec-packed")
    linkable = packed.where("_vec IS NOT NULL AND _id IS NOT NULL")
    # A class goes by a number of its own, since ids may repeat; it holds because it is read from what was written.
    classes = stored(linkable.groupBy("_vec").agg(F.min("_id").alias("least_id"), F.count(F.lit(1)).alias("times")).withColumn("rep", F.monotonically_increasing_id()), "vec-classes")
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = classes.select("rep", "_vec").repartition(partitions, "rep").mapInArrow(_celled(dtype), "key long, owner boolean, rep long")
    owned = stored(owned, "vec-cells")
    sizes = stored(owned.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("owner").cast("int")).alias("any_owner")).where("size > 1 AND any_owner = 1").select(
        "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "vec-sizes")
    placed = owned.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "owner", "rep")
    full = dealt.join(classes.drop("least_id"), "rep").select("key", "i", "j", "block", "owner", "rep", "times", "_vec")
    compared = stored(full.repartition(partitions, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compared(dtype, least), "rep long, links long, root long"), "vec-links")
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(compared.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    parted = stored(classes.join(links, "rep", "left").join(parts, "rep", "left").select(
        "_vec", "least_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("part")), "vec-parted")
    known = stored(parted.join(parted.groupBy("part").agg(F.min("least_id").alias("component_id")), "part").select("_vec", "n_links", "component_id"), "vec-found")
    found = linkable.join(known, "_vec").select(F.col("_id").alias(id_col), "n_links", "component_id")
    rest = packed.where("_vec IS NULL OR _id IS NULL").select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return found.unionAll(rest).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
