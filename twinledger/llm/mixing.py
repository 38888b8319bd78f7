"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and once more with probability r - floor(r).
Which ones is decided by moving the vector of probabilities through the null space of the constraints (number of words, number
of documents) until all but a few are 0 or 1 (flight). Blocks of bounded size fly in parallel, what each leaves open flies
again with the rest of its source, until one block a source is left. There the last open documents land on the nearest total.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
# Documents that fly as one block, about.
BLOCK = 1_000
# Exchanges of documents that even out what the last open ones leave; each brings the total nearer.
EXCHANGES = 8
# A mix names its sources; more than this is refused, since targets are worked out on the driver and broadcast (some 10 MB).
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[float], weights: list[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """Shares of ``share`` times the sum of the sizes by weight, none above ``cap`` times its size; excess is shared again."""
    out, total = [0.0] * len(sizes), share * sum(sizes)
    free, left = [k for k, size in enumerate(sizes) if size > 0], total
    while free:
        unit = left / sum(weights[k] for k in free)
        full = [k for k in free if weights[k] * unit > cap * sizes[k]]
        if not full:
            for k in free:
                out[k] = weights[k] * unit
            break
        for k in full:
            out[k] = cap * sizes[k]
            left -= out[k]
        free = [k for k in free if k not in set(full)]
    return out


def flight(sizes: np.ndarray, probabilities: np.ndarray, generator: np.random.Generator) -> np.ndarray:
    """Moves equal probabilities to 0 or 1 keeping their sum and the sum of sizes, until at most two are between.

    Three open documents at a time: (1, 1, 1) and their sizes span the constraints, so the cross product of the two is the
    direction in which neither sum changes; of the two steps to a face of the cube one is drawn so that expectations hold.
    """
    p, size, eps = probabilities.tolist(), sizes.tolist(), 1e-9
    draws, drawn = generator.random(len(p) + 8).tolist(), 0
    held: list[int] = []
    for k in [*range(len(p)), -1, -1]:
        if k >= 0:
            if eps < p[k] < 1 - eps:
                held.append(k)
            else:
                p[k] = float(round(p[k]))
        while len(held) == 3 or (len(held) == 2 and size[held[0]] == size[held[1]]):
            if len(held) == 3:
                a, b, c = held
                v = [size[b] - size[c], size[c] - size[a], size[a] - size[b]]
                if not any(v):
                    v = [1.0, -1.0, 0.0]
            else:
                v = [1.0, -1.0]
            up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(held, v) if x)
            down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(held, v) if x)
            if drawn == len(draws):
                draws, drawn = generator.random(1024).tolist(), 0
            step = up if draws[drawn] * (up + down) < down else -down
            drawn += 1
            still = []
            for i, x in zip(held, v):
                p[i] += step * x
                if p[i] <= eps or p[i] >= 1 - eps:
                    p[i] = float(round(p[i]))
                else:
                    still.append(i)
            if len(still) == len(held):  # rounding kept all of them open; the nearest to a face goes there
                i = min(still, key=lambda j: min(p[j], 1 - p[j]))
                p[i] = float(round(p[i]))
                still.remove(i)
            held = still
    return np.array(p)


def landing(sizes: np.ndarray, probabilities: np.ndarray, want: float) -> np.ndarray:
    """Sets the last open probabilities to 0 or 1 so that all words together come nearest to ``want``.

    What these few cannot even out is evened out by the best exchanges, each of at most one document more and one less.
    """
    out, open_ = probabilities.copy(), np.flatnonzero((probabilities > 0) & (probabilities < 1))
    closed = float(sizes[probabilities == 1].sum())
    best = min(range(1 << len(open_)), key=lambda bits: (abs(closed + sum(float(sizes[i]) for k, i in enumerate(open_) if bits >> k & 1) - want), bits.bit_count(), bits))
    for k, i in enumerate(open_):
        out[i] = best >> k & 1
    for _ in range(EXCHANGES):
        lack = want - float(sizes[out == 1].sum())
        outside, inside = np.flatnonzero(out == 0), np.flatnonzero(out == 1)
        add = np.concatenate([[0.0], sizes[outside]])
        remove_order = np.argsort(sizes[inside], kind="stable")
        remove = np.concatenate([[0.0], sizes[inside][remove_order]])
        place = np.searchsorted(remove, add - lack)
        choices = np.stack([np.clip(place - 1, 0, len(remove) - 1), np.clip(place, 0, len(remove) - 1)])
        errors = np.abs(lack - add + remove[choices])
        row, k = np.unravel_index(np.argmin(errors), errors.shape)
        if errors[row, k] >= abs(lack):
            break
        if k:
            out[outside[k - 1]] = 1
        if choices[row, k]:
            out[inside[remove_order[choices[row, k] - 1]]] = 0
    return out


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[dict]:
    """One entry per source, by code point and NULL last: source, n, source_size, target, place."""
    rows = sized.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size")).orderBy(F.col("_source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goals = targets([row["size"] for row in rows], [weights[k % len(weights)] for k in range(len(rows))], share, cap)
    return [{"source": row["_source"], "n": row["n"], "source_size": row["size"], "target": goal, "place": k} for k, (row, goal) in enumerate(zip(rows, goals))]


def mixed_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
                 share: float = SHARE, cap: float = CAP, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """Per document: its id, size (words), source_size, target (of its source), times and taken (= times * size).

    A NULL text has size 0. A NULL source is a source of its own, the last. Documents without words are taken as their source
    is, at no cost. Rows that share an id are documents of their own. Reruns agree: draws depend on seed, ids and sizes only,
    rows that agree in all of these being alike. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    # Ids travel as text: pandas would turn numbers with NULLs among them into floats.
    id_type = docs.schema[id_col].dataType
    sized = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(source_col).cast("string").alias("_source"), _words(F.col(text_col)).alias("_size"))
    sized = stored(sized, "mix-sizes")
    goals = source_targets(sized, weights, share, cap)
    schema = "_source string, source_size long, target double, place int, rate double, blocks int"
    table = spark.createDataFrame([
        (g["source"], g["source_size"], float(g["target"]), g["place"], g["target"] / g["source_size"] if g["source_size"] else 0.0, max(1, math.ceil(g["n"] / block))) for g in goals], schema)
    joined = sized.join(F.broadcast(table), sized["_source"].eqNullSafe(table["_source"])).drop(table["_source"])
    whole, order = F.floor("rate"), F.xxhash64("_id", "_size", F.lit(seed))
    units = joined.select("_id", "_size", "source_size", "target", "place", "blocks", whole.cast("long").alias("_whole"), (F.col("rate") - whole).alias("_p"), order.alias("_order"))
    sides = F.col("_p").between(1e-9, 1 - 1e-9)
    done = units.where(~sides).withColumn("_p", F.round("_p")).drop("blocks")
    open_ = units.where(sides)
    want = {g["place"]: (g["target"] - math.floor(g["target"] / g["source_size"]) * g["source_size"]) if g["source_size"] else 0.0 for g in goals}
    blocks = {g["place"]: max(1, math.ceil(g["n"] / block)) for g in goals}
    taken_so_far: dict[int, float] = {}
    level, pieces = 0, [done]
    columns = [c for c in units.columns if c != "blocks"]
    while max(blocks.values(), default=1) > 1:
        placed = open_.withColumn("_block", F.pmod(F.col("_order") + level, F.col("blocks")).cast("int"))
        # The first block of a source waits for the last round, where its documents can even out what is left.
        waiting = placed.where("_block = 0").select(*columns)
        flown = stored(placed.where("_block > 0").groupBy("place", "_block").applyInPandas(_flown(seed, level), units.select(*columns).schema), "mix-flight")
        closed = flown.where("_p = 0 OR _p = 1")
        for row in closed.groupBy("place").agg(F.sum(F.col("_p") * F.col("_size")).alias("words")).collect():
            taken_so_far[row["place"]] = taken_so_far.get(row["place"], 0.0) + row["words"]
        pieces.append(closed.select(*columns))
        blocks = {k: max(1, math.ceil(2 * n / block)) for k, n in blocks.items()}
        smaller = spark.createDataFrame(list(blocks.items()), "place int, blocks int")
        open_ = waiting.unionAll(flown.where("_p > 0 AND _p < 1").select(*columns)).join(F.broadcast(smaller), "place")
        level += 1
    left = {k: w - taken_so_far.get(k, 0.0) for k, w in want.items()}
    pieces.append(open_.select(*columns).groupBy("place").applyInPandas(_landed(seed, left), units.select(*columns).schema).select(*columns))
    out = pieces[0].select(*columns)
    for piece in pieces[1:]:
        out = out.unionAll(piece)
    times = F.col("_whole") + F.col("_p").cast("long")
    return out.select(F.col("_id").cast(id_type).alias(id_col), F.col("_size").alias("size"), "source_size", "target", times.alias("times"), (times * F.col("_size")).alias("taken"))


def _words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def _flown(seed: int, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", "_id", "_size"], kind="stable", ignore_index=True)
        rows["_p"] = flight(rows["_size"].to_numpy(float), rows["_p"].to_numpy(float), np.random.default_rng([seed, level, *map(int, key)]))
        return rows.drop(columns=["_block", "blocks"], errors="ignore")
    return run


def _landed(seed: int, left: dict[int, float]):
    fly = _flown(seed, 1 << 20)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = fly(key, rows)
        rows["_p"] = landing(rows["_size"].to_numpy(float), rows["_p"].to_numpy(float), left[int(key[0])])
        return rows
    return run


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix with all their columns, each repeated as often as it is taken.

    Rows that share id and size share what is taken of them as evenly as whole rows allow, by a hash of the row.
    """
    counts = mixed_counts(docs, id_col, text_col, source_col, **options)
    times = counts.groupBy(F.col(id_col).alias("_times_id"), F.col("size").alias("_times_size")).agg(F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_rows")).where("_times > 0")
    sized = docs.withColumn("_size", _words(F.col(text_col)))
    joined = sized.join(times, F.col(id_col).eqNullSafe(F.col("_times_id")) & (F.col("_size") == F.col("_times_size")))
    turn = F.row_number().over(Window.partitionBy("_times_id", "_times_size").orderBy(F.xxhash64(*docs.columns)))
    copies = F.floor(F.col("_times") / F.col("_rows")) + F.when(turn <= F.col("_times") % F.col("_rows"), 1).otherwise(0)
    return joined.withColumn("_copies", copies.cast("int")).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)
