"""Exact, near and embedding duplicates, components and mixing, against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import embedding_dedup, exact_dedup, mixing, near_dedup
from twinledger.llm.common import read
from twinledger.llm.components import connected_components

ODD = [(1, "a b"), (2, "ab "), (3, None), (4, ""), (5, " \t\n"), (6, "x" * 50_000), (7, "x" * 49_999 + " x"), (8, "Ab"), (8, "Ab"), (None, "ab"), (9, "ñ\x00")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "other", 1) for i, t in rows], "doc_id long, text string, _id string, rep long")


def test_exact_duplicates_of_odd_texts(spark):
    found = {r.doc_id: r for r in exact_dedup.exact_duplicates(documents(spark, ODD)).collect()}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert exact_dedup.exact_duplicates(documents(spark, ODD)).count() == len(ODD)
    for i, text in ODD:
        same = [(j, t) for j, t in ODD if norm(t) == norm(text)]
        keep = min(same, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))[0]
        assert (found[i].keep_id, found[i].group_size) == (keep, len(same))
        assert found[i].text_sha256 == hashlib.sha256(norm(text).encode()).hexdigest()
    kept = exact_dedup.without_exact_copies(documents(spark, ODD)).collect()
    assert sorted(len(r.text or "") for r in kept) == sorted({norm(t): max(len(u or "") for _, u in ODD if norm(u) == norm(t)) for _, t in ODD}.values())
    assert exact_dedup.exact_duplicates(documents(spark, ODD).limit(0)).count() == 0


def test_a_large_group_of_copies_is_cut_and_joined_again(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    found = exact_dedup.exact_duplicates(documents(spark, rows), salts=8).where("doc_id % 3 = 0").agg(F.min("group_size"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(found) == (1000, 0, 1)


def brute_near(rows, size, percent=80):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(sets, links)


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(100 + i, " ".join(f"v{rng.randrange(300)}" for _ in range(rng.randrange(3, 60)))) for i in range(80)]
    for family in range(3):
        base = [f"b{family}_{k}" for k in range(150)]
        rows += [(1000 * (family + 1) + i, edited(rng, base, rng.choice([0, 1, 2, 4, 6, 9]))) for i in range(60)]
    rows += [(1, "one two"), (2, "ONE\ttwo"), (3, None), (4, " "), (5, "one"), (6, "long " * 30_000), (7, "LONG " * 30_000)]
    sets, parts = brute_near(rows, 4)
    found = {r.doc_id: r for r in near_dedup.near_duplicates(documents(spark, rows), shingle_words=4).collect()}
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in found.items()} == parts
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_near_duplicates_of_no_rows_null_ids_and_repeated_rows(spark):
    assert near_dedup.near_duplicates(documents(spark, []).limit(0)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (5, "a b c d e f")]
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(documents(spark, rows)).collect())
    assert found == [(0, 0, True), (3, 3, True), (3, 3, True), (5, 3, False)]


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (2000, 5), (5, 2000)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == components(nodes, [e for e in edges if e[0] != e[1]])


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(300, 64))
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = rng.uniform(0.85, 0.99, size=(300, 1))
    x = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * noise, x[:5], x[:3]]).astype(np.float32)
    odd = [[0.0] * 64, None, [], [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] * 64]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000 + i, v, 1) for i, v in enumerate(odd)]
    found = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep int")).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (y @ y.T >= 0.9)
    np.fill_diagonal(near, False)
    links = near.sum()
    got = sum(found[i].n_links for i in range(len(x)))
    assert 0.99 * links <= got <= links
    assert all(found[i].n_links <= near[i].sum() for i in range(len(x)))
    for i in range(len(odd)):
        assert (found[5000 + i].n_links, found[5000 + i].component_id, found[5000 + i].kept) == (0, 5000 + i, True)
    assert all(found[i].component_id <= i for i in range(len(x))) and found[600].component_id == found[0].component_id


def test_vectors_of_any_size_are_compared(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 8))
    vectors = [(base[k] * scale).tolist() for k, scale in enumerate((1e200, 1e-200, 1e307, 5e-324))]
    vectors = [v for v in vectors for _ in range(2)]
    rows = [(i, [x * (1.001 if i % 2 and abs(x) < 1e307 else 1.0) for x in v]) for i, v in enumerate(vectors)]
    found = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(found[i].n_links >= 1 and found[i + 1].component_id == found[i].component_id for i in range(0, 6, 2))


def test_nearest_lattice_points():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) * 2
    points = embedding_dedup.nearest_points(x, 2) / 2
    own = points[:, 0]
    assert ((np.round(2 * own) == 2 * own).all() and (np.abs(own.sum(axis=1) % 2) < 1e-9).all())
    halves = (own % 1 != 0)
    assert (halves.all(axis=1) | ~halves.any(axis=1)).all()
    distances = ((points - x[:, None]) ** 2).sum(axis=2)
    assert (np.diff(distances, axis=1) >= -1e-9).all() and (distances[:, 0] <= 1 + 1e-9).all()
    assert (distances[:, 1] > 0).all() and (points[:, 0] != points[:, 1]).any(axis=1).all()


def test_targets_share_by_weight_up_to_the_cap():
    got = mixing.targets([100, 100, 100], [3, 1, 2])
    assert sum(got) == pytest.approx(450) and all(g <= 200 + 1e-9 for g in got) and got[2] == pytest.approx(2 * got[1])
    assert mixing.targets([0, 10], [3, 1]) == [0.0, pytest.approx(15)] and mixing.targets([], []) == []


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1000, size=500).astype(float)
    means = np.zeros(500)
    for seed in range(200):
        p = mixing.flight(sizes, np.full(500, 0.3), np.random.default_rng(seed))
        assert ((p > 0) & (p < 1)).sum() <= 2 and p.sum() == pytest.approx(150) and (p * sizes).sum() == pytest.approx(0.3 * sizes.sum())
        means += (p > 0.5) / 200
    assert abs(means.mean() - 0.3) < 0.01 and means.min() > 0.1 and means.max() < 0.5


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 200)), rng.choice(["a", "a", "a", "b", "c", None]), "x") for i in range(4000)] + [(9001, None, "a", "x"), (9002, "", None, "x"), (7, "w w", "b", "x"), (7, "w w", "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.mixed_counts(docs, block=200)
    got = found.collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got) and all(r.taken == r.times * r.size for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixed_counts(docs, block=200).collect()))
    taken = {}
    for r in got:
        taken[r.target] = taken.get(r.target, 0) + r.taken
    assert all(abs(words_ - target) <= 20 for target, words_ in taken.items()), taken
    copies = mixing.mixed_documents(docs, block=200)
    assert copies.columns == docs.columns and copies.count() == sum(r.times for r in got)
    assert mixing.mixed_counts(docs.limit(0)).count() == 0


def test_queries_over_whole_tables(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle_words=4).collect()}
    assert found == brute_near([(r.doc_id, r.text) for r in docs.collect()], 4)[1]
