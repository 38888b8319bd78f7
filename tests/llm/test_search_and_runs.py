"""Hard negatives, benchmark passages and periodic runs, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinledger.llm import decontamination, hard_negatives, periodic_runs
from twinledger.llm.fm_index import FmIndex, suffix_order
from twinledger.llm.words import hashed_words

VECTORS = "vec_id long, embedding array<double>, label int, no long, anchor_id string"


def plain_negatives(rows, is_anchor, positives=5, negatives=5):
    usable = [(i, [math.floor(256 * x) for x in v], k) for i, v, k, *_ in rows
              if i is not None and v is not None and k is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, av, ak in usable:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, k) for i, v, k in usable if i != a and len(v) == len(av))
        for p, pi in [(-s, i) for s, i, k in scored if k == ak][:positives]:
            inside = [(i, -s) for s, i, k in scored if k != ak and 80 * p <= -100 * s <= 100 * p][:negatives]
            out += [(a, pi, n, i, p, s) for n, (i, s) in enumerate(inside, 1)]
    return sorted(out)


def negatives_of(spark, rows, schema=VECTORS, modulus=3, **options):
    df = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % modulus == 0, **options).collect()))


def test_hard_negatives_with_ties_repeats_and_unusable_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.5, 0.25, -0.5, 0.1]) for _ in range(3)], rng.randrange(3), 1, "x") for i in range(60)]
    rows += [(7, rows[7][1], rows[7][2], 1, "x"), (9, rows[9][1], rows[9][2], 1, "x"), (12, [0.5, 0.5, 0.5], 1, 1, "x")]
    rows += [(100, None, 1, 1, "x"), (102, [0.1, None, 0.2], 1, 1, "x"), (105, [float("nan"), 1.0, 1.0], 1, 1, "x"), (108, [float("inf"), 1.0, 1.0], 1, 1, "x"),
             (111, [0.5, 0.5, 0.5], None, 1, "x"), (None, [0.5, 0.5, 0.5], 1, 1, "x"), (114, [], 1, 1, "x"), (115, [], 2, 1, "x"), (116, [], 1, 1, "x"), (117, [0.5, 0.5], 1, 1, "x")]
    found = negatives_of(spark, rows)
    assert found == plain_negatives(rows, lambda i: i % 3 == 0) and len(found) > 100
    assert (114, 116, 1, 115, 0, 0) in found


def test_hard_negatives_are_exact_beyond_doubles_and_refuse_what_no_key_holds(spark):
    big = [(i, [1e5 + i / 7, 3e5 - i, 2.0**21], i % 2, 1, "x") for i in range(12)]
    assert negatives_of(spark, big) == plain_negatives(big, lambda i: i % 3 == 0) != []
    with pytest.raises(Exception, match="62 bits"):
        negatives_of(spark, [(i, [1e30], i % 2, 1, "x") for i in range(8)])


def test_hard_negatives_of_nothing_and_bad_windows(spark):
    assert negatives_of(spark, []) == []
    assert negatives_of(spark, [(1, [1.0], 1, 1, "x")]) == []
    assert negatives_of(spark, [(3, [1.0], 1, 1, "x"), (4, [1.0], 1, 1, "x")]) == []
    with pytest.raises(ValueError):
        negatives_of(spark, [], high=120)


def test_hard_negatives_over_many_blocks(monkeypatch, sf_dir):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 2000)
    rng = np.random.default_rng(1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([str(i % 3) for i in range(50)]), pa.array(list(rng.random((50, 4))))], names=["id", "label", "vec"])
    blocks = list(hard_negatives._blocks(iter([batch.slice(0, 20), batch.slice(20, 5), batch.slice(25)]), 256.0))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b[1]) == list(range(50))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(docs, items, size=10):
    phrases = set()
    for item, text in items:
        w = plain_words(text)
        if w:
            k = min(size, len(w))
            phrases |= {(item, tuple(w[i:i + k])) for i in range(len(w) - k + 1)}
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for item, phrase in phrases:
            for i in range(len(w) - len(phrase) + 1):
                if tuple(w[i:i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    found |= {item} - {None}
        out.append((doc, len(w), sorted(hit), sorted(map(str, found))))
    return sorted(out, key=str)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (10, "Short one"), (2, "a a a a a a a a a a a"), (3, None), (4, "?!"),
         (2, "repeated id of another text"), (None, "words without an id"), (5, "größe 日本 é"), (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa other end")]
DOCS = [(1, "x ALPHA beta, gamma-delta epsilon zeta eta theta iota kappa lambda mu. y"), (2, "the short  one, short one"), (3, None), (4, ""), (5, "!!"), (6, "a " * 50),
        (7, "repeated id of another text"), (8, "here are words without an id or more"), (9, "Größe 日本 é größe 日本 é"), (1, "x short one"), (None, "short one"),
        (11, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (12, "short\x00one\x7fshort"), (13, "w " * 300 + "short one " + "v " * 300)]


def test_contamination_of_odd_documents(spark):
    docs = spark.createDataFrame([(i, t, "s", "p") for i, t in DOCS], "doc_id long, text string, item string, n_hit string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id long")
    found = decontamination.contamination(docs, items).collect()
    spread = sorted(((r.doc_id, r.n_words, [k for s in r.spans for k in range(s.start, s.end)], r["items"]) for r in found), key=str)
    assert spread == plain_contamination(DOCS, ITEMS) and all(r.n_hit == len(x[2]) for r, x in zip(sorted(found, key=lambda r: str((r.doc_id, r.n_words))), spread) if r.doc_id == 6)
    digest = {(r.doc_id, r.n_words): r for r in decontamination.summarised(decontamination.contamination(docs, items)).collect()}
    assert digest[1, 14].items_sha256 == hashlib.sha256(b"1,6").hexdigest() and digest[1, 14].n_items == 2
    assert not digest[3, 0].contaminated and digest[3, 0].items_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in decontamination.without_contamination(docs, items).collect()}
    assert docs.columns == decontamination.without_contamination(docs, items).columns
    assert (clean[2].text, clean[3].text, clean[11].text, clean[12].text) == ("the ", None, "", "\x7fshort")
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    with pytest.raises(ValueError):
        decontamination.contamination(docs, items, keep=["doc_id", "n_hit"])


def test_pieces_of_long_documents_and_many_phrases(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(400))
    phrases = {n: np.array([hashed_words(*_bytes(p), decontamination._WORD, True).hashes for p in {text[2 * i: 2 * i + 2 * n - 1] for i in range(0, 380, 7)}]) for n in (3, 10)}
    blocks = [(p, [["i"]] * len(p)) for p in phrases.values()]
    words = hashed_words(*_bytes(text), decontamination._WORD, True)
    whole = decontamination._looked_up(words, blocks, 10)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 25)
    pieces = decontamination._looked_up(words, blocks, 10)
    assert (whole[0] == pieces[0]).all() and whole[0].any() and whole[1] == pieces[1]


def _bytes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=5), phrases=st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), min_size=1, max_size=8))
def test_index_finds_every_occurrence(texts, phrases):
    words = np.array([w for t in texts for w in t], np.uint64)
    found = sorted(zip(*(x.tolist() for x in FmIndex(words, np.array([len(t) for t in texts])).occurrences(np.array(phrases, np.uint64)))))
    starts = np.cumsum([0, *[len(t) for t in texts]])
    assert found == sorted((p, k, int(starts[k]) + i) for p, phrase in enumerate(phrases) for k, t in enumerate(texts) for i in range(len(t) - 2) if t[i:i + 3] == phrase)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2), max_size=60))
def test_suffixes_are_ordered(symbols):
    symbols = np.array([*symbols, 0])
    assert suffix_order(symbols, 3).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, q, m) for (s, m), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, n):
    words = []
    while len(words) < n:
        root = [rng.choice("abcdefgh"[: rng.randrange(1, 8)]) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 40]))]
        words += (root * rng.randrange(1, 9))[: rng.randrange(1, 90)]
    return words[:n]


def runs_of(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, id int, runs string")
    found = periodic_runs.periodic_runs(docs, with_text=True, **options).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text, r.collapsed_sha256) for r in found), key=str)


def expected_runs(rows):
    out = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words)
        collapsed = plain_collapsed(words, runs)
        out.append((i, len(words), runs, collapsed if runs else None, hashlib.sha256(collapsed.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile_words", [1 << 16, 16, 64])
def test_runs_of_odd_and_repetitive_texts(spark, tile_words):
    rng = random.Random(tile_words)
    thue = ["a"]
    for _ in range(8):
        thue += ["b" if w == "a" else "a" for w in thue]
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a a A", "x " + "a b " * 4 + "c", "a b " * 3, " ".join("ab" * 33), " ".join(thue), "é é " * 9,
             " ".join("abcd" * 20 + "e" + "abcd" * 20), "w " * 700] + [" ".join(repetitive(rng, rng.randrange(5, 400))) for _ in range(25)]
    rows = [*enumerate(texts), (None, "a " * 7), (3, "a " * 7), (3, "a " * 7)]
    assert runs_of(spark, rows, tile_words=tile_words) == expected_runs(rows)


def test_runs_of_an_empty_table(spark):
    assert runs_of(spark, []) == []


def test_every_tile_of_a_document_is_needed_and_enough():
    for n in (4, 100, 1000, 5000):
        covered = {}
        for octaves, first, end, low, high in periodic_runs.tiles(n, 64):
            for s in octaves:
                assert low % s == 0 and (low == 0 or low - first >= s)
                covered.setdefault(s, []).append((low, high))
        for s, ranges in covered.items():
            assert ranges[0][0] == 0 and ranges[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        assert sorted(covered) == [2**k for k in range(20) if 4 * 2**k <= n]


def test_planted_runs_and_their_summary(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, "a b"), (40, None), (41, "")], "doc_id long, text string"))
    planted = {}
    for i, text in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        planted.setdefault(i, []).append(words)
    result = periodic_runs.summarised(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(docs))).collect()
    assert len(result) == docs.count()
    for row in result:
        runs = [plain_runs(words) for words in planted[row.doc_id]]
        lines = [hashlib.sha256("".join(f"{s},{m},{q}\n" for s, q, m in r).encode()).hexdigest() for r in runs]
        k = lines.index(row.runs_sha256)
        best = min(runs[k], key=lambda r: (-r[2] / r[1], r[0], r[1]), default=None)
        assert (row.n_runs, row.start, row.length, row.period) == ((len(runs[k]), best[0], best[2], best[1]) if best else (0, None, None, None))
        assert row.exponent_milli == (1000 * best[2] // best[1] if best else None)
    assert sum(row.n_runs > 0 for row in result) > 10
