"""Tokens, language model, language ID, pages and archives, against plain versions and libraries."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from test_dedup import words
from twinledger.llm import html_tree, language_id, near_dedup, ngram_lm, sentencepiece_codec, token_files, warc
from twinledger.llm.common import read, shared_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD_TEXTS = ["", " ", "  a", "a  b   c ", "\n\n x\t", "日本語 😀 ▁x", "<s> </s> <unk> <0x41> <|endoftext|>", "a" * 300, "ab" * 200 + " " * 40 + "z", "\x00é", "don't   x  y", "x\r\ny", "I'm 3.14% of it's"]


def texts_of(sf_dir, table="documents", column="text"):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/{table}.parquet")[column].to_pylist()


def test_pieces_equal_the_librarys(sf_dir):
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepiece_codec.Model(PIECES)
    texts = [*ODD_TEXTS, *[t or "" for t in texts_of(sf_dir)]]
    for text, ids in zip(texts, model.encode(texts)):
        ids = np.frombuffer(ids, "<i4")
        assert ids.tolist() == library.encode(text), text[:80]
        assert model.decode(ids) == library.decode(ids.tolist())
        if "▁" not in text:
            assert model.decode(ids) == text


def test_unigram_paths_score_as_high_as_the_librarys(sf_dir, tmp_path):
    data = open(PIECES, "rb").read()
    trainer = next(v for n, v in sentencepiece_codec._fields(data) if n == 2)
    at = trainer.index(b"\x18\x02")
    path = tmp_path / "unigram.model"
    path.write_bytes(data.replace(trainer, trainer[:at] + b"\x18\x01" + trainer[at + 2:], 1))
    library, model = sentencepiece.SentencePieceProcessor(model_file=str(path)), sentencepiece_codec.Model(str(path))
    assert model.type == sentencepiece_codec.UNIGRAM
    texts = [t for t in texts_of(sf_dir) if t][:40]
    for text, ids in zip(texts, model.encode(texts)):
        ids, theirs = np.frombuffer(ids, "<i4"), library.encode(text)
        assert model.decode(ids) == text
        # The library adds single-precision scores up over the whole text, which costs it a little on long ones.
        ours, library_score = (float(model.scores[x].astype(float).sum()) for x in (ids, theirs))
        assert library_score <= ours <= library_score + 2e-4 * abs(library_score)


def test_encoded_and_decoded_tables(spark):
    docs = spark.createDataFrame([(1, "ab c", "x"), (2, None, "y"), (2, None, "y")], "doc_id long, text string, ids string")
    tokens = sentencepiece_codec.encoded(docs, PIECES)
    back = sentencepiece_codec.decoded(tokens, PIECES)
    assert sorted((r.doc_id, r.decoded, len(r.ids)) for r in back.collect()) == [(1, "ab c", len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode("ab c"))), (2, "", 0), (2, "", 0)]
    assert sentencepiece_codec.round_trip(docs.limit(0), PIECES).count() == 0
    assert all(r.same for r in sentencepiece_codec.round_trip(docs, PIECES).collect())


def test_elias_fano_gives_numbers_back():
    rng = random.Random(0)
    for values in ([], [0], [5], [0, 0, 0], [7] * 200, sorted(rng.randrange(10**9) for _ in range(1000)), list(range(300)), [2**40 + k * k for k in range(70)]):
        code = token_files.EliasFano.of(np.array(values, np.uint64))
        about, data = code.packed()
        code = token_files.EliasFano.unpacked(about, data)
        assert code.all().tolist() == values
        at = np.array([rng.randrange(len(values)) for _ in range(50)] if values else [], np.int64)
        assert code.select(at).tolist() == [values[k] for k in at]
        if len(values) > 500:
            assert len(data) < len(values) * (2.2 + math.log2(values[-1] / len(values))) / 8 + 200


def test_token_files_round_trip(spark):
    rng = random.Random(1)
    rows = [(i - 40, t) for i, t in enumerate(ODD_TEXTS)] + [(10**12, "x " * 40_000), (5, None), (5, None), (5, "b"), (None, "n")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start long")
    manifest = token_files.write_token_files(docs, shared_folder(spark, "t"), BYTES)
    got = sorted(token_files.read_token_files(manifest, with_ids=True).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    left = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows)
    start = 0
    for r in got:
        left[(r.doc_id, tuple(r.ids))] -= 1
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        start += r.n_tokens
    assert not any(left.values())
    first = manifest.first()
    file = token_files.TokenFile.open(first.path)
    assert file.bounds(0)[0] == 0 and file.bounds(first.n_docs - 1)[1] == first.n_ids
    assert token_files.round_trip(spark, docs.limit(0), BYTES).count() == 0


def test_token_ids_equal_those_of_the_library_as_it_comes(spark, sf_dir):
    library, encoder = Tokenizer.from_file(BYTES), token_files.Encoder(BYTES, "<u4")
    # Letters of a newer Unicode than the library knows, and the other way round, if there are any.
    odd = [chr(c) for c in (*range(0x80, 0x3000), *range(0xA640, 0xAC00), *range(0x10000, 0x12000), 0x2FFFE, *range(0x3FC30, 0x3FC40)) if encoder._differs(chr(c))]
    texts = [*ODD_TEXTS, "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", "\x1c a \x1cb", *[f"a{c}b {c} 1{c}  {c}!" for c in odd[:40]], "ab \u0558cd" * 3, *[t for t in texts_of(sf_dir) if t]]
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = 0
    for r, text in zip(sorted(token_files.round_trip(spark, docs, BYTES).collect(), key=lambda r: r.doc_id), texts, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text[:80]
        start += len(ids)


def test_parts_end_at_line_breaks_and_their_ids_stay_the_librarys():
    library, encoder = Tokenizer.from_file(BYTES), token_files.Encoder(BYTES, "<u4")
    rng = random.Random(3)
    words = [f"w{'x' * k}é" for k in range(30)]
    # Every pair of words around a line break: parts are remembered by word, not by pair.
    pairs = [f"{a}.\n{b} {a}" for a in words for b in words]
    assert len({key for text in pairs for key in encoder.keys(text)}) <= 3 * len(words) + 1
    signs = [" ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "a", "Bc", "é", "語", "12", "'s", "'", ".", ",\"", "😀", "\x00", "<|endoftext|>"]
    texts = pairs + ["".join(rng.choices(signs[:-1] if rng.random() < 0.9 else signs, k=rng.randrange(12))) for _ in range(20_000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_older_parts_are_let_go(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    library, encoder = Tokenizer.from_file(BYTES), token_files.Encoder(BYTES, "<u2")
    texts = [" ".join(f"{chr(97 + k % 26)}{chr(97 + j)}." for j in range(5)) for k in range(60)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) + len(encoder.known.older) <= 80


def brute_lm(train, rows):
    split = {i: words(t) + [None] for i, t in rows}
    counts = Counter(w for i in train for w in split[i])
    pairs = Counter(p for i in train for p in zip(["<begin>", *split[i]], split[i]))
    total, distinct = sum(counts.values()), len(counts)
    continued, contexts, kinds = Counter(b for _, b in pairs), Counter(), {}
    for (a, _), n in pairs.items():
        contexts[a] += n
        kinds.setdefault(a, [0, 0, 0])[min(n, 3) - 1] += 1
    lower, upper = (ngram_lm.discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]) for c in (continued, pairs))
    rest = sum(lower[min(n, 3) - 1] for n in continued.values()) / len(pairs)
    cut = lambda n, d: max(n - d[min(n, 3) - 1], 0) if n else 0

    def probability(a, b):
        p = cut(continued[b], lower) / len(pairs) + rest / (distinct + 1)
        if not contexts[a]:
            return p
        return cut(pairs[(a, b)], upper) / contexts[a] + sum(x * y for x, y in zip(upper, kinds[a])) / contexts[a] * p
    base = {i: sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in s) for i, s in split.items()}
    score = {i: sum(math.log10(probability(a, b)) for a, b in zip(["<begin>", *s], s)) for i, s in split.items()}
    assert sum(probability("the", w) for w in counts) + probability("the", "never seen") == pytest.approx(1)
    return split, counts, total, base, score


def test_language_model_against_plain_counts(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "THE the\tThe"), (10**6 + 3, "zz " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    train = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    split, counts, total, base, score = brute_lm(train, rows)
    found = {r.doc_id: r for r in ngram_lm.scored_with_holdout(docs).collect()}
    for i, s in split.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i not in train, len(s), sum(w in counts for w in s), total)
        assert r.base_score == pytest.approx(base[i]) and r.score == pytest.approx(score[i])
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_that_no_file_holds_are_refused(tmp_path):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array([1, 2]), pa.array([5, 2**32])], names=["shard", "key", "n"])
    with pytest.raises(OverflowError):
        list(ngram_lm._write_sorted(str(tmp_path / "lm"), False)(iter([batch])))
    assert len(list(ngram_lm._write_sorted(str(tmp_path / "ok"), False)(iter([batch.slice(0, 1)])))) >= 1


def test_words_are_counted_in_the_memory_that_holds_them():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(0)
    numbers = [rng.integers(0, 3_000_000, 1000).tolist() for _ in range(ngram_lm.COMBINE // 1000 + 300)]
    batches = [pa.RecordBatch.from_arrays([pa.array([" ".join(map(str, some)) for some in numbers[at: at + 500]])], names=["text"]) for at in range(0, len(numbers), 500)]
    tracemalloc.start()
    found, n = 0, 0
    for rows in ngram_lm._counted(iter(batches)):
        found, n = found + len(rows), n + int(rows.column(1).to_numpy().sum())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == sum(len(some) + 1 for some in numbers) and found >= len({x for some in numbers for x in some}) + 1
    # The buffer itself, and blocks of text and rows; before, five times the buffer.
    assert most < 2 * 8 * ngram_lm.COMBINE + (32 << 20)


def test_equal_values_are_counted_together(monkeypatch):
    monkeypatch.setattr(ngram_lm, "COMBINE", 100)
    monkeypatch.setattr(ngram_lm, "BATCH", 4)
    rng = random.Random(5)
    for values in ([], [7], [2**64 - 1] * 99, [3] * 1000, [rng.choice([0, 1, 2**63, 2**64 - 1, rng.randrange(50)]) for _ in range(1234)]):
        cuts = sorted(rng.randrange(len(values) + 1) for _ in range(5))
        parts = [np.array(values[a:b], np.uint64) for a, b in zip([0, *cuts], [*cuts, len(values)])]
        found, rows = Counter(), list(ngram_lm._combined(iter(parts)))
        for batch in rows:
            keys = batch.column(0).to_numpy().view(np.uint64).tolist()
            assert keys == sorted(set(keys))
            found.update(dict(zip(keys, batch.column(1).to_pylist())))
        assert found == Counter(values)
        if 0 < len(values) <= 100:
            assert sum(map(len, rows)) == len(set(values))


def test_language_model_without_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = ngram_lm.train(docs.limit(0))
    assert (model.total, model.distinct) == (0, 0)
    assert ngram_lm.scored(docs, model).first().score == pytest.approx(0.0)
    assert ngram_lm.scored(docs.limit(0), model).count() == 0


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 4])
    gain, step = rng.uniform(0.1, 1, size=(4, 3, 3)), rng.uniform(0.1, 2, size=(3, 3))
    found = language_id.forward_backward(gain, lengths, step)[0]
    for k, n in enumerate(lengths):
        sums = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.prod([gain[t, k, y] for t, y in enumerate(path)]) * np.prod([step[a, b] for a, b in zip(path, path[1:])])
            for t, y in enumerate(path):
                sums[t, y] += weight
        assert np.allclose(found[:n, k], sums / sums.sum(axis=1, keepdims=True))


def test_windows_of_a_long_text_give_what_the_whole_gives(monkeypatch):
    rng = random.Random(6)
    kinds = {"en": "the of and to in is was he for it with as his on".split(), "fr": "le la et les des en un du une que est pour qui dans".split(), "el": "ΟΔΟΣ και το να της".split()}
    texts = [" ".join(rng.choice(kinds[k]) for _ in range(60)) for k in kinds for _ in range(20)]
    model = language_id.fit(texts, [k for k in kinds for _ in range(20)])
    mixed = ". ".join(" ".join(rng.choice(kinds[rng.choice(list(kinds))]) for _ in range(rng.randrange(1, 30))) for _ in range(150))
    whole = model.shares([mixed])
    for size in (50, 333, 5000):
        monkeypatch.setattr(language_id, "CHUNK_CHARS", size)
        assert "".join(language_id.parts_of(mixed)) == mixed and len(list(language_id.parts_of(mixed))) > 1
        share, counts = model.shares([mixed])
        assert counts.tolist() == whole[1].tolist() and np.allclose(share, whole[0], atol=1e-6)
    assert model.shares(["1 2 3 " * 2000])[1].tolist() == [0]
    assert "".join(language_id.parts_of("x" * 20_000 + "-" + "y" * 3000)) == "x" * 20_000 + "-" + "y" * 3000


def test_language_id_held_out_and_odd_texts(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = {r.doc_id: r for r in language_id.identify_with_holdout(docs).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    held = [i for i, r in rows.items() if r.held_out]
    assert set(held) == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(rows[i].lang_pred == truth[i][0] for i in held) >= 0.97 * len(held)
    model = language_id.fit_on(docs)
    english, french = (next(t for lang, t in truth.values() if lang == name and len(t) > 1000) for name in ("en", "fr"))
    found = language_id.spans(f"{english[:300]} {french[:300]} {english[300:600]}", model)
    assert [x[2] for x in found][:1] == ["en"] and "fr" in [x[2] for x in found]
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 34 !", "en"), (4, french * 20, "en"), (4, french * 20, "en"), (None, english, None)], "doc_id long, text string, score string")
    got = sorted((r.doc_id or 0, r.lang_pred, 0 <= r.score <= 1) for r in language_id.identify(odd, model).collect())
    assert got == [(0, "en", True), (1, "und", True), (2, "und", True), (3, "und", True), (4, "fr", True), (4, "fr", True)]
    none = language_id.fit_on(docs.limit(0))
    assert none.languages == [] and language_id.identify(odd, none).first().lang_pred == "und"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<p>a", "a"), ("text <b>x</b>y<br>z &amp; &#233;", "text xy z & é"), ("<nav>a<ul><li>b</ul></nav><article><h1>T</h1><p>b<p>c</article><footer>f</footer>", "T\nb\nc"),
    ('<article>a<div class="share-buttons">s</div>b<aside>q</aside>c</article>', "a\nb\nc"), ("<article>a<!-- x --> b<script>if(a<b)</script> c</article>", "a b c"),
    ('<div class="comments"><article>no</article></div><main><p>yes</main>', "yes"), ("<ul><li>a<li>b</ul>&lt;x&gt; &am", "a\nb\n<x> &am"), ("<p>a <span class='x'>b</span> c</p>", "a b c"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<form>f</form><p hidden>h</p><p>v  w\n</p>", "v w"), ("</p></div>a<p", "a"),
])
def test_main_text_of_one_page(html, text):
    assert html_tree.Page(html).main_text(set()) == text


@pytest.mark.parametrize("html, text", [
    ('<article class="post has-comments"><p>a</article>', "a"), ('<div class="content no-sidebar"><article>a</article></div>', "a"), ('<main class="layout-sidebar-right"><p>a</main>', "a"),
    ('<article class="comments"><p>a</article>', "a"), ('<p class="share-price">a</p><p class="notice">b</p>', "a\nb"), ('<div class="sidebar"><main>a</main></div>', "a"),
    ('<div class="banner"><article>a</article></div>', "a"), ('<x-search class="search">s<article>a</article>s</x-search>', "a"), ('<span class="related"><main>a</main></span>', "a"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</article>", "so x=1 holds"),
    ('<article>a<section class="post-comments"><article>c</article></section></article>', "a"), ('<p>a</p><div id="cookie-banner-2">c</div><div class="related-posts">r</div><span class="share">s</span>', "a"),
])
def test_names_cut_whole_roles_and_no_article(html, text):
    assert html_tree.Page(html).main_text(set()) == text


def test_branches_that_all_pages_share_are_cut(spark):
    page = "<body><div class='promoted-box'><div>Our house style, on each page</div></div><article><p>Text {i} of its own</p><section><p>See also our archive</p></section></article></body>"
    rows = [(i, "http://a.example/x", page.replace("{i}", str(i)), "x") for i in range(30)] + [(100, "http://b.example", page, "x"), (101, None, None, None), (101, "::", "<p>q", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {(r.page_id, r.url): r for r in html_tree.main_texts(pages).collect()}
    assert found[(3, "http://a.example/x")].text == "Text 3 of its own"
    assert found[(100, "http://b.example")].text == "Text {i} of its own\nSee also our archive"
    assert found[(101, None)].n_chars == 0 and found[(101, "::")].text == "q"
    assert html_tree.main_texts(pages.limit(0)).count() == 0


def test_copies_of_a_page_make_no_template(spark):
    page = "<body><div class='promoted-box'><div>Our house style, on each page</div></div><div class='content'><p>Text {i} of its own</div></body>"
    rows = [(i, "http://a.example/x", page.replace("{i}", str(max(i, 949)))) for i in range(1000)]
    # Copies of a few pages say nothing about a host.
    rows += [(2000 + i, "http://b.example/x", page.replace("{i}", str(i % 9))) for i in range(100)]
    found = {r.page_id: r.text for r in html_tree.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)).collect()}
    assert found[0] == "Text 949 of its own" and found[999] == "Text 999 of its own"
    assert found[2000] == "Our house style, on each page\nText 0 of its own"
    tree = {r.pages for r in html_tree.style_tree(spark.createDataFrame(rows[:1000], "page_id long, url string, html string").repartition(8)).collect()}
    assert tree == {51}


def _plain_site(n: int) -> list[tuple[str, str]]:
    """(html, article) of pages whose names say nothing (numbers in names are one); menus, adverts and footers are drawn anew from short lists on each page."""
    import random

    draw = random.Random(7)
    menu, adverts, foot = [f"menu{k}" for k in range(8)], [f"Buy the new box{k} today" for k in range(6)], [f"imprint{k}" for k in range(5)]
    usual = "the of and to in is with on a for".split()
    out = []
    for _ in range(n):
        blocks = [" ".join(draw.choice(usual) if draw.random() < 0.4 else f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(5, 40))) for _ in range(draw.randrange(1, 5))]
        links = "".join(f'<li><a href="/{m}">{m}</a></li>' for m in draw.sample(menu, 4))
        html = (f'<body><div class="ka"><div class="kb"><ul>{links}</ul></div><div class="kc">{"".join(f"<p>{b}</p>" for b in blocks)}'
                f'<div class="kd">{draw.choice(adverts)}</div></div></div><div class="ke">{" ".join(draw.sample(foot, 3))}</div></body>')
        out.append((html, "\n".join(blocks)))
    return out


def test_importance_alone_finds_the_article_where_names_say_nothing(spark):
    site = _plain_site(200)
    pages = spark.createDataFrame([(i, "http://User@A.example:8080/x" if i % 2 else "//a.EXAMPLE?q", html) for i, (html, _) in enumerate(site)], "page_id long, url string, html string").repartition(8)
    found = {r.page_id: r.text for r in html_tree.main_texts(pages).collect()}
    without = {r.page_id: r.text for r in html_tree.main_texts(pages, low=0.0).collect()}
    assert all(found[i] == article for i, (_, article) in enumerate(site))
    assert all(without[i] != article and article in without[i] for i, (_, article) in enumerate(site))


def test_importance_equals_a_plain_count(spark):
    from collections import defaultdict
    from math import log

    site = _plain_site(40)
    rows = html_tree.style_tree(spark.createDataFrame([("http://a.example", html) for html, _ in site], "url string, html string").repartition(4)).collect()
    m, styles, having, over = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int)), {}
    for html, _ in site:
        page = html_tree.Page(html)
        words = defaultdict(set)
        for owner, text in page.blocks:
            words[owner] |= set(text.split())
        for owner, target in page.targets:
            words[owner].add((target,))
        paths, kids, below = set(), set(), defaultdict(set)
        for owner, some in words.items():
            node = owner
            below[page.path[owner]] |= some
            while node > 0:
                paths.add(page.path[node])
                kids.add((page.path[node], tuple(page.children[node])))
                if page.judged[node]:
                    over.setdefault(page.path[owner], set()).add(page.path[node])
                node = page.parent[node]
        for path in paths:
            m[path] += 1
        for path, style in kids:
            styles[path][style] += 1
        for path, some in below.items():
            for word in some:
                having[path][word] += 1
    assert {r.path for r in rows} == {up for ups in over.values() for up in ups}
    for r in rows:
        parts = [1 - log(k) / log(m[path]) for path, ups in over.items() if r.path in ups for k in having[path].values()]
        shares, content = styles[r.path].values(), sum(parts) / len(parts)
        presentation, weight = 1 - sum(k * log(k) for k in shares) / (sum(shares) * log(m[r.path])), html_tree.GAMMA ** len(shares)
        assert r.pages == m[r.path] and r.content == pytest.approx(content) and r.importance == pytest.approx((1 - weight) * presentation + weight * content)


def test_very_deep_pages_are_read_whole(spark):
    deep = "".join(f"<div class=a>{k} " for k in range(700))
    rows = [(i, "http://a.example", f"<body>{deep}<p>own{i}</p></body>") for i in range(20)] + [(99, "http://b.example", "<i>" * 700 + "x")]
    found = {r.page_id: r.text for r in html_tree.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[99] == "x" and all(len(html_tree.Page(html).nodes()) < 20_000 for _, _, html in rows) and set(found) == {*range(20), 99}


def test_pages_of_the_table_give_their_articles(spark, sf_dir):
    import html
    import re

    for r, p in zip(*(sorted(x.collect(), key=lambda r: r.page_id) for x in (html_tree.main_texts(read(spark, sf_dir, "pages")), read(spark, sf_dir, "pages")))):
        body = re.search("<article>(.*)</article>", p.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_archives_round_trip(spark):
    long, short = "é" * 60, "x" * 99
    rows = [(5, "u", long), (3, "u", long), (3, "u", long), (7, "u", short), (8, "u", short), (9, None, None), (10, "u", ""), (None, "u", long), (11, "u", "y" * 2_000_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect())
    kind = lambda i, t: ("revisit", 3) if t == long and i != 3 else ("response", None)
    assert got == sorted((i or 0, len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest(), *kind(i, t)) for i, _, t in rows)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_salvage_goes_on_behind_damage():
    records = [warc.record_bytes([("WARC-Type", "response"), ("X", str(i))], b"HTTP/1.1 200 OK\r\n\r\n" + b"body %d " % i * 50) for i in range(6)]
    for data, parts in ((b"".join(map(warc.member, records)), list(map(warc.member, records))), (b"".join(records), records)):
        assert [r.headers["x"] for r in warc.salvage(data)] == [str(i) for i in range(6)]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
        broken = bytearray(data)
        broken[starts[2] + 60] ^= 0xFF
        found = list(warc.salvage(bytes(broken)))
        assert [x.headers["x"] for x in found if isinstance(x, warc.Record)] == ["0", "1", "3", "4", "5"]
        assert [(x.start, x.end) for x in found if isinstance(x, warc.Gap)] == [(starts[2], starts[3])]
        junk = data[: starts[1]] + b"garbage \x1f\x8b\x08 WARC/1.0\r\n" + data[starts[1]: starts[5] + 10]
        found = list(warc.salvage(junk))
        assert [x.headers["x"] for x in found if isinstance(x, warc.Record)] == ["0", "1", "2", "3", "4"]
        gaps = [x for x in found if isinstance(x, warc.Gap)]
        assert [len(gaps), gaps[0].start, gaps[-1].end] == [2, starts[1], len(junk)]
    assert list(warc.salvage(b"")) == []


def test_language_stage_goes_by_rows_not_ids(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    english = docs.where("lang = 'en' and length(text) > 500").first().text
    extra = spark.createDataFrame([(None, "12 34", "en", "src0", 5), (None, english, "en", "src0", 1), (None, english, None, None, None), (-7, None, None, "src1", 0), (-7, english, "en", "src1", 2), (-7, english, "en", "src1", 2)], docs.schema)
    kept = corpus_pipeline.languages(spark, docs.unionByName(extra), sf_dir)
    assert kept.schema.names == docs.columns
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    assert rows(kept) == rows(docs.unionByName(extra.where("text like '%a%'")))


def test_long_units_are_encoded_in_segments_as_the_library_does(monkeypatch):
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepiece_codec.Model(PIECES)
    assert model.segmented
    rng = random.Random(4)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [draw("abcdefghijklmnopqrstuvwxyz", 5000), draw("的一是在不了有和人这中大为上个国我以要他", 3000), draw("ABCDEFabcdef0123456789+/", 4000), "a" * 3345, "ab" * 2000,
             draw("theandingion", 2000) + "😀" * 1000 + draw("xyz\x00é", 1000), "word " * 3 + draw("lorem", 3000) + " end"]
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text), text[:40]
    # Segments that begin too late for agreement begin earlier.
    monkeypatch.setattr(sentencepiece_codec, "WARM_UP", model.longest)
    monkeypatch.setattr(sentencepiece_codec, "SEGMENT", 40)
    texts = [text[:1500] for text in texts[:6]]
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def test_a_million_characters_without_a_blank_take_no_minutes():
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepiece_codec.Model(PIECES)
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(0x4E00, 0x4E80, size=500_000))) + "".join(map(chr, rng.integers(97, 123, size=500_000)))
    started = time.time()
    ids = model.encode([text])[0]
    assert time.time() - started < 120
    assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def test_languages_of_copies_and_of_long_texts_are_learned(spark):
    texts = {"aa": ["alpha beta gamma delta"] * 3000, "bb": ["uno dos tres cuatro"] * 5 + ["cinco seis siete"], "cc": ["yksi kaksi kolme neljä " * 50]}
    rows = [(k * 10_000 + i, t, lang) for k, (lang, some) in enumerate(texts.items()) for i, t in enumerate(some)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_on(docs, sample_docs=2, sample_chars=200, folds=10**6, fold=10**6 - 1)
    assert model.languages == ["aa", "bb", "cc"]
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()}
    assert (found[0], found[10_000], found[20_000]) == ("aa", "bb", "cc")
    with pytest.raises(ValueError, match="more than 2 languages"):
        language_id.fit_on(docs, max_languages=2)


def test_near_copies_that_share_an_id_are_told_apart(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (2, text, "b"), (2, "quite another text than the other ones here", "c"), (3, text + " x", "d"), (None, text, "e"), (4, None, "f"), (5, "quite another text than the other ones here", "g"),
            (4, "", "h"), (6, "same", "i"), (6, "same", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _node string")
    kept = near_dedup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r._node for r in kept.collect()) == ["a", "e", "f", "g", "h", "i", "i"]
    alone = near_dedup.one_of_each_group(docs.where("_node IN ('a', 'd', 'e', 'g')"))
    assert sorted(r._node for r in alone.collect()) == ["a", "e", "g"]


def test_last_stage_keeps_rows_and_ids_of_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(1, "some text here", "en", "s", 3), (1, "some text here", "en", "s", 3), (None, "other", None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, ids long")
    found = sorted(map(tuple, corpus_pipeline.pieces(spark, docs, "").collect()), key=str)
    assert found == sorted(((i, lang, source, len(ids), ids) for i, t, lang, source, _ in rows for ids in [library.encode(t or "")]), key=str)
    assert corpus_pipeline.pieces(spark, docs.limit(0), "").count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    names = docs.columns
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "123", "en", "src0", 3)], docs.schema)
    kept = corpus_pipeline.languages(spark, docs.unionByName(extra), sf_dir)
    assert kept.columns == names and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()}
    unique = corpus_pipeline.exact_copies(spark, kept, sf_dir)
    texts = {"".join((r.text or "").split(" ")) for r in docs.collect()}
    assert unique.columns == names and unique.count() <= len(texts)
    near = corpus_pipeline.near_copies(spark, unique, sf_dir)
    mixed = corpus_pipeline.source_mix(spark, near, sf_dir)
    tokens = corpus_pipeline.pieces(spark, mixed, sf_dir)
    assert near.columns == names and mixed.columns == names
    assert near.count() <= unique.count() and tokens.count() == mixed.count()
