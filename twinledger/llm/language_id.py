"""Language identification by a linear-chain conditional random field over words.

Each word has affix, n-gram and lexicon features; transitions between the languages of neighbouring words are learned as well,
so text that switches languages is labelled word by word. Posteriors come from forward-backward over the whole text. The model
is fitted on a bounded sample of labelled documents and sent to the tasks; its size depends on the number of languages only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from twinledger.llm.common import as_large_text, in_training, tidy

# Bounds of the sample that the model is fitted on: documents a language, characters a document and a language, languages.
SAMPLE_DOCS = 200
SAMPLE_CHARS = 100_000
LANGUAGE_CHARS = 4_000_000
MAX_LANGUAGES = 200
# Parts of a language that are sampled on their own first.
PARTS = 16
# Hashed n-gram features, and the lengths of n-grams; a word is padded, so those at its ends are its affixes.
FEATURES = 1 << 16
GRAMS = (1, 2, 3, 4)
EDGE = 1
UNKNOWN = "und"
# Characters handled at once; a longer document is handled alone.
CHUNK_CHARS = 1 << 19
# Posteriors (words times languages) worked out together, padding included; a longer document goes alone.
CELLS = 1 << 19
# Steps after which scaled values are brought back to a sum of 1.
RESCALE = 8

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _letters[0]


def _hash(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


@dataclass
class Words:
    """Words of some texts: padded code points, where each word begins in them, whole-word hashes, words per text, and where a
    word begins and ends in the lower-cased text."""

    points: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def words_of(texts: list[str]) -> Words:
    """Maximal runs of letters, lower-cased."""
    lowered = [text.lower() for text in texts]
    joined = "\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    lengths = ends - begins
    limits = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
    counts = np.diff(np.searchsorted(begins, limits))
    # All words with one edge between them: edge, word, edge, word, ..., edge.
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    padded = np.full(int(starts[-1]) + 1, EDGE, np.uint64)
    inside = np.ones(len(padded), dtype=bool)
    inside[starts] = False
    padded[inside] = points[letter]
    with np.errstate(over="ignore"):
        weights = np.arange(len(padded), dtype=np.uint64) - np.repeat(starts, np.append(lengths + 1, 1)).astype(np.uint64)
        mixed = _hash((padded + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93) + weights * np.uint64(0xA0761D6478BD642F))
        hashes = np.add.reduceat(mixed[:-1], starts[:-1]) if len(begins) else np.zeros(0, np.uint64)
    offset = np.repeat(limits[:-1], counts)
    return Words(padded, starts, hashes, counts, begins - offset, ends - offset)


def _grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature of each n-gram, position it begins at) for each length; n-grams don't cross the edge of a word."""
    edge = words.points == EDGE
    with np.errstate(over="ignore"):
        for n in GRAMS:
            count = len(words.points) - n + 1
            if count <= 0:
                continue
            values, crosses = np.full(count, np.uint64(n)), np.zeros(count, dtype=bool)
            for k in range(n):
                values = values * np.uint64(0x100000001B3) + words.points[k: k + count]
                if 0 < k < n - 1 or n == 1:
                    crosses |= edge[k: k + count]
            at = np.flatnonzero(~crosses)
            yield (_hash(values[at]) >> np.uint64(20)).astype(np.int64) & (FEATURES - 1), at


@dataclass
class Model:
    """languages; weights of n-gram features; lexicon (sorted word hashes, weights); transitions; start."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    lexicon_scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    lexicon_scale: float = 0.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def emissions(self, words: Words) -> np.ndarray:
        """Scores of each word in each language; words that occur often are scored once."""
        n = len(words.hashes)
        if not n:
            return np.zeros((0, len(self.languages)), np.float32)
        known, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        lengths = np.diff(words.starts)[first]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(words.starts[first] - starts[:-1], lengths) + np.arange(starts[-1])
        once = Words(np.append(words.points[source], np.uint64(EDGE)), starts, known, np.array([len(known)]), starts[:-1], starts[:-1])
        out = np.zeros((len(known), len(self.languages)), np.float32)
        for features, at in _grams(once):
            limits = np.append(np.searchsorted(at, starts[:-1]), len(at))
            sums = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(self.weights[features], axis=0, dtype=np.float64)])
            out += (sums[limits[1:]] - sums[limits[:-1]]).astype(np.float32) / np.maximum(1, limits[1:] - limits[:-1])[:, None]
        if len(self.lexicon):
            place = np.minimum(np.searchsorted(self.lexicon, known), len(self.lexicon) - 1)
            hit = self.lexicon[place] == known
            out[hit] += self.lexicon_scale * self.lexicon_scores[place[hit]]
        return out[inverse]

    def posteriors(self, emissions: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Posterior of each language for each word, by forward-backward over each text; texts of like length go together."""
        out = np.empty(emissions.shape, np.float32)
        limits = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(counts, kind="stable")
        order = order[counts[order] > 0]
        end = len(order)
        while end:
            longest = int(counts[order[end - 1]])
            begin = max(0, end - max(1, CELLS // (longest * emissions.shape[1])))
            mine = order[begin:end]
            gain = np.zeros((longest, len(mine), emissions.shape[1]))
            for k, text in enumerate(mine):
                gain[: counts[text], k] = emissions[limits[text]: limits[text + 1]]
            gamma = forward_backward(np.exp(gain - gain.max(axis=2, keepdims=True)), counts[mine], np.exp(self.transitions))[0]
            for k, text in enumerate(mine):
                out[limits[text]: limits[text + 1]] = gamma[: counts[text], k]
            end = begin
        return out


    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(share of each language in the words of each text, by their posteriors; number of words)."""
        if len(texts) == 1 and len(texts[0]) > CHUNK_CHARS:
            share, count = self._share_by_windows(texts[0])
            return share[None], np.array([count])
        words = words_of(texts)
        posterior = self.posteriors(self.emissions(words), words.counts)
        limits = np.concatenate([[0], np.cumsum(words.counts)])
        sums = np.concatenate([np.zeros((1, posterior.shape[1])), np.cumsum(posterior, axis=0, dtype=np.float64)])
        return (sums[limits[1:]] - sums[limits[:-1]]) / np.maximum(1, words.counts)[:, None], words.counts

    def _share_by_windows(self, text: str) -> tuple[np.ndarray, int]:
        """The same for a long text, with the memory of a part of it: a first pass forward keeps what it knows at the end of each
        part; a second one, from the last part to the first, goes forward again within a part and takes the message backward along."""
        step, before, count, total = np.exp(self.transitions), [None], 0, np.zeros(len(self.languages))
        for part in parts_of(text):
            gain = self._gain(part)
            before.append(_forward(gain, step, before[-1])[-1] if len(gain) else before[-1])
        after = None
        for k, part in reversed(list(enumerate(parts_of(text)))):
            gain = self._gain(part)
            if len(gain):
                alpha, beta = _forward(gain, step, before[k]), _backward(gain, step, after)
                gamma = alpha * beta
                total += (gamma / gamma.sum(axis=1, keepdims=True)).sum(axis=0)
                count, after = count + len(gain), beta[0] * gain[0]
        return total / max(1, count), count

    def _gain(self, text: str) -> np.ndarray:
        emissions = self.emissions(words_of([text])).astype(np.float64)
        return np.exp(emissions - emissions.max(axis=1, keepdims=True)) if len(emissions) else emissions


SPACE, NO_WORD = re.compile(r"\s"), re.compile(r"\W")


def parts_of(text: str) -> Iterator[str]:
    """A text cut between words into parts of about ``CHUNK_CHARS`` characters: at white space if some is near, else at another
    character that is no letter."""
    begin = 0
    while begin < len(text):
        wanted = begin + CHUNK_CHARS
        cut = SPACE.search(text, wanted, wanted + CHUNK_CHARS) or NO_WORD.search(text, wanted)
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end


def _forward(gain: np.ndarray, step: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Scaled forward values of the words of one part, ``before`` being those of the word ahead of it."""
    alpha = np.empty_like(gain)
    now = gain[0] if before is None else before @ step * gain[0]
    alpha[0] = now = now / now.sum()
    for t in range(1, len(gain)):
        now = now @ step * gain[t]
        if t % RESCALE == 0:
            now = now / now.sum()
        alpha[t] = now
    alpha[-1] /= alpha[-1].sum()
    return alpha


def _backward(gain: np.ndarray, step: np.ndarray, after: np.ndarray | None) -> np.ndarray:
    """Scaled backward values of the words of one part, ``after`` being those of the next word times its gain."""
    beta = np.empty_like(gain)
    now = np.ones(gain.shape[1]) if after is None else step @ after
    beta[-1] = now = now / now.sum()
    for t in range(len(gain) - 1, 0, -1):
        now = step @ (now * gain[t])
        if t % RESCALE == 0:
            now = now / now.sum()
        beta[t - 1] = now
    return beta


def forward_backward(gain: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(posteriors, scaled backward values) of sequences [time, sequence, label] of ascending lengths.

    At each time only the sequences that are that long take part; what lies behind the end of a sequence has no meaning.
    """
    alpha, beta = np.ones_like(gain), np.ones_like(gain)
    live = np.searchsorted(lengths, np.arange(len(gain)), side="right").tolist()
    back_step = np.ascontiguousarray(step.T)
    alpha[0] = gain[0]
    for t in range(1, len(gain)):
        now = alpha[t, live[t]:]
        np.matmul(alpha[t - 1, live[t]:], step, out=now)
        now *= gain[t, live[t]:]
        if t % RESCALE == 0:
            now /= now.sum(axis=1, keepdims=True)
    for t in range(len(gain) - 1, 0, -1):
        then = beta[t - 1, live[t]:]
        np.matmul(beta[t, live[t]:] * gain[t, live[t]:], back_step, out=then)
        if t % RESCALE == 0:
            then /= then.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    return gamma, beta


def fit(texts: list[str], labels: list[str], epochs: int = 6, seed: int = 5) -> Model:
    """Fits the field on labelled texts. Runs of words of different texts are joined to sequences, so that switches occur.

    The lexicon comes from one half of the texts and the weights from the other, or weights would trust it too much.
    """
    languages = sorted(set(labels))
    model = Model(languages, np.zeros((FEATURES, len(languages)), np.float32), transitions=np.zeros((len(languages),) * 2))
    if len(languages) < 2:
        return model
    generator = np.random.default_rng(seed)
    number = {language: k for k, language in enumerate(languages)}
    labels_ = np.array([number[label] for label in labels])
    order = generator.permutation(len(texts))
    half = [order[::2], order[1::2]] if len(texts) >= 4 * len(languages) else [order, order]
    model.lexicon, model.lexicon_scores = _lexicon([texts[k] for k in half[0]], labels_[half[0]], len(languages))
    words = words_of([texts[k] for k in half[1]])
    label = np.repeat(labels_[half[1]], words.counts)
    runs = [(a, min(a + int(generator.integers(8, 40)), end)) for begin, end in zip(np.cumsum(words.counts) - words.counts, np.cumsum(words.counts)) for a in range(int(begin), int(end), 40)]
    runs = [runs[k] for k in generator.permutation(len(runs))]
    if not runs:
        return model
    # A run is followed by one of its own language most of the time.
    by_language = [[r for r in runs if label[r[0]] == k] for k in range(len(languages))]
    sequences = []
    while any(by_language):
        k = int(generator.choice([i for i, r in enumerate(by_language) if r]))
        sequence = []
        while len(sequence) < 4 and any(by_language):
            if not by_language[k] or generator.random() < 0.25:
                k = int(generator.choice([i for i, r in enumerate(by_language) if r]))
            sequence.append(by_language[k].pop())
        sequences.append(np.concatenate([np.arange(*run) for run in sequence]))
    grams, owner = [], []
    for features, at in _grams(words):
        word = np.searchsorted(words.starts, at, side="right") - 1
        size = np.maximum(1, np.bincount(word, minlength=len(label)))
        grams.append((features, word, (1.0 / size[word]).astype(np.float32)))
        owner.append(np.searchsorted(word, np.arange(len(label) + 1)))
    model.lexicon_scale = 1.0
    place = np.minimum(np.searchsorted(model.lexicon, words.hashes), max(0, len(model.lexicon) - 1))
    prior = np.zeros((len(label), len(languages)), np.float32)
    if len(model.lexicon):
        hit = model.lexicon[place] == words.hashes
        prior[hit] = model.lexicon_scores[place[hit]]
    squares, step_squares, rate = np.full(model.weights.shape, 1e-8, np.float32), np.full(model.transitions.shape, 1e-8), 0.3
    for _ in range(epochs):
        for at in range(0, len(sequences), 16):
            batch = sorted(sequences[at: at + 16], key=len)
            longest = max(map(len, batch))
            index = np.concatenate(batch)
            scores = prior[index].astype(np.float64)
            chosen = []
            for (features, _, share), limits in zip(grams, owner):
                begin, end = limits[index], limits[index + 1]
                which = np.repeat(begin - np.concatenate([[0], np.cumsum(end - begin)[:-1]]), end - begin) + np.arange((end - begin).sum())
                row = np.repeat(np.arange(len(index)), end - begin)
                contribution = model.weights[features[which]] * share[which][:, None]
                for k in range(len(languages)):
                    scores[:, k] += np.bincount(row, contribution[:, k], minlength=len(index))
                chosen.append((features[which], row, share[which]))
            gain, live, truth = np.zeros((longest, len(batch), len(languages))), np.zeros((longest, len(batch)), dtype=bool), np.zeros((longest, len(batch)), np.int64)
            begin = 0
            for k, sequence in enumerate(batch):
                gain[: len(sequence), k], live[: len(sequence), k], truth[: len(sequence), k] = scores[begin: begin + len(sequence)], True, label[sequence]
                begin += len(sequence)
            gain = np.exp(gain - gain.max(axis=2, keepdims=True))
            step = np.exp(model.transitions)
            gamma, beta = forward_backward(gain, np.array([len(sequence) for sequence in batch]), step)
            error = np.concatenate([gamma[: len(s), k] for k, s in enumerate(batch)])
            error[np.arange(len(index)), label[index]] -= 1
            # Expected transitions: alpha is gamma / beta up to scale.
            alpha = gamma[:-1] / np.maximum(beta[:-1], 1e-300)
            inner = live[1:]
            pair = alpha[inner][:, :, None] * step[None] * (gain[1:] * beta[1:])[inner][:, None, :]
            pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
            expected = pair.sum(axis=0)
            np.subtract.at(expected, (truth[:-1][inner], truth[1:][inner]), 1.0)
            expected = expected / max(1, inner.sum()) + 1e-4 * model.transitions
            step_squares += expected**2
            model.transitions -= rate * expected / np.sqrt(step_squares)
            for features, row, share in chosen:
                unique, inverse = np.unique(features, return_inverse=True)
                gradient = np.stack([np.bincount(inverse, error[row, k] * share, minlength=len(unique)) for k in range(len(languages))], axis=1) / len(batch)
                squares[unique] += (gradient**2).astype(np.float32)
                model.weights[unique] -= (rate * gradient / np.sqrt(squares[unique])).astype(np.float32)
    return model


def _lexicon(texts: list[str], labels: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that occur at least 3 times, with the logarithm of their smoothed share in each language."""
    words = words_of(texts)
    label = np.repeat(labels, words.counts)
    known, inverse, seen = np.unique(words.hashes, return_inverse=True, return_counts=True)
    counts = np.zeros((len(known), n))
    np.add.at(counts, (inverse, label), 1)
    counts *= counts.sum() / n / np.maximum(1, counts.sum(axis=0))
    often = seen >= 3
    shares = (counts[often] + 0.5) / (counts[often].sum(axis=1, keepdims=True) + 0.5 * n)
    return known[often], np.log(shares * n).astype(np.float32)


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, folds: int = 5, fold: int = 0,
           sample_chars: int = SAMPLE_CHARS, language_chars: int = LANGUAGE_CHARS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fits the model on at most ``sample_docs`` different labelled texts a language, out of those outside the held-out fold.

    They are the first ones by a hash of the text, whatever number of copies a text has, and by ``language_chars`` in sum. Texts above
    ``sample_chars`` characters come after the others, and only their first ``sample_chars`` are learned from: a language of which
    there are no others is learned all the same. Documents without a label or without text are not learned from. More than
    ``max_languages`` labels are refused.
    """
    usable = docs.where(in_training(id_col, folds, fold)).select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text")).where(
        "_lang IS NOT NULL AND _text IS NOT NULL")
    hashed = usable.select("_lang", F.xxhash64("_text").alias("_hash"), F.length("_text").alias("_size"))
    different = hashed.groupBy("_lang", "_hash").agg(F.min("_size").alias("_size"))
    order = Window.partitionBy("_lang").orderBy(F.col("_size") > sample_chars, "_hash")
    # The first ones of parts of a language come first, so that what meets in one task doesn't grow with the table.
    in_part = Window.partitionBy("_lang", "_part").orderBy(F.col("_size") > sample_chars, "_hash")
    parted = different.withColumn("_part", F.pmod("_hash", F.lit(PARTS))).withColumn("_place", F.row_number().over(in_part)).where(F.col("_place") <= sample_docs)
    first = parted.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= sample_docs)
    before = F.coalesce(F.sum(F.least("_size", F.lit(sample_chars))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = first.withColumn("_before", before).where(F.col("_before") < language_chars)
    found = picked.select("_lang", "_hash").limit(max_languages * sample_docs + 1).collect()
    if len({row["_lang"] for row in found}) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # The list is bounded by the sample; copies of a text are one before they leave the tasks.
    listed = docs.sparkSession.createDataFrame([tuple(row) for row in found], "_lang string, _hash long")
    pieces = usable.withColumn("_hash", F.xxhash64("_text")).join(F.broadcast(listed), ["_lang", "_hash"]).groupBy("_lang", "_hash").agg(
        F.min(F.left("_text", F.lit(sample_chars))).alias("_text"))
    rows = sorted((row["_lang"], row["_text"]) for row in pieces.collect())
    return fit([text for _, text in rows], [language for language, _ in rows])


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > CHUNK_CHARS:
            yield begin, texts[begin:k]
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per document: its id, lang_pred, score (share of the predicted language over all words, by their posteriors).

    With ``keep`` these columns of the document stand in place of its id; none may be named like the two others.

    A long text is worked through in windows with exact messages between them, so that memory is bounded by a window.
    A text that is NULL or has no letter is ``und`` with score 0; so is every text if the model knows no language. Ties go to
    the first language by code point. Other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col] if keep is None else list(keep)
    # A text that is kept goes to the tasks once.
    once = text_col in names and docs.schema[text_col].dataType == StringType()
    at = names.index(text_col) if once else len(names)
    given = docs.select(*names, *([] if once else [F.col(text_col).cast("string").alias("_text")]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = shared.value
        for batch in batches:
            texts = as_large_text(batch.column(at)).to_pylist()
            for begin, part in _chunks(texts):
                if field_.languages:
                    share, counts = field_.shares(part)
                    best = share.argmax(axis=1)
                    languages = [field_.languages[k] if n else UNKNOWN for k, n in zip(best, counts)]
                    scores = np.where(counts > 0, np.clip(share[np.arange(len(part)), best], 0, 1), 0.0)
                else:
                    languages, scores = [UNKNOWN] * len(part), np.zeros(len(part))
                kept = [batch.column(k).slice(begin, len(part)) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    schema = StructType([docs.schema[name] for name in names]).add("lang_pred", StringType()).add("score", DoubleType())
    return given.mapInArrow(tidy(rows), schema)


def spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Runs of words of one language in a text: (begin, end, language); offsets are those of the lower-cased text."""
    words = words_of([text])
    if not len(words.hashes) or not model.languages:
        return []
    label = model.posteriors(model.emissions(words), words.counts).argmax(axis=1)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(label)) + 1, [len(label)]])
    return [(int(words.begins[a]), int(words.ends[b - 1]), model.languages[label[a]]) for a, b in zip(cuts[:-1], cuts[1:])]


def identify_with_holdout(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, fold: int = 0) -> DataFrame:
    """Per document: its id, held_out, lang_pred, score; learned from the documents that aren't held out."""
    model = fit_on(docs, id_col, text_col, lang_col, folds=folds, fold=fold)
    return identify(docs, model, id_col, text_col).select(id_col, (~in_training(id_col, folds, fold)).alias("held_out"), "lang_pred", "score")
