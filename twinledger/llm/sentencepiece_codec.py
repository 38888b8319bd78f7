"""SentencePiece encoding and decoding: a batched Viterbi in numpy over the pieces of a given model.

Texts are cut into units (blanks and the word behind them); units of one length advance together, character by character.
Hashes of all substrings that end at the current character probe the sorted hashes of the pieces, and the best piece is stored as
a back-pointer. For a model of type unigram, best is the largest sum of scores. For one of type BPE the pieces are those that
merging gives: a piece may follow another only if merging the two gives exactly these two (that decides a whole encoding, since
merges within two neighbours don't depend on what surrounds them), and of the pieces allowed the best score wins.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.llm.common import Remembered, as_large_text, tidy

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
UNKNOWN_SURFACE = b" \xe2\x81\x87 "

# What a worker remembers, as bounds on its memory: units with their ids, and pairs of pieces.
REMEMBERED_UNITS = 80_000
PAIR_BITS = 20
# Longer units aren't remembered.
LONG_UNIT = 64
FILTER_BITS = 22
# A unit above this many characters is cut into segments, each of which begins so many characters before its place.
SEGMENT = 1024
WARM_UP = 256
# Characters of units of one length that advance together.
ADVANCE_CHARS = 1 << 19


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at: at + size]
            at += size


class Model:
    """Pieces of a model file, with lookup by substring hash."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        self.pieces, scores, kinds = [], [], []
        for number, value in top:
            if number == 1:
                fields = dict(_fields(value))
                self.pieces.append(fields[1].decode("utf-8"))
                scores.append(struct.unpack("<f", fields.get(2, b"\0\0\0\0"))[0])
                kinds.append(fields.get(3, NORMAL))
        trainer = dict(_fields(next((v for n, v in top if n == 2), b"")))
        normalizer = dict(_fields(next((v for n, v in top if n == 3), b"")))
        self.type = trainer.get(3, UNIGRAM)
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("only models of type unigram and BPE")
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only models that leave characters and white space as they are")
        if USER_DEFINED in kinds:
            raise ValueError("no models with user-defined pieces")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.scores, kinds_ = np.array(scores, np.float32), np.array(kinds)
        self.unknown_id = int(np.flatnonzero(kinds_ == UNKNOWN)[0])
        self.byte_ids = None
        if BYTE in kinds:
            named = {self.pieces[i]: i for i in np.flatnonzero(kinds_ == BYTE).tolist()}
            self.byte_ids = np.array([named[f"<0x{b:02X}>"] for b in range(256)])
        usable = np.flatnonzero(kinds_ == NORMAL)
        self.unknown_score = float(self.scores[usable].min()) - UNKNOWN_PENALTY
        self.ids = {self.pieces[i]: i for i in usable.tolist()}
        self.score_of = {p: float(self.scores[i]) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        # Units may be cut before blanks unless a piece has one behind another character.
        # A character that no piece has never merges, so line ends may be units of their own.
        cuts, line_end = not any(BLANK in p.lstrip(BLANK) for p in self.ids), "" if any("\n" in p for p in self.ids) else "\n"
        self.units = re.compile((f"{line_end}|" if line_end else "") + f"{BLANK}+[^{BLANK}{line_end}]*|[^{BLANK}{line_end}]+") if cuts else re.compile(r"(?s).+")
        with np.errstate(over="ignore"):
            hashes = np.array([self._hash(np.array([[ord(c)] for c in p], np.uint64))[-1, 0] for p in self.ids], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array(list(self.ids.values()), np.int32)[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        # One bit for the upper bits of each key spares most searches.
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.alone = np.zeros(len(self.pieces), dtype=bool)
        self.histories: dict[int, tuple[list[float], list[str], list[str]]] = {}
        if self.type == BPE:
            for p, i in self.ids.items():
                self.histories[i], self.alone[i] = self._history(p)
        # Then what ends at a character doesn't depend on sums of scores, only on the pieces just before.
        self.segmented = self.type == BPE and all(c in self.ids for p in self.ids for c in p)
        self.surfaces = [self._surface(i, k) for i, k in enumerate(kinds)]
        self._pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self._pair_answers = np.zeros(1 << PAIR_BITS, dtype=bool)
        self._units = Remembered(REMEMBERED_UNITS)

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    @classmethod
    def _hash(cls, points: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes of units of one length, a column each; the first row is the empty prefix."""
        out = np.zeros((len(points) + 1, points.shape[1]), np.uint64)
        values = (points + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(32)
        for k in range(len(points)):
            out[k + 1] = out[k] * cls._FACTOR + values[k]
        return out

    def _found(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the hashes are pieces, their ids)."""
        at = np.flatnonzero(self.maybe[wanted >> np.uint64(64 - FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.keys, wanted[at]), len(self.keys) - 1)
        hit = self.keys[place] == wanted[at]
        return at[hit], self.key_ids[place[hit]]

    def _surface(self, i: int, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if kind == CONTROL:
            return b""
        return UNKNOWN_SURFACE if kind == UNKNOWN else self.pieces[i].replace(BLANK, " ").encode()

    def _history(self, piece: str) -> tuple[tuple[list[float], list[str], list[str]], bool]:
        """How merging builds a piece from its characters, the best-scored union first and the leftmost of equals: the scores
        of the merges, and the first and the last part before each merge and at the end. Also whether one part is left."""
        parts, score = list(piece), self.score_of
        steps, firsts, lasts = [], [sys.intern(parts[0])], [sys.intern(parts[-1])]
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = score.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, k
            if at < 0:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
            steps.append(best)
            firsts.append(sys.intern(parts[0]))
            lasts.append(sys.intern(parts[-1]))
        return (steps, firsts, lasts), len(parts) == 1

    def _stays_apart(self, one: int, two: int) -> bool:
        """Whether merging two pieces side by side never joins the last part of one with the first part of the other."""
        steps, _, lasts = self.histories[one]
        steps_two, firsts, _ = self.histories[two]
        i, j, score = 0, 0, self.score_of
        while True:
            across = score.get(lasts[i] + firsts[j])
            left = steps[i] if i < len(steps) else None
            right = steps_two[j] if j < len(steps_two) else None
            if across is not None and (left is None or across > left) and (right is None or across >= right):
                return False
            if left is not None and (right is None or left >= right):
                i += 1
            elif right is not None:
                j += 1
            else:
                return True

    def _may_follow(self, keys: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces of a key (first << 32 | second) leaves them apart.

        Answers are kept in a table with one place for each hash value; a pair that shares its place with another is worked out
        again when it comes back.
        """
        place = (keys.view(np.uint64) * self._FACTOR) >> np.uint64(64 - PAIR_BITS)
        unknown = np.flatnonzero(self._pair_keys[place] != keys)
        if len(unknown):
            fresh, inverse = np.unique(keys[unknown], return_inverse=True)
            answers = np.array([self._stays_apart(key >> 32, key & 0xFFFFFFFF) for key in fresh.tolist()], dtype=bool)
            out = self._pair_answers[place]
            out[unknown] = answers[inverse]
            self._pair_keys[place[unknown]] = keys[unknown]
            # The last of several keys written to one place is the one that stays; its answer goes with it.
            kept = self._pair_keys[place[unknown]] == keys[unknown]
            self._pair_answers[place[unknown][kept]] = answers[inverse][kept]
            return out
        return self._pair_answers[place]

    def _viterbi(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ending at each character or -1 for an unknown one, its length) on the best path, for units of one length.

        All arrays have a row for each character and a column for each unit.
        """
        length, n = points.shape
        hashes = self._hash(points)
        powers = [np.uint64(1)]
        for _ in range(self.longest):
            powers.append(powers[-1] * self._FACTOR)
        best = np.zeros((length + 1, n), np.float32)
        last, size = np.full((length + 1, n), -1, np.int32), np.zeros((length + 1, n), np.int32)
        for end in range(1, length + 1):
            # An unknown character is a piece of its own; for BPE it never merges, so it may follow and be followed.
            known, _ = self._found(hashes[end] - hashes[end - 1] * powers[1])
            best[end], size[end] = best[end - 1] + np.float32(self.unknown_score), 1
            best[end, known], size[end, known] = -np.inf, 0
            for width in range(min(end, self.longest), 0, -1):
                start = end - width
                at, piece = self._found(hashes[end] - hashes[start] * powers[width])
                if not len(at):
                    continue
                if self.type == BPE:
                    before = last[start, at]
                    allowed = self.alone[piece]
                    follows = (before >= 0) & allowed
                    if follows.any():
                        allowed[follows] = self._may_follow((before[follows].astype(np.int64) << 32) | piece[follows])
                    # Pieces allowed at one place are compared by their own scores: there is only one.
                    value = np.where(allowed, self.scores[piece], -np.inf).astype(np.float32)
                else:
                    value = best[start, at] + self.scores[piece]
                better = (value > best[end, at]) | ((size[end, at] == 0) & (value > -np.inf))
                chosen = at[better]
                best[end, chosen], last[end, chosen], size[end, chosen] = value[better], piece[better], width
        return last[1:], size[1:]

    def _learn(self, units: list[str], into: dict[str, bytes]) -> None:
        by_length: dict[int, list[str]] = {}
        for unit in units:
            if self.segmented and len(unit) > 2 * (SEGMENT + WARM_UP):
                into[unit] = self._of_segments(unit)
                continue
            by_length.setdefault(len(unit), []).append(unit)
        with np.errstate(over="ignore"):
            for length, all_same in by_length.items():
                step = max(1, ADVANCE_CHARS // length)
                for begin in range(0, len(all_same), step):
                    same = all_same[begin: begin + step]
                    points = np.frombuffer("".join(same).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(same), length)
                    last, size = (x.T for x in self._viterbi(np.ascontiguousarray(points.T).astype(np.uint64)))
                    # Back-pointers of all units are followed together: a mark on each character that ends a piece of the path.
                    end, marks, rows = np.full(len(same), length), np.zeros(last.shape, dtype=bool), np.arange(len(same))
                    while len(rows):
                        marks[rows, end - 1] = True
                        end = end - size[rows, end - 1]
                        rows, end = rows[end > 0], end[end > 0]
                    row, at = np.nonzero(marks)
                    ids = last[row, at]
                    if (ids < 0).any():
                        row, ids = self._with_unknown(row, ids, points[row, at])
                    limits = np.searchsorted(row, np.arange(len(same) + 1)) * 4
                    data = ids.astype("<i4").tobytes()
                    for k, unit in enumerate(same):
                        into[unit] = data[limits[k]: limits[k + 1]]

    def _of_segments(self, unit: str) -> bytes:
        """Ids of one long unit, whose segments advance together.

        Which piece ends at a character depends on those that end at the ``longest`` characters before it. A segment begins early, as
        if the text did; where it agrees with the segment before over so many characters, it agrees with the whole from there on. If it
        does not, all begin earlier.
        """
        points, warm_up, reach = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32), WARM_UP, self.longest
        n = len(points)
        last, size = np.empty(n, np.int32), np.empty(n, np.int32)

        def filled(length: int) -> bool:
            starts, known = np.array([*range(0, n - length, SEGMENT), n - length]), 0
            step = max(1, ADVANCE_CHARS // length)
            for begin in range(0, len(starts), step):
                some = starts[begin: begin + step]
                lasts, sizes = self._viterbi(points[some[None, :] + np.arange(length)[:, None]].astype(np.uint64))
                for k, start in enumerate(some.tolist()):
                    at = known - start
                    if known and ((lasts[at - reach: at, k] != last[known - reach: known]).any() or (sizes[at - reach: at, k] != size[known - reach: known]).any()):
                        return False
                    last[known: start + length], size[known: start + length] = lasts[at:, k], sizes[at:, k]
                    known = start + length
            return True

        with np.errstate(over="ignore"):
            while not filled(min(n, warm_up + SEGMENT)):
                warm_up *= 4
        ends, end, sizes = [], n, size.tolist()
        while end:
            ends.append(end - 1)
            end -= sizes[end - 1]
        marks = np.array(ends[::-1])
        ids = last[marks]
        if (ids < 0).any():
            _, ids = self._with_unknown(np.zeros(len(ids), np.int64), ids, points[marks])
        return ids.astype("<i4").tobytes()

    def _with_unknown(self, row: np.ndarray, ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as byte pieces, or as the unknown piece, runs of which are one."""
        if self.byte_ids is not None and (points[ids < 0] < 128).all():
            return row, np.where(ids < 0, self.byte_ids[np.minimum(points, 127)], ids)
        rows, out, before = [], [], None
        for r, i, c in zip(row.tolist(), ids.tolist(), points.tolist()):
            if i >= 0:
                found = [i]
            elif self.byte_ids is not None:
                found = self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))].tolist()
            else:
                found = [] if before == (r, -1) else [self.unknown_id]
            rows += [r] * len(found)
            out += found
            before = (r, i)
        return np.array(rows), np.array(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers; an empty text has none."""
        self._units.turn()
        cut = []
        for text in texts:
            marked = text.replace(" ", BLANK)
            if text and self.dummy_prefix:
                marked = BLANK + marked
            cut.append(self.units.findall(marked))
        missing = self._units.missing(unit for found in cut for unit in found)
        units, fresh = self._units.new, {}
        self._learn([u for u in missing if len(u) <= LONG_UNIT], units)
        self._learn([u for u in missing if len(u) > LONG_UNIT], fresh)
        if fresh:
            return [b"".join([units[u] if u in units else fresh[u] for u in found]) for found in cut]
        return [b"".join([units[u] for u in found]) for found in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD."""
        surfaces = self.surfaces
        text = b"".join([surfaces[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_models: dict[str, Model] = {}


def model_at(path: str) -> Model:
    """The model of a file, read once a worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encoded(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``ids_col`` (array of int); a NULL text has no ids. A column of that name is replaced.

    Texts that are not kept go to the tasks only, not back.
    """
    rest = [c for c in (docs.columns if keep is None else keep) if c != ids_col]
    # A text that is kept goes to the tasks once.
    once = text_col in rest and docs.schema[text_col].dataType == T.StringType()
    at = rest.index(text_col) if once else len(rest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in batches:
            for part in _parts(batch):
                ids = model.encode(as_large_text(part.column(at)).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], values], names=[*rest, ids_col])

    schema = T.StructType([docs.schema[c] for c in rest]).add(ids_col, T.ArrayType(T.IntegerType()))
    source = docs.select(*[F.col(f"`{c}`") for c in rest], *([] if once else [F.col(f"`{text_col}`").cast("string").alias("__text")]))
    return source.mapInArrow(tidy(rows), schema)


# Rows of a batch that are encoded or decoded together.
PART_ROWS = 500


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(batch), PART_ROWS):
        yield batch.slice(begin, PART_ROWS)


def decoded(tokens: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns and ``text_col``; NULL ids give an empty text. A column of that name is replaced."""
    rest = [c for c in tokens.columns if c != text_col]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in batches:
            for part in _parts(batch):
                texts = [model.decode(np.array(ids or [], np.int64)) for ids in part.column(len(rest)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(texts, pa.string())], names=[*rest, text_col])

    schema = T.StructType([tokens.schema[c] for c in rest]).add(text_col, T.StringType())
    return tokens.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{ids_col}`").alias("__ids")).mapInArrow(tidy(rows), schema)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_tokens, n_bytes (byte pieces among them), ids_crc32 (ids as little-endian 32-bit integers),
    text_crc32 (the decoded text in UTF-8) and same (it equals the text; NULL counts as empty). The ids don't leave the task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        is_byte = np.zeros(len(model.pieces), dtype=bool)
        if model.byte_ids is not None:
            is_byte[model.byte_ids] = True
        for batch in batches:
            for part in _parts(batch):
                texts = as_large_text(part.column(1)).to_pylist()
                ids = [np.frombuffer(x, "<i4") for x in model.encode(texts)]
                back = [model.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([zlib.crc32(x.encode()) for x in back], pa.int64()),
                    pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
                ], names=[id_col, "n_tokens", "n_bytes", "ids_crc32", "text_crc32", "same"])

    schema = T.StructType().add(id_col, docs.schema[id_col].dataType)
    for name in ("n_tokens", "n_bytes", "ids_crc32", "text_crc32"):
        schema = schema.add(name, T.LongType())
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(tidy(rows), schema.add("same", T.BooleanType()))
