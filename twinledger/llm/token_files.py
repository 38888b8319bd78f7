"""Token ids in binary files: one concatenated id array per file, document boundaries and document ids in Elias-Fano code.

A sequence of n ascending numbers below u takes about 2 + log2(u / n) bits a number: the low bits of each lie in a packed array,
the high bits are counted in unary in a bit array. The k-th number is found by selecting the k-th set bit, from a sample of
every 64th position, so no table of 64-bit offsets is kept.

Layout of a file: ids (little-endian, 16 or 32 bits), then the sections boundaries and document ids, then the footer, then its
length (8 bytes) and the magic.
"""

from __future__ import annotations

import functools
import json
import re
import string
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twinledger.llm.common import as_large_text, file_system, shared_folder, stored

MAGIC = b"EFTOKEN1"
SAMPLE = 64
# Pieces of text whose ids a worker remembers; a bound on its memory, not on the vocabulary.
REMEMBERED = 600_000
# Documents taken out of a batch together.
PART_ROWS = 500
# Fixed pattern of the vocabulary's pre-tokenizer.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


# A line break between other characters than white space is a piece of its own.
LINE_BREAK = re.compile(r"\n(?<=\S\n)(?=\S)")


@dataclass
class EliasFano:
    """Ascending numbers from 0 to ``top``; ``select`` gives them back by index."""

    n: int
    low_bits: int
    low: np.ndarray  # packed bits, uint8
    high: np.ndarray  # packed bits, uint8
    samples: np.ndarray  # position of every SAMPLE-th set bit, uint32 or uint64

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1) if low_bits else np.zeros((n, 0), np.uint64)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) + 1) if n else 0, np.uint8)
        high[places] = 1
        wide = np.uint32 if not n or places[-1] < 2**32 else np.uint64
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), np.packbits(high, bitorder="little"), places[::SAMPLE].astype(wide))

    def select(self, indexes: np.ndarray) -> np.ndarray:
        """The numbers at these indexes."""
        indexes = np.asarray(indexes, np.int64)
        if not len(indexes):
            return np.zeros(0, np.uint64)
        out = np.empty(len(indexes), np.uint64)
        for k in np.unique(indexes // SAMPLE):
            # Set bits from the sampled one up to the next sampled one.
            begin = int(self.samples[k])
            end = int(self.samples[k + 1]) if k + 1 < len(self.samples) else len(self.high) * 8
            bits = np.unpackbits(self.high[begin // 8: -(-end // 8)], bitorder="little")
            ones = np.flatnonzero(bits[begin % 8:]) + begin
            mine = np.flatnonzero(indexes // SAMPLE == k)
            out[mine] = (ones[indexes[mine] % SAMPLE] - indexes[mine]).astype(np.uint64)
        return (out << np.uint64(self.low_bits)) | self._lows(indexes)

    def all(self) -> np.ndarray:
        """All numbers in order."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(np.arange(self.n))

    def _lows(self, indexes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(indexes), np.uint64)
        for bit in range(self.low_bits):
            at = indexes * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(bit)
        return out

    def packed(self) -> tuple[dict, bytes]:
        return ({"n": self.n, "low_bits": self.low_bits, "low": len(self.low), "high": len(self.high), "samples": len(self.samples), "wide": self.samples.itemsize},
                self.low.tobytes() + self.high.tobytes() + self.samples.astype(self.samples.dtype.newbyteorder("<")).tobytes())

    @classmethod
    def unpacked(cls, about: dict, data: bytes) -> EliasFano:
        a, b = about["low"], about["low"] + about["high"]
        return cls(about["n"], about["low_bits"], np.frombuffer(data[:a], np.uint8), np.frombuffer(data[a:b], np.uint8), np.frombuffer(data[b:], f"<u{about['wide']}"))


class Differing(Exception):
    """A part holds a character that the pattern and the library take for different classes."""


class BlankThenSpace(Exception):
    """White space behind a blank, where a text can't be cut without looking at what follows."""


class KnownParts(dict):
    """Ids of parts by key, as bytes. A part that isn't there comes from the older ones or is worked out as it is looked up."""

    def __init__(self, worked_out: Callable[[str], bytes]):
        super().__init__()
        self.worked_out, self.older = worked_out, {}

    def turn(self) -> None:
        """Lets the older parts go once there are enough newer ones."""
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.worked_out(key)
        self[key] = found
        return found


class Encoder:
    """Ids of texts by the tokenizers library, which is asked once for each piece while it is remembered.

    A blank before a character that isn't white space always begins a piece of the vocabulary's pre-tokenizer, so texts are
    cut there and at single line breaks and the parts looked up, each once; an unknown part is cut by the pre-tokenizer's pattern
    and only new pieces are encoded. Texts with white space behind a blank are cut by the pattern altogether. Texts that hold an added token, or a character that the pattern and the library class differently, go to the library whole.
    """

    def __init__(self, path: str, dtype: str, special_tokens: bool = True):
        self.tokenizer, self.dtype, self.known = Tokenizer.from_file(path), dtype, KnownParts(self._ids_of_part)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.model = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values() if special_tokens or not token.special]
        self.alike, self.differing = set(), set()

    # Parts go by a key: what follows the blank that begins a part, or a blank and the part itself if it begins with none.

    @staticmethod
    def _key(part: str) -> str:
        return part[1:] if len(part) > 1 and part[0] == " " and not part[1].isspace() else " " + part

    @staticmethod
    def _part(key: str) -> str:
        return key[1:] if key[0] == " " else " " + key

    @staticmethod
    def keys(text: str) -> list[str]:
        keys = []
        for line in LINE_BREAK.split(text):
            parts = line.split(" ")
            if parts[0]:
                parts[0] = " " + parts[0]
            else:
                del parts[0]
            keys += parts
            keys.append(" \n")
        keys.pop()
        return keys

    def _differs(self, character: str) -> bool:
        """Whether the library takes a character for another class (letter, number, white space, other) than the pattern does."""
        joins = lambda before: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(before + character)) == 1
        letter, number, other = (len(PIECES.findall(before + character)) == 1 for before in "a1!")
        return (letter, number, other) != (joins("a"), joins("1"), joins("!")) or (character.isalpha() and not letter)

    def _ids_of_part(self, key: str) -> bytes:
        """Ids of a part that isn't known; its pieces are remembered, too."""
        if not self.alike.issuperset(key):
            fresh = set(key) - self.alike - self.differing
            self.differing.update(filter(self._differs, fresh))
            self.alike |= fresh - self.differing
            if not self.differing.isdisjoint(key):
                raise Differing
        word = key[1:] if key[:1] == " " else key
        # A part of letters only is one piece as it stands, one of letters before punctuation is two.
        if not word.isalpha():
            if not key or key[0] != " " and key[0].isspace():
                raise BlankThenSpace
            letters = word.rstrip(string.punctuation)
            if letters.isalpha():
                return self.known[key[: len(letters) - len(word)]] + self.known[" " + word[len(letters):]]
            pieces = PIECES.findall(self._part(key))
            if len(pieces) > 1:
                return b"".join([self.known[self._key(piece)] for piece in pieces])
        # What the library's byte-level pre-tokenizer makes of a piece: one character a byte, printable ASCII for itself.
        part = self._part(key)
        shown = part.replace(" ", BYTE_CHARACTERS[32]) if part.isascii() and part.isprintable() else "".join([BYTE_CHARACTERS[b] for b in part.encode("utf-8", "replace")])
        return b"".join([self.id_bytes[token.id] for token in self.model.tokenize(shown)])

    @functools.cached_property
    def id_bytes(self) -> list[bytes]:
        """Every id of the vocabulary as bytes."""
        width = np.dtype(self.dtype).itemsize
        return [i.to_bytes(width, "little") for i in range(max(self.tokenizer.get_vocab().values(), default=-1) + 1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as bytes."""
        return [self._encoded(text) for text in texts]

    def _encoded(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self._by_library(text)
        self.known.turn()
        try:
            try:
                return b"".join(map(self.known.__getitem__, self.keys(text)))
            except BlankThenSpace:
                return b"".join([self.known[self._key(piece)] for piece in PIECES.findall(text)])
        except Differing:
            return self._by_library(text)

    def _by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", special_tokens: bool = False) -> DataFrame:
    """Encodes the documents in ascending order of their ids into files below ``folder``; returns the stored manifest.

    Manifest: shard (ascending with the ids), path, n_docs, n_ids. Each text is followed by ``end_id``; a NULL text is empty.
    With ``special_tokens`` a special token spelled out in a text gives its id, as the library does unless told otherwise; without,
    it is text like any other. Rows without an id come first. Rows that share an id follow each other in the order of a hash of their texts. Other columns
    are ignored; an empty table gives no file. Texts are dealt out by ranges of (id, text hash), so nothing is gathered.
    """
    typed = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    ranged = typed.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie").select(F.spark_partition_id().alias("_shard"), "_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, encoder, out, system, root, name, shard = 16, None, None, None, None, "", 0
        ids, lengths = [], []
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                encoder = _encoder(tokenizer_path, special_tokens)
                width, shard = 8 * np.dtype(encoder.dtype).itemsize, batch.column(0)[0].as_py()
                system, root = file_system(folder)
                system.create_dir(root, recursive=True)
                name = f"{shard:06d}-{_attempt()}.ids"
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            end = np.array([end_id], encoder.dtype).tobytes()
            ids += batch.column(1).to_pylist()
            for begin in range(0, len(batch), PART_ROWS):
                for encoded in encoder.encode(as_large_text(batch.column(2).slice(begin, PART_ROWS)).to_pylist()):
                    out.write(encoded + end)
                    lengths.append(len(encoded) // (width // 8) + 1)
        if out is not None:
            n_null = sum(i is None for i in ids)
            present = np.array(ids[n_null:], np.int64)
            base = int(present[0]) if len(present) else 0
            sections, about = b"", {}
            for key, values in (("ends", np.cumsum(lengths)), ("ids", (present - base).view(np.uint64))):
                head, data = EliasFano.of(values).packed()
                about[key] = {**head, "at": len(sections), "bytes": len(data)}
                sections += data
            footer = json.dumps({"width": width, "n_docs": len(ids), "n_null": n_null, "base": base, "n_ids": int(sum(lengths)), "sections": len(sections), **about}).encode()
            out.write(sections + footer + len(footer).to_bytes(8, "little") + MAGIC)
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"], "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([int(sum(lengths))], pa.int64())})

    return stored(ranged.mapInArrow(write, "shard int, path string, n_docs long, n_ids long"), "token-manifest")


_encoders: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, special_tokens: bool) -> Encoder:
    if (path, special_tokens) not in _encoders:
        encoder = Encoder(path, "<u4", special_tokens)
        if encoder.tokenizer.get_vocab_size() <= 1 << 16:
            encoder.dtype = "<u2"
        _encoders[path, special_tokens] = encoder
    return _encoders[path, special_tokens]


def _attempt() -> str:
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.taskAttemptId()}" if context else "0"


@dataclass
class TokenFile:
    """A token file opened for reading; ids stay in the file until asked for."""

    source: pa.NativeFile
    about: dict
    ends: EliasFano
    ids: EliasFano

    @classmethod
    def open(cls, path: str) -> TokenFile:
        system, name = file_system(path)
        source = system.open_input_file(name)
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path}: not a token file")
        length = int.from_bytes(tail[:8], "little")
        about = json.loads(source.read_at(length, size - 16 - length))
        begin = size - 16 - length - about["sections"]
        part = lambda key: EliasFano.unpacked(about[key], source.read_at(about[key]["bytes"], begin + about[key]["at"]))
        return cls(source, about, part("ends"), part("ids"))

    def bounds(self, k: int) -> tuple[int, int]:
        """Where the ids of the k-th document begin and end, by select."""
        found = self.ends.select(np.array([k - 1, k] if k else [k])).astype(np.int64)
        return (int(found[0]), int(found[1])) if k else (0, int(found[0]))

    def read(self, begin: int, end: int) -> np.ndarray:
        width = self.about["width"] // 8
        return np.frombuffer(self.source.read_at((end - begin) * width, begin * width), f"<u{width}")

    def doc_ids(self) -> list[int | None]:
        return [None] * self.about["n_null"] + (self.ids.all().view(np.int64) + self.about["base"]).tolist()


# Ids read from a file at once.
READ_IDS = 4 << 20


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked
    for, ids. The starts of the files are running sums over the manifest, which has one row a file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile.open(path)
                ends, doc_ids = file.ends.all().astype(np.int64), file.doc_ids()
                k, begin = 0, 0
                while k < len(ends):
                    # Whole documents, about READ_IDS ids at once; a longer document is read alone.
                    last = max(k + 1, int(np.searchsorted(ends, begin + READ_IDS, side="right")))
                    ids = file.read(begin, int(ends[last - 1])).astype("<u4")
                    cuts = np.concatenate([[begin], ends[k:last]]) - begin
                    parts = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                    columns = {"doc_id": pa.array(doc_ids[k:last], pa.int64()), "start": pa.array(start + begin + cuts[:-1], pa.int64()), "n_tokens": pa.array(np.diff(cuts), pa.int64()),
                               "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64())}
                    if with_ids:
                        columns["ids"] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(columns)
                    begin, k = int(ends[last - 1]), last

    partitions = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return placed.select("path", "_start").repartition(partitions, "path").mapInArrow(rows, schema)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the documents as token files, with the library's defaults for special tokens, and reads them back."""
    return read_token_files(write_token_files(docs, shared_folder(spark, "tokens"), tokenizer_path, special_tokens=True))
