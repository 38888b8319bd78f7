"""Web archives: writing records, one gzip member each, and a reader that goes on behind damage.

A duplicate payload is written as a revisit of the record that holds it. Archives are written by tasks into a shared folder; a
manifest, stored as a table, names the files of the attempts that succeeded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.llm.common import file_system, shared_folder, stored

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
FIELD_NAME = re.compile(rb"[A-Za-z0-9!#$%&'*+.^_`|~-]+")
DIGESTS = ("md5", "sha1", "sha256", "sha512")
MEMBER_MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

# A new archive is begun once one has so many bytes; what a reading task holds is bounded by this and the longest record.
ARCHIVE_BYTES = 64 << 20
# Payloads below this size are always stored, never revisited.
REVISIT_FROM_BYTES = 100
FEED_BYTES = 1 << 16


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        head, separator, body = self.block.partition(b"\r\n\r\n")
        return body if separator else head


@dataclass
class Gap:
    start: int
    end: int
    reason: str


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    head += f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return VERSION + head.encode() + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _parsed(data: bytes, at: int, end: int) -> tuple[Record, int]:
    """The record at a place and where it ends. Raises ValueError if anything about it doesn't hold."""
    if not VERSION_LINE.match(data, at):
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", at, end)
    if stop < 0:
        raise ValueError("header not ended")
    headers = {}
    for line in data[at: stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not FIELD_NAME.fullmatch(name):
            raise ValueError("bad header line")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise ValueError("bad content length")
    begin = stop + 4
    finish = begin + int(length)
    if finish + 4 > end or data[finish: finish + 4] != b"\r\n\r\n":
        raise ValueError("content length doesn't fit")
    block = data[begin: finish]
    if given := headers.get("warc-block-digest"):
        kind, _, digest = given.partition(":")
        if kind not in DIGESTS:
            raise ValueError("unknown block digest")
        value = hashlib.new(kind, block)
        if digest.lower() != value.hexdigest() and digest != base64.b32encode(value.digest()).decode():
            raise ValueError("block digest differs")
    return Record(headers, block), finish + 4


def _unpacked(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at a place and where it ends."""
    unpacker, out, fed = zlib.decompressobj(31), [], at
    while not unpacker.eof:
        part = data[fed: fed + FEED_BYTES]
        if not part:
            raise ValueError("member not ended")
        try:
            out.append(unpacker.decompress(part))
        except zlib.error as error:
            raise ValueError(f"bad member: {error}") from None
        fed += len(part)
    return b"".join(out), fed - len(unpacker.unused_data)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """The records of an archive, packed or plain, and a gap for each run of bytes that is no valid record.

    After a failed check the search goes on one byte further, to the next gzip magic or version line from which a whole valid
    record can be read, so later records are never lost to earlier damage.
    """
    at, broken, reason = 0, None, ""
    begins = re.compile(re.escape(MEMBER_MAGIC) + rb"|" + VERSION_LINE.pattern)
    while at < len(data):
        try:
            if data.startswith(MEMBER_MAGIC, at):
                inner, end = _unpacked(data, at)
                record, used = _parsed(inner, 0, len(inner))
                if used != len(inner):
                    raise ValueError("bytes behind the record in its member")
            else:
                record, end = _parsed(data, at, len(data))
        except ValueError as error:
            if broken is None:
                broken, reason = at, str(error)
            found = begins.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if broken is not None:
            yield Gap(broken, at, reason)
            broken = None
        yield record
        at = end
    if broken is not None:
        yield Gap(broken, len(data), reason)


def with_record_types(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Adds _payload (binary), _digest, _refers (the id of the record to revisit, else NULL).

    Of equal payloads of at least ``REVISIT_FROM_BYTES`` bytes the smallest id is stored and the others revisit it. A NULL
    payload is empty. Rows that repeat the smallest id are all stored; rows without an id revisit if any row with one exists.
    """
    keyed = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("_payload")).withColumn("_digest", F.sha2("_payload", 256))
    shared = keyed.where(F.octet_length("_payload") >= REVISIT_FROM_BYTES).groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return keyed.join(shared, "_digest", "left").select("_id", "_payload", "_digest", F.when(~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("_refers"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Writes the pages as archives below ``folder``; returns the stored manifest: path, size, records."""
    typed = with_record_types(pages, id_col, payload_col)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        path, size, records = "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "size": [size], "records": [records]}, schema=pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]))

        system, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, size, records = system.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                identifier = "" if row["_id"] is None else str(row["_id"])
                headers = [("WARC-Type", "revisit" if row["_refers"] is not None else "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                           ("WARC-Date", RECORD_DATE), ("Content-Type", "application/http; msgtype=response"), ("X-Page-Id", identifier),
                           ("WARC-Payload-Digest", f"sha256:{row['_digest']}"), ("X-Payload-Length", str(len(row["_payload"])))]
                if row["_refers"] is not None:
                    headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(row["_refers"]))]
                packed = member(record_bytes(headers, HTTP_HEAD + (row["_payload"] if row["_refers"] is None else b"")))
                out.write(packed)
                size, records = size + len(packed), records + 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stored(typed.mapInArrow(write, "path string, size long, records long"), "warc-manifest")


RECORD_SCHEMA = "path string, record_type string, page_id long, payload_bytes long, payload_digest string, refers_to long, payload binary"
GAP_SCHEMA = "path string, gap_start long, gap_end long, reason string"


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _archive(path: str) -> bytes:
    system, name = file_system(path)
    with system.open_input_file(name) as source:
        return source.read()


def read_archives(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """The valid records of the archives named in column ``path``. Digest and length are worked out from stored payloads, and
    taken from the header of a revisit, which has none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                block, held = [], 0
                for record in salvage(_archive(path)):
                    if isinstance(record, Gap):
                        continue
                    get, payload = record.headers.get, record.payload
                    revisit = get("warc-type") == "revisit"
                    block.append({
                        "path": path, "record_type": get("warc-type"), "page_id": _number(get("x-page-id")),
                        "payload_bytes": _number(get("x-payload-length")) if revisit else len(payload),
                        "payload_digest": get("warc-payload-digest", "").partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest(),
                        "refers_to": _number(get("x-refers-to-page-id")) if revisit else None,
                        "payload": payload if with_payload and not revisit else None,
                    })
                    held += len(payload)
                    if len(block) >= 1000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(block, schema=schema)
                        block, held = [], 0
                if block:
                    yield pa.RecordBatch.from_pylist(block, schema=schema)

    return _one_task_each(paths).mapInArrow(rows, RECORD_SCHEMA)


def read_gaps(paths: DataFrame) -> DataFrame:
    """The quarantined byte ranges of the archives: path, gap_start, gap_end, reason."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("gap_start", pa.int64()), ("gap_end", pa.int64()), ("reason", pa.string())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                gaps = [{"path": path, "gap_start": x.start, "gap_end": x.end, "reason": x.reason} for x in salvage(_archive(path)) if isinstance(x, Gap)]
                if gaps:
                    yield pa.RecordBatch.from_pylist(gaps, schema=schema)

    return _one_task_each(paths).mapInArrow(rows, GAP_SCHEMA)


def _one_task_each(paths: DataFrame) -> DataFrame:
    """Deals the names of the archives out over the partitions, so that reading them is spread."""
    partitions = max(1, int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return paths.select("path").repartition(partitions, "path")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page, read back from archives written from the pages: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    manifest = write_archives(pages, shared_folder(spark, "warc"))
    return read_archives(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
