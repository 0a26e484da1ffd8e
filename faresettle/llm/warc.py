"""WARC archives in Zstandard: one frame per record, the dictionary in a skippable frame ahead."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from faresettle.llm.staging import stage
from faresettle.session import scratch_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

LEAST_REVISIT = 1000
DICTIONARY_BYTES = 64 * 1024
DICTIONARY_PAGES = 400
DICTIONARY_PAGE_BYTES = 65_536
ARCHIVE_BYTES = 16 * 1024 * 1024
LEVEL = 3
# Tasks that archives are dealt to for reading, one archive each up to here.
MOST_READERS = 50_000


class ArchiveError(ValueError):
    """An archive that isn't what its frames, headers or lengths say."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def load_dictionary(data: bytes) -> tuple[bytes, int]:
    """The dictionary in the leading skippable frame (itself plain or a Zstandard frame), and where the frame ends."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return b"", 0
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    if end > len(data):
        raise ArchiveError("the dictionary frame is cut off")
    held = data[8:end]
    if held[:4] == struct.pack("<I", FRAME):
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    return held, end


def frame_end(data: bytes, begin: int) -> int:
    """Where the Zstandard frame at `begin` ends, by its block headers."""
    if len(data) - begin < 6 or struct.unpack_from("<I", data, begin)[0] != FRAME:
        raise ArchiveError(f"no frame at byte {begin}")
    at = begin + zstandard.frame_header_size(data[begin : begin + 18])
    while True:
        if at + 3 > len(data):
            raise ArchiveError("a frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise ArchiveError("a block of a reserved type")
        at += 3 + (1 if kind == 1 else size)
        if last:
            break
    at += 4 * (data[begin + 4] >> 2 & 1)
    if at > len(data):
        raise ArchiveError("a frame is cut off")
    return at


def parse_record(data: bytes) -> Record:
    """One whole record: version, headers, a block of the length they give, two line ends."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ArchiveError("no WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"a header without a name: {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-record-id", "warc-type", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"no {name}")
    length = headers["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"content-length {length} in a record with {len(rest) - 4} bytes")
    return Record(headers, rest[:-4])


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive, one frame after the other."""
    dictionary, at = load_dictionary(data)
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=held)
    while at < len(data):
        if data[at : at + 4] != struct.pack("<I", FRAME) and len(data) - at >= 8 and struct.unpack_from("<I", data, at)[0] & ~15 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                raise ArchiveError("a skippable frame is cut off")
            continue
        end = frame_end(data, at)
        frame, at = data[at:end], end
        content = decoder.decompressobj().decompress(frame)
        size = zstandard.frame_content_size(frame)
        if size >= 0 and size != len(content):
            raise ArchiveError(f"a frame of {len(content)} bytes says {size}")
        yield parse_record(content)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, digest: str) -> bytes:
    """A response with its payload, or a revisit that has only the response's head."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    uri = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url or "")
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{uuid.uuid4().urn}>",
        "WARC-Date": RECORD_DATE,
        "WARC-Target-URI": uri,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Block-Digest": _sha1(block),
        "X-Payload-Length": str(len(payload)),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "X-Refers-To-Page": str(refers_to)}
    headers["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v or k == "Content-Length")
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample: the pages with the smallest hashes; none if they are too few to train on."""
    text = F.substring(F.col("payload"), 1, DICTIONARY_PAGE_BYTES)
    rows = pages.where("length(payload) > 0").select("page_id", "digest").orderBy("digest", "page_id").limit(DICTIONARY_PAGES)
    marks = [r["digest"] for r in rows.select("digest").distinct().collect()]
    samples = [bytes(r["x"]) for r in pages.where(F.col("digest").isin(marks)).select("digest", text.alias("x")).dropDuplicates(["digest"]).collect()] if marks else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def with_payloads(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.sha1("payload"))


def with_revisits(pages: DataFrame) -> DataFrame:
    """`refers_to`: the largest `page_id` of equal long payloads, for the other pages that have it; else null.

    Only digests and ids are grouped; ids of repeated payloads are joined back, and Spark splits a digest that
    very many pages share. Rows that repeat the response's id are responses too, as is a page without an id
    if no equal one has an id.
    """
    long = F.octet_length("payload") >= LEAST_REVISIT
    largest = (
        pages.where(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1 AND largest IS NOT NULL")
        .select("digest", "largest")
    )
    refers = F.when(long & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return pages.join(largest, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `with_revisits` rows as archives in `folder`; the manifest `path`, `records`, `bytes` of what counts.

    Each attempt of a task writes names of its own and only what a finished attempt reports is in the manifest,
    so lost executors and repeated tasks do no harm. The manifest is written before it is returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(root, recursive=True)
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        parts: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            path = f"{root}/{name}-{number:04d}.warc.zst"
            with store.open_output_stream(path) as out:
                out.write(dictionary_frame(dictionary) if dictionary else b"")
                for part in parts:
                    out.write(part)
            where = folder.rstrip("/") + path[len(root) :]
            return pa.RecordBatch.from_pydict({"path": [where], "records": pa.array([len(parts)], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "digest"))):
                page_id, url, payload, refers_to, digest = row
                record = write_record(page_id, url, payload, refers_to, refers_to is not None, digest)
                parts.append(encoder.compress(record))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield flush()
                    parts, size, number = [], 0, number + 1
        if parts:
            yield flush()

    return stage(pages.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _facts(record: Record) -> tuple:
    """What a record says, after its block and payload digests and its payload's length have been checked."""
    headers, block = record
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise ArchiveError("a block differs from its digest")
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ArchiveError("no HTTP head")
    kind = headers["warc-type"]
    if kind == "response" and _sha1(payload) != digest:
        raise ArchiveError("a payload differs from its digest")
    size = int(headers.get("x-payload-length", len(payload)))
    if kind == "response" and size != len(payload):
        raise ArchiveError("a payload differs from its length")
    page = headers.get("x-page-id")
    refers = headers.get("x-refers-to-page")
    plain = base64.b32decode(digest.removeprefix("sha1:")).hex()
    return int(page) if page else None, size, plain, kind, int(refers) if refers else None, headers.get("warc-target-uri")


def read_archives(manifest: DataFrame) -> DataFrame:
    """`RECORD_SCHEMA` for every record of the archives in `manifest`, an archive at a time in a task.

    A wrong header, length or digest, a cut-off frame, or a number of records that isn't the manifest's raises
    `ArchiveError`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                with store.open_input_stream(at) as source:
                    rows = [_facts(r) for r in read_archive(source.read())]
                if len(rows) != records:
                    raise ArchiveError(f"{len(rows)} records in {path}, {records} written")
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    # The manifest is a few short rows to Spark, but each stands for an archive.
    spread = manifest.select("path", "records").repartition(max(1, min(manifest.count(), MOST_READERS)), "path")
    return spread.mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page to archives in the shared folder, read them back: `RECORD_SCHEMA` per page.

    A null html is an empty payload; null ids and urls are left out of the headers and read back as null; other
    columns are ignored; an empty table gives no rows.
    """
    rows = with_payloads(pages)
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(with_revisits(rows), folder, train_dictionary(rows), archive_bytes))
