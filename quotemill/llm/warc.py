"""WARC archives compressed with Zstandard, one frame per record, and their reader.

An archive begins with a skippable frame that holds the dictionary of all its frames.
Archives are written and read by the tasks through the file system of the shared
folder, streaming; a table of paths, not the files' contents, goes through Spark. Each
attempt of a task writes files of its own name, and only those of the attempt that
counted are in the table, so lost or repeated tasks do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize, scratch_path

#: Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

ARCHIVE_BYTES = 16 * 1024**2
DICTIONARY_BYTES = 32 * 1024
_SAMPLE_RECORDS = 64
_SAMPLE_BYTES = 64 * 1024
_CHUNK = 256 * 1024
DATE = "2000-01-01T00:00:00Z"
RECORD_SCHEMA = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string,"
    " refers_to bigint, payload binary"
)


def record_id(page_id: int) -> str:
    """A version 8 UUID that carries the 64 bits of a page id."""
    bits = page_id % 2**64
    number = (0x8 << 76) | ((bits >> 62) << 64) | (0b10 << 62) | (bits & (2**62 - 1))
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(record: str | None) -> int | None:
    """The page id in such a record id; None for any other."""
    if record is None:
        return None
    number = uuid.UUID(record.removeprefix("<urn:uuid:").removesuffix(">")).int
    if number >> 80 or (number >> 76) & 0xF != 0x8 or (number >> 62) & 0b11 != 0b10:
        return None
    bits = ((number >> 64) & 0b11) << 62 | number & (2**62 - 1)
    return bits - 2**64 if bits >= 2**63 else bits


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, first, date: str) -> bytes:
    """One record; ``first`` is the page whose response a revisit refers to, or None."""
    identity = record_id(int(page_id)) if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest(payload))}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": identity,
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        # A header is one line: control characters and blanks are percent-encoded.
        headers["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if first is not None:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(int(first))}
    headers["Content-Length"] = str(len(block))
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "replace") for k, v in headers.items())
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Writes archives below a folder, a new one when the last has reached its size."""

    def __init__(self, folder: str, archive_bytes: int):
        self.files, self.base = fs.FileSystem.from_uri(folder)
        self.folder, self.limit = folder, archive_bytes
        self.waiting: list[bytes] = []
        self.stream = self.packer = None
        self.name, self.records, self.written = "", 0, 0

    def add(self, record: bytes) -> Iterator[tuple[str, int]]:
        if self.stream is None:
            self.waiting.append(record)
            if len(self.waiting) < _SAMPLE_RECORDS:
                return
            self._open()
        else:
            self._put(record)
        if self.written >= self.limit:
            yield self._close()

    def end(self) -> Iterator[tuple[str, int]]:
        if self.waiting:
            self._open()
        if self.stream is not None:
            yield self._close()

    def _open(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.stream = self.files.open_output_stream(f"{self.base}/{self.name}")
        self.records = self.written = 0
        try:
            samples = [record[:_SAMPLE_BYTES] for record in self.waiting]
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:  # too little to learn from; the frame is optional
            self.packer = zstandard.ZstdCompressor(level=3)
        else:
            self.packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary)
            content = dictionary.as_bytes()
            self._write(DICTIONARY_FRAME.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
        for record in self.waiting:
            self._put(record)
        self.waiting = []

    def _put(self, record: bytes) -> None:
        self._write(self.packer.compress(record))
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.written += len(data)

    def _close(self) -> tuple[str, int]:
        self.stream.close()
        self.stream = None
        return f"{self.folder}/{self.name}", self.records


def read_frames(stream: BinaryIO) -> Iterator[bytes]:
    """The contents of an archive's frames, one after another; holds one record at a time."""
    data = stream.read(_CHUNK)
    dictionary = None
    if data[:4] == DICTIONARY_FRAME.to_bytes(4, "little"):
        size = int.from_bytes(data[4:8], "little")
        while len(data) < 8 + size:
            more = stream.read(_CHUNK)
            if not more:
                raise ValueError("the dictionary ends early")
            data += more
        content, data = data[8 : 8 + size], data[8 + size :]
        if content[:4] == zstandard.FRAME_HEADER:
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := stream.read(_CHUNK)):
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                break
            if not (data := stream.read(_CHUNK)):
                raise ValueError("a frame ends early")
        data = frame.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Headers and block of one record, validated: version, required headers, lengths.

    A response must hold the payload its digest and HTTP length tell, a revisit must
    name the record it refers to. Anything else raises ``ValueError``.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError(f"not a record of {VERSION.decode()}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise ValueError(f"no header: {name!r}")
        headers[name.strip().title()] = value.strip()
    if missing := [name for name in REQUIRED if name.title() not in headers]:
        raise ValueError(f"missing headers: {missing}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, not {length}")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not gap or told is None:
        raise ValueError("no HTTP header with a length")
    kind, size = headers["Warc-Type"], int(told[1])
    found = headers.get("Warc-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != found):
        raise ValueError("the payload does not match its length or digest")
    if kind == "revisit" and (payload or "Warc-Refers-To" not in headers):
        raise ValueError("a revisit with a payload or without a reference")
    return {
        "page_id": page_of(headers["Warc-Record-Id"]),
        "url": headers.get("Warc-Target-Uri"),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": found,
        "refers_to": page_of(headers.get("Warc-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


def write_archives(
    pages: DataFrame, folder: str | None = None, *, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE
) -> DataFrame:
    """Archives the pages and returns the written archives: ``path`` and ``records``.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored. Of equal
    payloads of at least ``least_bytes`` bytes the page with the smallest id becomes a
    response, the others revisits of it. A null html is an empty payload, a null url
    leaves out the header. A page without an id is a response that nothing refers to.
    Rows that repeat the smallest id are all responses. An empty table writes nothing.
    ``folder`` is a URI that all executors reach, by default a fresh one in the shared
    folder.
    """
    spark = pages.sparkSession
    target = folder or scratch_path(spark, "archives")
    if "://" not in target and not target.startswith("file:"):
        target = f"file://{target}"
    if target.startswith("file:/") and not target.startswith("file://"):
        target = "file://" + target.removeprefix("file:")
    files, base = fs.FileSystem.from_uri(target)
    files.create_dir(base, recursive=True)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("key"))
    repeated = materialize(
        keyed.where((F.octet_length("payload") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("key")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("key", "first"),
        "repeated-payloads",
    )
    marked = keyed.join(repeated, "key", "left").select(
        "page_id", "url", "payload", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("first")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, done = ArchiveWriter(target, archive_bytes), []
        for batch in batches:
            for page_id, url, data, first in zip(
                *(batch[c].astype(object).where(batch[c].notna(), None) for c in ("page_id", "url", "payload", "first")), strict=True
            ):
                done += writer.add(_record(page_id, url, bytes(data), first, date))
        done += writer.end()
        yield pd.DataFrame(done, columns=["path", "records"])

    # Ids travel as text: pandas would turn nullable integers into floating point.
    texts = marked.select(F.col("page_id").cast("string"), "url", "payload", F.col("first").cast("string"))
    return materialize(texts.mapInPandas(write, "path string, records bigint"), "archive-list")


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the archives whose ``path`` is given, one row each, validated.

    ``payload`` is null for revisits; their bytes and digest are those of the record
    they refer to. An archive that breaks the format raises.
    """
    number = max(1, archives.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                files, place = fs.FileSystem.from_uri(path)
                with files.open_input_stream(place) as stream:
                    held, size = [], 0
                    for data in read_frames(stream):
                        held.append(parse_record(data))
                        size += len(data)
                        if size >= ARCHIVE_BYTES // 2:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    return archives.select("path").repartitionByRange(number, "path").mapInPandas(read, RECORD_SCHEMA)


def _rows(records: list[dict]) -> pd.DataFrame:
    rows = pd.DataFrame(records)
    for name in ("page_id", "refers_to"):
        rows[name] = pd.array([r[name] for r in records], dtype="Int64")
    return rows
