"""WARC archives with a Zstandard dictionary: one frame a record, read back and validated."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.storage import open_input, open_output, shared_folder, stored

#: Skippable frame that holds an archive's dictionary, and that of Zstandard data (both fixed by their formats).
DICTIONARY_FRAME = 0x184D2A5D
DATA_FRAME = 0xFD2FB528
DICTIONARY_BYTES = 64 << 10
#: Payload bytes from which a dictionary is trained, the first ones of an archive.
SAMPLE_BYTES = 4 << 20
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
LEVEL = 3
EMPTY_TIME = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


@dataclass
class Record:
    """One record: headers by lower-case name, and its block."""

    headers: dict[str, str]
    block: bytes


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as WARC/1.1 lays it down."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    """Check version, header lines, required headers, length and end of one record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name != name.strip():
            raise WarcError(f"bad header line: {line[:80]}")
        if name.lower() in headers and name.lower() != "warc-concurrent-to":
            raise WarcError(f"repeated header: {name}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no header {name}")
    if not headers["content-length"].isdecimal():
        raise WarcError("bad content-length")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"content-length {size}, but {len(rest) - 4} bytes")
    return Record(headers, rest[:size])


class ArchiveWriter:
    """Writes records as frames of their own, behind a frame with the dictionary they share."""

    def __init__(self, uri: str, samples: list[bytes], level: int = LEVEL):
        import zstandard

        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples to train on
            data = b"".join(samples)[-DICTIONARY_BYTES:]
        kept = zstandard.ZstdCompressor().compress(data) if data else b""
        self.out = open_output(uri)
        self.size = self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(kept)) + kept)
        shared = zstandard.ZstdCompressionDict(data) if data else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)

    def write(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.out.write(frame)
        self.size += len(frame)

    def close(self) -> None:
        self.out.close()


def read_archive(uri: str) -> Iterator[Record]:
    """The records of an archive, one frame at a time; bounded by the longest record."""
    import zstandard

    with open_input(uri) as source:
        head = source.read(8)
        if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
            raise WarcError("no leading dictionary frame")
        size = struct.unpack("<I", head[4:])[0]
        data = source.read(size)
        if len(data) != size:
            raise WarcError("dictionary frame cut short")
        if data[:4] == struct.pack("<I", DATA_FRAME):
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        shared = zstandard.ZstdCompressionDict(data) if data else None
        reader, left = zstandard.ZstdDecompressor(dict_data=shared), b""
        while left or (left := source.read(READ_BYTES)):
            frame, parts = reader.decompressobj(), []
            while True:
                parts.append(frame.decompress(left))
                if frame.eof:
                    left = frame.unused_data
                    break
                if not (left := source.read(READ_BYTES)):
                    raise WarcError("frame cut short")
            yield parse_record(b"".join(parts))


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds refers_to: of rows with equal payloads the largest page_id is stored, the others point to it.

    Payloads are told apart by SHA-1 and length, aggregated before the shuffle;
    only rows that do revisit go back, by page_id and payload. Payloads below ``least`` bytes
    and rows without a page_id revisit nothing; repeated rows of one page_id are
    all stored, and rows of one page_id with other payloads each go by their own. The columns of the result are page_id, url, html, refers_to.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    content = F.concat(F.unhex(F.sha1(F.encode("html", "utf-8"))), F.encode(F.octet_length("html").cast("string"), "utf-8"))
    narrow = base.where(F.col("page_id").isNotNull() & (F.octet_length("html") >= least)).select("page_id", content.alias("content"))
    narrow = stored(narrow, "payloads")
    stays = narrow.groupBy("content").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = narrow.join(stays.select("content", "refers_to"), "content").where(F.col("page_id") != F.col("refers_to"))
    revisits = revisits.select("page_id", "content", "refers_to").distinct()
    return base.withColumn("content", content).join(revisits, ["page_id", "content"], "left").select("page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record for every row of ``pages``; returns (file, records, bytes) of each archive.

    A task writes archives of about ARCHIVE_BYTES under new names, and only those
    of tasks that ended well are listed. Null html: an empty payload. A revisit
    has an empty block and names the stored record.
    """
    folder = folder or shared_folder(pages.sparkSession, "archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: list[tuple[str, int, int]] = []
        archive, pending, held, records = None, [], 0, 0

        def records_of(batch: pa.RecordBatch) -> Iterator[bytes]:
            for at in range(0, batch.num_rows, 64):
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    payload = html.encode()
                    headers = [
                        ("WARC-Type", "response" if refers_to is None else "revisit"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"),
                        ("WARC-Date", EMPTY_TIME),
                        ("WARC-Target-URI", "".join((url or "").split())),
                        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
                        ("X-Page-ID", "" if page_id is None else str(page_id)),
                        ("X-Payload-Length", str(len(payload))),
                    ]
                    if refers_to is not None:
                        headers.append(("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(refers_to))}>"))
                        headers.append(("X-Refers-To-Page-ID", str(refers_to)))
                    yield record_bytes(headers, payload if refers_to is None else b"")

        def start() -> None:
            nonlocal archive, held, pending, records
            name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            archive = ArchiveWriter(name, pending)
            written.append((name, 0, 0))
            for record in pending:
                archive.write(record)
            records, held, pending = len(pending), 0, []

        def finish() -> None:
            nonlocal archive
            archive.close()
            written[-1] = (written[-1][0], records, archive.size)
            archive = None

        for batch in batches:
            for record in records_of(batch):
                if archive is None:
                    pending.append(record)
                    held += len(record)
                    if held >= SAMPLE_BYTES:
                        start()
                else:
                    archive.write(record)
                    records += 1
                    if archive.size >= ARCHIVE_BYTES:
                        finish()
        if pending:
            start()
        if archive is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([w[k] for w in written], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "records", "bytes"]
        )

    marked = mark_revisits(pages, least)
    return stored(marked.mapInArrow(write, "file string, records long, bytes long"), "archive-list")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Stored payloads are checked against their digest and length, revisits must
    be empty, and an archive must hold as many records as listed.
    """

    def read(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups:
            for name, expected in zip(group["file"], group["records"]):
                rows, size, seen = [], 0, 0
                for record in read_archive(name):
                    head, seen = record.headers, seen + 1
                    digest, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
                    length, page = int(head["x-payload-length"]), head["x-page-id"]
                    if kind == "response" and (len(record.block) != length or payload_digest(record.block) != digest):
                        raise WarcError(f"payload of page {page} does not match its headers")
                    if kind not in ("response", "revisit") or (kind == "revisit" and record.block):
                        raise WarcError(f"bad record of page {page}")
                    refers_to = head.get("x-refers-to-page-id")
                    rows.append((int(page) if page else None, head.get("warc-target-uri"), length, digest, kind, int(refers_to) if refers_to else None, record.block))
                    size += len(record.block)
                    if size >= 8 << 20:
                        yield _frame(rows)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows)
                if seen != expected:
                    raise WarcError(f"{name}: {seen} records, not {expected}")

    spread = archives.select("file", "records").repartition(archives.sparkSession.sparkContext.defaultParallelism * 4, "file")
    return spread.mapInPandas(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every row of ``pages`` to archives and read all records back."""
    return read_archives(write_archives(pages, least))
