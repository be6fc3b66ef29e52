"""WARC archives compressed with Zstandard: a dictionary in front, one frame per record.

An archive starts with a skippable frame that holds the dictionary (itself compressed), followed by
one frame per record. The reader loads the dictionary, walks the frames by their block headers,
decodes each on its own and checks version, required headers, lengths and digests. Archives are
rows of one binary each, closed at about ``ARCHIVE_BYTES``, so they can lie in any store Spark writes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.llm.store import cut_lineage, small_batches

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 4 << 20
ARCHIVE_PAYLOAD = 64 << 20
DICTIONARY_BYTES = 64 << 10
TRAINING_PAGES, TRAINING_BYTES = 64, 2 << 20
LEVEL = 3
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

ARCHIVE_SCHEMA = "archive string, content binary"
RECORD_SCHEMA = (
    "archive string, record_id string, record_type string, target_uri string, date string, page_id long, "
    "refers_to_id string, payload_digest string, payload_bytes long, payload binary"
)


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"no WARC version line: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"missing header {name}")
    if not headers["content-length"].isdigit():
        raise WarcError("content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, header says {length}")
    return headers, rest[:length]


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, read from its header and block headers."""
    try:
        if struct.unpack_from("<I", data, at)[0] != FRAME:
            raise WarcError(f"no frame at byte {at}")
        flags = data[at + 4]
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            block = data[at] | data[at + 1] << 8 | data[at + 2] << 16
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3:
                raise WarcError("reserved block type")
            at += 3 + (1 if kind == 1 else size)
        at += 4 * (flags >> 2 & 1)
    except (IndexError, struct.error):
        raise WarcError("archive ends inside a frame") from None
    if at > len(data):
        raise WarcError("archive ends inside a frame")
    return at


def read_archive(content: bytes) -> Iterator[bytes]:
    """The raw records of one archive, in order."""
    data, at, dictionary = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data, 0)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise WarcError("archive ends inside its dictionary")
        raw, at = bytes(data[8: 8 + size]), 8 + size
        if raw[:4] == struct.pack("<I", FRAME):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        end = frame_end(data, at)
        try:
            yield reader.decompressobj().decompress(data[at:end])
        except zstandard.ZstdError as error:
            raise WarcError(f"frame at byte {at}: {error}") from None
        at = end


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[: DICTIONARY_BYTES]


class Writer:
    """Collects records; ``close`` gives the archive."""

    def __init__(self, samples: list[bytes]):
        raw = make_dictionary(samples)
        packed = zstandard.ZstdCompressor(level=19).compress(raw)
        self.parts = [struct.pack("<II", SKIPPABLE, len(packed)), packed]
        held = zstandard.ZstdCompressionDict(raw) if raw else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        self.size = self.payload = 0

    def add(self, whole: bytes) -> None:
        self.parts.append(self.compressor.compress(whole))
        self.size += len(self.parts[-1])
        self.payload += len(whole)

    @property
    def full(self) -> bool:
        return self.size >= ARCHIVE_BYTES or self.payload >= ARCHIVE_PAYLOAD

    def close(self) -> bytes:
        return b"".join(self.parts)


def page_record(page_id: int | None, url: str | None, html: bytes, sha1: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{sha1}"), ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Length", str(len(html))), ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
        return record(headers, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n"
    return record(headers, http.encode() + html)


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(archive, content)`` with a record for every row of ``pages(page_id, url, html)``.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest page_id is the
    response; rows with a smaller id revisit it. Null html is an empty payload. Rows that repeat the
    largest id are all responses, as are rows without page_id. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    # only payloads that occur twice take part in the join, so single pages stay where they are
    holders = cut_lineage(rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("holder"), F.count("*").alias("n")).filter("n > 1"))
    typed = rows.join(holders.select("sha1", "holder"), "sha1", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") < F.col("holder"), F.col("holder")).alias("refers_to"))
    return typed.mapInArrow(_write, ARCHIVE_SCHEMA)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    prefix, number, writer = f"part-{TaskContext.get().partitionId():06d}", 0, None
    waiting: list[tuple] = []

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([f"{prefix}-{number:05d}.warc.zst"]), pa.array([writer.close()], pa.binary()),
        ], names=["archive", "content"])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield tuple(batch.column(c)[k].as_py() for c in range(4))

    def begin() -> Writer:
        return Writer([r[2] for r in waiting if r[2] and r[3] is None])

    def add(fresh: list[tuple]) -> Iterator[pa.RecordBatch]:
        nonlocal number, writer
        for row in fresh:
            writer.add(page_record(row[0], row[1], row[2], digest(row[2]), row[3]))
            if writer.full:
                yield closed()
                number, writer = number + 1, begin()

    held = 0
    for row in rows():
        if writer is not None:
            yield from add([row])
            continue
        waiting.append(row)  # the first pages of a task are its archives' training sample
        held += len(row[2])
        if len(waiting) == TRAINING_PAGES or held >= TRAINING_BYTES:
            writer = begin()
            yield from add(waiting)
    if writer is None and waiting:
        writer = begin()
        yield from add(waiting)
    if writer is not None and writer.size:
        yield closed()


def read_archives(archives: DataFrame, on_error: str = "raise") -> DataFrame:
    """All records of archive rows ``(archive, content)``; ``on_error="skip"`` leaves broken archives' rest out."""
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error: {on_error}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        types = [pa.binary() if n == "payload" else pa.int64() if n in ("page_id", "payload_bytes") else pa.string() for n in names]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out: list[tuple] = []
                size = 0
                try:
                    for raw in read_archive(content.as_py() or b""):
                        out.append((archive, *_fields(*parse_record(raw))))
                        size += len(raw)
                        if size > ARCHIVE_BYTES:
                            yield batch_of(out)
                            out, size = [], 0
                except WarcError as error:
                    if on_error == "raise":
                        raise WarcError(f"{archive}: {error}") from None
                if out:
                    yield batch_of(out)

    return archives.select("archive", "content").mapInArrow(read, RECORD_SCHEMA)


def _fields(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers["warc-type"]
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        raise WarcError("no HTTP header in the block")
    sha1 = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    length = int(headers.get("warc-payload-length") or len(payload))
    if kind == "response":
        if len(payload) != length:
            raise WarcError(f"payload of {len(payload)} bytes, header says {length}")
        if sha1 != digest(payload):
            raise WarcError("payload digest differs")
    elif kind == "revisit":
        if "warc-refers-to" not in headers:
            raise WarcError("a revisit without warc-refers-to")
    else:
        raise WarcError(f"unexpected record type {kind[:40]!r}")
    page = headers.get("warc-page-id", "")
    return (
        headers["warc-record-id"], kind, headers.get("warc-target-uri"), headers["warc-date"], int(page) if page else None,
        headers.get("warc-refers-to"), sha1, length, payload if kind == "response" else None,
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives to the shared folder and read them back.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, one row per row of ``pages``.
    """
    records = read_archives(cut_lineage(write_archives(pages)))
    refers = F.regexp_extract("refers_to_id", r"<urn:page:(-?\d+)>", 1)
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", refers.cast("long")).alias("refers_to"),
    )
