"""Web archives: records in independent Zstandard frames with a seek table at the end.

A bundle is one .warc.zst file: records are put together to frames of about FRAME bytes,
each frame is compressed by itself, and a skippable frame at the end lists compressed and
plain sizes (the seekable format of the Zstandard project). The index maps each record to
its frame and to its place in the frame's plain bytes, so one record is read by
decompressing one frame. Bundles are rows of a written table, because executors can only
write through Spark to a folder that all share; `content` is the file byte for byte.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Plain bytes of a frame and compressed bytes of a bundle from which the next one starts.
FRAME = 256 << 10
BUNDLE = 4 << 20
#: Payloads of fewer bytes are always stored.
SMALL = 100
LEVEL = 3
# fixed values of the seekable format: magic numbers of the skippable frame and the footer
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

INDEX = "array<struct<page_id: bigint, frame: int, offset: bigint, length: bigint>>"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The last frame of a bundle, from the compressed and plain sizes of the others."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """Place, compressed size and plain size of each frame."""
    count, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE or flags & 0x7C:
        raise ValueError("no seek table at the end")
    width = 12 if flags & 0x80 else 8
    start = len(content) - 9 - count * width
    head, size = struct.unpack("<II", content[start - 8 : start])
    if head != SKIPPABLE or size != count * width + 9:
        raise ValueError("the seek table is damaged")
    out, at = [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", content, start + i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def _clean(value: str) -> str:
    """A header value: control characters would end the line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    return {k.lower(): v for k, v in pairs}


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(data: bytes) -> tuple[int | None, str | None, str, int | None, int, str, bytes | None]:
    """page_id, url, type, refers_to, payload size, payload digest, payload of a record.

    The size and digest of a response come from its payload, which must agree with its
    headers; those of a revisit are what its headers say of the payload it stands for.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    page, url = _page(fields["warc-record-id"]), fields.get("warc-target-uri")
    if fields["warc-type"] == "revisit":
        return page, url, "revisit", _page(fields["warc-refers-to"]), size, digest, None
    if len(payload) != size or sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {page}: the payload does not agree with its headers")
    return page, url, "response", None, size, digest, payload


class Bundle:
    """Collects records; holds one frame of plain bytes and one bundle of packed ones."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.clear()

    def clear(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.plain: list[bytes] = []
        self.at = self.packed = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append({"page_id": page_id, "frame": len(self.frames), "offset": self.at, "length": len(data)})
        self.plain.append(data)
        self.at += len(data)
        if self.at >= FRAME:
            self.close_frame()

    def close_frame(self) -> None:
        if self.plain:
            frame = self.packer.compress(b"".join(self.plain))
            self.sizes.append((len(frame), self.at))
            self.frames.append(frame)
            self.packed += len(frame)
            self.plain, self.at = [], 0

    def close(self) -> pa.RecordBatch:
        self.close_frame()
        content = b"".join([*self.frames, seek_table(self.sizes)])
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([sha256(content).hexdigest()[:32]]),
                pa.array([content], pa.binary()),
                pa.array(
                    [self.index],
                    pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])),
                ),
            ],
            ["bundle", "content", "index"],
        )
        self.clear()
        return out


def _bundled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bundle = Bundle()
    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, html, digest, refers = (c[i].as_py() for c in batch.columns)
            bundle.add(page_id, record(page_id, url, (html or "").encode("utf-8"), digest, refers))
            if bundle.packed >= BUNDLE:
                yield bundle.close()
    if bundle.index:
        yield bundle.close()


def digest_of(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256)


def archive(pages: DataFrame) -> DataFrame:
    """bundle, content, index: the bundles of pages (page_id, url, html), as a plan.

    The html is stored in UTF-8 (null: empty). Of equal payloads of SMALL bytes or more the
    one with the smallest page_id is a response and the others are revisits of it; rows
    that repeat this page_id are responses too. Smaller payloads are responses. A row with
    a null page_id is a revisit if any row with an id has its payload. A url is stored with
    control characters escaped, and left out if null.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("digest", digest_of(F.col("html")))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= SMALL
    firsts = (
        rows.where(large)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
        .where("n > 1")
        .select("same", "first")
    )
    # small payloads get a key that nothing has, so that they do not meet in one task
    key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    return (
        rows.withColumn("key", key)
        .join(firsts, F.col("key") == F.col("same"), "left")
        .select("page_id", "url", "html", "digest", refers.alias("refers_to"))
        .mapInArrow(_bundled, f"bundle string, content binary, index {INDEX}")
    )


def write_archive(pages: DataFrame) -> DataFrame:
    """archive(), written to the shared folder and read from there."""
    return written(archive(pages), "warc")


def records(content: bytes, wanted: Iterable[dict]) -> Iterator[bytes]:
    """The records at the index entries given, each frame decompressed once in a row."""
    frames, last, plain = read_seek_table(content), None, b""
    unpacker = zstandard.ZstdDecompressor()
    for entry in wanted:
        if entry["frame"] != last:
            last = entry["frame"]
            at, size, length = frames[last]
            plain = unpacker.decompress(content[at : at + size], max_output_size=length)
        yield plain[entry["offset"] : entry["offset"] + entry["length"]]


def _read(batches: Iterable[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            content, index = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            rows = []
            for data in records(content, index):
                row = parse(data)
                rows.append(row if payloads else (*row[:6], None))
                if payloads and len(rows) == 64:
                    yield _batch(rows, kinds, names)
                    rows = []
            yield _batch(rows, kinds, names)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def read_archive(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of bundles, found through seek table and index.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for
    revisits, and for all if `payloads` is false).
    """
    return bundles.select("content", "index").mapInArrow(
        partial(_read, payloads=payloads),
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary",
    )


#: What reading back the archives of `pages` gives, for tables whose page_id is unique.
SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), sized AS (
    SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes,
        min(page_id) OVER (PARTITION BY payload) AS first_id
    FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM sized
"""
