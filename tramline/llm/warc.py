"""Web archives in seekable Zstandard bundles.

Method: records are gathered into frames of about ``FRAME_BYTES``, each an
independent Zstandard frame. A bundle ends with two skippable frames: a table
of records (identifier, frame, offset in the frame, length) and, as the footer,
a seek table (compressed and plain size of each frame, their number, a magic
number). Any tool reads a bundle as one Zstandard stream; a reader that wants
one record reads the footer, the table of records, and a single frame.

Of records with equal payloads of at least ``LEAST`` bytes the one with the
smallest id is a response, the others are revisits that refer to it. Payloads
are compared by SHA-256. The smallest id of each digest is a minimum combined
before the shuffle; a payload that a third of all pages share meets its one row
in a join that may split the pages.

A task writes bundles of about ``BUNDLE_BYTES`` as it goes. A bundle is written
under a name of its own and then moved to its final name.

Defined results: a NULL payload is empty. A row without id never is the one
that others refer to; with a payload of which no row has an id it is a
response. Rows that repeat the smallest id are responses each. A NULL url
leaves its header out. An empty table writes no bundle. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"  # records tell no time of capture; a fixed one keeps bundles reproducible

# Fixed values of the formats: skippable frames and the seek table's footer.
SKIP_SEEK, SKIP_RECORDS, SEEK_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1

INDEX_SCHEMA = "bundle string, page_id long, frame long, offset long, length long"
PAGE_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record(page_id: int | None, url: str | None, kind: str, refers: int | None, payload: bytes, digest: str) -> bytes:
    """One record with its headers; a revisit carries no payload, but its size and digest."""
    body = payload if kind == "response" else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        lines.insert(4, f"WARC-Refers-To: <urn:page:{refers}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


class Bundle:
    """A bundle in the making."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.frames: list[tuple[int, int]] = []
        self.records: list[tuple[int | None, int, int, int]] = []
        self.open: list[bytes] = []
        self.plain = 0
        self.size = 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.records.append((page_id, len(self.frames), self.plain, len(raw)))
        self.open.append(raw)
        self.plain += len(raw)
        self.size += len(raw)
        if self.plain >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.parts.append(packed)
            self.frames.append((len(packed), self.plain))
            self.open, self.plain = [], 0

    def to_bytes(self) -> bytes:
        self._close_frame()
        rows = b"".join(
            struct.pack("<?qIII", i is None, i or 0, frame, offset, length) for i, frame, offset, length in self.records
        )
        seek = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        return b"".join(
            [
                *self.parts,
                struct.pack("<II", SKIP_RECORDS, len(rows)),
                rows,
                struct.pack("<II", SKIP_SEEK, len(seek)),
                seek,
            ]
        )


class Reader:
    """Random access to the records of a bundle."""

    def __init__(self, raw: bytes):
        n, _, magic = struct.unpack_from("<IBI", raw, len(raw) - 9)
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        table = len(raw) - 9 - 8 * n
        sizes = list(struct.iter_unpack("<II", raw[table : len(raw) - 9]))
        self.raw, self.starts, at = raw, [], 0
        for packed, plain in sizes:
            self.starts.append((at, packed, plain))
            at += packed
        kind, size = struct.unpack_from("<II", raw, at)
        if kind != SKIP_RECORDS:
            raise ValueError("no table of records")
        self.records = list(struct.iter_unpack("<?qIII", raw[at + 8 : at + 8 + size]))
        self.decompressor = zstandard.ZstdDecompressor()
        self.held = (-1, b"")

    def read(self, frame: int, offset: int, length: int) -> bytes:
        if self.held[0] != frame:
            at, packed, plain = self.starts[frame]
            self.held = (frame, self.decompressor.decompress(self.raw[at : at + packed], max_output_size=plain))
        return self.held[1][offset : offset + length]


def _write(folder: str, bundle_bytes: int):
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        part, number, bundle = TaskContext.get().partitionId(), 0, Bundle()

        def flush() -> pa.RecordBatch:
            nonlocal number, bundle
            name = f"bundle-{part:06d}-{number:06d}.warc.zst"
            own = f"{root}/.{name}-{uuid.uuid4().hex}"
            with system.open_output_stream(own) as out:
                out.write(bundle.to_bytes())
            system.move(own, f"{root}/{name}")
            rows = [(name, *r) for r in bundle.records]
            number, bundle = number + 1, Bundle()
            kinds = [pa.string(), *[pa.int64()] * 4]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for page, url, html, digest, refers in zip(
                *(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to"))
            ):
                payload = (html.as_py() or "").encode()
                kind = "response" if refers.as_py() is None else "revisit"
                bundle.add(page.as_py(), record(page.as_py(), url.as_py(), kind, refers.as_py(), payload, digest.as_py()))
                if bundle.size >= bundle_bytes:
                    yield flush()
        if bundle.records:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles below ``folder``; returns the map of records, a written table.

    ``folder`` is a URI all executors can write to. The map has for each record
    its bundle, frame, offset in the frame, and length.
    """
    spark = pages.sparkSession
    system, root = fs.FileSystem.from_uri(f"{folder}/bundles")
    system.create_dir(root, recursive=True)
    pages = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.col("html").cast("string"),
        F.sha2(F.coalesce(F.col("html").cast("string"), F.lit("")), 256).alias("digest"),
        (F.octet_length(F.coalesce("html", F.lit(""))) >= LEAST).alias("shared"),
    )
    heads = pages.where("shared").groupBy("digest").agg(F.min("page_id").alias("head"))
    refers = F.when(F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))
    (
        pages.join(heads, "digest", "left")
        .select("page_id", "url", "html", "digest", refers.alias("refers_to"))
        .mapInArrow(_write(f"{folder}/bundles", bundle_bytes), INDEX_SCHEMA)
        .write.parquet(f"{folder}/records")
    )
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/records")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PAGE_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def page_of(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    for batch in batches:
        for content in batch.column("content"):
            reader, rows = Reader(content.as_buffer().to_pybytes()), []
            for _, _, frame, offset, length in reader.records:
                headers, body = parse(reader.read(frame, offset, length))
                kind = headers["WARC-Type"]
                size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response":
                    size, digest = len(body), hashlib.sha256(body).hexdigest()
                rows.append((page_of(headers["WARC-Record-ID"]), size, digest, kind, page_of(headers.get("WARC-Refers-To"))))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record below ``folder``; sizes and digests of responses are taken from their payloads."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.schema(schema).format("binaryFile").option("pathGlobFilter", "bundle-*.warc.zst")
    return files.load(f"{folder}/bundles").select("content").mapInArrow(_read, PAGE_SCHEMA)
