"""Seekable Zstandard WARC bundles.

``write_bundles`` turns pages into WARC/1.1 records and packs them into bundle
files: whole records are grouped into independent Zstandard frames of about
``FRAME_BYTES``, and a skippable frame at the end holds the seek table of the
Zstandard seekable format (compressed and decompressed size per frame). The
index maps every record identifier to its bundle, frame and offset in the frame, so
``read_records`` decompresses only the frames it needs.

Equal payloads (UTF-8 bytes, null is empty, compared by SHA-256 and length)
are stored once if they have at least ``min_bytes`` bytes: the largest page_id
is the response, the others are revisits that carry the HTTP header and refer
to it. The duplicate groups are found on (page_id, digest) rows with partial
aggregates, and joined back to those rows by a broadcast of checked size, or by
a shuffle join with a plain scan on either side, of which Spark splits a hot payload.

Files are written through the file system of the folder's URI, which every
executor must reach. Each task attempt writes its own file names and the index
names the files of the attempts that counted, so a repeated task or a lost
executor leaves only unreferenced files. A task holds one frame at a time.

Edge cases. Null html is an empty payload; null urls are written as empty. A null page_id cannot be
referred to and its record is always a response. Rows that repeat a page_id
are records of their own; of equal payloads under the same id, each row is a
response if the id is the largest. Extra columns are ignored. An empty table
gives no bundle and an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import bounded, prepare, saved

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
READ_BYTES = 64 << 20  # of records per reading task: index rows are small, what they point to is not
MAX_BROADCAST = 200_000  # payloads of two pages or more, rows of about 100 bytes; beyond, a shuffle join
SEEK_MAGIC, SKIPPABLE = 0x8F92EAB1, 0x184D2A5E
INDEX = "page_id long, bundle string, frame int, frame_offset long, frame_bytes long, record_offset long, record_bytes long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def arrow_uri(folder: str) -> str:
    """A folder as Spark names it, as Arrow does."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[5:]
    if folder.startswith(("s3a://", "s3n://")):
        return "s3" + folder[3:]
    return folder


def file_system(folder: str):
    """(file system, path) of a folder URI."""
    from pyarrow import fs

    folder = arrow_uri(folder)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to``) has the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {uri}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").rstrip(">")
    return int(text) if text else None


def parse(data: bytes) -> tuple:
    """The RECORD row of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(_fields(http)["Content-Length"])
    if not revisit and (len(payload) != size or digest(payload) != fields["WARC-Payload-Digest"].removeprefix("sha1:")):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return (_number(fields["WARC-Record-ID"]), size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
            _number(fields["WARC-Refers-To"]) if revisit else None, fields["WARC-Target-URI"], None if revisit else payload)


class Bundle:
    """Writes frames of whole records, and the seek table on ``close``."""

    def __init__(self, out, frame_bytes: int):
        self.out, self.frame_bytes, self.size = out, frame_bytes, 0
        self.packer = zstandard.ZstdCompressor(level=3)
        self.table: list[tuple[int, int]] = []
        self.records: list[tuple] = []  # page_id, record offset, record bytes
        self.pending: list[bytes] = []
        self.held = 0

    def add(self, page_id: int | None, data: bytes) -> list[tuple]:
        self.records.append((page_id, self.held, len(data)))
        self.pending.append(data)
        self.held += len(data)
        return self.flush() if self.held >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        """Index rows (without the bundle) of the frame that ends here."""
        if not self.pending:
            return []
        frame = self.packer.compress(b"".join(self.pending))
        rows = [(p, len(self.table), self.size, len(frame), at, n) for p, at, n in self.records]
        self.out.write(frame)
        self.table.append((len(frame), self.held))
        self.size += len(frame)
        self.pending, self.records, self.held = [], [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        body = b"".join(struct.pack("<II", *e) for e in self.table) + struct.pack("<IBI", len(self.table), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        return rows


def seek_table(read, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, decompressed bytes) of each frame, from the footer; ``read(offset, n)``."""
    frames, _, magic = struct.unpack("<IBI", read(size - 9, 9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    body, at, out = read(size - 9 - 8 * frames, 8 * frames), 0, []
    for i in range(frames):
        packed, plain = struct.unpack_from("<II", body, 8 * i)
        out.append((at, packed, plain))
        at += packed
    return out


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int) -> Iterator[pa.RecordBatch]:
    files, path = file_system(folder)
    bundle, name = None, ""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*((r[0], name, *r[1:]) for r in found)))
        kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in INDEX.split(", ")])

    for batch in batches:
        for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if bundle is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                bundle = Bundle(files.open_output_stream(f"{path}/{name}", compression=None), frame_bytes)
            if found := bundle.add(page_id, record(page_id, url, (html or "").encode(), refers_to)):
                yield rows(found)
            if bundle.size >= bundle_bytes:
                if found := bundle.close():
                    yield rows(found)
                bundle = None
    if bundle is not None and (found := bundle.close()):
        yield rows(found)


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Index rows, sorted by bundle and frame, to records: each needed frame is found by its number in the footer."""
    files, path = file_system(folder)
    name, source, table, at, plain = None, None, None, None, b""
    for batch in batches:
        found = []
        for _, bundle, frame, _, _, start, n in zip(*(c.to_pylist() for c in batch.columns)):
            if bundle != name:
                name, source, at = bundle, files.open_input_file(f"{path}/{bundle}"), None
                table = seek_table(lambda o, k: source.read_at(k, o), source.size())
            if frame != at:
                at, (offset, packed, size) = frame, table[frame]
                plain = zstandard.ZstdDecompressor().decompress(source.read_at(packed, offset), max_output_size=size)
            found.append(parse(plain[start:start + n]))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        cols = list(zip(*found)) if found else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in RECORD.split(", ")])


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 1, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as bundles under ``folder``; returns the index, materialised."""
    prepare(pages.sparkSession)
    files, path = file_system(folder)
    files.create_dir(path, recursive=True)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    key = F.sha2(F.col("html").cast("binary"), 256).alias("key")
    sums = pages.select("page_id", key, F.octet_length("html").alias("size")).where(f"size >= {min_bytes} and page_id is not null")
    # Written first: joined on its own, a payload of very many pages (an empty or an error page) is broadcast or split.
    groups = saved(sums.groupBy("key", "size").agg(F.max("page_id").alias("first"), F.min("page_id").alias("last")).where("first <> last"))
    # only pages with an equal payload elsewhere: rows of ids, without payloads
    revisits = saved(sums.join(bounded(groups, MAX_BROADCAST), ["key", "size"]).where("page_id < first").select(
        F.col("page_id").alias("id"), F.col("key").alias("id_key"), F.col("first").alias("refers_to")).distinct())
    keyed = pages.withColumn("key", key)
    told = keyed.join(revisits, (keyed["page_id"] == revisits["id"]) & (keyed["key"] == revisits["id_key"]), "left")
    return saved(told.select("page_id", "url", "html", "refers_to").mapInArrow(
        partial(_write, folder=folder, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes), INDEX))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of ``index`` rows (all, or those of wanted identifiers); revisits have a null payload."""
    prepare(index.sparkSession)
    size = index.agg(F.sum("record_bytes")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(size / READ_BYTES))
    near = index.repartition(parts, "bundle", F.floor(F.col("frame") / 4)).sortWithinPartitions("bundle", "frame")
    return near.mapInArrow(partial(_read, folder=folder), RECORD)
