"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of whole WARC records, closed by
a seek table in a skippable frame (compressed and decompressed size of every frame), as public seekable
Zstandard readers expect. Any record is reached by reading the footer, one frame, and the record's
offset inside that frame; the index keeps (record id, bundle, frame, offset in frame).

Bundles are written through pyarrow's file systems into the shared folder, under a name of their task and
attempt; the index table holds only the bundles of tasks that succeeded, so lost tasks leave at most files
that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.sidefiles import file_system
from tickloom.llm.tables import only
from tickloom.session import new_folder, stored

# The public seekable Zstandard format.
SEEK_FRAME_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
BUNDLES_PER_TASK = 8
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

INDEX = (
    "record_id string, page_id long, bundle string, frame int, frame_offset long, frame_bytes long, "
    "offset long, length long"
)
RECORDS = (
    "record_id string, target_uri string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to_id string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class BundleWriter:
    """Collects records into frames and frames into one file."""

    def __init__(self, uri: str, level: int = 3):
        self.uri, self.level = uri, level
        system, path = file_system(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.pending: list[bytes] = []
        self.held = self.written = 0
        self.rows: list[tuple] = []
        self._open_rows: list[tuple] = []

    def add(self, record_id: str, page_id: int | None, record: bytes) -> None:
        self._open_rows.append((record_id, page_id, self.held, len(record)))
        self.pending.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.pending:
            return
        frame = zstandard.ZstdCompressor(level=self.level, write_content_size=True).compress(b"".join(self.pending))
        self.out.write(frame)
        number = len(self.frames)
        self.rows += [
            (record_id, page_id, self.uri, number, self.written, len(frame), offset, length)
            for record_id, page_id, offset, length in self._open_rows
        ]
        self.frames.append((len(frame), self.held))
        self.written += len(frame)
        self.pending, self._open_rows, self.held = [], [], 0

    def close(self) -> list[tuple]:
        """Write the seek table; gives the index rows of the bundle."""
        self.end_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_FRAME_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()
        return self.rows


class BundleReader:
    """Random access to the frames of a bundle."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self._range(size - 9, 9))
        if magic != SEEK_FOOTER_MAGIC:
            raise ValueError(f"no seek table in {uri}")
        table = self._range(size - 9 - 8 * count, 8 * count)
        self.frames, at = [], 0
        for compressed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, compressed, plain))
            at += compressed

    def _range(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, number: int) -> bytes:
        at, compressed, plain = self.frames[number]
        data = zstandard.ZstdDecompressor().decompress(self._range(at, compressed), max_output_size=plain)
        if len(data) != plain:
            raise ValueError("frame size differs from the seek table")
        return data

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]

    def close(self) -> None:
        self.file.close()


def make_record(record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    http = _HTTP % len(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is None:
        block = http + payload
    else:  # the headers alone, whose Content-Length still states the full payload
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{refers_to}>"]
        block = http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers, block, place after the record)."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    return headers, data[start:stop], stop + 4


def _parsed(headers: dict, block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    refers = headers.get("WARC-Refers-To")
    return (
        headers["WARC-Record-ID"][1:-1], headers["WARC-Target-URI"], kind, digest, length,
        refers[1:-1] if refers else None, payload if kind == "response" else None,
    )


def page_record_id(page_id: int | None) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def _batch(rows: list[tuple], names_types: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in names_types.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields]
    )


def write_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write one record per row of pages (page_id, url, html) and give the index table of the records.

    The payload is the html in UTF-8; null is empty. Among pages with equal payloads of at least
    ``min_bytes`` bytes the smallest page_id is a response, all others revisit it. A page without an id comes
    after all others; rows that repeat the first page's id, or equal pages none of which has an id, are
    responses each. A null url is empty. Other columns are not read; an empty table gives no records.
    """
    spark = pages.sparkSession
    rows = only(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    digest = F.sha1(F.col("html").cast("binary"))
    # payloads count as equal if digest, length and a second hash agree, so one broken hash makes no false revisit
    same = {"sha1": digest, "bytes": F.octet_length("html"), "second": F.xxhash64("html")}
    # one row per payload that occurs more than once: few rows or none, combined before the shuffle
    twice = stored(
        rows.where(F.octet_length("html") >= min_bytes).withColumns(same)
        .groupBy(*same).agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1").select(*same, "first_page"),
        "warc-repeats",
    )
    marked = rows.withColumns(same).join(twice, [*same], "left")
    marked = marked.where(F.octet_length("html") >= min_bytes).unionByName(
        marked.where(F.octet_length("html") < min_bytes).withColumn("first_page", F.lit(None).cast("long"))
    ) if min_bytes > 0 else marked
    folder = new_folder(spark, "warc-bundles")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        bundle, number = None, 0
        for batch in batches:
            for page_id, url, html, sha1, first in zip(
                *(batch.column(n).to_pylist() for n in ("page_id", "url", "html", "sha1", "first_page"))
            ):
                if bundle is None:
                    bundle, number = BundleWriter(f"{stem}-{number:04d}.warc.zst"), number + 1
                payload = html.encode()
                refers = page_record_id(first) if first is not None and first != page_id else None
                record_id = page_record_id(page_id)
                uri = " ".join((url or "").split())
                named = base64.b32encode(bytes.fromhex(sha1)).decode()
                bundle.add(record_id, page_id, make_record(record_id, uri, payload, named, refers))
                if bundle.written >= BUNDLE_BYTES:
                    yield _batch(bundle.close(), INDEX)
                    bundle = None
        if bundle is not None:
            yield _batch(bundle.close(), INDEX)

    return stored(marked.select("page_id", "url", "html", "sha1", "first_page").mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """All records of the indexed bundles, each frame once: one row per record (see RECORDS).

    Digests and lengths are checked while reading; a damaged bundle is an error.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                bundle = BundleReader(uri)
                for number in range(len(bundle.frames)):
                    data, at, rows = bundle.frame(number), 0, []
                    while at < len(data):
                        headers, block, at = parse_record(data, at)
                        rows.append(_parsed(headers, block))
                    yield _batch(rows, RECORDS)
                bundle.close()

    bundles = stored(index.select("bundle").distinct(), "warc-bundle-list")
    # names are few bytes but stand for whole bundles, so their number of tasks is set here
    count, cores = bundles.count(), index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(count, max(4 * cores, count // BUNDLES_PER_TASK)))
    return bundles.repartition(tasks, "bundle").mapInArrow(read, RECORDS)


def fetch(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records with the given ids (column record_id), by seeking: only their frames are read, each once a task.

    The records of a frame go to one task in their order, so a worker holds one open bundle and one plain frame.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, here, data = None, None, b""
        for batch in batches:
            rows = []
            for uri, frame, offset, length in zip(
                *(batch.column(n).to_pylist() for n in ("bundle", "frame", "offset", "length"))
            ):
                if here is None or here[0] != uri:
                    if bundle is not None:
                        bundle.close()
                    bundle, here = BundleReader(uri), None
                if here != (uri, frame):
                    here, data = (uri, frame), bundle.frame(frame)
                headers, block, _ = parse_record(data[offset : offset + length])
                rows.append(_parsed(headers, block))
            yield _batch(rows, RECORDS)
        if bundle is not None:
            bundle.close()

    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    return (
        wanted.select("bundle", "frame", "offset", "length").repartition("bundle", "frame")
        .sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, RECORDS)
    )


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of read records of pages."""
    def number(name: str):
        return F.expr(f"try_cast(substring_index({name}, ':', -1) as bigint)")

    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to_id").alias("refers_to"),
    )
