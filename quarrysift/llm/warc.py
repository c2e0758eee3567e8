"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. A task reads a byte range: it looks for the
gzip magic, takes a place for a record only if what unpacks there begins as a WARC
record does, and owns the records that start inside its range, the last of which
may end after it. So one large archive is read by many tasks without an index.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import drop_on_exit, prepare, stored
from .tokenfiles import open_folder

# Payloads from this many bytes on are written once.
LEAST_PAYLOAD = 100
# An archive is closed after it has grown to this size, and read in ranges of this size.
ARCHIVE_BYTES = 1 << 28
RANGE_BYTES = 4 << 20
READ_BYTES = 1 << 20
UNPACK_BYTES = 1 << 14

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
LINE = b"\r\n"
# Of a candidate so much is unpacked to tell whether a record begins there.
PROBE_BYTES = 64
# A task reads ranges of about this many bytes.
TASK_BYTES = 256 << 20

MANIFEST = "file string, bytes long, records long"


def plan_records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """Which record each page becomes: k, url, payload, digest and first.

    ``first`` is the page that holds the payload, for pages that only revisit it. Of equal
    payloads of at least ``LEAST_PAYLOAD`` bytes the smallest id is the response, and so is every row
    with that id. Null payloads are empty. Digests are counted before they move; a payload
    moves once, to the list of repeated digests, where that is too long to broadcast.
    """
    rows = pages.select(
        F.col(id_col).alias("k"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= LEAST_PAYLOAD)
    repeated = long.groupBy("digest").agg(F.min("k").alias("least"), F.count("*").alias("c")).where("c > 1")
    repeated = stored(repeated.select("digest", "least"), "repeated-payloads")
    found = rows.join(repeated, "digest", "left")
    revisit = F.col("least").isNotNull() & ~F.col("k").eqNullSafe(F.col("least"))
    return found.select("k", "url", "payload", "digest", F.when(revisit, F.col("least")).alias("first"))


def record(page: str | None, url: str | None, payload: bytes, digest: str, first: str | None) -> bytes:
    """The bytes of one record before compression."""
    # Line ends have no place in a header value.
    target = (url or "").replace("\r", " ").replace("\n", " ")
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if target:
        lines.append(f"WARC-Target-URI: {target}")
    if page is not None:
        lines.append(f"X-Page: {quote(page, safe='')}")
    if first is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
        lines.append("Content-Type: application/http; msgtype=response")
    else:
        block = b""
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page: {quote(first, safe='')}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + LINE * 2 + block + LINE * 2


def unquoted(value: str | None) -> str | None:
    """An id as it was: in a header blanks, line breaks and the like stand percent-encoded."""
    return None if value is None else unquote(value)


def packed(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_archives(records: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write planned records to archives in a folder that all executors share.

    Returns the manifest (file, bytes, records) and the folder. Each task writes
    archives of its own under new names, and only those of tasks that succeeded are in the manifest.
    """
    spark = records.sparkSession
    prepare(spark)
    if folder is None:
        folder = scratch_dir(spark, "warc")
        drop_on_exit(spark, folder)
    rows = records.select(F.col("k").cast("string"), "url", "payload", "digest", F.col("first").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        name = sink = None
        size = count = 0

        def line() -> pa.RecordBatch:
            columns = [pa.array([name]), pa.array([size], pa.int64()), pa.array([count], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "bytes", "records"])

        for batch in batches:
            for page, url, payload, digest, first in zip(*(batch.column(c) for c in range(5))):
                if sink is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                data = packed(record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), first.as_py()))
                sink.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    sink = None
                    yield line()
        if sink is not None:
            sink.close()
            yield line()

    return stored(rows.mapInArrow(run, MANIFEST), "warc-manifest"), folder


class Source:
    """A window over a file that moves forward."""

    def __init__(self, file, size: int, start: int) -> None:
        self.file, self.size = file, size
        self.base, self.data = start, b""

    def view(self, start: int, count: int) -> bytes:
        """Up to ``count`` bytes from ``start``, fewer only at the end of the file."""
        if start < self.base or start > self.base + len(self.data):
            self.base, self.data = start, b""
        skip = start - self.base
        if len(self.data) - skip < count and self.base + len(self.data) < self.size:
            self.data, self.base, skip = self.data[skip:], start, 0
            want = max(count, READ_BYTES) - len(self.data)
            self.file.seek(self.base + len(self.data))
            self.data += self.file.read(want)
        return self.data[skip : skip + count]


def begins_record(source: Source, place: int) -> bool:
    """Whether a gzip member starts here that unpacks to a WARC record."""
    got = zlib.decompressobj(31)
    try:
        return got.decompress(source.view(place, 4096), PROBE_BYTES).startswith(b"WARC/")
    except zlib.error:
        return False


def unpack(source: Source, place: int) -> tuple[bytes, int]:
    """The member at ``place`` and where the next one starts."""
    unpacker, parts, at = zlib.decompressobj(31), [], place
    while not unpacker.eof:
        data = source.view(at, UNPACK_BYTES)
        if not data:
            raise EOFError("the member is cut off")
        parts.append(unpacker.decompress(data))
        at += len(data)
    return b"".join(parts), at - len(unpacker.unused_data)


def members(source: Source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Records that start in [start, end), with their places.

    After a record the next one is expected at once; where none begins there, or a member is broken,
    the search for the magic goes on one byte later.
    """
    place = start
    while place < end:
        data = source.view(place, UNPACK_BYTES)
        at = data.find(MAGIC)
        if at < 0:
            if len(data) < UNPACK_BYTES:
                return
            place += len(data) - len(MAGIC) + 1
            continue
        place += at
        if place >= end:
            return
        if begins_record(source, place):
            try:
                data, following = unpack(source, place)
            except (zlib.error, EOFError):
                place += 1
                continue
            yield place, data
            place = following
        else:
            place += 1


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    end = data.find(LINE * 2)
    if end < 0:
        raise ValueError("the record's header has no end")
    headers = {}
    for row in data[:end].split(LINE)[1:]:
        name, _, value = row.partition(b":")
        headers[name.decode().strip().lower()] = value.decode().strip()
    start = end + 2 * len(LINE)
    return headers, data[start : start + int(headers["content-length"])]


FIELDS = [
    ("file", pa.string()),
    ("place", pa.int64()),
    ("record_type", pa.string()),
    ("url", pa.string()),
    ("page", pa.string()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("refers_to", pa.string()),
    ("payload", pa.binary()),
]


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the listed archives, read by byte ranges of ``range_bytes``.

    A response's length and digest are taken from its payload, those of a revisit from its
    header. A response whose payload does not fit its digest fails the job, and so does an archive
    with more or fewer records than the manifest counts; for that the rows are stored once. A manifest
    without ``records`` is not compared. A task holds one record and one batch of at most a few
    megabytes of payloads.
    """
    ranges = manifest.select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes))).alias("start")
    )
    # Ranges are short rows: dealing them out evenly costs nothing.
    count, total = ranges.agg(F.count(F.lit(1)), F.sum(F.least(F.lit(range_bytes), F.col("bytes") - F.col("start")))).first()
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism * 2, math.ceil((total or 0) / TASK_BYTES))
    ranges = ranges.repartition(max(1, min(count, tasks)), "file", "start")
    schema = pa.schema(FIELDS)

    def batch_from(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for batch in batches:
            for task in batch.to_pylist():
                rows, held = [], 0
                with store.open_input_file(f"{root}/{task['file']}") as file:
                    source = Source(file, task["bytes"], task["start"])
                    for place, data in members(source, task["start"], task["start"] + range_bytes):
                        headers, block = parse(data)
                        kind, digest = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2]
                        payload, size = None, int(headers["x-payload-length"])
                        if kind == "response":
                            payload = block[block.find(LINE * 2) + 2 * len(LINE) :]
                            size = len(payload)
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"payload and digest differ at {place} of {task['file']}")
                        held += size
                        rows.append(
                            (
                                task["file"],
                                place,
                                kind,
                                headers.get("warc-target-uri"),
                                unquoted(headers.get("x-page")),
                                size,
                                digest,
                                unquoted(headers.get("x-refers-to-page")),
                                payload if with_payload else None,
                            )
                        )
                        if held > READ_BYTES * 4 or len(rows) >= 4096:
                            yield batch_from(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_from(rows)

    found = ranges.mapInArrow(
        run,
        "file string, place long, record_type string, url string, page string, payload_bytes long, "
        "payload_digest string, refers_to string, payload binary",
    )
    if "records" not in manifest.columns:
        return found
    found = stored(found, "warc-records")
    wanted = manifest.groupBy("file").agg(F.sum("records").alias("wanted"))
    counts = wanted.join(found.groupBy("file").count(), "file", "left")
    bad = counts.where(F.coalesce("count", F.lit(0)) != F.col("wanted")).orderBy("file").first()
    if bad is not None:
        raise ValueError(f"{bad['file']} has {bad['count'] or 0} whole records of {bad['wanted']}")
    return found


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """Write a record per page, read the archives back, and describe each record.

    Per page: the id, payload_bytes, payload_digest (SHA-256 of the full payload, lower-case
    hex), record_type and refers_to. A page without an id keeps none; equal rows give equal records.
    """
    manifest, folder = write_archives(plan_records(pages, id_col, payload_col, url_col))
    kind: T.DataType = pages.schema[id_col].dataType
    return read_archives(manifest, folder, with_payload=False).select(
        F.col("page").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
