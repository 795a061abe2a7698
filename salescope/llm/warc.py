"""WARC archives: a writer, and a reader that splits gzip files.

Every record is a gzip member of its own.  Of records with equal payloads of at
least ``MIN_REVISIT`` bytes, the one with the smallest ``page_id`` is stored as a
response and the others as revisits that name it; smaller ones are all responses.

The reader cuts every file into byte ranges.  A task looks for the gzip magic in
its range, takes a place for a member when it decodes to a WARC header, and owns
the records that start inside; the last may end beyond.  Behind a member the next
one follows at once, so only the first place of a range is searched, and where a
member is damaged the search goes on behind its start.  Records that do not
decode are not returned.

Files are reached by ``pyarrow.fs`` inside the tasks (local, HDFS, S3 and others,
by the path's scheme).  A writing task writes under an attempt's name and moves
the file in place at the end, so a repeated task replaces its own file.

Defined results: a null html is an empty payload; a null ``page_id`` is never the
smallest unless all are null; rows that repeat the smallest ``page_id`` are all
responses; other columns are ignored; no rows give no records.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import stored
from salescope.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
GZIP = 31  # zlib's window setting for gzip
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ---- end of fixed values ----
MIN_REVISIT = 100
LEVEL = 6
SPLIT_BYTES = 8 << 20
RANGES = 16  # read by a task, at most about
CHUNK = 1 << 20  # bytes read at a time
PROBE = 512  # bytes that show whether a member begins here
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record(fields: list[tuple[str, str | None]], content: bytes, level: int = LEVEL) -> bytes:
    """One record as a gzip member."""
    head = b"".join(
        f"{name}: {' '.join(value.splitlines()) if value else ''}\r\n".encode("utf-8", "replace")
        for name, value in fields
        if value is not None
    )
    raw = b"".join((VERSION, b"\r\n", head, b"Content-Length: %d\r\n\r\n" % len(content), content, b"\r\n\r\n"))
    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return packer.compress(raw) + packer.flush()


def encoded(name: str | None) -> str | None:
    """A page id as a header value that comes back whole, white space and line ends included."""
    return None if name is None else quote(name, safe="")


def _decoded(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def _page_record(part: int, n: int, page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    name = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{part}/{n}/{page_id}/{digest}')}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", encoded(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", encoded(refers_to))]
    return record(fields, HTTP + (b"" if revisit else payload))


def marked(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, digest, revisit, refers_to)`` of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Only groups of copies matter; the payloads themselves are not moved for it.
    copies = rows.filter(F.length("payload") >= MIN_REVISIT).groupBy("digest")
    copies = copies.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(stored(copies.select("digest", "first"), "copies"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        "page_id",
        "url",
        "payload",
        "digest",
        revisit.alias("revisit"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write(pages: DataFrame, path: str) -> int:
    """Write one archive per partition of ``pages`` below ``path``; the number of records."""
    rows = marked(pages).select(
        F.col("page_id").cast("string"), "url", "payload", "digest", "revisit", F.col("refers_to").cast("string")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        part = task.partitionId()
        store.create_dir(root, recursive=True)
        final = f"{root}/part-{part:06d}.warc.gz"
        draft = f"{root}/_draft-{part:06d}-{task.taskAttemptId()}"
        count = 0
        with store.open_output_stream(draft, compression=None) as out:
            out.write(record([("WARC-Type", "warcinfo"), ("WARC-Date", DATE)], b"format: WARC File Format 1.1\r\n"))
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for page_id, url, payload, digest, revisit, refers_to in zip(*columns):
                    out.write(_page_record(part, count, page_id, url, payload, digest, revisit, refers_to))
                    count += 1
        if store.get_file_info(final).type != fs.FileType.NotFound:
            store.delete_file(final)
        store.move(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["records"])

    return rows.mapInArrow(run, "records long").agg(F.sum("records")).first()[0] or 0


class _Bytes:
    """A file read forward in chunks, kept from the place still needed."""

    def __init__(self, file, at: int):
        self.file, self.size = file, file.size()
        self.at, self.data = at, b""

    def more(self) -> bool:
        new = self.file.read_at(min(CHUNK, self.size - self.at - len(self.data)), self.at + len(self.data))
        self.data += new
        return bool(new)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member(data: _Bytes, offset: int) -> tuple[bytes, int] | None:
    """The content of the member at ``offset`` of the buffer and its length; None if there is none."""
    while len(data.data) < offset + PROBE and data.more():
        pass
    if data.data[offset : offset + 3] != MAGIC:
        return None
    try:
        head = zlib.decompressobj(GZIP).decompress(data.data[offset : offset + PROBE], PROBE)
        if not head.startswith(b"WARC/1."):
            return None
        unpacker = zlib.decompressobj(GZIP)
        parts = [unpacker.decompress(memoryview(data.data)[offset:])]
        end = len(data.data)
        while not unpacker.eof:
            if not data.more():
                return None
            parts.append(unpacker.decompress(memoryview(data.data)[end:]))
            end = len(data.data)
        return b"".join(parts), end - len(unpacker.unused_data) - offset
    except zlib.error:
        return None


def members(file, start: int, end: int) -> Iterator[bytes]:
    """The contents of the members that begin in ``[start, end)``."""
    data = _Bytes(file, start)
    offset = 0
    while data.at + offset < end:
        found = _member(data, offset)
        if found:
            content, length = found
            yield content
            offset += length
        else:
            while (place := data.data.find(MAGIC, offset + 1)) < 0:
                offset = max(offset, len(data.data) - len(MAGIC))
                if data.at + offset >= end or not data.more():
                    return
            offset = place
        if offset >= CHUNK:
            data.drop(offset)
            offset = 0


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields (names in lower case) and the content of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields, rest[: int(fields.get("content-length", 0))]


KEPT = (
    "page_id string, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to string, payload binary"
)


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """The page records of all archives below ``path``.

    Length and digest of a response are those of the payload read back; those of
    a revisit are the ones its record states.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    files = files.load(path).filter("length > 0").select("path", "length")
    step = F.lit(split_bytes).cast("long")
    ranges = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)))
    ranges = durable(ranges.select("path", "start", F.least(F.col("start") + step, F.col("length")).alias("end")))
    # A task takes several ranges, but no core is left without one.
    count = ranges.count()
    wanted = max(-(-count // RANGES), min(count, 2 * spark.sparkContext.defaultParallelism), 1)
    dealt = ranges.repartitionByRange(wanted, F.xxhash64("path", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = fs.FileSystem.from_uri(where)
                rows = []
                with store.open_input_file(name) as file:
                    for content in members(file, start, end):
                        fields, body = parse(content)
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        payload = body.partition(b"\r\n\r\n")[2]
                        digest = fields.get("warc-payload-digest", "").partition(":")[2]
                        length = int(fields.get("x-payload-length", len(payload)))
                        if kind == "response":
                            digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                        rows.append(
                            (
                                _decoded(fields.get("x-page-id")),
                                fields.get("warc-target-uri"),
                                kind,
                                length,
                                digest,
                                _decoded(fields.get("x-refers-to-page-id")),
                                payload if payloads and kind == "response" else None,
                            )
                        )
                        if len(rows) == 256:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    return dealt.mapInArrow(run, KEPT)


def _batch(rows: list) -> pa.RecordBatch:
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
