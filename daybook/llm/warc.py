"""WARC archives: written by tasks, read back by byte ranges.

Each record is a gzip member of its own. A reading task owns the records that
start inside its range: it looks for the gzip magic, takes a place for a record
only if what it inflates to begins as a WARC header, and then goes on at the
member's end, which may lie beyond the range. A record that begins so and cannot
be read whole ends the job with its path and offset. Header names count alike in
any capitals.

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the largest id is a response and the others are revisits that name it. Rows that
repeat an id and payload are written alike; a null id is never the largest, and
payloads of null ids only are responses. Null html is an empty payload.

A task writes files named after its attempt and returns their names; the table
of names is committed by Spark, so files of lost or repeated attempts are in no
table and are never read. Files go through ``pyarrow.fs`` to the folder all
executors share.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import column, slices, utf8_texts, written

FILE_BYTES = 128 << 20
RANGE_BYTES = 16 << 20
_CHUNK = 1 << 18
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_COLUMNS = (
    "path string, offset bigint, record_type string, record_id string, target_uri string,"
    " refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def with_roles(
    pages: DataFrame, ident: str = "page_id", html: str = "html", min_revisit: int = 0
) -> DataFrame:
    """``pages`` with ``payload_sha1`` (hex) and ``keeper``, the id of the response."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    hashed = pages.withColumns({"payload_sha1": F.sha1(payload)})
    large = F.octet_length(payload) >= min_revisit
    keepers = hashed.filter(large).groupBy("payload_sha1").agg(F.max(ident).alias("__keeper"))
    joined = hashed.join(keepers, "payload_sha1", "left")
    return joined.withColumn(
        "keeper", F.when(large, F.col("__keeper")).otherwise(F.col(ident))
    ).drop("__keeper")


def _header_text(value: str) -> bytes:
    """A header value on one line: control characters are percent-encoded."""
    return b"".join(b"%%%02X" % b if b < 32 or b == 127 else bytes([b]) for b in value.encode())


def record(
    ident: str, uri: str | None, payload: bytes, sha1: str, refers_to: str | None
) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1))
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <urn:page:" + ident.encode() + b">",
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Payload-Digest: sha1:" + digest,
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if uri is not None:
        lines.append(b"WARC-Target-URI: " + _header_text(uri))
    if refers_to is not None:
        lines += [b"WARC-Refers-To: <urn:page:" + refers_to.encode() + b">"]
        lines += [b"WARC-Profile: " + _PROFILE]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def write(
    pages: DataFrame,
    root: str,
    ident: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the archives below ``root``; the written table of ``path, bytes, records``."""
    rows = pages.select(
        F.col(f"`{ident}`").alias("ident"),
        F.col(f"`{url}`").alias("url"),
        F.col(f"`{html}`").alias("html"),
    )
    rows = with_roles(rows, "ident", "html", min_revisit).select(
        F.coalesce(F.col("ident").cast("string"), F.lit("null")).alias("ident"),
        "url",
        "html",
        "payload_sha1",
        F.when(~F.col("ident").eqNullSafe(F.col("keeper")), F.col("keeper").cast("string")).alias(
            "refers_to"
        ),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        files: list[tuple[str, int, int]] = []
        out, size, count = None, 0, 0
        for part in slices(batches, "html"):
            columns = [column(part, c).to_pylist() for c in ("ident", "url", "payload_sha1", "refers_to")]
            payloads = utf8_texts(column(part, "html"))
            for name, uri, sha1, refers_to, payload in zip(*columns, payloads, strict=True):
                if out is None:
                    path = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{len(files)}.warc.gz"
                    out, size, count = store.open_output_stream(path, compression=None), 0, 0
                member = record(name, uri, payload, sha1, refers_to)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    files.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            files.append((path, size, count))
        if files:
            paths, sizes, counts = zip(*files, strict=True)
            paths = [f"{root.rstrip('/')}/{p.rpartition('/')[2]}" for p in paths]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["path", "bytes", "records"],
            )

    return written(rows.mapInArrow(run, "path string, bytes bigint, records bigint"), "archives")


def _fields(head: bytes) -> dict[bytes, bytes]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


class DamagedRecord(ValueError):
    """A place that begins as a WARC record and does not hold a whole one."""


class Member:
    """A gzip member that is read from ``offset`` on, as far as asked for."""

    def __init__(self, file: pa.NativeFile, offset: int):
        self.file, self.at = file, offset
        self.inflate, self.data = zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Inflate another chunk; false at the member's end."""
        if self.inflate.eof:
            return False
        chunk = self.file.read_at(_CHUNK, self.at)
        if not chunk:
            raise zlib.error("truncated member")
        self.data += self.inflate.decompress(chunk)
        self.at += len(chunk) - len(self.inflate.unused_data)
        return True

    def header(self) -> bytes | None:
        """The WARC header, or None if this is no record."""
        while (end := self.data.find(b"\r\n\r\n")) < 0:
            if not b"WARC/1.".startswith(self.data[:7]) or not self.more():
                return None
        head = bytes(self.data[:end])
        return head if head.startswith(b"WARC/1.") and b"warc-type" in _fields(head) else None

    def block(self, length: int) -> bytes:
        while self.more():
            pass
        start = self.data.find(b"\r\n\r\n") + 4
        if start + length > len(self.data):
            raise ValueError(f"block of {len(self.data) - start} bytes, not {length}")
        return bytes(self.data[start : start + length])


def _begins_record(file: pa.NativeFile, offset: int) -> bool:
    """Whether the first bytes inflate to a WARC version, whatever follows them."""
    try:
        return zlib.decompressobj(31).decompress(file.read_at(_CHUNK, offset), 7) == b"WARC/1."
    except zlib.error:
        return False


def records_in(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, bytes, bytes]]:
    """``offset, header, block`` of the records that start in ``start..end``."""
    at, held, base = start, b"", start
    while at < end:
        found = held.find(_MAGIC, at - base)
        if found < 0:
            # Keep what may be the beginning of a magic cut by the chunk.
            keep = max(at, base + len(held) - 2)
            held = held[keep - base :]
            chunk = file.read_at(_CHUNK, keep + len(held))
            if not chunk:
                return
            base, at, held = keep, keep, held + chunk
            continue
        at = base + found
        if at >= end:
            return
        member = Member(file, at)
        head = block = None
        try:
            head = member.header()
            if head is not None:
                block = member.block(int(_fields(head)[b"content-length"]))
        except (zlib.error, KeyError, ValueError) as error:
            if _begins_record(file, at):
                raise DamagedRecord(f"damaged record at {at}: {error!r}") from error
        if head is None:
            at += 1
            continue
        yield at, head, block
        at = member.at
        if at >= base + len(held):
            base, held = at, b""


def _urn(value: bytes | None) -> str | None:
    return value.decode().removeprefix("<urn:page:").removesuffix(">") if value else None


def read(archives: DataFrame, range_bytes: int = RANGE_BYTES, payload: bool = True) -> DataFrame:
    """The records of ``archives`` (path, bytes). The digest of a response is
    that of the payload read; with ``payload=False`` the bytes are left out."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = archives.filter("bytes > 0").select("path", F.explode(starts).alias("start"))
    tasks = max(1, ranges.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(column(batch, "path").to_pylist(), column(batch, "start").to_pylist(), strict=True)
            for path, start in pairs:
                store, place = pa.fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    rows, held = [], 0
                    try:
                        for offset, head, block in records_in(file, start, start + range_bytes):
                            row = parsed(head, block)
                            rows.append((path, offset, *(row if payload else (*row[:-1], None))))
                            held += len(block)
                            if held > 4 << 20 or len(rows) >= 1000:
                                yield as_batch(rows)
                                rows, held = [], 0
                    except DamagedRecord as error:
                        raise DamagedRecord(f"{path}: {error}") from error
                    yield as_batch(rows)

    def parsed(head: bytes, block: bytes) -> tuple:
        fields = _fields(head)
        http, _, body = block.partition(b"\r\n\r\n")
        kind = fields[b"warc-type"].decode()
        uri = fields.get(b"warc-target-uri")
        if kind == "revisit":
            digest = fields[b"warc-payload-digest"].decode().partition(":")[2]
            size, body = int(_fields(http)[b"content-length"]), None
        else:
            digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
        return (
            kind,
            _urn(fields[b"warc-record-id"]),
            uri.decode() if uri is not None else None,
            _urn(fields.get(b"warc-refers-to")),
            digest,
            size,
            body,
        )

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        names = [part.split()[0] for part in RECORD_COLUMNS.split(",")]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )

    return ranges.repartition(tasks).mapInArrow(run, RECORD_COLUMNS)
