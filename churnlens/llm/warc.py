"""WARC archives: one gzip member a record, written by tasks, read back by byte ranges.

Writing. Equal payloads of at least ``least`` bytes are stored once: the row
with the smallest page_id is a response, the others are revisits that name it.
Each task writes its rows to files of its own in the archive folder; the table
of written files is the list that counts, so files of lost or repeated attempts
are never read.

Reading. Files are cut into byte ranges and dealt to tasks. A task looks for the
gzip magic in its range and takes a candidate for a record if the header is one
of deflate, the data decode from there, and their first line is a WARC version.
A record belongs to the range in which it starts; its reader goes on past the
range's end to the record's. After a record the search goes on behind it, so
magic bytes inside compressed data cost one failed decoding at most. A damaged
record gives a row with ``problem`` set, or ends the job with ``strict``.

Defined results: a null html is an empty payload; a null page_id or url leaves
its header out and is null again when read; null ids come last, so they refer to
others and never are referred to; rows that repeat the smallest page_id of a
payload are responses all; line ends in a url are kept by an encoded header.
One payload has to fit a task's memory. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize
from ..operators.joins import attach_by_key
from ..session import scratch_path

#: A file is closed once it is this long.
FILE_BYTES = 1 << 30
#: The byte range of one reading task.
RANGE_BYTES = 64 << 20
#: Smaller payloads are never revisits.
LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

_WRITTEN = "path string, bytes long, records long"
_RECORD = ("path string, offset long, bytes long, warc_type string, record_id string, target_uri string, "
           "page_id long, refers_to long, digest string, payload binary, problem string")
#: Bytes read at once, and bytes decoded at once.
_BLOCK, _STEP = 1 << 20, 1 << 16


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it; runs in tasks as well."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path)


# --- writing -------------------------------------------------------------------

def with_origins(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (the page_id whose payload is the same, null in responses)."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= least
    firsts = (rows.filter(long).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1 AND first_id IS NOT NULL"))
    first = F.col("first_id")
    return (attach_by_key(rows, firsts, "digest", "_n", name="warc-origins")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(first), first)).drop("first_id"))


def record_id(page_id: object, url: str | None) -> str:
    """The same id whenever a row is written again."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{url}'.encode()).digest())}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 date: str = DATE) -> bytes:
    """One record, before compression."""
    body = (HTTP_HEAD % len(payload)).encode() + (payload if refers_to is None else b"")
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, url)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
        if quote(url, safe=_URL_SAFE) != url:
            head.append(f"X-Target-URI-Base64: {base64.b64encode(url.encode()).decode()}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


_URL_SAFE = "!#$%&'()*+,-./:;<=>?@[]_~|^`{}\\\""


def _member(data: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _writer(folder: str, file_bytes: int, level: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        out = path = None
        size = records = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # an attempt's own: never appended to by another
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)  # members are packed here
                    path, size, records = f"{folder}/{name}", 0, 0
                packed = _member(record_bytes(*[c[i].as_py() for c in columns]), level)
                out.write(packed)
                size, records = size + len(packed), records + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})
    return write


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES,
               level: int = 6) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder``; returns the written table of files (path, bytes, records)."""
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    rows = with_origins(pages, least).select("page_id", "url", "payload", "digest", "refers_to")
    return materialize(rows.mapInArrow(_writer(folder, file_bytes, level), _WRITTEN), "warc-files")


# --- reading -------------------------------------------------------------------

class _Tail:
    """Forward reading of a file from any place, a block at a time."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def _hold(self, offset: int, least: int) -> int:
        """Have ``data`` hold ``least`` bytes from ``offset`` on, unless the file ends; the place in ``data``."""
        skip = offset - self.at
        if not 0 <= skip <= len(self.data) - least and offset < self.size:
            self.file.seek(offset)
            self.at, self.data, skip = offset, self.file.read(max(_BLOCK, least)), 0
        return skip if 0 <= skip <= len(self.data) else len(self.data)

    def bytes(self, offset: int, most: int) -> bytes:
        """Up to ``most`` bytes from ``offset`` on; none at the file's end only."""
        skip = self._hold(offset, 1)
        return self.data[skip:skip + most]

    def find(self, what: bytes, start: int, end: int) -> int:
        """The first place of ``what`` that starts in [start, end), or -1."""
        while start < end:
            skip = self._hold(start, len(what))
            at = self.data.find(what, skip)
            if at >= 0:
                at += self.at
                return at if at < end else -1
            if len(self.data) - skip < len(what):
                return -1
            start = self.at + len(self.data) - len(what) + 1
        return -1


def is_record(tail: _Tail, offset: int) -> bool:
    """Whether a gzip member at ``offset`` starts with a WARC version line."""
    flags = tail.bytes(offset + len(MAGIC), 1)
    if not flags or flags[0] & 0xE0:  # reserved bits
        return False
    unpack, seen, most = zlib.decompressobj(31), b"", len(VERSIONS[0])
    try:
        while len(seen) < most and not unpack.eof and (data := tail.bytes(offset, 1 << 9)):
            seen += unpack.decompress(data, most - len(seen))
            offset += len(data) - len(unpack.unconsumed_tail) - len(unpack.unused_data)
    except zlib.error:
        return False
    return seen in VERSIONS


def read_member(tail: _Tail, offset: int) -> tuple[bytes, int]:
    """The data of the member at ``offset`` and its end; ValueError if it is damaged."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        data = tail.bytes(offset, _STEP)
        if not data:
            raise ValueError("the file ends inside the record")
        try:
            parts.append(unpack.decompress(data))
        except zlib.error as e:
            raise ValueError(str(e)) from e
        offset += len(data) - len(unpack.unused_data)
    return b"".join(parts), offset


def parse_record(data: bytes) -> dict:
    """The fields of a decoded record, keyed as the columns of ``read_warc``; ValueError if they contradict."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if not mark or not fields.get("content-length", "").isdigit():
        raise ValueError("no Content-Length")
    n = int(fields["content-length"])
    if len(rest) < n:
        raise ValueError("the block is shorter than its Content-Length")
    payload = rest[:n]
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        payload = payload.partition(b"\r\n\r\n")[2]
    uri = fields.get("warc-target-uri")
    if "x-target-uri-base64" in fields:
        uri = base64.b64decode(fields["x-target-uri-base64"]).decode()

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    return {"warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "target_uri": uri,
            "page_id": number("x-page-id"), "refers_to": number("x-refers-to-page-id"),
            "digest": fields.get("warc-payload-digest"), "payload": payload}


def records_in(tail: _Tail, start: int, end: int) -> Iterator[dict]:
    """The records that start in [start, end), damaged ones with ``problem``."""
    at = tail.find(MAGIC, start, end)
    while at >= 0:
        after = at + 1
        if is_record(tail, at):
            row = dict.fromkeys(_NAMES) | {"offset": at}
            try:
                data, ended = read_member(tail, at)
                row |= {"bytes": ended - at} | parse_record(data)
                after = ended
            except ValueError as e:
                row |= {"problem": str(e)}
            yield row
        at = tail.find(MAGIC, after, end)


_NAMES = [c.split()[0] for c in _RECORD.split(", ")]
_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                     for n, t in (c.split() for c in _RECORD.split(", "))])


def _reader(batch_bytes: int, strict: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                fs, path = file_system(part["path"])
                with fs.open_input_file(path) as file:
                    for row in records_in(_Tail(file, file.size()), part["start"], part["end"]):
                        if strict and row["problem"]:
                            raise ValueError(f"{part['path']} at {row['offset']}: {row['problem']}")
                        rows.append(row | {"path": part["path"]})
                        held += len(row["payload"] or b"") + 200
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
    return read


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the archives at ``path`` (a folder or pattern); lists, reads nothing."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, batch_bytes: int = 16 << 20,
              strict: bool = False) -> DataFrame:
    """The records of ``files`` (path, bytes), one row each; every byte range is a row that any task may take."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = (files.filter("bytes > 0").select("path", start.alias("start"))
              .withColumn("end", F.col("start") + F.lit(range_bytes)))
    spark = files.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return ranges.repartition(parts, "path", "start").mapInArrow(_reader(batch_bytes, strict), _RECORD)


def resolved_pages(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: a revisit's payload is its response's.

    Sizes and digests are of the payloads read. Revisits get those of the
    response that has the page_id and the digest that they name; null if none has.
    """
    stated = F.regexp_replace("digest", "^sha256:", "")
    own = F.sha2("payload", 256)
    key = F.when(F.col("refers_to").isNotNull(), F.concat_ws(":", "refers_to", stated)).otherwise(
        F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("?")), own))
    rows = materialize(records.filter("problem IS NULL AND warc_type IN ('response', 'revisit')").select(
        "page_id", "warc_type", "refers_to", F.octet_length("payload").cast("long").alias("own_bytes"),
        own.alias("own_digest"), key.alias("_key")), "warc-read")
    is_new = F.col("warc_type") == "response"
    origins = (rows.groupBy("_key").agg(F.max(F.when(is_new, F.col("own_bytes"))).alias("bytes"),
                                        F.max(F.when(is_new, F.col("own_digest"))).alias("sha"),
                                        F.count(F.lit(1)).alias("_n"))
               .filter("_n > 1 AND sha IS NOT NULL"))
    return attach_by_key(rows, origins, "_key", "_n", name="warc-resolved").select(
        "page_id", F.when(is_new, F.col("own_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(is_new, F.col("own_digest")).otherwise(F.col("sha")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), "refers_to")


def round_trip(pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES, **kw) -> DataFrame:
    """Write ``pages`` to archives under ``folder`` (default: the shared scratch folder), read them back, resolve."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return resolved_pages(read_warc(write_warc(pages, folder, **kw), range_bytes))
