"""WARC archives as a chunked record table.

``write`` lays records down as gzip members of archives in shared storage, one open
archive per task, and returns the manifest of the archives it finished (an attempt that
is lost leaves none there). Of records with equal payloads that with the smallest id is
a response, the others are revisits without payload.

``chunks`` streams archives: a task decompresses an archive piece by piece and emits a
row for every ``chunk_bytes`` of a payload, keyed by archive, record number and chunk
number, with the bytes and the digest so far. Beside the payload cell of the input table,
which is read in place, no record is ever held whole, neither written nor read. ``records`` keeps the last chunk of each record, whose running
counters are the totals.

Defined cases: a null payload is empty (one chunk of no bytes); a null id or URL is left
out of the header and comes back null; a record with a null id is always a response; rows
that repeat the smallest id of a payload are all responses; an empty table writes no
archive and reads back no record; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common as C

CHUNK_BYTES = 1 << 20
#: An archive is closed once it is this large.
ARCHIVE_BYTES = 1 << 30
_FLUSH_BYTES = 8 << 20

# --- Fixed values: WARC 1.1 names ----------------------------------------------
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
# -----------------------------------------------------------------------------
RECORD_URN = "urn:page:"
DATE = "1970-01-01T00:00:00Z"

_MANIFEST = "path string, records long, bytes long"
_CHUNKS = (
    "path string, record_no long, record_id string, record_type string, target_uri string, refers_to string, "
    "declared_digest string, chunk_no long, chunk binary, bytes_so_far long, digest_so_far string, last boolean"
)


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(text: str) -> str:
    """A URL on one header line: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def header(record_id, url, length: int, digest: bytes, refers_to) -> bytes:
    """What stands before the payload of a record, a response or a revisit: the WARC header
    and the HTTP header, which is all that a revisit's block has."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = [VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if record_id is not None:
        lines.append(f"WARC-Record-ID: <{RECORD_URN}{record_id}>")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{sha1_base32(digest)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{RECORD_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    size = len(http) + (length if refers_to is None else 0)
    lines += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {size}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + http


def record(record_id, url, payload: bytes, refers_to) -> bytes:
    """One small record whole, not compressed."""
    head = header(record_id, url, len(payload), hashlib.sha1(payload).digest(), refers_to)
    return head + (payload if refers_to is None else b"") + b"\r\n\r\n"


def member(record_id, url, payload: memoryview, digest: bytes, refers_to, slice_bytes: int = CHUNK_BYTES):
    """Yield the pieces of one record as a gzip member. The payload goes through the
    compressor slice by slice: neither the record nor its compressed form is ever whole."""
    gz = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    yield gz.compress(header(record_id, url, len(payload), digest, refers_to))
    if refers_to is None:
        for at in range(0, len(payload), slice_bytes):
            yield gz.compress(payload[at : at + slice_bytes])
    yield gz.compress(b"\r\n\r\n")
    yield gz.flush()


def _write(folder: str, archive_bytes: int):
    def run(batches):
        fs, base = C.storage(folder)
        fs.create_dir(base, recursive=True)
        done, out, name, n, size = [], None, "", 0, 0
        for batch in batches:
            ids, urls, payloads, digests, firsts = batch.columns
            for k in range(batch.num_rows):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = memoryview(payloads[k].as_buffer())  # a view of the batch, no copy
                for piece in member(ids[k].as_py(), urls[k].as_py(), payload, digests[k].as_py(), firsts[k].as_py()):
                    size += out.write(piece)
                n += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        columns = zip(*done) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"],
        )

    return run


def write(
    pages: DataFrame,
    record_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """Write every row as a record; returns the manifest (path, records, bytes).
    Payloads under ``revisit_min_bytes`` are never revisits."""
    spark = pages.sparkSession
    C.bounded_batches(spark, 200)
    rows = pages.select(
        F.col(record_id).cast("long").alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    # Only ids and digests are compared; equal payloads meet after partial minima.
    narrow = rows.select("id", "digest", F.length("payload").alias("n"))
    first = narrow.where(F.col("n") >= revisit_min_bytes).groupBy("digest", "n").agg(F.min("id").alias("first"))
    again = (
        narrow.where(F.col("n") >= revisit_min_bytes)
        .join(first, ["digest", "n"])
        .where("id > first")
        .select(F.col("id").alias("of"), F.col("digest").alias("of_digest"), "first")
        .distinct()
    )
    told = rows.join(again, (rows["id"] == again["of"]) & (rows["digest"] == again["of_digest"]), "left")
    folder = folder or C.scratch_path(spark, "warc")
    done = told.select("id", "url", "payload", "digest", "first").mapInArrow(_write(folder, archive_bytes), _MANIFEST)
    return C.cut(done, "warc-manifest")


def _header(stream) -> tuple[bytes, dict[str, str]] | None:
    """First line and fields of a header, up to its empty line; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    fields = {}
    while (x := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = x.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return line.strip(), fields


def _urn(value: str | None) -> str | None:
    return value.strip("<>").removeprefix(RECORD_URN) if value else None


class _Counted:
    """Reads of a stream, counted, so that a header's length is known."""

    def __init__(self, stream):
        self.stream, self.n = stream, 0

    def readline(self) -> bytes:
        line = self.stream.readline()
        self.n += len(line)
        return line


def read_archive(stream, chunk_bytes: int = CHUNK_BYTES):
    """Yield a row (without the path) for every chunk of every record of a stream."""
    number = 0
    while (head := _header(stream)) is not None:
        first, fields = head
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        left = int(fields["content-length"])
        kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        payload_length = None
        if fields.get("content-type", "").startswith("application/http"):
            counted = _Counted(stream)
            http = _header(counted)
            left -= counted.n
            payload_length = int(http[1].get("content-length", left)) if http else None
        base = (number, _urn(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), _urn(fields.get("warc-refers-to")), declared)
        digest, total, k = hashlib.sha1(), 0, 0
        while True:
            piece = stream.read(min(chunk_bytes, left)) if left else b""
            if left and not piece:
                raise ValueError("the archive ends inside a record")
            left -= len(piece)
            total += len(piece)
            digest.update(piece)
            if kind == "revisit":  # counts and digest of the payload it stands for
                yield (*base, k, piece, payload_length, declared, True)
            else:
                yield (*base, k, piece, total, sha1_base32(digest.digest()), not left)
            k += 1
            if not left:
                break
        number += 1


def _read(chunk_bytes: int):
    schema = pa.schema(
        [("path", pa.string()), ("record_no", pa.int64())]
        + [(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "refers_to", "declared_digest")]
        + [("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())]
    )

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = C.storage(path)
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in read_archive(stream, chunk_bytes):
                        rows.append((path, *row))
                        held += len(row[7]) + 400
                        if held >= _FLUSH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def chunks(spark: SparkSession, archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of archives (column ``path``): one task reads one archive."""
    paths = archives.select("path").repartition(max(1, archives.count()), "path")
    return paths.mapInArrow(_read(chunk_bytes), _CHUNKS)


def records(chunk_table: DataFrame) -> DataFrame:
    """One row per record: path, record_no, record_id, record_type, target_uri,
    refers_to, payload_bytes, payload_digest and whether the digest is the declared one."""
    return chunk_table.where("last").select(
        "path", "record_no", "record_id", "record_type", "target_uri", "refers_to",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        (F.col("declared_digest").isNull() | (F.col("digest_so_far") == F.col("declared_digest"))).alias("intact"),
    )


C.ship(__name__)
