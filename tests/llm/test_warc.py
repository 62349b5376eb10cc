from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from gridlake.llm import warc as W


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS path", "3 AS id")


ROWS = [
    (5, "http://a/x y\r\nz", "same"), (2, "http://b/", "same"), (9, None, "same"), (7, "http://é/", None), (8, "u", ""),
    (1, "u", "é" * 40_000 + "\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (3, "u", "one"), (3, "u", "one"),
]


def test_round_trip(spark):
    for options in ({}, {"archive_bytes": 1}):
        archives = W.write(pages(spark, ROWS), **options)
        assert archives.agg({"records": "sum"}).first()[0] == len(ROWS)
        table = W.chunks(spark, archives, chunk_bytes=1000)
        rows = table.collect()
        found = W.records(table).collect()
        assert len(found) == len(ROWS) and all(r.intact for r in found)
        got = sorted((r.record_id or "", r.record_type, r.refers_to or "", r.payload_bytes, r.payload_digest) for r in found)
        want = []
        for i, _, html in ROWS:
            b = (html or "").encode()
            first = min((j for j, _, h in ROWS if (h or "") == (html or "") and j is not None), default=None)
            again = i is not None and first is not None and i > first
            want.append(("" if i is None else str(i), "revisit" if again else "response", str(first) if again else "", len(b), digest(b)))
        assert got == sorted(want)
        # Chunks of one record join to its payload and carry the digest so far.
        long = sorted((r for r in rows if r.record_id == "1"), key=lambda r: r.chunk_no)
        assert len(long) > 50 and max(len(r.chunk) for r in long) <= 1000
        so_far = b""
        for k, r in enumerate(long):
            so_far += bytes(r.chunk)
            assert (r.chunk_no, r.bytes_so_far, r.digest_so_far) == (k, len(so_far), digest(so_far))
        assert so_far.decode() == ROWS[5][2] and long[-1].last


def test_least_size_of_revisits(spark):
    found = W.records(W.chunks(spark, W.write(pages(spark, ROWS), revisit_min_bytes=5))).collect()
    assert {r.record_type for r in found} == {"response"}


def test_empty_and_broken(spark):
    none = W.write(pages(spark, ROWS).limit(0))
    assert none.count() == 0 and W.chunks(spark, none).count() == 0
    whole = W.record(1, "u", b"payload", None)
    with pytest.raises(ValueError, match="ends inside"):
        list(W.read_archive(io.BytesIO(whole[:-8])))
    with pytest.raises(ValueError, match="not a WARC"):
        list(W.read_archive(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(b"hello\r\n\r\n")))))


def test_payload_is_compressed_slice_by_slice():
    class Watched:  # a payload that is only ever asked for slices
        def __init__(self, b):
            self.b, self.most = b, 0

        def __len__(self):
            return len(self.b)

        def __getitem__(self, at):
            self.most = max(self.most, at.stop - at.start)
            return self.b[at]

    body = bytes(range(256)) * 4_000 + b"end"
    payload = Watched(body)
    pieces = list(W.member(4, "u", payload, hashlib.sha1(body).digest(), None, slice_bytes=10_000))
    assert payload.most == 10_000 and len(pieces) > 100
    assert gzip.decompress(b"".join(pieces)) == W.record(4, "u", body, None)
    # A revisit's member never touches the payload.
    payload = Watched(body)
    again = b"".join(W.member(4, "u", payload, hashlib.sha1(body).digest(), 2))
    assert payload.most == 0 and gzip.decompress(again) == W.record(4, "u", body, 2)


def test_payload_of_many_slices(spark):
    text = "".join(chr(32 + (k * k) % 90) for k in range(3_500_000))
    found = W.records(W.chunks(spark, W.write(pages(spark, [(1, "u", text), (2, "v", text)])))).collect()
    assert sorted((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.intact) for r in found) == [
        ("1", "response", 3_500_000, digest(text.encode()), True), ("2", "revisit", 3_500_000, digest(text.encode()), True),
    ]
