from __future__ import annotations

import numpy as np
import pytest

from gridlake.llm import token_scan as T
from tests.llm.helpers import docs_of, empty_docs, rows_by_id


def write(path, ids, dtype="uint16"):
    np.array(ids, dtype).tofile(path)


def brute(ids, end):
    out, n = [], 0
    for x in ids:
        if x == end:
            out.append((n, True))
            n = 0
        else:
            n += 1
    return out + ([(n, False)] if n else [])


def test_blocks_are_stitched(spark, scratch):
    rnd = np.random.default_rng(1)
    files = {
        "a": rnd.integers(0, 6, 500), "b": [5], "c": [1] * 70, "d": [], "e": [5, 5, 5, 1, 2], "f": [1] * 40 + [5] + [2] * 40,
    }
    for name, ids in files.items():
        write(f"{scratch}/{name}.bin", ids, "uint32")
    paths = spark.createDataFrame([(f"{scratch}/{n}.bin",) for n in files], "path string")
    for block in (1, 3, 16, 10_000):
        found = T.scan(paths, "uint32", 5, block).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.path, r.ordinal)):
            got.setdefault(r.path[-5], []).append((r.n_tokens, r.ended))
        assert got == {n: brute(ids, 5) for n, ids in files.items() if len(ids)}


def test_broken_file_fails(spark, scratch):
    with open(f"{scratch}/x.bin", "wb") as f:
        f.write(b"abc")
    with pytest.raises(Exception, match="whole number"):
        T.scan(spark.createDataFrame([(f"{scratch}/x.bin",)], "path string")).collect()


def test_round_trip_of_documents(spark):
    texts = {0: None, 1: "", 2: "Two words", 3: "é漢字 " * 3000, 4: "Two words", None: "x"}
    docs = docs_of(spark, texts)
    written = T.write(docs.union(docs.where("doc_id = 2")).selectExpr("*", "1 AS path", "2 AS ordinal"), file_tokens=8)
    found = written.join(T.scan(written.select("path"), block_tokens=64), ["path", "ordinal"])
    encode = T.encoder(T.VOCABULARY)
    assert found.count() == 7
    assert {i: r.n_tokens for i, r in rows_by_id(found).items()} == {i: len(encode(t)) if t else 0 for i, t in texts.items()}
    none = T.write(empty_docs(spark))
    assert none.count() == 0 and T.scan(none.select("path")).count() == 0
