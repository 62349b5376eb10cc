from __future__ import annotations

import random

import xxhash

from gridlake.llm import simhash as S
from tests.llm.helpers import docs_of, empty_docs, lower, rows_by_id, words


def brute_print(text, shingle=3):
    w = words(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64(g.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(S, "_SLICE", 7)
    rnd = random.Random(1)
    for text in [None, "", " \n", "One", "one two", "É é E e"] + [" ".join(rnd.choices("abXcé", k=n)) for n in (3, 8, 60)]:
        for shingle in (1, 3, 5):
            assert S.fingerprint(text, shingle) == brute_print(text, shingle)


def test_links_find_every_close_pair_of_any_distance(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1, 0x5555555555555555]
    points = set(base)
    for p in base:
        for _ in range(25):
            points.add(p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))))
    points = sorted(points)
    df = spark.createDataFrame([(signed(p),) for p in points], "fp long")
    for most in (0, 1, 2, 3, 5):
        want = {
            tuple(sorted((signed(a), signed(b))))
            for i, a in enumerate(points)
            for b in points[i + 1 :]
            if (a ^ b).bit_count() <= most
        }
        assert {(r.a, r.b) for r in S.links(df, most).collect()} == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (202, 201), (-5, 300)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200, 202: 200, -5: -5, 300: -5}
    assert got == want
    assert S.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    docs = {7: None, 3: "", 9: "a b c d", 5: "A B C D", 6: "a b c e", 4: "x", None: "x", 8: "long " * 20_000}
    df = docs_of(spark, docs)
    df = df.union(df.where("doc_id = 9")).selectExpr("*", "1 AS fp", "2 AS component_id")
    rows = S.near_duplicates(df).collect()
    assert len(rows) == 9
    got = {r.doc_id: r for r in rows}
    assert {i: r.fp for i, r in got.items()} == {i: signed(brute_print(t)) for i, t in docs.items()}
    assert (got[7].component_id, got[3].component_id, got[9].component_id, got[None].component_id) == (3, 3, 5, 4)
    assert S.near_duplicates(empty_docs(spark)).count() == 0
    assert rows_by_id(S.near_duplicates(docs_of(spark, {None: "only"})))[None].component_id is None
