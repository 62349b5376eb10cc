from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gridlake.llm import iblt as I
from tests.llm.helpers import docs_of, empty_docs


def units(t):
    return {p for p in re.split(r"\n+|(?<=[.!?])[ \t]+", t or "") if p}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, docs, found):
    order = sorted(docs, key=lambda i: (i is None, i))
    got = {r.doc_id: r for r in found.collect()}
    assert set(got) == set(docs)
    for k, i in enumerate(order):
        t, after = docs[i] or "", docs[order[(k + 1) % len(order)]] or ""
        f = len(t) // 4
        edited = t[: len(t) - f] + after[:f]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(jaccard(units(t), units(edited)))
        assert got[i].near_next == pytest.approx(jaccard(units(t), units(after)))
    return got


def texts(n=30):
    rnd = random.Random(9)
    lines = [f"Line {k} é. Second {k}!" for k in range(25)]
    docs = {3 * i: "\n".join(rnd.choices(lines, k=rnd.randint(0, 30))) for i in range(n)}
    return docs | {1: None, 2: "", 4: "no end", 5: docs[9], 7: docs[9], 10_000: "x. " * 3000, 10_001: "\n".join(f"u{k}" for k in range(900))}


def test_documents(spark):
    docs = texts()
    df = docs_of(spark, docs | {None: "last. one."})
    df = df.union(df.where("doc_id = 9")).selectExpr("*", "1 AS ord", "2 AS h", "3 AS n", "'t' AS edited")
    got = check(spark, docs | {None: "last. one."}, I.fingerprints(df))
    assert got[5].fingerprint == got[7].fingerprint == got[9].fingerprint != got[4].fingerprint
    assert got[1].fingerprint == got[2].fingerprint


def test_failed_sketches_are_retried(spark, monkeypatch):
    monkeypatch.setattr(I, "CELLS_EACH", 0.9)  # too small to peel
    monkeypatch.setattr(I, "LEAST", 2)
    check(spark, texts(12), I.fingerprints(docs_of(spark, texts(12))))


def test_recovered_digests(spark):
    rows = [(1, [1, 2, 3, 4], [3, 4, 5]), (2, [], [7]), (3, [8], [8]), (4, list(range(100, 160)), [])]
    df = spark.createDataFrame(rows, "k long, a array<long>, b array<long>").selectExpr("*", "CAST(NULL AS STRING) AS note")
    got = {r.k: r for r in I.peel(df, ["k"], keep_digests=True).collect()}
    assert set(got) == {1, 2, 4} and all(r.left == 0 for r in got.values())
    assert sorted(got[1].gone_digests) == [1, 2] and got[1].come_digests == [5]
    assert got[2].come_digests == [7] and sorted(got[4].gone_digests) == list(range(100, 160))


def test_order_wraps_over_partitions(spark):
    ids = [5, 1, 9, 7, 3, 2**40, -4]
    source = I.documents(docs_of(spark, {i: f"t{i}" for i in ids}), "doc_id", "text")
    got = {r.ord: r.p_ord for r in I.neighbours(source).collect()}
    ids.sort()
    assert got == {b: a for a, b in zip([ids[-1], *ids], ids)}


def test_single_and_empty(spark):
    (r,) = I.fingerprints(docs_of(spark, ["One. Two. Three. Four."])).collect()
    assert r.near_next == 1.0 and 0 < r.near_edited < 1
    assert I.fingerprints(empty_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    df = docs_of(spark, texts(5))
    pairs = I._pairs(I.versions(s := I.documents(df, "doc_id", "text"), I.neighbours(s), 4), True)
    plan = I.peel(pairs, [*I.KEY, "pair"]).select(F.sum("gone"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_long_texts_without_sentence_ends(spark):
    rnd = random.Random(5)
    flow = lambda: " ".join(f"w{rnd.randint(0, 9999)}" for _ in range(2000))
    signs = lambda end: "".join(chr(rnd.randint(0x4E00, 0x9FFF)) + end * (k % 15 == 14) for k in range(3000))
    letters = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4000))
    docs = {0: flow(), 1: flow(), 2: signs(""), 3: signs(""), 4: signs("。"), 5: signs("。"), 6: letters(), 7: letters()}
    got = {r.doc_id: r for r in I.fingerprints(docs_of(spark, docs)).collect()}
    for i in (0, 2, 4, 6):  # three quarters are kept, one is the successor's: 0.6 of either's paragraphs
        assert 0.4 < got[i].near_edited < 0.75, (i, got[i].near_edited)
    assert got[0].near_next < 0.05 and got[2].near_next < 0.05
    assert got[0].fingerprint != got[1].fingerprint


def test_counts_of_many_paragraphs(spark):
    found = F.sequence(F.lit(1).cast("long"), F.lit(70_000).cast("long"))
    text = spark.range(1).select(I.fingerprint(found, base=1).alias("f")).first().f
    cells = [text[i : i + 40] for i in range(0, len(text), 40)]
    assert len(cells) == 3 and sum(int(c[:8], 16) for c in cells) == 3 * 70_000


def test_one_row_per_row_and_the_greatest_id(spark):
    last = 2**63 - 1
    docs = {1: "One. Two.", last: "Three. Four.", None: "Five. Six."}
    df = docs_of(spark, docs)
    got = I.fingerprints(df.union(df).union(df.where("doc_id = 1"))).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(["1"] * 3 + [str(last)] * 2 + ["None"] * 2)
    check(spark, docs, I.fingerprints(df))
    same = docs_of(spark, {last: "Seven.", None: "Seven.", 3: "Eight."})  # equal texts, the two greatest
    assert {r.doc_id: r.near_next for r in I.fingerprints(same).collect()} == {3: 0.0, last: 1.0, None: 0.0}


def test_a_sketch_too_small_is_tried_again(spark, monkeypatch):
    """With the parameters of production: paragraphs with the smallest digests are shared, so next
    to nothing seems to differ, and the returned sketches don't peel."""
    told = spark.range(4000).selectExpr("concat('p', id) AS p").selectExpr("p", "xxhash64(p) AS d").orderBy("d").collect()
    shared, rest = [r.p for r in told[: I.NEAREST + 2]], [r.p for r in told[I.NEAREST + 2 :]]
    docs = {1: "\n".join(shared + rest[:400]), 2: "\n".join(shared + rest[400:900]), 3: "\n".join(shared)}
    tried = []
    peel = I.peel

    def counted(*args, **options):
        tried.append(options.get("grow", 1))
        return peel(*args, **options)

    monkeypatch.setattr(I, "peel", counted)
    check(spark, docs, I.fingerprints(docs_of(spark, docs)))
    assert tried[0] == 1 and len(tried) > 1


def test_near_texts_are_compared_by_the_returned_sketches(spark):
    """A width of BASE and the same hashes: the cells of the first try are those of the strings."""
    rows = [(1, list(range(1, 60)), [*range(1, 58), 100])]
    df = spark.createDataFrame(rows, "k long, a array<long>, b array<long>").selectExpr("*", "CAST(NULL AS STRING) AS note")
    (r,) = I.peel(df, ["k"], keep_digests=True).collect()
    assert r.left == 0 and sorted(r.gone_digests) == [58, 59] and r.come_digests == [100]
    told = df.select(I.fingerprint(F.col("a")).alias("x"), I.fingerprint(F.col("b")).alias("y")).first()
    cells = lambda t: [(int(t[i : i + 8], 16), int(t[i + 8 : i + 24], 16)) for i in range(0, len(t), 40)]
    differ = {i for i, (c, d) in enumerate(zip(cells(told.x), cells(told.y))) if c != d}
    where = df.select(F.array(*[I.slot(F.lit(v).cast("long"), t, F.lit(I.BASE).cast("long"), 0) for v in (58, 59, 100) for t in range(3)]).alias("s"))
    assert differ <= set(where.first().s)
