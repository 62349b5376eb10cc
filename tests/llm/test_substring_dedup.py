from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from gridlake.llm import common as C
from gridlake.llm import substring_dedup as S
from tests.llm.helpers import docs_of, empty_docs, rows_by_id, words


def brute(docs, window):
    """doc_id -> (words, removed places): all windows, judged on the input."""
    first, gone = {}, {}
    for i in sorted(docs, key=lambda k: (k is None, k)):
        w = words(docs[i])
        gone[i] = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if first.setdefault(key, (i, s)) != (i, s):
                gone[i].update(range(s, s + window))
    return {i: ([x for k, x in enumerate(words(t)) if k not in gone[i]], len(gone[i])) for i, t in docs.items()}


def check(spark, docs, **options):
    found = rows_by_id(S.factors(docs_of(spark, docs), **options))
    want = brute(docs, options.get("window", S.WINDOW))
    for i, t in docs.items():
        kept, removed = want[i]
        assert words(found[i].kept_text) == kept, i
        assert sum(e - s for s, e in zip(found[i].starts, found[i].ends)) == removed
        assert found[i].n_words == len(words(t))
        if not removed:
            assert found[i].kept_text == t


def test_random_texts_of_few_words_in_many_blocks(spark):
    rnd = random.Random(3)
    docs = {i: " ".join(rnd.choices("abc", k=rnd.randint(0, 80))) for i in range(0, 120, 2)}
    check(spark, docs, window=8, gram=4, block_bytes=400)
    check(spark, docs, window=8, gram=4)


def test_repeated_passages_copies_and_runs(spark):
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    noise = lambda n: " ".join(str(rnd.random()) for _ in range(n))
    docs = {
        0: None, 1: "", 2: noise(30) + "\n" + passage + "  " + noise(30), 3: passage, 4: noise(5) + " " + passage[:-20],
        5: "same " * 300, 6: "same " * 25, 7: noise(4000), 8: passage + " " + passage, 9: "  " + passage + "\ttail end",
        None: passage + " more",
    }
    docs |= {20 + i: docs[2] for i in range(6)}
    check(spark, docs, block_bytes=3000)
    check(spark, docs)


def test_repeated_rows_extra_columns_and_empty(spark):
    docs = docs_of(spark, {1: "w " * 10, 2: " ".join(f"w{i}" for i in range(40))})
    twice = docs.union(docs).selectExpr("*", "1 AS block", "2 AS ord", "'k' AS kept_text")
    rows = S.factors(twice).collect()
    assert len(rows) == 4 and all(not r.starts for r in rows)
    assert S.factors(empty_docs(spark)).count() == 0


def test_leftmost_min():
    g = np.array([5, 3, 3, 9, 1, 7, 1, 1, 8], np.uint64)
    for width in range(1, 8):
        want = [i + int(np.argmin(g[i : i + width])) for i in range(len(g) - width + 1)]
        assert S._leftmost_min(g, width).tolist() == want


def test_windows_of_one_anchor_that_share_32_bits_of_hash(spark):
    rnd = random.Random(6)
    phrases = [" ".join(f"{rnd.random()}" for _ in range(8)) for _ in range(3000)]
    phrase = phrases[int(S.Windows([S.word_hashes(p) for p in phrases], 8, 8).anchor.argmin())]
    tails = rnd.choices([f"t{i}" for i in range(5000)], k=12 * 150_000)
    texts = [phrase + " " + " ".join(tails[12 * i : 12 * i + 12]) for i in range(150_000)]
    w = S.Windows([S.word_hashes(t) for t in texts], 20, 8)
    low = w.hashes().astype(np.uint64) & np.uint64(2**32 - 1)
    order = np.lexsort((low, w.anchor))
    same = (low[order][1:] == low[order][:-1]) & (w.anchor[order][1:] == w.anchor[order][:-1])
    pairs = [(w.doc[a], w.doc[b]) for a, b in zip(order[:-1][same], order[1:][same])]
    pairs = [(a, b) for a, b in pairs if texts[a] != texts[b]]
    assert pairs
    # Documents of the same anchor and 32 bits of hash, which have no 20 words in common.
    docs = {i: texts[k] for i, k in enumerate(sorted({k for p in pairs for k in p}))}
    check(spark, docs)
    check(spark, docs, block_bytes=300)


def test_hot_anchors_and_rows_without_an_id(spark):
    rnd = random.Random(8)
    phrase = [f"h{i}" for i in range(8)]
    texts = [" ".join(rnd.choices("xyz", k=rnd.randint(0, 6)) + phrase * 2 + rnd.choices("xyz", k=14)) for _ in range(150)]
    docs = dict(enumerate(texts))
    for block_bytes in (600, C.BLOCK_BYTES):
        check(spark, docs, window=10, gram=4, block_bytes=block_bytes, hot_anchor=2)
        check(spark, docs, window=10, gram=4, block_bytes=block_bytes, hot_anchor=10**9)
    rows = spark.createDataFrame([(None, t) for t in texts] + [(None, texts[0])], "doc_id long, text string")
    found = S.factors(rows, window=10, gram=4, block_bytes=600, keep=["text"])
    ties = {r.text: r.tie for r in rows.select("text", F.xxhash64("text").alias("tie")).collect()}
    order = sorted(ties, key=ties.get)
    want = dict(zip(order, brute(dict(enumerate(order)), 10).values()))
    got = found.collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert words(r.kept_text) == want[r.rest.text][0]


def test_rows_without_an_id_are_dealt_over_the_blocks(spark):
    rows = spark.range(20_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "CONCAT('text ', id) AS text")
    per = rows.groupBy(C.block_of(F.col("doc_id"), 64, F.col("text")).alias("b")).count().collect()
    assert len(per) == 64 and max(r["count"] for r in per) < 2 * 20_000 / 64
