from __future__ import annotations

import random
import re
import sys
import time

from gridlake.llm import decontaminate as D
from tests.llm.helpers import docs_of, empty_docs, lower, rows_by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window):
    w = WORD.findall(lower(text))
    hit, found = set(), set()
    for item_id, t in items:
        p = WORD.findall(lower(t))
        m = min(window, len(p))
        grams = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)} if m else set()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i : i + m]) in grams:
                hit.update(range(i, i + m))
                found.add(item_id)
    return len(w), len(hit), sorted(found, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_search_equals_brute_force_on_random_texts():
    rnd = random.Random(5)
    vocabulary = ["a", "b", "cé", "D4"]
    for _ in range(200):
        items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 9)))) for k in range(rnd.randint(0, 5))]
        text = ", ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60)))
        for window in (1, 2, 4):
            w = D.item_words(text)
            spans, found = D.search(w, D.build_tables(items, window))
            merged = D.merge(spans)
            got = len(w), sum(e - s for s, e in merged), sorted(found, key=str)
            assert got == brute(text, items, window)


def test_edge_cases_passes_and_ties(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(1, passage), (2, passage), (10, "Short one!"), (3, None), (4, " -- "), (None, "null id item words")]
    texts = {
        0: None,
        1: "",
        2: "x " + passage.upper() + " y",
        3: "SHORT, one",
        4: "short two one",
        5: "long " * 50_000 + passage,
        6: " ".join(passage.split()[:12]),
        7: "null-id item.words",
    }
    docs = docs_of(spark, texts)
    docs = docs.union(docs.where("doc_id = 2")).selectExpr("*", "'x' AS n_words", "1 AS items")
    for pass_bytes in (D.PASS_BYTES, 60):
        found = D.decisions(D.hits(docs, bench(spark, items), pass_bytes=pass_bytes)).collect()
        assert len(found) == 9
        for r in found:
            n, hit, ids = brute(texts[r.doc_id], items, D.WINDOW)
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0 and 20 * hit >= n)


def test_empty_tables(spark):
    some = bench(spark, [(1, "a b")])
    assert D.decisions(D.hits(empty_docs(spark), some)).count() == 0
    none = rows_by_id(D.decisions(D.hits(docs_of(spark, ["a b", None]), some.limit(0))))
    assert [(r.n_hit, r.contaminated) for r in none.values()] == [(0, False), (0, False)]


def zipf_items(rnd, n_bytes):
    vocabulary = [f"w{i}" for i in range(20_000)]
    weights = [1 / (i + 1) for i in range(20_000)]
    n_words = n_bytes // 5
    drawn = rnd.choices(vocabulary, weights, k=n_words)
    return [(i, " ".join(drawn[i * 100 : i * 100 + 100])) for i in range(n_words // 100)]


def size_of(tables):
    numbers, ids, searches = tables
    own = sum(sys.getsizeof(x) for s in searches for x in (s.shift, s.offsets, s.hashes, s.starts, s.items))
    words = sys.getsizeof(numbers) + sum(sys.getsizeof(k) + 32 for k in numbers)
    return own + words + sum(sys.getsizeof(s.stream) for s in searches[:1])


def test_search_time_and_memory_grow_with_neither_buckets_nor_formulas():
    rnd = random.Random(9)
    text = [w.encode() for _, t in zipf_items(rnd, 400_000) for w in t.split()]
    took = {}
    for n_bytes in (100_000, 3_000_000):
        items = zipf_items(rnd, n_bytes)
        items += [(-i, "all of these items begin and end with the same words " + t + " end of item") for i, t in items[:500]]
        tables = D.build_tables(items, D.WINDOW)
        assert size_of(tables) < 12 * sum(len(t) for _, t in items) + 2_000_000
        began = time.perf_counter()
        spans, _ = D.search(text, tables)
        took[n_bytes] = time.perf_counter() - began
    assert took[3_000_000] < 5 * took[100_000] + 0.5


def test_formula_of_many_items():
    formula = " ".join(f"f{i}" for i in range(13))
    items = [(i, f"x{i} {formula} y{i}") for i in range(300)] + [(i, formula) for i in range(300, 600)]
    w = D.item_words(f"a {formula} b " * 50)
    spans, found = D.search(w, D.build_tables(items))
    assert len(spans) == 50 and found == set(range(600))
