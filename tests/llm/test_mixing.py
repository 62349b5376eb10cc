from __future__ import annotations

import math
from collections import defaultdict

import pytest

from gridlake.llm import mixing as M
from tests.llm.helpers import DOC_SCHEMA, empty_docs

SIZES = {"a": 400, "b": 100, "c": 20, None: 10}


def documents(spark):
    rows, i = [], 0
    for source, n in SIZES.items():
        for k in range(n):
            rows.append((i, "w " * (1 + (k * 7) % 13), "en", source, 0))
            i += 1
    return spark.createDataFrame(rows, DOC_SCHEMA), rows


def tokens(rows):
    t = defaultdict(int)
    for r in rows:
        t[r[3]] += len(r[1].split())
    return t


def brute_exponent(p, within):
    low, high = 0.0, 16.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if within(mid) else (mid, high)
    return high


def test_entropy_target(spark):
    docs, rows = documents(spark)
    t = tokens(rows)
    p = [x / sum(t.values()) for x in t.values()]

    def entropy(a):
        w = [x**a for x in p]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    want = brute_exponent(p, lambda a: entropy(a) <= 0.8 * math.log(len(p)))
    per = M.budgets(M.source_tokens(docs, "doc_id", "text", "source"), target_entropy=0.8).collect()
    weights = {None if r.no_src else r.src: r.weight for r in per}
    z = sum(x**want for x in p)
    for s, x in zip(t, p):
        assert weights[s] == pytest.approx(x**want / z, rel=1e-6)


def test_repeat_limit_and_realised_mixture(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)
    docs, rows = documents(spark)
    t = tokens(rows)
    found = M.mix(docs, max_repeats=3.0, block_tokens=500).collect()
    times = defaultdict(lambda: defaultdict(int))
    got = defaultdict(int)
    for r in found:
        times[r.source][r.doc_id] += 1
        got[r.source] += r.n_tokens
    biggest = max(t, key=t.get)
    alpha = 1 - math.log(3) / math.log(max(t.values()) / min(t.values()))
    for s, n in SIZES.items():
        assert len(times[s]) == n  # nothing is dropped
        budget = t[biggest] * (t[s] / t[biggest]) ** alpha
        assert budget - 1 <= got[s] < budget + 14  # a document starts within the budget
        assert max(times[s].values()) - min(times[s].values()) <= 1
    # Blocks are permutations: positions without gaps, each block near the mixture.
    blocks = defaultdict(list)
    for r in found:
        blocks[r.block].append(r)
    for b in blocks.values():
        assert sorted(r.position for r in b) == list(range(len(b)))
    share = got["a"] / sum(got.values())
    for b in blocks.values():
        n = sum(r.n_tokens for r in b)
        assert abs(sum(r.n_tokens for r in b if r.source == "a") / n - share) < 0.1
    again = M.mix(docs.repartition(7), max_repeats=3.0, block_tokens=500).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)


def test_budget_and_edges(spark):
    docs, rows = documents(spark)
    half = sum(tokens(rows).values()) // 2
    n = sum(r.n_tokens for r in M.mix(docs, budget_tokens=half).collect())
    assert half <= n <= half + 13 * len(SIZES)
    assert M.mix(empty_docs(spark), max_repeats=2.0).count() == 0
    odd = spark.createDataFrame(
        [(1, None, None, "x", None), (2, "", None, "x", None), (None, "a b", None, None, None), (3, "a " * 90_000, None, "y", 1), (3, "b", None, "y", 1)],
        DOC_SCHEMA,
    ).selectExpr("*", "1 AS u", "2 AS pass", "3 AS block", "4 AS tokens")
    got = M.mix(odd, max_repeats=1.0).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 0), (2, 0), (3, 1), (3, 90_000)]


def test_rows_that_share_an_id_or_have_none(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 8)
    rows = [(None, f"text {i} " + "w " * (i % 5), "en", "a", 0) for i in range(60)]
    rows += [(7, f"other {i}", "en", "b", 0) for i in range(9)] + [(8, "same", "en", "b", 0)] * 3
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = M.mix(docs, max_repeats=1.0, block_tokens=40).collect()
    assert len(found) == len(rows)
    places = [(r.block, r.position) for r in found]
    assert len(set(places)) == len(places)
    again = M.mix(docs.repartition(5), max_repeats=1.0, block_tokens=40).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)
