from __future__ import annotations

import math
import random

import numpy as np
import pytest

from gridlake.llm import queries as Q
from gridlake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(rows, use_counts=False):
    """x per kept row, and n, S, mean, covariance over the fit list."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in kept]
    fit = [v for _, v in x] if use_counts else sorted({v for _, v in x})
    a = np.array(fit, float)
    return x, len(fit), [sum(c) for c in zip(*fit)], np.cov(a, rowvar=False, bias=True)


def check(rows, found, use_counts=False, k=4):
    x, n, s, v = brute(rows, use_counts)
    got = sorted(found.collect(), key=lambda r: (r.vec_id is None, r.vec_id, r.whitened))
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in x)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    by_id = {}
    for i, vec in x:
        by_id.setdefault(i, vec)
    xs, ws = [], []
    for r in got:
        vec = by_id[r.vec_id]
        assert r.n == n and r.deviation == sum((n * c - t) ** 2 for c, t in zip(vec, s))
        assert r.explained == pytest.approx([e / values.sum() for e in values[:k]], rel=1e-9)
        assert r.identity_error < 1e-9
        xs.append(vec), ws.append(r.whitened)
    # What was projected on has the covariance's eigenvalues and is of unit length.
    centred = np.array(xs, float) - np.array(s) / n
    basis = np.linalg.lstsq(centred, np.array(ws) * np.sqrt(values[:k]), rcond=None)[0]
    if np.linalg.matrix_rank(centred) == centred.shape[1]:
        assert np.allclose(v @ basis, basis * values[:k], atol=1e-7 * values[0])
        assert np.allclose((basis**2).sum(axis=0), 1)


def cloud(n=200, d=6, seed=1):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0, 1 + 0.4 * k) + (rnd.random() if k else 0) for k in range(d)]) for i in range(n)]


def test_against_numpy(spark):
    rows = cloud()
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(5000, [c + 1e-7 for c in rows[4][1]])]
    check(rows, W.whiten(vectors(spark, rows), components=4))
    check(rows, W.whiten(vectors(spark, rows), components=4, use_counts=True), use_counts=True)


def test_bad_rows_go_and_odd_ids_stay(spark):
    rows = cloud(60)
    bad = [(900, None), (901, [None] * 6), (902, [float("nan")] * 6), (903, [1.0, 2.0, float("inf"), 0.0, 0.0, 0.0])]
    rows[5] = (None, rows[5][1])
    df = vectors(spark, rows + bad + [(904, [1.0, 2.0]), (905, [])]).selectExpr("*", "1 AS x", "2 AS h", "3 AS n", "4 AS salt", "5 AS count")
    check(rows, W.whiten(df, components=4))
    twice = vectors(spark, rows + rows[:3])
    assert W.whiten(twice, components=2).count() == 63


def test_hot_vectors_are_salted(spark, monkeypatch):
    monkeypatch.setattr(W, "HOT_ROWS", 20)
    rows = cloud(50)
    rows += [(1000 + i, rows[3][1]) for i in range(300)]
    check(rows, W.whiten(vectors(spark, rows), components=4))


def test_no_variance_or_no_rows(spark):
    assert W.whiten(vectors(spark, [])).count() == 0
    assert W.whiten(vectors(spark, [(1, []), (2, [])])).count() == 0
    assert W.whiten(vectors(spark, [(1, None)])).count() == 0
    assert W.whiten(vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    line = [(i, [i / 8, i / 4, 0.0]) for i in range(20)]  # one direction only
    assert {len(r.whitened) for r in W.whiten(vectors(spark, line), components=4).collect()} == {1}


def test_long_and_huge_entries(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, -1.0])]
    got = {r.vec_id: r for r in W.whiten(vectors(spark, rows)).collect()}
    assert set(got) == {1, 2, 3} and got[1].deviation is None
    wide = [(i, [random.Random(i * 700 + k).random() for k in range(700)]) for i in range(30)]
    (first, *_) = W.whiten(vectors(spark, wide)).collect()
    assert first.n == 30 and len(first.whitened) == 29 and first.identity_error < 1e-9


def test_query(spark, scratch):
    rows = cloud(80, 5)
    vectors(spark, rows).write.parquet(f"{scratch}/embeddings.parquet")
    found = Q.queries()["op11_embedding_whitening"](spark, scratch)
    assert found.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"),
        ("identity_error", "double"),
    ]
    got = found.collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c) for i in range(80) for c in (1, 2, 3, 4)]
    x, n, s, v = brute(rows)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    for c in (1, 2, 3, 4):
        w = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == c])
        assert w.mean() == pytest.approx(0, abs=1e-9) and (w**2).mean() == pytest.approx(1)
        assert {round(r.explained, 12) for r in got if r.component == c} == {round(values[c - 1] / values.sum(), 12)}
