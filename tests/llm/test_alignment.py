from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import alignment as A
from gridlake.llm import queries as Q
from gridlake.llm import vocabulary as V
from tests.llm.helpers import docs_of, empty_docs


@pytest.fixture(scope="module")
def sides():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(A.VOCABULARY_A)
    own.encode_special_tokens = True
    return A.ByteLevel(A.VOCABULARY_A), A.Pieces(A.VOCABULARY_B), own


def one(sides, text):
    """(ids of A and B, groups, link id pairs) of a text by plain loops; None: no tokens."""
    if not text:
        return None
    a, b, own = sides
    x, y = own.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    raw = (" " + text).encode()
    if b"".join(a.spell[i] for i in x) != raw or b"".join(b.spell[i] for i in y) != raw:
        return None
    spans = []
    for side, ids in ((a, x), (b, y)):
        at, found = 0, []
        for i in ids:
            found.append((at, at + len(side.spell[i])))
            at = found[-1][1]
        spans.append(found)
    links, j = [], 0
    for i, (s, e) in enumerate(spans[0]):
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(y) and spans[1][k][0] < e:
            links.append((x[i], y[k]))
            k += 1
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for c in cuts:
        pick = lambda ids, found: [str(t) for t, (s, e) in zip(ids, found) if s >= start and e <= c]  # noqa: B023, E731
        groups.append(",".join(pick(x, spans[0])) + "|" + ",".join(pick(y, spans[1])))
        start = c
    return x, y, groups, links


def brute(sides, docs):
    found = {i: one(sides, t) for i, t in docs.items()}
    held = Counter(p for f in found.values() if f for p in set(f[3]))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = {}
    for i, f in found.items():
        if f is None:
            out[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        x, y, groups, links = f
        best = sum(held[p] == top[p[0]] for p in links)
        out[i] = (len(x), len(y), len(groups), len(links), best, sum(held[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest())
    return out


def texts(n=60):
    rnd = random.Random(3)
    words = ["the", "naïve", "Straße", "日本語", "don't", "x" * 30, "<|endoftext|>", "<s>", "</s>", "1234567", "\n\n", "  ", "\t", "🙂", "\r\n", "á", "\x00", "Über"]
    docs = {3 * i + 1: " ".join(rnd.choices(words + ["and", "price", "of"] * 8, k=rnd.randint(0, 40))) for i in range(n)}
    return docs | {1000: None, 1001: "", 1002: " ", 1003: "a▁b", 1004: "▁", 1005: docs[4], 1006: docs[4], 1007: "<unk>", 1008: "x" * 3000}


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def op12(spark, docs, scratch):
    docs.write.parquet(f"{scratch}/documents.parquet")
    return Q.queries()["op12_token_alignment"](spark, scratch)


def test_query_against_loops(spark, sides, scratch, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_CHARS", 700)  # several chunks a task
    docs = texts()
    df = docs_of(spark, docs).selectExpr("*", "1 AS n_a", "2 AS chunk", "'g' AS groups", "3 AS pair")
    found = op12(spark, df, scratch)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    want = brute(sides, docs)
    assert {i for i in docs if want[i][0] == 0} == {1000, 1001, 1003, 1004} | {i for i, t in docs.items() if t == ""}
    assert got == want


def test_long_texts_in_pieces(spark, sides, monkeypatch):
    monkeypatch.setattr(V, "PIECE_CHARS", 150)
    monkeypatch.setattr(A, "BATCH_CHARS", 1000)
    rnd = random.Random(8)
    words = ["und", "the", "Preis", "it's", "two  spaces", "e\n", "日本", "Q1", "so,", "tab\tx", " lead"]
    docs = {i: " ".join(rnd.choices(words, k=400)) for i in range(5)} | {7: "nocut" * 200, 8: "fine words " * 50 + "▁" + " more words" * 50}
    assert len(A.pieces_of(docs[0])) > 5
    want = brute(sides, docs)
    got = {r.doc_id: r for r in A.align(docs_of(spark, docs)).collect()}
    assert want[8][0] == 0 and set(got) == set(docs)
    for i, r in got.items():
        digest = hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, digest) == want[i], i


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = docs_of(spark, {1: "one two", 2: "one three"})
    df = df.union(df).union(df.selectExpr("CAST(NULL AS BIGINT)", "text", "lang", "source", "n_chars"))
    got = A.align(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "2", "None", "None"]
    assert {r.count_sum for r in got if r.doc_id is not None} >= {r.count_sum for r in got if r.doc_id is None}
    assert A.align(empty_docs(spark)).count() == 0
    assert A.align(docs_of(spark, [None, ""])).agg(F.sum("count_sum")).first()[0] == 0


def test_row_products_are_matrix_products():
    rnd = np.random.default_rng(5)
    for _ in range(20):
        a, b = (rnd.random((7, 9)) < 0.3).astype(int), (rnd.random((6, 9)) < 0.3).astype(int)

        def rows(m):
            return np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1]

        row, column, value = A.row_products(rows(a), A.transposed(*rows(b), 9))
        dense = np.zeros((7, 6), int)
        dense[row, column] = value
        assert (dense == a @ b.T).all() and len(row) == (dense > 0).sum()


def test_links_of_both_kinds(spark, sides):
    docs = {1: "Strompreise naïve 日本語", 2: None, 3: "a"}
    want = {i: one(sides, t) for i, t in docs.items() if t}
    over = A.links(docs_of(spark, docs)).collect()
    for i, (x, y, groups, pairs) in want.items():
        mine = sorted((r for r in over if r.doc_id == i), key=lambda r: (r.a, r.b))
        assert [(r.a_id, r.b_id) for r in mine] == pairs and sum(r.shared_bytes for r in mine) == len((" " + docs[i]).encode())
    shared = A.links(docs_of(spark, docs), shared_groups=True).collect()
    for i, (x, y, groups, pairs) in want.items():
        n = sum(len(g.split("|")[0].split(",")) * len(g.split("|")[1].split(",")) for g in groups)
        assert sum(r.doc_id == i for r in shared) == n
    got = {r.doc_id: r.n_shared for r in A.align(docs_of(spark, docs)).collect()}
    assert got == {i: sum(r.doc_id == i for r in shared) for i in docs}


def test_shared_group_links_are_made_by_products_in_blocks(sides, monkeypatch):
    rnd = np.random.default_rng(6)
    a_group, b_group = (np.sort(np.concatenate([np.arange(5), rnd.integers(0, 5, n)])) for n in (40, 60))
    made, product = [], A.row_products
    monkeypatch.setattr(A, "row_products", lambda a, b: made.append(product(a, b)) or made[-1])
    monkeypatch.setattr(A, "LINKS_AT_A_TIME", 70)
    blocks = list(A.shared_group_links(a_group, b_group))
    got = [(i, j) for row, column in blocks for i, j in zip(row.tolist(), column.tolist())]
    assert got == [(i, j) for i in range(45) for j in range(65) if a_group[i] == b_group[j]]
    assert 1 < len(blocks) == len(made) < 45 and max(len(row) for row, _ in blocks) <= 70
    none = np.zeros(0, np.int64)
    assert list(A.shared_group_links(none, none)) == []
    # A document's number is the products' entries.
    made.clear()
    monkeypatch.setattr(A, "LINKS_AT_A_TIME", 20)
    found = A._Batch(*sides[:2]).run([" Strompreise naïve 日本語", " a", " x" * 30])
    assert sum(f.numbers[4] for f in found) == sum(len(row) for row, _, _ in made[:-1])
    assert len(made) > 2 and sum(f.numbers[3] for f in found) == len(made[-1][0])


def test_rank_encoder_equals_the_files_own(sides):
    a, _, own = sides
    assert a.ranks
    rnd = random.Random(1)
    bits = ["a", "b", " ", "'", "s", "é", "日", "\n", "1", "!", "the", "ing", "\x85", "\x1c", "🙂", "'ll", "<|endoftext|>", "x" * 700]
    found = ["".join(rnd.choices(bits, k=rnd.randint(1, 60))) for _ in range(5000)]
    assert a.encode(found) == [e.ids for e in own.encode_batch(found, add_special_tokens=False)]
