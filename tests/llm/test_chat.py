from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import chat as H
from gridlake.llm import queries as Q
from gridlake.llm import vocabulary as V

SCHEMA = "conv_id long, turn long, role string, text string"
SAID = r"\### Assistant: </turn> ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for i in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == i), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).digest()))
        said = [t or "" for _, _, r, t in mine if r == "assistant"]
        formatted = sum(len(H.TURN + H.escape(r or "") + H.SAYS + H.escape(t or "") + H.END) for _, _, r, t in mine)
        out[i] = (len(mine), sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in mine)), len("".join(said)), sha("".join(said)), formatted)
    return out


def result(found):
    return {r.conv_id: tuple(r)[1:] for r in found.collect()}


def rows_of(n=40):
    rnd = random.Random(2)
    bits = ["hello", "</turn>", "<turn>", "<says>", "\\", "\\\\", "<\\turn>", "<", "<<turn>", "naïve 日本語 🙂", "\n", "<|endoftext|>", "assistant", " ", "</turn", "\x00"]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "tool<says>"]), "".join(rnd.choices(bits, k=rnd.randint(0, 12)))))
    return rows + [(100, 0, "user", None), (100, 1, "assistant", None), (101, None, None, "x"), (None, 1, "assistant", "a"), (None, 0, "user", "b")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_escapes_are_reversible():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choices(["<", "turn>", "/", "says>", "\\", "a", "</turn>", "<turn>", "\n"], k=rnd.randint(0, 12)))
        told = H.escape(text)
        assert H.unescape(told) == text and not any(c in told for c in (H.TURN, H.SAYS, H.END))


def test_query_against_loops(spark, scratch):
    rows = rows_of()
    random.Random(4).shuffle(rows)
    frame(spark, rows).selectExpr("*", "1 AS piece", "2 AS ids").write.parquet(f"{scratch}/conversations.parquet")
    got = result(Q.queries()["op13_chat_formatting"](spark, scratch))
    assert got == brute([*rows, (-7, 0, "user", SAID), (-7, 1, "assistant", SAID)])


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_any_piece_size_reads_back(spark, piece, monkeypatch):
    monkeypatch.setattr(V, "PIECE_CHARS", 40)
    rows = rows_of(12) + [(200, t, "assistant" if t % 2 else "user", "some words to cut " * 20) for t in range(6)]
    written = H.write(frame(spark, rows), piece=piece)
    assert written.agg(F.max(F.size("ids"))).first()[0] <= piece
    assert result(H.read(written)) == brute(rows)
    back = [(r.conv_id, r.turn, r.role, r.text) for r in H.turns(written).collect()]
    assert result(H.read(H.write(frame(spark, back)))) == brute(rows)


def test_one_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </turn>") for t in range(1200)] + [(2, 0, "user", "u")]
        assert result(H.read(H.write(frame(spark, rows), piece=100))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ties_repeats_and_no_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "assistant", "c")]
    for k in range(3):
        again = rows[k:] + rows[:k]
        assert result(H.read(H.write(frame(spark, again)))) == brute(rows)
    assert H.read(H.write(frame(spark, []))).count() == 0


def test_masks_and_reserved_ids():
    t = H.Template()
    (r1, r2), texts = t.encode(["user", "assistant"]), t.encode([SAID, SAID])
    ids, mask = H.assemble(t, [r1, r2], texts, [False, True])
    assert (ids >= t.turn).sum() == 6 and ids[0] == t.turn and ids[-1] == t.end
    told = b"".join(t.spell[i] for i in ids[mask]).decode()
    assert H.unescape(told) == SAID and H.END not in told
    assert mask.sum() == len(texts[1]) and not mask[: len(r1) + len(texts[0]) + 3].any()
    long = "good words here " * 5000
    whole = t.encode([long])[0]
    V.PIECE_CHARS, kept = 1000, V.PIECE_CHARS
    try:
        assert len(V.pieces_of(long)) > 10 and t.encode([long])[0] == whole
    finally:
        V.PIECE_CHARS = kept
    assert np.array_equal(H.assemble(t, [[]], [[]], [True])[1], [False] * 3)
