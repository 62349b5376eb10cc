"""LM scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts of 0 to ``ORDER`` symbols, counted over the whole
training part of the corpus. A byte is predicted in its longest context; where the
context never had it, the escape probability is paid and the next shorter context is
asked, without the symbols that the longer one has already excluded (escape estimation
of PPM-D: with d symbols in t occurrences, an escape has d / 2t and a symbol seen c times
(2c - 1) / 2t). Below the empty context all symbols left are equally likely. A text is its
bytes (A-Z lowered) and an end symbol, so the probabilities of all texts sum to one.

A node of the trie is a gram: up to ORDER context symbols and one more, nine bits each.
All nodes of three symbols and more that end alike fall into one bucket by their last two
context symbols, so buckets are evaluated on their own; the levels above have at most
257 x 257 nodes, joined in as a bounded broadcast. Documents are hashed to blocks; a block
lists its distinct grams and words once, gets their code lengths and counts back, and scores
its texts with them. The lists are a table in the shared scratch folder, computed once; texts
travel compressed, once to be listed and once to be scored. Nothing that grows with the corpus
reaches the driver.

Defined cases: a null or empty text is the end symbol alone (one token); without training
texts every symbol is equally likely; repeated rows are learnt and scored as often as they
come; a null id hashes like the text ''; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common as C

ORDER = 5
BLOCK_BYTES = 24_000_000
BUCKETS = 1024
_BITS = 9
_EDGE = 256  # before the first byte, and the end symbol
_SYMBOLS = 257
#: In place of a gram: the row is a word's. The end token is a word no text can have.
_WORD = -1
END_TOKEN = " "
_SLICE = 1 << 20


def grams(text: bytes, order: int = ORDER):
    """The text's grams of order + 1 symbols, in slices of bounded size."""
    a = np.concatenate((np.full(order, _EDGE, np.int64), np.frombuffer(text, np.uint8), [_EDGE]))
    for at in range(0, len(a) - order, _SLICE):
        n = min(_SLICE, len(a) - order - at)
        g = np.zeros(n, np.int64)
        for j in range(order + 1):
            g <<= _BITS
            g |= a[at + j : at + j + n]
        yield g


def _packed(batches):
    """Texts in lower case, as UTF-8, compressed with their length in front."""
    for batch in batches:
        packed = []
        for text in batch.column("text").to_pylist():
            raw = text.encode("utf-8", "replace").lower() if text else b""
            packed.append(len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(packed, pa.binary()))


def _texts(column):
    for x in column:
        packed = x.as_py()
        yield pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


class _Counts:
    """Distinct values and their counts, merged as they come."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, values: np.ndarray, weight: int) -> None:
        self.parts.append((values, weight))
        self.size += len(values)
        if self.size > 1 << 22:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = [], []
        for weight in (0, 1):
            if mine := [v for v, w in self.parts if isinstance(w, int) and w == weight]:
                u, c = np.unique(np.concatenate(mine), return_counts=True)
                keys.append(u)
                n.append(c * weight)
        for v, w in self.parts:
            if not isinstance(w, int):
                keys.append(v)
                n.append(w)
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, inv, np.concatenate(n).astype(np.int64))
        self.parts, self.size = [(u, total)], 0
        return u, total


def _vocabulary(order: int):
    """A block's documents -> its distinct grams and words, with training counts."""

    def run(key, docs):
        counts, seen = _Counts(), {}
        for text, train in zip(_texts(docs.column("text")), docs.column("train").to_pylist()):
            for g in grams(text, order):
                counts.add(g, int(train))
            for w in text.split():
                seen[w] = seen.get(w, 0) + train
            seen[END_TOKEN.encode()] = seen.get(END_TOKEN.encode(), 0) + train
        g, n = counts.settle()
        w = pa.array(list(seen), pa.binary())
        m = len(g) + len(w)
        return pa.table(
            {
                "block": pa.array(np.full(m, key[0].as_py(), np.int32)),
                "gram": pa.array(np.concatenate((g, np.full(len(w), _WORD)))),
                "word": pa.chunked_array([pa.nulls(len(g), pa.binary()), w]),
                "n": pa.array(np.concatenate((n, np.fromiter(seen.values(), np.int64, len(w))))),
            }
        )

    return run


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """values of the wanted keys (sorted, distinct), 0 where absent."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, values, len(u)).astype(np.int64)


def code(gram, n, n1, t1, d1, a1, n0, t0, d0, order: int = ORDER) -> np.ndarray:
    """log10 probability of the last symbol of each gram after its context.

    ``gram``: distinct grams, with all that share their last two context symbols; ``n``:
    their training counts. n1, n0: counts of the gram's last two symbols and last symbol;
    t1, d1, a1: occurrences and distinct symbols after its last context symbol, and the
    occurrences of those symbols in any context; t0, d0: all occurrences and symbols."""

    def tail(k):  # of k symbols
        return gram & ((1 << _BITS * k) - 1)

    level = {}  # k -> (grams of k + 1 symbols, counts), (contexts, occurrences, symbols, excluded occurrences below)
    for k in range(order, 1, -1):
        have = n > 0
        u, c = _summed(tail(k + 1)[have], n[have])
        level[k] = u, c
    first = {}
    if 2 in level:
        u, at = np.unique(tail(3), return_index=True)
        first = u, n1[at]
    contexts = {}
    for k in range(2, order + 1):
        u, c = level[k]
        below = _find(*(first if k == 2 else level[k - 1]), u if k == 2 else u & ((1 << _BITS * k) - 1))
        ctx, inv = np.unique(u >> _BITS, return_inverse=True)
        contexts[k] = ctx, *(np.bincount(inv, x, len(ctx)).astype(np.int64) for x in (c, np.ones(len(u)), below))
    out, open_ = np.zeros(len(gram)), np.ones(len(gram), bool)
    gone_t, gone_d = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
    for k in range(order, -1, -1):
        if k >= 2:
            at = tail(k + 1)
            count, (ctx, t, d, a) = _find(*level[k], at), contexts[k]
            t, d, a = (_find(ctx, x, at >> _BITS) for x in (t, d, a))
        else:
            count, t, d, a = (n1, t1, d1, a1) if k else (n0, t0, d0, np.zeros(len(gram), np.int64))
        left_t, left_d = t - gone_t, d - gone_d
        asked = open_ & (left_d > 0)
        hit = asked & (count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.where(hit, out + np.log10((2 * count - 1) / (2 * left_t)), np.where(asked, out + np.log10(left_d / (2 * left_t)), out))
        open_ &= ~hit
        # Occurrences, in the next shorter context, of the symbols excluded there.
        gone_t, gone_d = np.where(d > 0, a, gone_t * 0), np.where(d > 0, d, 0)
    return np.where(open_, out - np.log10(np.maximum(1, _SYMBOLS - gone_d)), out)


_TRIE = ("n", "n1", "t1", "d1", "a1", "n0", "t0", "d0")


def _code(order: int):
    def run(table):
        columns = [table.column(c).to_numpy() for c in ("gram", *_TRIE)]
        return pa.table({"gram": pa.array(columns[0]), "value": pa.array(code(*columns, order=order))})

    return run


def _score(order: int, tokens: int, distinct: int):
    def run(key, docs, rows):
        gram, value = rows.column("gram").to_numpy(), rows.column("value").to_numpy()
        is_gram = gram >= 0
        by_gram = np.argsort(gram[is_gram])
        keys, codes = gram[is_gram][by_gram], value[is_gram][by_gram]
        words = rows.filter(pa.array(~is_gram)).column("word").to_pylist()
        counts = dict(zip(words, value[~is_gram].astype(np.int64).tolist()))
        del rows, words, gram, value, is_gram, by_gram
        norm = np.log10(tokens + distinct + 1)
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
        for text in _texts(docs.column("text")):
            w = [*text.split(), END_TOKEN.encode()]
            out["n_tokens"].append(len(w))
            c = np.fromiter(map(counts.__getitem__, w), np.int64, len(w))
            out["n_known"].append(int((c > 0).sum()))
            out["base_score"].append(float(np.log10(c + 1).sum() - len(w) * norm))
            # Sorted, neighbouring lookups share cache lines.
            out["score"].append(float(sum(codes[np.searchsorted(keys, np.sort(g))].sum() for g in grams(text, order))))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "train": docs.column("train"),
                "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "n_known": pa.array(out["n_known"], pa.int64()),
                "train_tokens": pa.array(np.full(len(docs), tokens, np.int64)),
                "base_score": pa.array(out["base_score"], pa.float64()),
                "score": pa.array(out["score"], pa.float64()),
            }
        )

    return run


def scores(
    docs: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, train, n_tokens (words and the end), n_known (tokens
    of the training part), train_tokens, base_score (add-one unigram words) and score
    (PPM), both log10 probabilities of the whole text. ``train``: which rows to learn from."""
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6: a gram is packed in 63 bits")
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    blocks = C.block_count(source, "text", block_bytes)
    C.bounded_batches(docs.sparkSession)
    named = source.withColumn("block", C.block_of(F.col("doc_id"), blocks, F.col("text")))
    placed = named.mapInArrow(_packed, "doc_id long, text binary, train boolean, block int")
    listed = C.cut(placed.groupBy("block").applyInArrow(_vocabulary(order), "block int, gram long, word binary, n long"), "ppm-lists")
    counted = C.cut(listed.groupBy("gram", "word").agg(F.sum("n").alias("n")), "ppm-counts")
    is_word = F.col("gram") == _WORD
    sums = counted.where(is_word).agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    trie = counted.where(~is_word).select("gram", "n")
    last, pair = (1 << _BITS) - 1, (1 << 2 * _BITS) - 1
    g1 = F.col("gram").bitwiseAND(F.lit(pair))
    after = Window.partitionBy("c1")
    ones = (
        trie.groupBy(g1.alias("g1"))
        .agg(F.sum("n").alias("n1"))
        .withColumn("c1", F.shiftright("g1", _BITS))
        .withColumn("s", F.col("g1").bitwiseAND(F.lit(last)))
    )
    everything = Window.partitionBy()  # at most 257 rows
    zeros = (
        ones.groupBy("s").agg(F.sum("n1").alias("n0"))
        .withColumn("t0", F.sum("n0").over(everything))
        .withColumn("d0", F.count(F.when(F.col("n0") > 0, 1)).over(everything))
    )
    high = (
        ones.join(F.broadcast(zeros), "s")  # 257 rows at most
        .withColumn("t1", F.sum("n1").over(after))
        .withColumn("d1", F.count(F.when(F.col("n1") > 0, 1)).over(after))
        .withColumn("a1", F.sum(F.when(F.col("n1") > 0, F.col("n0")).otherwise(0)).over(after))
        .select("g1", "n1", "t1", "d1", "a1", "n0", "t0", "d0")
    )
    nodes = (
        trie.withColumn("g1", g1)
        .join(F.broadcast(high), "g1")  # 257 x 257 rows at most
        .withColumn("bucket", F.pmod(F.xxhash64(F.shiftright("gram", _BITS).bitwiseAND(F.lit(pair))), F.lit(BUCKETS)))
        .select("gram", *_TRIE, "bucket")
    )
    codes = nodes.groupBy("bucket").applyInArrow(_code(order), "gram long, value double")
    by_gram = listed.where(~is_word).select("block", "gram").join(codes, "gram")
    known = counted.where(is_word).select("word", F.col("n").cast("double").alias("value"))
    by_word = listed.where(is_word).select("block", "gram", "word").join(known, "word")
    told = by_gram.select("block", "gram", F.lit(None).cast("binary").alias("word"), "value").unionByName(
        by_word.select("block", "gram", "word", "value")
    )
    return (
        placed.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(
            _score(order, int(sums[0] or 0), int(sums[1] or 0)),
            "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


C.ship(__name__)
