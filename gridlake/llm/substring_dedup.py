"""Substring dedup by relative Lempel-Ziv factors between blocks of the corpus.

Documents are hashed to blocks of bounded size. Every block is indexed by the
anchors of its texts: of the 13 grams of 8 words in a window of 20 words, the
smallest hash (the leftmost of equals), so equal windows have equal anchors at
equal offsets, and about one word in seven carries one. Anchors that occur
once in the corpus can't be part of a repeat. From each of the others, a block
parses its texts: the windows that hang on the anchor are looked up in the index
of all blocks, and windows with an earlier occurrence join into factors, at
least ``window`` words long. The windows that straddle the boundary of a factor
are looked up like the others, so a factor ends exactly where no earlier text
goes on. The words of all factors are removed.

Windows are told apart by 64 bits of hash of their own, whatever their anchor: of
n different windows on one anchor about n * n / 2^65 pairs count as equal (5 million:
one in a million). Equal windows of one block meet before the shuffle, so a passage that a third of all documents
share arrives once per block. Windows are dealt to the ranking by their anchor, and those of a
frequent anchor (``HOT_ANCHOR``) each by its own hash, so a common phrase is no hot key. Texts are shuffled once, by block, and both cogroups
read that exchange.

Defined cases: a null text has no words (kept_text stays null); texts shorter
than a window lose nothing; a null doc_id orders last; rows of one doc_id (or none) order
by the hash of their text, and rows equal in both are the same document (equal places
are neither earlier); columns named in ``keep``
ride along in ``rest``, others are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake.llm import common as C

WINDOW = 20
GRAM = 8
#: An anchor that the blocks' batches list this often is dealt window by window.
HOT_ANCHOR = 64
_LAST = 2**63 - 1
_A = np.uint64(0x9E3779B97F4A7C15)  # any odd multipliers: independent gram and window hashes
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_SPACED = re.compile(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*")


def word_hashes(text: str | None) -> np.ndarray:
    w = text.encode("utf-8", "replace").split() if text else []
    return np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))


def _rolling(h: np.ndarray, k: int, by: np.uint64) -> np.ndarray:
    """A hash of every run of ``k`` words."""
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        out *= by
        out += h[j : j + len(out)]
    out ^= out >> np.uint64(31)
    out *= _A
    out ^= out >> np.uint64(29)
    return out


def _leftmost_min(g: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the place of its smallest (leftmost)."""
    at, done = np.arange(len(g), dtype=np.int64), 1
    while done < width:
        step = min(done, width - done)
        a, b = at[:-step] if step else at, at[step:]
        at = np.where(g[a] <= g[b], a, b)
        done += step
    return at


class Windows:
    """All windows of some documents: their starts, documents and anchors."""

    def __init__(self, hashes: list[np.ndarray], window: int, gram: int):
        lengths = np.array([len(h) for h in hashes], np.int64)
        ends = np.cumsum(lengths)
        self.first = ends - lengths
        self.h = np.concatenate(hashes) if len(hashes) else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(hashes)), lengths)
        n = max(0, len(self.h) - window + 1)
        start = np.arange(n)
        ok = start + window <= ends[doc[:n]]
        grams = _rolling(self.h, gram, _A)
        at = _leftmost_min(grams, window - gram + 1)[:n] if n else np.zeros(0, np.int64)
        self.start, self.doc, self.at = start[ok], doc[:n][ok], at[ok]
        self.anchor = grams[self.at] if n else np.zeros(0, np.uint64)
        self.window = window

    def hashes(self) -> np.ndarray:
        return _rolling(self.h, self.window, _B)[self.start] if len(self.start) else np.zeros(0, np.uint64)


def _anchors(window: int, gram: int):
    """(block, text) -> the anchors of each block, 2 where a batch has several."""

    def run(batches):
        for batch in batches:
            texts, blocks = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            w = Windows([word_hashes(t) for t in texts], window, gram)
            new = np.ones(len(w.at), bool)
            new[1:] = w.at[1:] != w.at[:-1]  # an anchor serves neighbouring windows
            a, b = w.anchor[new], blocks[w.doc[new]] if len(blocks) else np.zeros(0, np.int32)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            head = np.ones(len(a), bool)
            head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            n = np.diff(np.append(np.flatnonzero(head), len(a)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[head].view(np.int64)), pa.array(b[head].astype(np.int32)), pa.array(np.minimum(n, 2).astype(np.int32))],
                names=["anchor", "block", "n"],
            )

    return run


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the maximal runs in which every key is constant."""
    n = len(keys[0])
    head = np.ones(n, bool)
    if n > 1:
        head[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(head)


_CANDIDATES = "deal long, block int, ord long, tie long, pos int, n int, windows array<long>"


def _candidates(window: int, gram: int):
    """A block's documents and repeated anchors -> rows of two kinds: n = 0 has
    consecutive windows of one anchor (to be looked up in the other blocks),
    n > 0 says that the n windows from pos have an earlier equal in this block.
    ``deal`` is the anchor, of a hot one's window a hash of both."""

    def run(key, docs, repeated):
        docs = docs.sort_by([("ord", "ascending"), ("tie", "ascending")])
        ords, ties = docs.column("ord").to_numpy(), docs.column("tie").to_numpy()
        w = Windows([word_hashes(t) for t in docs.column("text").to_pylist()], window, gram)
        known = repeated.column("anchor").to_numpy().view(np.uint64)
        by_anchor = np.argsort(known)
        known, is_hot = known[by_anchor], repeated.column("hot").to_numpy(zero_copy_only=False).astype(bool)[by_anchor]
        at = np.minimum(np.searchsorted(known, w.anchor), max(0, len(known) - 1))
        hit = known[at] == w.anchor if len(known) else np.zeros(len(w.anchor), bool)
        i, doc, place, anchor, hashes = w.start[hit], w.doc[hit], w.at[hit], w.anchor[hit], w.hashes()[hit]
        hot = is_hot[at[hit]] if len(known) else hit[hit]
        pos = i - w.first[doc] if len(i) else i
        order = np.lexsort((i, hashes, anchor))
        run_of = np.zeros(len(i), np.int64)
        heads = _runs(anchor[order], hashes[order]) if len(i) else np.zeros(0, np.int64)
        run_of[heads] = 1
        first = order[heads][np.cumsum(run_of) - 1] if len(i) else order
        lead, copy = np.zeros(len(i), bool), np.zeros(len(i), bool)
        lead[first] = True
        same = lead
        if len(i):
            a, b = doc[order], doc[first]
            same = (ords[a] == ords[b]) & (ties[a] == ties[b]) & (pos[order] == pos[first])
        copy[order] = ~same
        out = []
        for kind, keep in ((0, lead), (1, copy)):
            k_i, k_doc, k_place, k_pos = i[keep], doc[keep], place[keep], pos[keep]
            if not len(k_i):
                continue
            step = k_i - np.arange(len(k_i))
            each = np.where(hot[keep], np.arange(len(k_i)), -1)
            starts = _runs(step, k_doc, k_place, each) if kind == 0 else _runs(step, k_doc)
            lengths = np.diff(np.append(starts, len(k_i)))
            values = hashes[keep].view(np.int64) if kind == 0 else np.zeros(0, np.int64)
            offsets = np.append(starts, len(k_i)) if kind == 0 else np.zeros(len(starts) + 1)
            o, p = ords[k_doc[starts]], k_pos[starts]
            deal = (o.astype(np.uint64) * _A + p.astype(np.uint64)) * _B
            if kind == 0:
                a = anchor[keep][starts]
                deal = np.where(hot[keep][starts], (a ^ hashes[keep][starts].view(np.uint64)) * _A, a)
            out.append(
                pa.table(
                    {
                        "deal": deal.view(np.int64),
                        "block": np.full(len(starts), key[0].as_py(), np.int32),
                        "ord": o,
                        "tie": ties[k_doc[starts]],
                        "pos": p.astype(np.int32),
                        "n": (lengths * kind).astype(np.int32),
                        "windows": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)),
                    }
                )
            )
        empty = pa.table({c: pa.array([], t) for c, t in (("deal", pa.int64()), ("block", pa.int32()), ("ord", pa.int64()), ("tie", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("windows", pa.list_(pa.int64())))})
        return pa.concat_tables([x.cast(empty.schema) for x in out]) if out else empty

    return run


def cut_words(text: str | None, covered: np.ndarray) -> str | None:
    """The text without its covered words and the white space after each."""
    if text is None or not covered.any():
        return text
    raw = text.encode("utf-8", "replace")
    pieces = [raw[: m.start()] if (m := _WORD.search(raw)) else raw]
    pieces += [m[0] for m, gone in zip(_SPACED.finditer(raw), covered) if not gone]
    return b"".join(pieces).decode("utf-8", "replace")


def _remove(window: int):
    def run(key, docs, repeats):
        repeats = repeats.sort_by([("ord", "ascending"), ("tie", "ascending")])
        ords, ties, pos, n = (repeats.column(c).to_numpy() for c in ("ord", "tie", "pos", "n"))
        heads = _runs(ords, ties)
        of = dict(zip(zip(ords[heads].tolist(), ties[heads].tolist()), zip(heads, np.append(heads[1:], len(ords)))))
        n_words, starts, ends, kept = [], [], [], []
        for o, tie, text in zip(*(docs.column(c).to_pylist() for c in ("ord", "tie", "text"))):
            size = len(text.encode("utf-8", "replace").split()) if text else 0
            a, b = of.get((o, tie), (0, 0))
            edge = np.zeros(size + 1, np.int64)
            np.add.at(edge, np.minimum(pos[a:b], size), 1)
            np.add.at(edge, np.minimum(pos[a:b] + n[a:b] + window - 1, size), -1)
            covered = np.cumsum(edge[:size]) > 0
            change = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
            n_words.append(size)
            starts.append(change[0::2].tolist())
            ends.append(change[1::2].tolist())
            kept.append(cut_words(text, covered))
        out = {
            "doc_id": docs.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "starts": pa.array(starts, pa.list_(pa.int32())),
            "ends": pa.array(ends, pa.list_(pa.int32())),
            "kept_text": pa.array(kept, pa.string()),
        }
        if "rest" in docs.column_names:
            out["rest"] = docs.column("rest")
        return pa.table(out)

    return run


def factors(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = C.BLOCK_BYTES,
    keep: Sequence[str] = (),
    hot_anchor: int = HOT_ANCHOR,
) -> DataFrame:
    """One row per document: doc_id, n_words, the word spans of its factors
    (starts, ends) and kept_text, the text without them (white space stays); with
    ``keep`` also those columns of the document, as the struct rest."""
    C.bounded_batches(docs.sparkSession)
    rest = [F.struct(*[F.col(c) for c in keep]).alias("rest")] if keep else []
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *rest)
    blocks = C.block_count(source, "text", block_bytes)
    placed = source.select(
        "*",
        F.coalesce("doc_id", F.lit(_LAST)).alias("ord"),
        F.xxhash64("text").alias("tie"),
        C.block_of(F.col("doc_id"), blocks, F.col("text")).alias("block"),
    )
    anchors = placed.select("block", "text").mapInArrow(_anchors(window, gram), "anchor long, block int, n int")
    repeated = (
        anchors.withColumn("total", F.sum("n").over(Window.partitionBy("anchor")))
        .where("total > 1")
        .select("block", "anchor", (F.col("total") > hot_anchor).alias("hot"))
    )
    rows = (
        placed.groupBy("block")
        .cogroup(repeated.groupBy("block"))
        .applyInArrow(_candidates(window, gram), _CANDIDATES)
        .repartition("deal")
    )
    # Both kinds of rows go through one ranking: a second reader would run the step above again.
    to_find = F.transform(
        "windows", lambda w, j: F.struct(w.alias("w"), (F.col("pos") + j).alias("at"), F.lit(1).alias("m"), F.lit(False).alias("known"))
    )
    known = F.array(F.struct(F.lit(0).cast("long").alias("w"), F.col("pos").alias("at"), F.col("n").alias("m"), F.lit(True).alias("known")))
    earlier = Window.partitionBy("deal", "w", "known").orderBy("ord", "tie", "at")
    repeats = (
        rows.select("deal", "block", "ord", "tie", F.explode(F.when(F.col("n") == 0, to_find).otherwise(known)).alias("x"))
        .select("deal", "block", "ord", "tie", "x.*")
        .withColumn("place", F.rank().over(earlier))
        .where("place > 1 OR known")
        .select("block", "ord", "tie", F.col("at").alias("pos"), F.col("m").alias("n"))
    )
    schema = StructType.fromDDL("doc_id long, n_words long, starts array<int>, ends array<int>, kept_text string")
    if keep:
        schema = schema.add(placed.schema["rest"])
    return placed.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(_remove(window), schema)


def removed_words():
    return F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
    )


C.ship(__name__)
