"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items: ``window`` consecutive
words, or the whole item where it has fewer. Patterns of one length make one
search: a shift table, keyed by blocks of two words, tells how far the search
may jump without missing an occurrence; a block with shift 0 selects the bucket
of patterns that end with it, a hash of all words finds the place in the bucket (so
large buckets, as of a formula in many items, cost no more), and comparing the words
confirms an occurrence. Words are numbered and the tables flat arrays.

Patterns reach the tasks by broadcast in passes: a pass takes items of at most
``pass_bytes`` of text, whatever the number of items, and the documents are
searched once a pass. Documents are never shuffled; a task holds one Arrow
batch. Defined cases: a null or empty text has no words and no hits; an item
without words is ignored; items with equal texts each count, repeated items once, a null
item id is an id like others; columns named in ``keep`` ride along in ``rest``, others
are ignored; repeated documents give repeated rows; an empty table of either kind gives no hits.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common as C

WINDOW = 13
#: Benchmark text of one search pass: bounds the broadcast tables, which take up to about ten
#: times as much (measured in tests/llm).
PASS_BYTES = 16_000_000
_WORD = 0x9E3779B97F4A7C15  # any odd multipliers: hashes of patterns and of blocks
_BLOCK = 0x9E3779B1
_64 = (1 << 64) - 1

_SPACES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, runs of 0-9, a-z and non-ASCII characters."""
    return text.encode("utf-8", "replace").translate(_SPACES).split() if text else []


class Search:
    """Wu-Manber tables of the patterns of one length ``m``, over word numbers.

    ``shift`` is a table by hashed block: the distance from the block to the end of the
    nearest pattern that has it, the largest jump where none has (of blocks that share a place
    the least counts, which is never too far). ``offsets`` cuts the patterns, sorted by the hash
    of their last block and then by that of all their words, into buckets: ``hashes``, ``starts``
    (in ``stream``, the items' words one after the other) and ``items``. All are flat arrays.
    Patterns of one word have that word as their block."""

    def __init__(self, m: int, stream: array, starts: np.ndarray, items: np.ndarray):
        self.m, self.stream = m, stream
        words = np.frombuffer(stream, np.int32).astype(np.uint64)
        size = max(1 << 10, 1 << int(4 * len(starts)).bit_length())
        self.mask = size - 1
        self.far = m - min(2, m) + 1
        shift = np.full(size, min(self.far, 255), np.uint8)
        for end in range(min(2, m), m + 1):  # the last assignment is the smallest distance
            block = self._blocks(words, starts + end)
            shift[block] = min(m - end, 255)
        h = np.zeros(len(starts), np.uint64)
        for j in range(m):
            h = h * np.uint64(_WORD) + words[starts + j]
        order = np.lexsort((h, block))
        self.shift = bytearray(shift.tobytes())
        self.offsets = array("i", np.searchsorted(block[order], np.arange(size + 1)).astype(np.int32).tobytes())
        self.hashes = array("Q", h[order].tobytes())
        self.starts = array("i", starts[order].astype(np.int32).tobytes())
        self.items = array("i", items[order].astype(np.int32).tobytes())

    def _blocks(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        last = words[ends - 1]
        both = words[ends - 2] * np.uint64(_BLOCK) + last if self.m > 1 else last
        return (both & np.uint64(self.mask)).astype(np.int64)

    def run(self, w: array, spans: list, found: set) -> None:
        """Add the (start, end) spans of occurrences in ``w`` and the numbers of the items hit."""
        n, m, shift, mask, pairs = len(w), self.m, self.shift, self.mask, self.m > 1
        hashes, offsets, known = self.hashes, self.offsets, {}
        i = m - 1
        while i < n:
            block = (w[i - 1] * _BLOCK + w[i] if pairs else w[i]) & mask
            jump = shift[block]
            if jump:
                i += jump
                continue
            low, high = offsets[block], offsets[block + 1]
            if low < high:
                start, h = i - m + 1, 0
                window = w[start : i + 1]
                for x in window:
                    h = (h * _WORD + x) & _64
                k = bisect_left(hashes, h, low, high)
                if known.get(k) == window:  # met before in this text
                    spans.append((start, i + 1))
                else:
                    hit = False
                    for at in range(k, high):
                        if hashes[at] != h:
                            break
                        s = self.starts[at]
                        if self.stream[s : s + m] == window:
                            hit = True
                            found.add(self.items[at])
                    if hit:
                        known[k] = window
                        spans.append((start, i + 1))
            i += 1


def build_tables(items, window: int = WINDOW) -> tuple[dict, list, list]:
    """The word numbers (from 1; 0 is any other word), the item ids, and a search per
    pattern length."""
    numbers: dict[bytes, int] = {}
    ids, stream, places = [], array("i"), {}
    for item_id, text in items:
        w = item_words(text)
        m = min(window, len(w))
        if m:
            places.setdefault(m, []).append((len(stream), len(w) - m + 1, len(ids)))
            ids.append(item_id)
            stream.extend(numbers.setdefault(x, len(numbers) + 1) for x in w)
    searches = []
    for m, of in sorted(places.items()):
        first, n, item = np.array(of, np.int64).T
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        searches.append(Search(m, stream, np.repeat(first, n) + within, np.repeat(item, n)))
    return numbers, ids, searches


def search(w: list[bytes], tables) -> tuple[list[tuple[int, int]], set]:
    """Occurrences as (start, end) word spans, and the ids of the items hit."""
    numbers, ids, searches = tables
    spans, found = [], set()
    if searches:
        coded = array("i", map(numbers.get, w, repeat(0)))
        for s in searches:
            s.run(coded, spans, found)
    return spans, {ids[k] for k in found}


def merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _scan(tables):
    def scan(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("__text")).to_pylist()
            starts, ends, items, counts = [], [], [], []
            old = [batch.column(names.index(c)).to_pylist() for c in ("hit_starts", "hit_ends", "items")]
            for k, text in enumerate(texts):
                w = item_words(text)
                spans, found = search(w, tables.value)
                spans = merge([*zip(old[0][k], old[1][k]), *spans])
                starts.append([s for s, _ in spans])
                ends.append([e for _, e in spans])
                items.append(sorted(found.union(old[2][k]), key=str))
                counts.append(len(w))
            new = {"n_words": counts, "hit_starts": starts, "hit_ends": ends, "items": items}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[c], batch.schema.field(c).type) if c in new else batch.column(c) for c in names],
                schema=batch.schema,
            )

    return scan


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, n_words, hit_starts, hit_ends (merged word
    spans covered by occurrences), items (ids of the items with occurrences); with
    ``keep`` also those columns of the document, as the struct rest."""
    spark = docs.sparkSession
    C.bounded_batches(spark)
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("t")).where("t IS NOT NULL").distinct()
    # The largest item counts as well: hashing balances all but single items.
    passes = C.block_count(items, "t", pass_bytes)
    id_type = items.schema["id"].dataType.simpleString()
    out = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("__text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<int>").alias("hit_starts"),
        F.array().cast("array<int>").alias("hit_ends"),
        F.array().cast(f"array<{id_type}>").alias("items"),
        *([F.struct(*[F.col(c) for c in keep]).alias("rest")] if keep else []),
    )
    schema = out.schema
    for k in range(passes):
        rows = items.where(C.block_of(F.col("t"), passes, F.col("id")) == k).collect()  # at most about pass_bytes
        tables = spark.sparkContext.broadcast(build_tables([(r["id"], r["t"]) for r in rows], window))
        out = out.mapInArrow(_scan(tables), schema)
        if k + 1 < passes:  # one pass's tables in a worker at a time
            out = C.cut(out, "decontaminate")
    return out.drop("__text")


def decisions(found: DataFrame, share: int = 20) -> DataFrame:
    """Per document: n_words, n_hit, n_items, the ids' digest, and whether at
    least one in ``share`` of its words is hit."""
    n_hit = F.aggregate(
        F.zip_with("hit_starts", "hit_ends", lambda s, e: (e - s).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        *[c for c in found.columns if c == "rest"],
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr(f"n_hit > 0 AND {share} * n_hit >= n_words"))


C.ship(__name__)
