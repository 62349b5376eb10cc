"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

A text is encoded by a byte-level BPE (A) and a piece vocabulary with byte fallback (B), both over
a space and the text. For each side, token-byte incidence is a sparse matrix, built by hand in
compressed rows: a row a token, a column a byte. Gustavson's row products A * B^T then give, for
each A token, the B tokens that share a byte with it (the overlap links), with the number of bytes
they share. Byte offsets where tokens of both sides end cut the tokens into groups; the products
of the token-group incidences, a block of rows at a time, give the links within a group
(shared-group links), which ``align`` counts and ``links`` returns.

Texts are processed in pieces of bounded size: a long text is cut before a single space between two
ASCII letters, where neither vocabulary has a token across, so pieces are encoded as the whole
text is. Tasks lay documents into chunks of bounded size; a chunk lists its distinct id pairs once,
with the documents that hold them, and a document keeps numbers in its chunk's list. Corpus-wide
counts are an aggregation over the lists, and go back to the chunks by joins on the pair (a frequent
pair has one row a chunk, not one an occurrence) and on the chunk.

Defined cases: texts that are null, empty, or not given back byte for byte by both sides have no
tokens; repeated rows (and equal or null ids) are documents of their own; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common as C
from gridlake.llm.vocabulary import ByteLevel, Pieces, pieces_of

#: Public vocabularies: where the box keeps them.
VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of texts encoded at a time, and of a chunk.
BATCH_CHARS = 500_000
CHUNK_CHARS = 8_000_000
#: Shared-group links made at a time.
LINKS_AT_A_TIME = 2_000_000
#: An id pair is one number: a * WIDTH + b.
WIDTH = 1 << 31


def incidence(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compressed rows (pointers, columns) of a matrix whose row i holds columns starts[i]..ends[i]-1."""
    size = ends - starts
    pointers = np.concatenate([[0], np.cumsum(size)])
    return pointers, np.arange(pointers[-1]) - np.repeat(pointers[:-1] - starts, size)


def transposed(pointers: np.ndarray, columns: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Compressed rows of the transposed matrix."""
    rows = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))
    order = np.argsort(columns, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(columns, minlength=width))]), rows[order]


def row_products(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson: row i of A * B is the sum of the rows of B that row i of A names. Entries
    (row, column, value) by row and column; matrices are compressed rows of ones."""
    (a_ptr, a_col), (b_ptr, b_col) = a, b
    fan = np.diff(b_ptr)[a_col]
    row = np.repeat(np.repeat(np.arange(len(a_ptr) - 1), np.diff(a_ptr)), fan)
    first = np.cumsum(fan) - fan
    column = b_col[np.arange(len(row)) - np.repeat(first - b_ptr[a_col], fan)]
    if len(row) > 1 and not ((np.diff(row) > 0) | (np.diff(column) >= 0)).all():
        order = np.lexsort((column, row))
        row, column = row[order], column[order]
    new = np.concatenate([[True], (np.diff(row) != 0) | (np.diff(column) != 0)]) if len(row) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return row[at], column[at], np.diff(np.concatenate([at, [len(row)]]))


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A token, B token, shared bytes for all pairs that share a byte; ends: byte offsets of both sides."""
    starts = lambda ends: np.concatenate([[0], ends[:-1]])
    total = int(a_ends[-1]) if len(a_ends) else 0
    a, b = incidence(starts(a_ends), a_ends), incidence(starts(b_ends), b_ends)
    return row_products(a, transposed(*b, total))


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and B token: groups end where tokens of both sides end."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)


def shared_group_links(a_group: np.ndarray, b_group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A token, B token for all pairs of one group: the product of the group incidences, made in
    blocks of A rows with at most LINKS_AT_A_TIME entries (or of one row), as a group of a text
    that never aligns has as many as its A times its B tokens."""
    count = int(a_group[-1]) + 1 if len(a_group) else 0
    one = lambda g: (np.arange(len(g) + 1), g)
    groups = transposed(*one(b_group), count)
    upto = np.cumsum(np.diff(groups[0])[a_group])
    start, made = 0, 0
    while start < len(a_group):
        end = max(start + 1, int(np.searchsorted(upto, made + LINKS_AT_A_TIME, side="right")))
        row, column, _ = row_products(one(a_group[start:end]), groups)
        yield row + start, column
        start, made = end, int(upto[end - 1])


@dataclass
class Found:
    """A text's numbers (n_a, n_b, n_groups, n_links, n_shared), groups, and distinct linked id
    pairs, rising, with how often each occurs."""

    numbers: tuple
    groups: str
    pair: np.ndarray
    times: np.ndarray


def distinct_rows(owner: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (owner, pair), sorted, and how often each occurs."""
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    at = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(pair) != 0)]))
    return owner[at], pair[at], np.diff(np.concatenate([at, [len(pair)]]))


class _Batch:
    """Encoded pieces of documents, laid end to end."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.sizes = [np.array([len(s) for s in side.spell], np.int64) for side in (a, b)]
        # "12," "12|" "12;" "12": an id and what follows it.
        self.told = [[f"{i}{mark}" for i in range(len(side.spell)) for mark in (",", "|", ";", "")] for side in (a, b)]

    def run(self, pieces: list[str]) -> list:
        """Per piece: what it shows (see ``Found``), or None if it is not given back whole."""
        a_ids = self.a.encode(pieces)
        b_ids = self.b.encode([p[1:] for p in pieces])  # B puts a space first
        spelt = lambda side, ids: b"".join(map(side.spell.__getitem__, ids))
        good = [
            k for k, p in enumerate(pieces) if (raw := p.encode()) == spelt(self.a, a_ids[k]) and raw == spelt(self.b, b_ids[k])
        ]
        out = [None] * len(pieces)
        if not good:
            return out
        flat = [np.concatenate([np.array(ids[k], np.int64) for k in good]) for ids in (a_ids, b_ids)]
        counts = [np.array([len(ids[k]) for k in good], np.int64) for ids in (a_ids, b_ids)]
        ends = [np.cumsum(size[f]) for size, f in zip(self.sizes, flat)]
        group = groups_of(*ends)
        piece_of = np.repeat(np.arange(len(good)), counts[0])
        of_group = np.zeros(int(group[0][-1]) + 1, np.int64)
        of_group[group[0]] = piece_of
        n_groups = np.bincount(of_group, minlength=len(good))
        shared = np.zeros(len(good), np.int64)
        for row, _ in shared_group_links(*group):
            shared += np.bincount(piece_of[row], minlength=len(good))
        texts = self._told(flat, group, counts)
        row, column, _ = overlap_links(*ends)
        owner, pair, times = distinct_rows(piece_of[row], flat[0][row] * WIDTH + flat[1][column])
        bounds = np.searchsorted(owner, np.arange(len(good) + 1))
        for g, k in enumerate(good):
            i, j = bounds[g], bounds[g + 1]
            numbers = (int(counts[0][g]), int(counts[1][g]), int(n_groups[g]), int(times[i:j].sum()), int(shared[g]))
            out[k] = Found(numbers, texts[g], pair[i:j], times[i:j])
        return out

    def _told(self, flat, group, counts) -> list[str]:
        """a1,a2|b1;a3|b2,b3 for each piece."""
        marks = []
        for side, g in enumerate(group):
            mark = np.where(np.concatenate([np.diff(g) != 0, [True]]), 1 + side, 0)
            if side == 1:
                mark[np.cumsum(counts[1]) - 1] = 3  # nothing follows a piece's last token
            marks.append(flat[side] * 4 + mark)
        # Order: by group, A before B, then as they stand.
        order = np.argsort(np.concatenate([group[0] * 2, group[1] * 2 + 1]), kind="stable")
        from_a = order < len(flat[0])
        code = np.concatenate(marks)[order].tolist()
        a_told, b_told = self.told
        words = [a_told[c] if is_a else b_told[c] for c, is_a in zip(code, from_a.tolist())]
        stops = np.cumsum(counts[0] + counts[1]).tolist()
        return ["".join(words[i:j]) for i, j in zip([0, *stops[:-1]], stops)]


def _packed(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.astype(np.uint32).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32).astype(np.int64)


def _joined(parts: list) -> Found | None:
    """A document's pieces as one; none if a piece is not given back."""
    if not parts or None in parts:
        return None
    if len(parts) == 1:
        return parts[0]
    pair, place = np.unique(np.concatenate([p.pair for p in parts]), return_inverse=True)
    times = np.bincount(place, weights=np.concatenate([p.times for p in parts])).astype(np.int64)
    return Found(tuple(map(sum, zip(*(p.numbers for p in parts)))), ";".join(p.groups for p in parts), pair, times)


def _documents(batches, work: _Batch):
    """(doc_id, characters, Found or None) of each document in turn."""
    for batch in batches:
        waiting, size = [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            waiting.append((doc_id, pieces_of(" " + text) if text else []))
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield from _run(waiting, work)
                waiting, size = [], 0
        yield from _run(waiting, work)


def _run(waiting: list, work: _Batch):
    short = iter(work.run([parts[0] for _, parts in waiting if len(parts) == 1]))
    for doc_id, parts in waiting:
        found = [next(short)] if len(parts) == 1 else [x for part in parts for x in work.run([part])]
        yield doc_id, sum(map(len, parts)), _joined(found)


#: What a task hands on: documents (pairs null) and, last, the list of each chunk (place null).
OUT = {
    "chunk": "string", "place": "int", "doc_id": "{}", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_shared": "long",
    "groups": "string", "held": "binary", "times": "binary", "pairs": "array<long>", "docs": "array<int>",
}


def _chunk(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
    """A chunk's documents, their pairs as places (rising, so written as steps) in the sorted
    list of the chunk's pairs, and that list with the documents that hold each pair."""
    nothing = Found((0, 0, 0, 0, 0), "", np.zeros(0, np.int64), np.zeros(0, np.int64))
    found = [x or nothing for _, x in rows]
    pairs, place = np.unique(np.concatenate([x.pair for x in found]), return_inverse=True)
    held = np.split(place, np.cumsum([len(x.pair) for x in found])[:-1])
    none, name = [None] * len(rows), uuid.uuid4().hex
    columns = [
        pa.array([name] * (len(rows) + 1)),
        pa.array([*range(len(rows)), None], pa.int32()),
        pa.array([*(i for i, _ in rows), None], id_type),
        *(pa.array([*c, None], pa.int64()) for c in zip(*(x.numbers for x in found))),
        pa.array([*(x.groups for x in found), None], pa.string()),
        pa.array([*(_packed(np.diff(h, prepend=0)) for h in held), None], pa.binary()),
        pa.array([*(_packed(x.times) for x in found), None], pa.binary()),
        pa.array([*none, pairs], pa.list_(pa.int64())),
        pa.array([*none, np.bincount(place, minlength=len(pairs))], pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(OUT))


def _encode(path_a: str, path_b: str, id_type: pa.DataType):
    """(doc_id, text) -> rows of OUT."""

    def run(batches):
        work, rows, size = _Batch(ByteLevel(path_a), Pieces(path_b)), [], 0
        for doc_id, chars, found in _documents(batches, work):
            rows.append((doc_id, found))
            size += chars + 100
            if size >= CHUNK_CHARS:
                yield _chunk(rows, id_type)
                rows, size = [], 0
        if rows:
            yield _chunk(rows, id_type)

    return run


def encoded(docs: DataFrame, doc_id: str, text: str, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """Rows of OUT: documents with their groups as text and their links as places in the list
    of their chunk, and the lists."""
    from pyspark.sql.pandas.types import to_arrow_type

    C.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = ", ".join(f"{n} {t}" for n, t in OUT.items()).format(kind.simpleString())
    return rows.mapInArrow(_encode(vocabulary_a, vocabulary_b, to_arrow_type(kind)), schema)


def links(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    shared_groups: bool = False,
) -> DataFrame:
    """The links themselves: doc_id, piece, a, b (places of the tokens in the piece), a_id, b_id
    and shared_bytes; with ``shared_groups`` those between all tokens of a group (bytes null)."""
    C.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        a, b = ByteLevel(vocabulary_a), Pieces(vocabulary_b)
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                for k, part in enumerate(pieces_of(" " + text) if text else []):
                    ids = [np.array(side.encode([t])[0], np.int64) for side, t in ((a, part), (b, part[1:]))]
                    ends = [np.cumsum([len(side.spell[t]) for t in x]) for side, x in zip((a, b), ids)]
                    blocks = ((*x, None) for x in shared_group_links(*groups_of(*ends))) if shared_groups else [overlap_links(*ends)]
                    for row, column, size in blocks:
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([i] * len(row), pa.int64())),
                                pa.array([k] * len(row), pa.int32()),
                                *(pa.array(x, pa.int32()) for x in (row, column, ids[0][row], ids[1][column])),
                                pa.array([None] * len(row) if size is None else size, pa.int32()),
                            ],
                            names=["doc_id", "piece", "a", "b", "a_id", "b_id", "shared_bytes"],
                        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, a int, b int, a_id int, b_id int, shared_bytes int")


def pair_counts(lists: DataFrame) -> DataFrame:
    """Of the chunks' lists: pair, n (documents that hold it), best (no pair of its A id is
    held by more)."""
    each = lists.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counted = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {WIDTH}"))  # as many rows as B has ids, at most
    return counted.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def _sum_up(key, documents: pa.Table, counts: pa.Table) -> pa.Table:
    n = np.zeros(counts.num_rows, np.int64)
    best = np.zeros(counts.num_rows, bool)
    at = counts.column("at").to_numpy()
    n[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for held, times in zip(documents.column("held").to_pylist(), documents.column("times").to_pylist()):
        places, often = np.cumsum(_unpacked(held)), _unpacked(times)
        sums.append(int((n[places] * often).sum()))
        bests.append(int(often[best[places]].sum()))
    kept = documents.drop_columns(["chunk", "held", "times"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    show: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_shared, what ``show`` makes
    of them and of ``groups`` (default: groups itself), n_best (links whose pair's count is its A
    id's highest) and count_sum (the pairs' counts, summed over the links)."""
    show = {"groups": F.col("groups")} if show is None else show
    found = encoded(docs, doc_id, text, vocabulary_a, vocabulary_b)
    plain = ["chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared"]
    table = C.cut(found.select(*plain, *[c.alias(n) for n, c in show.items()], "held", "times", "pairs", "docs"), "aligned")
    lists = table.where("pairs IS NOT NULL").select("chunk", "pairs", "docs")
    counts = C.cut(pair_counts(lists), "pair-counts")
    each = lists.select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("at", "pair"))
    told = each.join(counts.hint("merge"), "pair").select("of_chunk", "at", "n", "best")
    documents = table.where("place IS NOT NULL").select("chunk", *plain[2:], *show, "held", "times")
    schema = documents.drop("chunk", "held", "times").schema.add("n_best", "long").add("count_sum", "long")
    return documents.groupBy("chunk").cogroup(told.groupBy("of_chunk")).applyInArrow(_sum_up, schema)


C.ship(__name__)
