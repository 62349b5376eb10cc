"""SimHash near-dedup through a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 segments of two bits. The
Manhattan distance of two such vectors never exceeds the bit distance of the
fingerprints, so it is a lower bound to prune by. The segments are dealt to
``groups`` groups, enough that a pair within ``max_bits`` differs by at most one in
some group; the counts of a group are its grid cell, and the range join meets
points of the same cell and of the cells at distance one. Cells at distance one have
sums of opposite parity, so only points with an even sum look at their neighbours
and every pair is met once a group. In the join the Manhattan distance of the whole
vectors is checked first, then the exact bit distance.

Counts are kept as thermometer codes (0, 1, 2 as 00, 01, 11): the Manhattan
distance is then the number of differing bits, in compiled expressions.

Equal fingerprints meet in one row before the join. Links become components by
alternating large-star and small-star rounds on the shared checkpoint folder.

Defined cases: a null or empty text has fingerprint zero and links like any other;
null doc_ids never name a component unless it has no other; repeated rows stay, each
with its component; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common as C

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_EACH = 0x5555555555555555  # the low bit of every segment
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles (fewer words: one shingle)."""
    w = text.encode("utf-8", "replace").lower().split() if text else []
    if not w:
        return 0
    k = min(shingle, len(w))
    total = len(w) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _SLICE):
        n = min(_SLICE, total - at)
        grams = zip(*(w[at + j : at + j + n] for j in range(k)))
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64, n)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(n, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _scan(shingle: int):
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            out = [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "fp", *batch.schema.names[2:]])

    return run


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, row: Column | None = None
) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) and, if given, row (a long that tells rows of one id apart)."""
    C.bounded_batches(docs.sparkSession)
    more = [] if row is None else [row.alias("row")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *more)
    return rows.mapInArrow(_scan(shingle), "doc_id long, fp long" + (", row long" if more else ""))


def embedding(fp: Column) -> Column:
    """Bit counts of the two-bit segments, as thermometer codes."""
    up, each = F.shiftrightunsigned(fp, 1), F.lit(_EACH)
    return fp.bitwiseOR(up).bitwiseAND(each).bitwiseOR(F.shiftleft(fp.bitwiseAND(up).bitwiseAND(each), 1))


def _groups(max_bits: int) -> int:
    g = 1
    while max_bits // g > 1:
        g *= 2
    return g


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) within ``max_bits``
    bits of each other, once each."""
    groups = _groups(max_bits)
    bits = 64 // groups
    mask = (1 << bits) - 1 if bits < 64 else -1
    points = (
        fps.select("fp", embedding(F.col("fp")).alias("t"))
        .withColumn("g", F.explode(F.array(*[F.lit(i) for i in range(groups)])))
        .withColumn("cell", F.expr(f"shiftrightunsigned(t, g * {bits}) & {mask}L" if groups > 1 else "t"))
    )
    # A unit step: the low bit flips where the high one is 0, the high one where the low one is 1.
    steps = F.expr(
        f"""transform(filter(sequence(0, {bits - 1}), k ->
              ((shiftrightunsigned(cell, IF(k % 2 = 0, k + 1, k - 1)) & 1) = k % 2)), k -> cell ^ shiftleft(1L, k))"""
    )
    near = F.when(F.bit_count("cell") % 2 == 0, steps).otherwise(F.array().cast("array<bigint>"))
    looks = F.concat(
        F.array(F.struct(F.col("cell").alias("at"), F.lit(True).alias("same"))),
        F.transform(near, lambda c: F.struct(c.alias("at"), F.lit(False).alias("same"))),
    )
    left = points.select(F.col("fp").alias("a"), F.col("t").alias("ta"), "g", F.explode(looks).alias("x")).select(
        "a", "ta", F.col("g").alias("ga"), F.col("x.at").alias("at"), F.col("x.same").alias("same")
    )
    right = points.select(F.col("fp").alias("b"), F.col("t").alias("tb"), F.col("g").alias("gb"), F.col("cell").alias("cb"))
    close = (
        (F.bit_count(F.col("ta").bitwiseXOR(F.col("tb"))) <= max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (~F.col("same") | (F.col("a") < F.col("b")))
    )
    met = left.join(right.hint("merge"), (F.col("ga") == F.col("gb")) & (F.col("at") == F.col("cb")) & close)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b), for every node
    that has an edge. Alternates large-star and small-star rounds until the edges
    are stars; each round is a table in the shared scratch folder."""
    pairs = C.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = state(pairs)
    while before[0]:
        # Large star: the larger neighbours of every node move to its smallest one.
        both = pairs.union(pairs.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = C.cut(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    row: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id that
    links reach, its own included) and root (a fingerprint of the component, one for all of
    it, also where no document has an id); with ``row`` that column too."""
    prints = C.cut(fingerprints(docs, doc_id, text, shingle, row), "fingerprints")
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(points, max_bits))
    of = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = of.join(named, "root").select(F.col("fp").alias("f"), "component_id", "root")
    return prints.join(classes, prints["fp"] == classes["f"]).select(*prints.columns, "component_id", "root")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


C.ship(__name__)
