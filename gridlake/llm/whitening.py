"""Whitening of embeddings by a weighted covariance of distinct vectors.

Entries are put on an integer grid (floor of ``scale`` times the entry), and identical grid
vectors are grouped with their multiplicity: the fit reads each distinct vector once, with its
count or one as its weight. Two passes over the distinct vectors give the exact sums and then,
centred before multiplying, the covariance: each task adds up the products of its vectors and
hands on one d x d matrix, and the matrices are added by an aggregation. Only sums, the d x d
matrix and what follows from it reach the driver: their size is set by the dimension alone. Each
distinct vector is whitened once, in the task that holds it, and the result joined back to the
rows. A vector that very many rows share is salted in that join.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries are left out, as
are vectors of another length than most rows have (ties: the longer length). Grid entries beyond
a long count as the nearest long; a deviation beyond a long is null. Rows with equal or null ids
are rows of their own. Components without variance (an eigenvalue of at most ``d * 1e-14`` times
the largest) are left out, so a table with one distinct vector, with empty vectors or with no
rows gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common as C

#: Vectors that more than HOT_ROWS rows share, and more than one row in HOT_VECTORS, are salted in
#: the join: at most HOT_VECTORS of them, so their hashes can be broadcast.
HOT_ROWS = 100_000
HOT_VECTORS = 10_000
SALTS = 64
#: Relative size below which an eigenvalue counts as zero.
TINY = 1e-14


@dataclass
class Fit:
    """What the distinct vectors show: n (sum of weights), sums (exact) per dimension,
    eigenvalues by falling size, components as columns, trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def grid(rows: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """vec_id and x, the vector on the integer grid, of the rows that have one."""
    found = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    )
    return found.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(d: int):
    """Per task: dimension, exact sum of weight times x (dimension -1: sum of weights)."""

    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x, w = _matrix(batch.column(0), d), batch.column(1).to_numpy()
            n += int(w.sum())
            if len(x) and np.abs(x.astype(float)).max() * float(w.sum()) < 2**62:
                part = (x * w[:, None]).sum(axis=0).tolist()
            else:
                part = (x.astype(object) * w.astype(object)[:, None]).sum(axis=0).tolist() if len(x) else [0] * d
            total = [a + int(b) for a, b in zip(total, part)]
        if n:
            from decimal import Context, Decimal

            exact = [Decimal(t, Context(prec=60)) for t in [n, *total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, d), pa.int32()), pa.array(exact, pa.decimal128(38, 0))], names=["dim", "s"]
            )

    return run


def _products(n: int, mean: np.ndarray):
    """Per task: its part of the covariance, a row of the matrix per row."""

    def run(batches):
        d, total = len(mean), np.zeros((len(mean), len(mean)))
        for batch in batches:
            centred = _matrix(batch.column(0), d) - mean
            total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total / n))], names=["i", "part"])

    return run


def covariance(vectors: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """Weighted covariance of rows (vector, weight) about a mean; n is the sum of weights."""
    parts = vectors.mapInArrow(_products(n, mean), "i int, part array<double>")
    added = parts.select("i", F.posexplode("part").alias("j", "p")).groupBy("i", "j").agg(F.sum("p").alias("p"))
    matrix = np.zeros((len(mean), len(mean)))
    for r in added.toLocalIterator():  # d x d numbers
        matrix[r.i, r.j] = r.p
    return matrix


def fit(distinct: DataFrame, d: int) -> Fit | None:
    """Of rows x (length d) and weight, one row per distinct vector."""
    weighted = distinct.select("x", "weight")
    summed = weighted.mapInArrow(_sums(d), "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    at = {r.dim: int(r.s) for r in summed.collect()}  # d + 1 rows
    if not at:
        return None
    n, sums = at[-1], [at[i] for i in range(d)]
    matrix = covariance(weighted, n, np.array([t / n for t in sums]))
    values, basis = np.linalg.eigh((matrix + matrix.T) / 2)
    trace = float(np.trace(matrix))
    order = np.argsort(-values, kind="stable")
    return Fit(n, sums, values[order], basis[:, order], trace)


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum over dimensions of (n*x - S)^2 per row; null where it is beyond a long."""
    most = max([abs(s) for s in sums], default=0) + n * (float(np.abs(x.astype(float)).max()) if len(x) else 0.0)
    if most * most * max(len(sums), 1) < 2**62:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    return [int(v) if v < 2**63 else None for v in (off * off).sum(axis=1)]


def _whiten(model: Fit, k: int):
    mean, d = model.mean, len(model.sums)
    turn = model.basis[:, :k] / np.sqrt(model.values[:k])
    n, sums = model.n, model.sums

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(_exact_deviation(x, n, sums), pa.int64()),
                    pa.array(list((x - mean) @ turn), pa.list_(pa.float64())),
                ],
                names=["h", "x", "count", "weight", "deviation", "w"],
            )

    return run


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the weighted covariance of column w minus the identity."""
    each = whitened.select("weight", F.posexplode("w").alias("at", "v"))
    means = {r["at"]: r.m for r in each.groupBy("at").agg((F.sum(F.col("v") * F.col("weight")) / n).alias("m")).collect()}
    found = covariance(whitened.select("w", "weight"), n, np.array([means[i] for i in range(k)]))
    return float(np.abs(found - np.eye(k)).max())


def _joined(placed: DataFrame, whitened: DataFrame) -> DataFrame:
    """Rows with what their vector got; a hot vector's rows are dealt to SALTS copies of it."""
    spark = placed.sparkSession
    total = whitened.agg(F.sum("count")).first()[0]
    is_hot = F.col("count") > max(HOT_ROWS, total // HOT_VECTORS)
    hot = [(r.h,) for r in whitened.where(is_hot).select("h").distinct().collect()]  # HOT_VECTORS at most
    salt = F.lit(0)
    if hot:
        placed = placed.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        known = spark.createDataFrame(hot, "h long").withColumn("hot", F.lit(True))
        placed = placed.join(F.broadcast(known), "h", "left")
        salt = F.when(F.col("hot"), F.col("deal")).otherwise(0)
    salted = placed.select("vec_id", "x", "h", salt.alias("salt"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    held = whitened.select("h", "x", "deviation", "w", F.explode(copies).alias("salt"))
    return salted.join(held.hint("merge"), ["h", "salt", "x"])


def whiten(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int | None = None,
    scale: float = 256.0,
    use_counts: bool = False,
) -> DataFrame:
    """One row per row with a vector: vec_id, n, deviation, whitened (an array, a number a
    component), explained (the components' shares of the variance), identity_error."""
    spark = rows.sparkSession
    C.bounded_batches(spark, 4000)
    schema = "vec_id {}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    empty = spark.createDataFrame([], schema.format(rows.schema[vec_id].dataType.simpleString()))
    placed = grid(rows, vec_id, vector, scale)
    lengths = placed.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None or lengths.d == 0:
        return empty
    d = lengths.d
    placed = placed.where(F.size("x") == d).withColumn("h", F.xxhash64("x"))
    weight = F.col("count") if use_counts else F.lit(1).cast("long")
    distinct = C.cut(placed.groupBy("h", "x").count().withColumn("weight", weight), "vectors")
    model = fit(distinct, d)
    spread = model.values > max(float(model.values[0]), 0.0) * d * TINY
    k = int(spread.sum()) if components is None else min(components, int(spread.sum()))
    if k == 0:
        return empty
    schema = "h long, x array<bigint>, count long, weight long, deviation long, w array<double>"
    whitened = C.cut(distinct.mapInArrow(_whiten(model, k), schema), "whitened")
    error = identity_error(whitened, model.n, k)
    share = [float(v) / model.trace for v in model.values[:k]]
    return _joined(placed, whitened).select(
        "vec_id",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.array(*[F.lit(s) for s in share]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


C.ship(__name__)
