"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, every run of non-letters becomes one space, and the n-grams
of 1 to 4 characters are hashed to ``BUCKETS`` features. Document frequencies are
counted over all training texts. The weights are fitted by follow-the-regularised-
leader (proximal, one learning rate per weight) with an elastic-net penalty on a
bounded sample: for every label the ``PER_LABEL`` training documents with the smallest
hash of their id. A fifth of the sample is kept back to fit the temperature that
calibrates the probabilities. The label set is expected to be a closed one (languages):
the model and the sample are bounded by its size.

Prediction reads the text alone. Long texts are counted in slices, so a task holds
one batch of texts and one slice of features.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without
any labelled training text every document is ``und``; equal probabilities go to the
label that sorts first; rows with a null label train the document frequencies only;
repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake.llm import common as C

BUCKETS = 1 << 13
ORDERS = (1, 2, 3, 4)
#: Documents of each label that the classifier is fitted on (and calibrated with).
PER_LABEL = 1000
UNKNOWN = "und"
_SLICE = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Whether each code point of the letter planes is a letter."""
    global _LETTERS
    try:
        return _LETTERS
    except NameError:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x33480)), bool, 0x33480)
        return _LETTERS


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None if the text has no letter."""
    if not text:
        return None
    out, table, seen = np.zeros(BUCKETS, np.int64), _letters(), False
    reach = max(ORDERS) - 1
    for at in range(0, len(text), _SLICE):
        piece = text[max(0, at - reach) : at + _SLICE].lower()
        cp = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        cp = np.where((cp < len(table)) & table[np.minimum(cp, len(table) - 1)], cp, 32)
        seen |= bool((cp != 32).any())
        space = cp == 32
        cp = cp[~(space & np.concatenate(([False], space[:-1])))].astype(np.uint64)
        h = np.zeros(len(cp), np.uint64)
        for n in ORDERS:
            if len(cp) < n:
                break
            h = (h[: len(cp) - n + 1] + cp[n - 1 :] + np.uint64(n)) * _MIX
            out += np.bincount((h >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
    return out if seen else None


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (BUCKETS + 1, labels); the last row is the intercept
    temperature: float

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        idx = np.flatnonzero(counts)
        x = (1.0 + np.log(counts[idx])) * self.idf[idx]
        x /= np.sqrt(x @ x)
        return np.append(idx, BUCKETS), np.append(x, 1.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if self.labels else None
        if counts is None:
            return UNKNOWN, 0.0
        idx, x = self.vector(counts)
        p = softmax(x @ self.weights[idx] / self.temperature)
        k = int(np.argmax(p))
        return self.labels[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(examples, n_labels: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
    """FTRL-proximal with elastic net; examples: (feature ids, values, label)."""
    z = np.zeros((BUCKETS + 1, n_labels))
    n = np.zeros((BUCKETS + 1, n_labels))

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for idx, x, y in examples:
            w = weights(z[idx], n[idx])
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p
            new = n[idx] + g * g
            z[idx] += g - (np.sqrt(new) - np.sqrt(n[idx])) / alpha * w
            n[idx] = new
    return weights(z, n)


class Examples:
    """The sample on the driver, fetched a partition at a time and kept packed (feature and
    count, six bytes); vectors are made one at a time."""

    def __init__(self, sample: DataFrame, labels: list[str], idf: np.ndarray):
        self.idf, rows = idf, []
        for r in sample.toLocalIterator():
            if len(r["idx"]):
                idx, val = np.frombuffer(r["idx"], np.uint16), np.frombuffer(r["val"], np.uint32)
                rows.append((r["h"], labels.index(r["label"]), idx, val))
        self.rows = sorted(rows, key=lambda r: r[:2])

    def part(self, chosen):
        return _Part([r for k, r in enumerate(self.rows) if chosen(k)], self.idf)


class _Part:
    def __init__(self, rows, idf):
        self.rows, self.idf = rows, idf

    def __iter__(self):
        for _, y, idx, val in self.rows:
            at = idx.astype(np.int64)
            x = (1.0 + np.log(val)) * self.idf[at]
            yield np.append(at, BUCKETS), np.append(x / np.sqrt(x @ x), 1.0), y


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its log."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()

    a, b, r = -1.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches):
    df, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts = ngram_counts(text)
            if counts is not None:
                df += counts > 0
                docs += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], names=["feature", "n"])


def _features(batches):
    for batch in batches:
        idx, val = [], []
        for text in batch.column(1).to_pylist():
            counts = ngram_counts(text)
            at = np.flatnonzero(counts) if counts is not None else np.zeros(0, np.int64)
            idx.append(at.astype(np.uint16).tobytes())
            val.append(counts[at].astype(np.uint32).tobytes() if len(at) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(idx, pa.binary()), pa.array(val, pa.binary())],
            names=["label", "h", "idx", "val"],
        )


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = PER_LABEL) -> Model:
    """Train on all rows of ``docs``: document frequencies over every text, weights on
    the bounded sample of labelled rows."""
    C.bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.xxhash64(F.col(doc_id).cast("string"), F.col(doc_id).isNull()).alias("h"),
        F.col(text).alias("text"),
        F.col(label).cast("string").alias("label"),
    )
    counted = rows.select("text").mapInArrow(_frequencies, "feature long, n long")
    found = counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS + 1 rows
    df, n = np.zeros(BUCKETS), 0
    for r in found:
        if r["feature"] < 0:
            n = r["n"]
        else:
            df[r["feature"]] = r["n"]
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    # The hash below which a label has per_label documents: one row a label.
    ranked = Window.partitionBy("label").orderBy("h")
    named = rows.where("label IS NOT NULL AND text IS NOT NULL")
    cuts = (
        named.select("label", "h").withColumn("k", F.row_number().over(ranked)).where(F.col("k") <= per_label)
        .groupBy("label").agg(F.max("h").alias("top")).collect()
    )
    labels = sorted(r["label"] for r in cuts)
    model = Model(labels, idf, np.zeros((BUCKETS + 1, len(labels))), 1.0)
    if not labels:
        return model
    chosen = F.lit(False)
    for r in cuts:
        chosen = chosen | ((F.col("label") == r["label"]) & (F.col("h") <= r["top"]))
    sample = named.where(chosen).select("label", "text", "h").mapInArrow(_features, "label string, h long, idx binary, val binary")
    examples = Examples(sample, labels, idf)
    model.weights = ftrl(examples.part(lambda k: k % 5 != 4), len(labels))
    held = examples.part(lambda k: k % 5 == 4)
    logits = np.array([x @ model.weights[i] for i, x, _ in held]).reshape(-1, len(labels))
    model.temperature = temperature(logits, np.array([y for *_, y in held], np.int64))
    return model


def _predict(model):
    def run(batches):
        for batch in batches:
            out = [model.value.predict(t) for t in batch.column(1).to_pylist()]
            told = [batch.column(0), pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.float64())]
            yield pa.RecordBatch.from_arrays([*told, *batch.columns[2:]], names=["doc_id", "lang_pred", "score", *batch.schema.names[2:]])

    return run


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang_pred, score (calibrated probability of the prediction); with ``keep``
    also those columns of the document, as the struct rest."""
    spark = docs.sparkSession
    C.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x labels numbers
    rest = [F.struct(*[F.col(c) for c in keep]).alias("rest")] if keep else []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *rest)
    schema = StructType.fromDDL("doc_id long, lang_pred string, score double")
    if keep:
        schema = schema.add(rows.schema["rest"])
    return rows.mapInArrow(_predict(shared), schema)


C.ship(__name__)
