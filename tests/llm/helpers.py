"""Small tables and brute-force pieces for the operator tests."""

from __future__ import annotations

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(UPPER, UPPER.lower())


def docs_of(spark, texts, **columns):
    """documents with doc_id 0.. (or given ids) and texts; other columns constant."""
    rows = [
        (i, t, columns.get("lang", "en"), columns.get("source", "s"), None if t is None else len(t))
        for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def lower(text):
    return (text or "").translate(_LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
