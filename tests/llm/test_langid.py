from __future__ import annotations

import pyarrow.parquet as pq

from gridlake.llm import langid as L
from gridlake.llm import queries as Q
from tests.conftest import SF_MID
from tests.llm.helpers import docs_of, empty_docs, rows_by_id


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in Q.op8_language_id(spark, SF_MID).collect()}
    table = pq.read_table(f"{SF_MID}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()
    held = [(r["lang"], found[r["doc_id"]]) for r in table if found[r["doc_id"]].held_out]
    assert len(found) == len(table) and len(held) > 150
    assert sum(lang == f.lang_pred for lang, f in held) / len(held) > 0.98
    assert all(0 <= f.score <= 1 for f in found.values())


def test_counts_do_not_depend_on_the_slices(monkeypatch):
    text = "Ünïcode  Straße 123 naïve -- ǅ 漢字 " * 40
    whole = L.ngram_counts(text)
    assert whole is not None and whole.sum() > 1000
    for absent in (None, "", "12 !? \n", "\U0001f600"):
        assert L.ngram_counts(absent) is None
    monkeypatch.setattr(L, "_SLICE", 1 << 20)
    assert (L.ngram_counts(text) == whole).all()


def test_edge_cases(spark):
    en, fr = "the thing with the words of a text ", "les mots que nous avons dans une phrase "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 3), "en" if i % 2 else "fr", "s", 0) for i in range(40)]
    rows += [(100, None, "en", "s", 0), (101, en, None, "s", 0), (102, "", "fr", None, None), (None, fr, "fr", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS label", "2 AS h", "3 AS score")
    model = L.fit(docs, per_label=15)
    assert model.labels == ["en", "fr"]
    asked = docs_of(spark, {1: en, 2: fr, 3: None, 4: "", 5: "42 !", 6: fr * 20_000, None: en})
    got = rows_by_id(L.predict(asked, model))
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 6, None)] == ["en", "fr", "und", "und", "und", "fr", "en"]
    assert got[3].score == 0
    bare = L.fit(empty_docs(spark))
    assert [r.lang_pred for r in L.predict(docs_of(spark, [en]), bare).collect()] == ["und"]
    assert L.predict(empty_docs(spark), model).count() == 0
