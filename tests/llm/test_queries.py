from __future__ import annotations

import random

import pytest

import corpus_pipeline as pipeline
from gridlake.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC_SCHEMA
from tests.oracle_compare import compare, duck_connection


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    result = compare(spark, duck_connection(SF_SMALL), name, Q.queries()[name], Q.oracle_sql()[name], SF_SMALL)
    assert result["status"] == "ok", result


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_temperature_mix", "op2_ppm_score", "op3_token_counts", "op6_iblt_fingerprint", "op7_simhash_near_dedup"])
def test_query_covers_every_document(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = Q.queries()[name](spark, SF_SMALL)
    assert found.select("doc_id").distinct().count() == docs.count()


WORDS = [f"{a}{b}" for a in ("mar", "lin", "tor", "vel", "sun", "pal") for b in ("da", "ke", "mo", "ri", "su", "ta", "ne", "lo")]


def prose(k, n=60):
    return " ".join(random.Random(k).choices(WORDS, k=n))


def test_stages_take_effect(spark, scratch):
    shared = " ".join(f"shared{i}" for i in range(55))
    item = " ".join(f"secret{i}" for i in range(20))
    texts = {i: prose(i) for i in range(30)}
    texts |= {40: texts[3], 41: texts[4].upper(), 42: "1234 5678", 43: None, 44: "", 45: prose(90) + " " + shared, 46: prose(91) + " " + shared}
    texts |= {47: prose(92, 30) + " " + item, 48: texts[5]}
    rows = [(i, t, "xx" if i != 7 else None, f"s{i % 3}" if i != 8 else None, len(t or "")) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    docs = docs.union(docs.where("doc_id = 9"))
    extra = docs.selectExpr("*", "1 AS kept_text", "2 AS block", "3 AS id", "4 AS mix_pass", "5 AS score")
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    kept = {n: None for n, _ in pipeline.STAGES}
    for name, stage in pipeline.STAGES:
        extra = stage(spark, extra, scratch)
        extra.write.parquet(f"{scratch}/{name}")
        extra = spark.read.parquet(f"{scratch}/{name}")
        kept[name] = extra
        if name != "mix_sources":
            assert extra.columns == [*docs.columns, "kept_text", "block", "id", "mix_pass", "score"]
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in kept.items()}
    assert set(texts) - ids["language_id"] == {42, 43, 44}
    assert ids["language_id"] - ids["simhash_near_dedup"] == {40, 41, 48}
    assert kept["simhash_near_dedup"].count() == len(ids["simhash_near_dedup"])
    cut = {r.doc_id: r for r in kept["substring_dedup"].collect()}
    assert cut[46].text.split() == prose(91).split() and cut[46].n_chars == len(cut[46].text)
    assert cut[45].text == texts[45] and set(cut) == ids["simhash_near_dedup"]
    assert ids["substring_dedup"] - ids["decontaminate"] == {47}
    assert ids["mix_sources"] == ids["decontaminate"]
    run = pipeline.run(spark, scratch)
    assert run.columns == [*docs.columns, "mix_pass", "mix_block", "mix_position"]
    assert {r.doc_id for r in run.collect()} == ids["mix_sources"]


def test_pipeline_of_no_documents(spark, scratch):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert pipeline.run(spark, scratch).count() == 0


def test_rows_without_an_id_or_with_a_shared_one(spark, scratch):
    rows = [(None, prose(i), "xx", "s", 1) for i in range(12)] + [(None, prose(3).upper(), "xx", "s", 1)]
    rows += [(5, prose(40), "xx", "s", 1), (5, prose(41), "xx", "t", 1), (5, prose(40).upper(), "xx", "s", 1)]
    rows += [(6, prose(50) + " " + prose(51, 9000), "xx", "t", 1), (None, prose(41), "xx", "t", 1)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    kept = pipeline.dedupe_documents(spark, docs, scratch).collect()
    texts = [r.text.lower() for r in kept]
    assert sorted(texts) == sorted({t.lower() for _, t, *_ in rows})
    assert next(r.doc_id for r in kept if r.text == prose(41)) == 5
    twice = docs.union(docs.where("doc_id = 6"))
    laid = pipeline.mix_sources(spark, twice, scratch).collect()
    first = [r for r in laid if r.mix_pass == 1]
    assert sorted((r.doc_id or 0, r.text) for r in first) == sorted((r.doc_id or 0, r.text) for r in twice.collect())
    places = {(r.mix_block, r.mix_position) for r in laid}
    assert len(places) == len(laid)
    blocks = {b for b, _ in places}
    assert all(sorted(p for c, p in places if c == b) == list(range(sum(c == b for c, _ in places))) for b in blocks)
