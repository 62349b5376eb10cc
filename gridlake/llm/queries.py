"""The ``opN_*`` queries: each applies one operator to its whole table, with the
parameters used in production, and derives the contract's columns from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common as C
from gridlake.llm import alignment, chat, decontaminate, html_text, iblt, langid, mixing, ppm, simhash, substring_dedup, token_scan, warc, whitening
from gridlake.llm.sql import ORACLE
from gridlake.session import ensure_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_temperature_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), max_repeats=2.0)


def op2_ppm_score(spark, sf_dir):
    held_out = C.crc_mod(F.col("doc_id"), 7) == 2
    found = ppm.scores(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_token_counts(spark, sf_dir):
    written = token_scan.write(table(spark, sf_dir, "documents"))
    counted = token_scan.scan(written.select("path"))
    # Both sides have a row per document; the file of the one is small only because its paths compress.
    return written.join(counted.hint("merge"), ["path", "ordinal"]).select("doc_id", "n_tokens", "ended")


def op4_decontaminate(spark, sf_dir):
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.decisions(found)


def op5_warc_chunks(spark, sf_dir):
    archives = warc.write(table(spark, sf_dir, "pages"), revisit_min_bytes=0)
    read = warc.records(warc.chunks(spark, archives))
    return read.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op6_iblt_fingerprint(spark, sf_dir):
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = C.crc_mod(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_html_main_text(spark, sf_dir):
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_substring_dedup(spark, sf_dir):
    found = substring_dedup.factors(table(spark, sf_dir, "documents"))
    kept = F.array_join(C.words(F.col("kept_text")), " ")
    return found.select(
        "doc_id",
        "n_words",
        substring_dedup.removed_words().alias("n_removed"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def op11_embedding_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    found = found.select("vec_id", "n", "deviation", "identity_error", each)
    return found.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


def op12_token_alignment(spark, sf_dir):
    told = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return alignment.align(table(spark, sf_dir, "documents"), show={"groups_sha256": told})


def op13_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    return chat.read(chat.write(given.union(more)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
