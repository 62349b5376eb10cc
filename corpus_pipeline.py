"""Corpus pipeline: documents through the stages of ``STAGES``, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
it as Parquet under the session's shared checkpoint folder and hands the table
read back to the next stage.

Rows are told apart by doc_id and a hash of all their columns, so null and repeated ids are
handled like any other: of a group of near duplicates exactly one row stays (the smallest id,
null last; of equal ids the smallest hash), and every row that is left has places of its own in
the mixture. Rows equal in every column are one document to the near-duplicate stage. Documents
without text or letters go with the language stage; a null lang or source is a value like any
other to the later stages; columns that documents has beside its own ride along, whatever their
names; an empty table gives an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import common as C
from gridlake.llm import decontaminate, langid, mixing, simhash, substring_dedup
from gridlake.session import ensure_utc

_LAST = 2**63 - 1
KEY = ["__id", "__key"]
#: A document whose language is predicted with less confidence is rejected.
MIN_LANGUAGE_SCORE = 0.3
#: How often the mixture may pass its most repeated source.
MAX_REPEATS = 2.0


def row_of(docs: DataFrame) -> Column:
    """What tells rows of one doc_id apart (also none from the largest), the same whenever it
    is computed."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def keyed(docs: DataFrame) -> DataFrame:
    """docs with the row's key, which is never null: __id and __key."""
    return docs.withColumns({"__id": F.coalesce("doc_id", F.lit(_LAST)), "__key": row_of(docs)})


def key_of(found: DataFrame, *more: Column) -> DataFrame:
    """The same key from an operator's doc_id and row."""
    return found.select(F.coalesce("doc_id", F.lit(_LAST)).alias("__id"), F.col("row").alias("__key"), *more)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or without a confident language; a null lang
    becomes the predicted one."""
    model = langid.fit(docs.where(C.crc_mod(F.col("doc_id"), 4) != 2))
    found = langid.predict(docs, model, keep=docs.columns)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    lang = F.coalesce("rest.lang", "lang_pred")
    return kept.select(*[lang.alias(c) if c == "lang" else F.col(f"rest.`{c}`") for c in docs.columns])


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of every group of near duplicates one row: that of the smallest id (null last)."""
    found = simhash.near_duplicates(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS, row=row_of(docs))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = key_of(found.groupBy("root").agg(F.min(place).alias("f")).select("f.doc_id", "f.row"))
    # Equal rows stay once; both steps share the join's partitions.
    return keyed(docs).join(first, KEY, "left_semi").dropDuplicates(KEY).select(*docs.columns)


def dedupe_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage of 20 words or more that an earlier document (or place) has;
    a document of which nothing is left goes."""
    others = [c for c in docs.columns if c != "text"]
    found = substring_dedup.factors(docs, keep=others).withColumn("cut", F.size("starts") > 0)
    new = {"text": F.col("kept_text"), "n_chars": F.when(F.col("cut"), F.length("kept_text").cast("long")).otherwise(F.col("rest.n_chars"))}
    return found.where("NOT cut OR kept_text <> ''").select(
        *[new[c].alias(c) if c in new else F.col(f"rest.`{c}`") for c in docs.columns]
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark passages."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.decisions(decontaminate.hits(docs, benchmark, keep=docs.columns))
    return found.where("NOT contaminated").select(*[F.col(f"rest.`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mixture: documents in block order, sources passed up to
    ``MAX_REPEATS`` times. Adds (or replaces) mix_pass, mix_block, mix_position."""
    plan = mixing.mix(docs, max_repeats=MAX_REPEATS, row=row_of(docs))
    plan = key_of(plan, *[F.col(k).alias(f"__{k}") for k in ("pass", "block", "position")])
    # Equal rows have a place each in the plan, and any of them fills it: one row a key meets all
    # its places. Both steps share the join's partitions.
    laid = keyed(docs).dropDuplicates(KEY).join(plan, KEY)
    kept = [c for c in docs.columns if c not in ("mix_pass", "mix_block", "mix_position")]
    return laid.select(*kept, *[F.col(f"__{k}").alias(f"mix_{k}") for k in ("pass", "block", "position")])


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", dedupe_documents),
    ("substring_dedup", dedupe_passages),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
]

#: Hash orders and a trained model have no SQL form; tests/llm checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = C.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
