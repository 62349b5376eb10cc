"""Shared pieces of the llm operators: scratch tables, text blocks, SQL pieces."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import ensure_checkpoint_dir

# --- Fixed values: word patterns of the contracts ------------------------------
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE_CLASS = r"[\x20\x09-\x0D]"
# -----------------------------------------------------------------------------

#: Text bytes of one block: what a Python task holds at a time, whatever the
#: size of the corpus (one longer document is a block of its own size).
BLOCK_BYTES = 8_000_000


def ship(module_name: str) -> None:
    """Send a module's functions to the Python workers by value, so that they do
    not need this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what crosses to Python at a time: whole texts travel in batches of
    at most ``rows`` rows (a smaller setting of the session stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: ends the
    lineage and computes it once. A lost executor loses nothing of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def storage(uri: str):
    """(file system, path) of a URI or absolute path, for byte access inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as the text '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def block_count(df: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many hash blocks keep a block near ``block_bytes`` (one cheap scan)."""
    total = df.agg(F.sum(F.octet_length(F.col(text)) + F.lit(64))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def block_of(id_col: Column, n: int, *more: Column) -> Column:
    """The hash block of a row; ``more`` (its text) spreads rows that share an id or have none."""
    return F.pmod(F.xxhash64(id_col, *more), F.lit(n)).cast("int")


ship(__name__)
