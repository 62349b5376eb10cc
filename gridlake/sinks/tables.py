"""Partitioned Parquet tables with staged, idempotent partition publishing.

Without a table format, a MERGE is: read the target *only in the partitions
the batch touches* (a literal partition filter), compute the merged rows there
(``revision_merge`` / ``upsert``), write them to
``<lake>/_staging/<table>/<batch_id>`` and then replace exactly those partitions by
renaming the staged folders.

* The staged copy cuts the lineage between the read of the target and its
  replacement, and it lives in the table's own (shared) storage.
* Publishing is idempotent: a partition is replaced when its staged folder is still
  there, and left alone when it was moved before. A crash between staging and publishing is
  repaired by ``recover``, which every merge runs first, so a later merge always starts
  from the recovered rows.
* One writer at a time: a merge holds the table's lock. A lock whose copy is complete is
  recovered and taken over; one whose writer may still be writing raises ``TableBusy``.
* Rows are dealt to files by partition before they are staged, so a partition gets as many
  files as its size asks for, not one per task.

Limits: readers may see a partition being replaced. When an Iceberg or Delta catalog is
configured, use its ``MERGE`` instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake.operators.revisions import revision_merge, upsert

STAGING = "_staging"
PUBLISHED = "_PUBLISHED"
STAGED = "_STAGED"
LOCK = "_LOCK"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
TARGET_FILE_BYTES = 256 * 1024 * 1024
#: Stored bytes of a batch's input that a task is to take.
TASK_BYTES = 64 * 1024 * 1024


class TableBusy(RuntimeError):
    """Another writer holds the table."""


# -- file system helpers (driver-side metadata calls only) --------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _fs(spark, source)
    _, t = _fs(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise RuntimeError(f"could not move {source} to {target}")


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p)]


def _name(path: str) -> str:
    return path.rstrip("/").split("/")[-1]


def _is_data(path: str) -> bool:
    return not _name(path).startswith(("_", "."))


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the table folder holds data files or partitions."""
    return any(_is_data(c) for c in _children(spark, path))


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders (relative to ``path``), ``depth`` levels down."""
    found = [""]
    for _ in range(depth):
        found = [f"{x}/{_name(c)}".lstrip("/") for x in found for c in _children(spark, f"{path}/{x}") if _is_data(c)]
    return found


def file_sizes(spark: SparkSession, path: str, partition_cols: Sequence[str] = ()) -> dict[str, list[int]]:
    """Bytes of each data file by partition folder, from the file listing."""
    out: dict[str, list[int]] = {}
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return out
    if fs.getFileStatus(p).isFile():
        return {"": [fs.getFileStatus(p).getLen()]}
    for leaf in _leaves(spark, path, len(partition_cols)):
        _, folder = _fs(spark, f"{path}/{leaf}")
        out[leaf] = [
            s.getLen() for s in fs.listStatus(folder) if s.isFile() and _is_data(s.getPath().getName())
        ]
    return out


# -- reads ---------------------------------------------------------------------
def read_table(spark: SparkSession, path: str, like: DataFrame | StructType) -> DataFrame:
    """The table with the declared columns and types (partition columns too), or an empty
    frame of that shape before the first publish."""
    schema = like if isinstance(like, StructType) else like.schema
    if has_data(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return spark.createDataFrame([], schema)


# -- one writer ------------------------------------------------------------------
def _lock_path(table_path: str) -> str:
    return f"{staging_dir(table_path)}/{LOCK}"


def acquire(spark: SparkSession, table_path: str, batch_id: str, partition_cols: Sequence[str]) -> None:
    """Take the table's lock for ``batch_id`` (a replay of the same batch keeps it)."""
    lock = _lock_path(table_path)
    if exists(spark, lock):
        holder = _read_text(spark, lock)
        if holder == batch_id:
            return
        copy = f"{staging_dir(table_path)}/{holder}"
        if not exists(spark, f"{copy}/{STAGED}"):
            raise TableBusy(f"{table_path}: batch {holder} is being written (break_lock() if its writer is gone)")
        recover(spark, table_path, partition_cols)
        _delete(spark, lock)
    try:
        _write_text(spark, lock, batch_id, overwrite=False)
    except Exception as exc:  # created by another writer just now
        raise TableBusy(f"{table_path}: taken by another writer") from exc


def release(spark: SparkSession, table_path: str) -> None:
    _delete(spark, _lock_path(table_path))


def break_lock(spark: SparkSession, table_path: str) -> None:
    """Drop the lock of a writer known to be gone; its incomplete copy is never published."""
    release(spark, table_path)


# -- publishing ----------------------------------------------------------------
def staging_dir(table_path: str) -> str:
    parent, name = table_path.rstrip("/").rsplit("/", 1)
    return f"{parent}/{STAGING}/{name}"


def deal(df: DataFrame, table_path: str, partition_cols: Sequence[str], leaves: Sequence[str] | None = None) -> DataFrame:
    """Rows dealt by partition, a large partition over several files: as many as the
    largest of the stored partitions concerned would fill."""
    sizes = file_sizes(df.sparkSession, table_path, partition_cols)
    largest = max((sum(v) for k, v in sizes.items() if leaves is None or k in leaves), default=0)
    files = max(1, -(-largest // TARGET_FILE_BYTES))
    if not partition_cols:
        return df.repartition(files)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    return df.repartition(*[F.col(c) for c in partition_cols], salt)


def dealt_tasks(spark: SparkSession, source: DataFrame, table_path: str, partition_cols: Sequence[str], partitions: int) -> int:
    """Over how many tasks to deal a batch made of ``source`` by its key: a multiple of
    ``partitions``, by the size of the files it is read from and of the largest stored partition."""
    names, given = set(source.inputFiles()), 0  # as URIs
    for folder in {name.rsplit("/", 1)[0] for name in names}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(folder))
        listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
        given += sum(s.getLen() for s in listed if s.getPath().toUri().toString() in names)
    largest = max((sum(v) for v in file_sizes(spark, table_path, partition_cols).values()), default=0)
    return partitions * max(1, -(-given // (partitions * TASK_BYTES)), -(-largest // TARGET_FILE_BYTES))


def stage(df: DataFrame, table_path: str, batch_id: str, partition_cols: Sequence[str]) -> str:
    """Write the staged copy, then mark it complete (the mark lists what it holds)."""
    spark = df.sparkSession
    path = f"{staging_dir(table_path)}/{batch_id}"
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
    held = _leaves(spark, path, len(partition_cols)) if partition_cols else [_name(c) for c in _children(spark, path) if _is_data(c)]
    _write_text(spark, f"{path}/{STAGED}", "\n".join(held))
    return path


def publish(spark: SparkSession, table_path: str, batch_id: str, partition_cols: Sequence[str]) -> None:
    """Replace the table's partitions that the staged copy holds, by renaming."""
    staged = f"{staging_dir(table_path)}/{batch_id}"
    held = [x for x in _read_text(spark, f"{staged}/{STAGED}").split("\n") if x]
    table = table_path.rstrip("/")
    for item in held:
        if exists(spark, f"{staged}/{item}"):  # else it was moved before a crash
            _delete(spark, f"{table}/{item}")
            _rename(spark, f"{staged}/{item}", f"{table}/{item}")
    if not partition_cols:
        for old in _children(spark, table):
            if _is_data(old) and _name(old) not in held:
                _delete(spark, old)
    _write_text(spark, f"{staged}/{PUBLISHED}", "")


def recover(spark: SparkSession, table_path: str, partition_cols: Sequence[str]) -> list[str]:
    """Publish every complete staged batch that was never published, oldest first."""
    waiting = []
    for child in _children(spark, staging_dir(table_path)):
        if exists(spark, f"{child}/{STAGED}") and not exists(spark, f"{child}/{PUBLISHED}"):
            fs, mark = _fs(spark, f"{child}/{STAGED}")
            waiting.append((fs.getFileStatus(mark).getModificationTime(), _name(child)))
    for _, batch_id in sorted(waiting):
        publish(spark, table_path, batch_id, partition_cols)
    return [batch_id for _, batch_id in sorted(waiting)]


def write_partitions(
    spark: SparkSession, df: DataFrame, table_path: str, batch_id: str, partition_cols: Sequence[str]
) -> None:
    """Stage then publish ``df``'s partitions (idempotent per batch id)."""
    acquire(spark, table_path, batch_id, partition_cols)
    try:
        recover(spark, table_path, partition_cols)
        stage(deal(df, table_path, partition_cols), table_path, batch_id, partition_cols)
        publish(spark, table_path, batch_id, partition_cols)
    finally:
        release(spark, table_path)


def in_partitions(partition_cols: Sequence[str], values: Sequence[tuple]) -> Column:
    """Literal filter on partition values (None included): prunes the scan's folders."""
    if len(partition_cols) == 1:
        c, known = F.col(partition_cols[0]), [v for (v,) in values if v is not None]
        found = c.isin(known) if known else F.lit(False)
        return found | c.isNull() if any(v is None for (v,) in values) else found
    cond = F.lit(False)
    for row in values:
        match = F.lit(True)
        for c, v in zip(partition_cols, row):
            match = match & F.col(c).eqNullSafe(F.lit(v))
        cond = cond | match
    return cond


def check_layout(spark: SparkSession, table_path: str, partition_cols: Sequence[str]) -> None:
    """A table stored by other partition columns is not merged into: its rows would not be found."""
    other = [_name(c) for c in _children(spark, table_path) if _is_data(c) and not _name(c).startswith(f"{partition_cols[0]}=")] if partition_cols else []
    if other:
        raise ValueError(f"{table_path} is not partitioned by {partition_cols[0]} but holds {other[0]}: rewrite it first")


def touched_target(spark: SparkSession, table_path: str, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Target rows in the partitions the batch writes to. The touched partition values
    (bounded by the days or buckets of a batch, not by its rows) are read on the driver
    and become a literal filter, so the scan lists those folders only."""
    target = read_table(spark, table_path, batch)
    if not partition_cols or not has_data(spark, table_path):
        return target
    values = [tuple(r) for r in batch.select(*partition_cols).distinct().collect()]
    return target.where(in_partitions(partition_cols, values))


def merge_into(
    spark: SparkSession,
    table_path: str,
    schema: StructType,
    batch: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    batch_id: str,
    version: str | None = "fetched_at",
    merge_fn=None,
    tasks: int | None = None,
) -> None:
    """Revision-aware (``version``) or unconditional (``version=None``) MERGE
    of ``batch`` into the table at ``table_path``; ``merge_fn(target, batch)``
    replaces the merge rule when given. The partition must be a function of the key.

    The batch is evaluated once (kept for the merge), whatever its plan. ``tasks``: the batch is
    dealt by its keys over so many tasks, each holding rows of one partition; stored rows are
    dealt alike, and the merged rows are written as they lie.
    """
    cols = [f.name for f in schema.fields] + [c for c in partition_cols if c not in schema.fieldNames()]
    check_layout(spark, table_path, partition_cols)
    acquire(spark, table_path, batch_id, partition_cols)
    batch = batch.select(*cols)
    kept = batch.storageLevel != StorageLevel.NONE  # by the caller
    if not kept:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        recover(spark, table_path, partition_cols)
        target = touched_target(spark, table_path, batch, partition_cols)
        if tasks:  # an empty table too: a union is dealt as its sides are
            target = target.repartition(tasks, *keys)
        if merge_fn is not None:
            merged = merge_fn(target, batch).select(*cols)
        elif version:
            merged = revision_merge(target, batch, keys, version)
        else:
            merged = upsert(target, batch, keys)
        dealt = merged if tasks else deal(merged, table_path, partition_cols)
        stage(dealt, table_path, batch_id, partition_cols)
        publish(spark, table_path, batch_id, partition_cols)
    finally:
        if not kept:
            batch.unpersist()
        release(spark, table_path)


# -- upkeep ----------------------------------------------------------------------
def expire_staged(spark: SparkSession, table_path: str, older_than: dt.datetime, retain_last: int) -> int:
    """Delete the folders of published batches older than ``older_than``, always
    keeping the newest ``retain_last``. Unpublished copies are kept for ``recover``.
    ``older_than`` must be timezone-aware. Returns the number of folders deleted."""
    if older_than.tzinfo is None:
        raise ValueError("older_than must be timezone-aware")
    cutoff_ms = int(older_than.timestamp() * 1000)
    fs, root = _fs(spark, staging_dir(table_path))
    if not fs.exists(root):
        return 0
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    published = sorted(
        (
            (fs.getFileStatus(jpath(st.getPath(), PUBLISHED)).getModificationTime(), st.getPath())
            for st in fs.listStatus(root)
            if st.isDirectory() and fs.exists(jpath(st.getPath(), PUBLISHED))
        ),
        key=lambda pair: pair[0],
        reverse=True,
    )
    deleted = 0
    for mtime, path in published[retain_last:]:
        if mtime < cutoff_ms:
            fs.delete(path, True)
            deleted += 1
    return deleted


def _folder(partition_cols: Sequence[str]) -> Column:
    """A row's partition folder, as the listing names it."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER))) for c in partition_cols]
    return F.concat_ws("/", *parts) if parts else F.lit("")


def table_files(spark: SparkSession, table_path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Files and rows per partition: files from the listing, rows from a scan without
    columns (Parquet footers)."""
    listed = [(k, len(v)) for k, v in file_sizes(spark, table_path, partition_cols).items()]
    files = spark.createDataFrame(listed, "folder string, files long")
    rows = spark.read.parquet(table_path).groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("rows"))
    joined = rows.withColumn("folder", _folder(partition_cols)).join(files, "folder")
    return joined.select(*partition_cols, "files", "rows")


def compact(
    spark: SparkSession,
    table_path: str,
    partition_cols: Sequence[str],
    batch_id: str,
    min_input_files: int = 5,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> dict[str, int]:
    """Rewrite partitions holding at least ``min_input_files`` files into
    files of about ``target_file_bytes``; rows are unchanged and a second
    run finds nothing to do. Returns rewritten and added file counts."""
    acquire(spark, table_path, batch_id, partition_cols)
    try:
        recover(spark, table_path, partition_cols)
        sizes = file_sizes(spark, table_path, partition_cols)
        chosen = {k: max(1, -(-sum(v) // target_file_bytes)) for k, v in sizes.items() if len(v) >= min_input_files}
        if not chosen:
            return {"rewritten_files": 0, "added_files": 0}
        df = spark.read.parquet(table_path)
        if partition_cols:
            outputs = spark.createDataFrame(list(chosen.items()), "__folder string, __outputs int")
            rows = df.withColumn("__folder", _folder(partition_cols)).where(F.col("__folder").isin(list(chosen)))
            salt = F.pmod(F.xxhash64(*df.columns), F.col("__outputs"))
            rows = rows.join(outputs, "__folder").repartition(sum(chosen.values()), "__folder", salt)
            rewritten = rows.select(*df.columns)
        else:
            rewritten = df.repartition(chosen[""])
        staged = stage(rewritten, table_path, batch_id, partition_cols)
        added = sum(len(v) for v in file_sizes(spark, staged, partition_cols).values())
        publish(spark, table_path, batch_id, partition_cols)
        return {"rewritten_files": sum(len(sizes[k]) for k in chosen), "added_files": added}
    finally:
        release(spark, table_path)
