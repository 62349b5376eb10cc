"""Token counts of flat token files by a separator scan.

A file is nothing but token ids of one width, each document ended by the
end-of-document id; there is no index. Files are cut into blocks that tasks read on
their own; inside a block the separators are found by one vectorised comparison. A
document that runs over a block boundary is stitched by a prefix scan over the blocks of
its file: the tokens since the last separator are carried in, and the separators before
a block number its documents.

Defined cases: an empty document has 0 tokens; tokens after the last separator are a
document that is not ``ended``; an empty file has no document; a file that isn't a whole
number of tokens fails. Writing: a null text is empty, repeated rows are written again, an
empty table writes no file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common as C

BLOCK_TOKENS = 1 << 22
FILE_TOKENS = 1 << 29
END = 50256
#: A public vocabulary (ranks, one per line): where the box keeps it.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# --- Fixed values: the public split pattern of byte-level BPE ------------------
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# -----------------------------------------------------------------------------


def encoder(vocabulary: str):
    """text -> token ids, by a public byte-level BPE vocabulary."""
    import base64

    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _write(folder: str, vocabulary: str, dtype: str, end: int, file_tokens: int):
    def run(batches):
        encode, (fs, base) = encoder(vocabulary), C.storage(folder)
        fs.create_dir(base, recursive=True)
        out, name, ordinal, size = None, "", 0, 0
        for batch in batches:
            paths, ordinals = [], []
            for text in batch.column(1).to_pylist():
                if out is None or size >= file_tokens:
                    if out is not None:
                        out.close()
                    name, ordinal, size = f"{uuid.uuid4().hex}.bin", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                ids = encode(text) if text else []
                out.write(np.array([*ids, end], dtype).tobytes())
                paths.append(f"{folder}/{name}")
                ordinals.append(ordinal)
                ordinal, size = ordinal + 1, size + len(ids) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.string()), pa.array(ordinals, pa.int64())], names=["doc_id", "path", "ordinal"]
            )
        if out is not None:
            out.close()

    return run


def write(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    dtype: str = "uint16",
    end: int = END,
    file_tokens: int = FILE_TOKENS,
    folder: str | None = None,
) -> DataFrame:
    """Write the documents as flat token files; returns where each went (doc_id, path,
    ordinal). Only files of finished tasks are named there."""
    spark = docs.sparkSession
    C.bounded_batches(spark)
    folder = folder or C.scratch_path(spark, "tokens")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return C.cut(rows.mapInArrow(_write(folder, vocabulary, dtype, end, file_tokens), "doc_id long, path string, ordinal long"), "tokens-written")


def _lengths():
    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            sizes = []
            for p in paths:
                fs, name = C.storage(p)
                sizes.append(fs.get_file_info(name).size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return run


def scan_block(tokens: np.ndarray, end: int) -> tuple[int, int, int, int, list[int]]:
    """(tokens, separators, tokens before the first separator, tokens after the last,
    lengths of the documents between). Without a separator all tokens are 'after'."""
    at = np.flatnonzero(tokens == end)
    if not len(at):
        return len(tokens), 0, 0, len(tokens), []
    return len(tokens), len(at), int(at[0]), int(len(tokens) - 1 - at[-1]), (np.diff(at) - 1).tolist()


def _scan(dtype: str, end: int, block_bytes: int):
    width = np.dtype(dtype).itemsize

    def run(batches):
        for batch in batches:
            for path, size, block in zip(*(c.to_pylist() for c in batch.columns)):
                if size % width:
                    raise ValueError(f"{path}: {size} bytes are no whole number of {dtype} tokens")
                fs, name = C.storage(path)
                with fs.open_input_file(name) as f:
                    raw = f.read_at(min(block_bytes, size - block * block_bytes), block * block_bytes)
                n, seps, head, tail, inner = scan_block(np.frombuffer(raw, dtype), end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), *(pa.array([x], pa.int64()) for x in (block, seps, head, tail)), pa.array([inner], pa.list_(pa.int64()))],
                    names=["path", "block", "seps", "head", "tail", "inner"],
                )

    return run


def scan(paths: DataFrame, dtype: str = "uint16", end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token files (column ``path``) -> path, ordinal, n_tokens, ended: one row per
    document, the separator not counted."""
    spark = paths.sparkSession
    block_bytes = block_tokens * np.dtype(dtype).itemsize
    sized = C.cut(paths.select("path").distinct().mapInArrow(_lengths(), "path string, bytes long"), "token-files")
    blocks = sized.where("bytes > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bytes - 1) div {block_bytes}"))))
    dealt = blocks.repartition("path", "block")
    found = dealt.mapInArrow(_scan(dtype, end, block_bytes), "path string, block long, seps long, head long, tail long, inner array<long>")
    in_file = Window.partitionBy("path").orderBy("block")
    so_far = in_file.rowsBetween(Window.unboundedPreceding, 0)
    # A block with a separator starts a new run; its tail and the blocks after it are open.
    stitched = (
        found.withColumn("run", F.sum(F.when(F.col("seps") > 0, 1).otherwise(0)).over(so_far))
        .withColumn("open", F.sum("tail").over(Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("carried", F.coalesce(F.lag("open").over(in_file), F.lit(0)))
        .withColumn("before", F.sum("seps").over(so_far) - F.col("seps"))
        .withColumn("final", F.lead("block").over(in_file).isNull())
    )
    ended = F.when(F.col("seps") > 0, F.concat(F.array(F.col("carried") + F.col("head")), "inner")).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("final") & (F.col("open") > 0), F.array("open")).otherwise(F.array().cast("array<bigint>"))
    return (
        stitched.select("path", "before", "seps", F.posexplode(F.concat(ended, rest)).alias("k", "n_tokens"))
        .select("path", F.expr("before + k").alias("ordinal"), "n_tokens", F.expr("k < seps").alias("ended"))
    )


C.ship(__name__)
