"""Token ids as Parquet list columns.

Documents are range-partitioned and sorted by id, encoded, and written by
Spark's Parquet writer: one file per partition in id order, ids as a
dictionary-encoded list column, the counters delta-encoded, bounded row groups
and pages, with page indexes.  A reader that asks for ``doc_id`` and
``n_tokens`` touches no token page, and a range of ids touches only the row
groups and pages that hold it.  An ``index`` table beside the files has the ids
before each file, so a document's position in the whole sequence is its file's
plus the one stored with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recolake.llm.tokens import encoder, strings

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # delta encodings where no dictionary is used
    "parquet.block.size": 32 << 20,
    "parquet.page.size": 256 << 10,
    "parquet.page.row.count.limit": 2000,
    "parquet.dictionary.page.size": 1 << 20,
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#local_start": "false",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", layout: dict | None = None, cache: int | None = None) -> None:
    """Write ``path``/tokens (doc_id, file, local_start, n_tokens, ids) in
    ascending id order (null ids first, rows of one id by text) and
    ``path``/index (file, start, n_tokens, n_docs).

    ``tokenizer`` is the place of a vocabulary file of the tokenizers library,
    on every executor; ``cache`` bounds the pieces that a worker remembers (see
    ``tokens.CACHE``).  ``end_id`` ends every document; a null text counts as
    empty; repeated rows are written once each; an empty table writes empty
    tables; other input columns are not read.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    # the digest spreads rows that share an id
    ordered = (src.withColumn("digest", F.xxhash64("text")).repartitionByRange("doc_id", "digest")
               .sortWithinPartitions("doc_id", "digest", "text").select("doc_id", "text"))
    end = np.array([end_id], dtype="<i4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file, at = encoder(tokenizer, cache), TaskContext.get().partitionId(), 0
        for b in batches:
            held: list[bytes] = []
            done = size = 0
            n = b.num_rows
            for i, ids in enumerate(enc.encode(strings(b.column("text"))), 1):
                held.append(ids + end)
                size += len(ids) + 4
                if size >= 1 << 22 or i == n:  # bounded batches, also for long texts
                    counts = np.array([len(x) // 4 for x in held], dtype=np.int64)
                    ends = np.cumsum(counts)
                    values = pa.array(np.frombuffer(b"".join(held), dtype="<i4"))
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        b.column("doc_id").slice(done, len(held)), pa.array(np.full(len(held), file, dtype=np.int32)),
                        pa.array(at + ends - counts), pa.array(counts), pa.ListArray.from_arrays(offsets, values),
                    ], ["doc_id", "file", "local_start", "n_tokens", "ids"])
                    at += int(ends[-1])
                    done, held, size = i, [], 0

    tokens = ordered.mapInArrow(encode, f"doc_id {id_type}, file int, local_start long, n_tokens long, ids array<int>")
    tokens.write.options(**(LAYOUT | (layout or {}))).parquet(f"{path}/tokens")
    # reads the counters alone; one row per file
    files = (spark.read.parquet(f"{path}/tokens").groupBy("file")
             .agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs")))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    (files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/index"))


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    the named columns of the files under ``path``."""
    tokens = spark.read.parquet(f"{path}/tokens")
    # one row per file
    index = F.broadcast(spark.read.parquet(f"{path}/index").select("file", F.col("start").alias("file_start")))
    return tokens.join(index, "file").select(
        "doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", *columns)


def with_ids_crc32(tokens: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Replace the ids by ``ids_crc32``: unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers."""
    keep = [c for c in tokens.columns if c != ids_col]
    schema = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in keep) + ", ids_crc32 long"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(ids_col)
            at, flat = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<i4")).cast("B")
            crc = [zlib.crc32(flat[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(crc, pa.int64())],
                                             [*keep, "ids_crc32"])

    return tokens.mapInArrow(digest, schema)
