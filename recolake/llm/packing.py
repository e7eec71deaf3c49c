"""Best-fit packing of documents into sequences under several capacities.

Documents are cut into pieces only where they are longer than a sequence.
Pieces are dealt at random into buckets of bounded size, and each bucket is
packed on its own: in descending length, every piece goes to the open sequence
that fits it under all capacities - tokens, pieces and attention cost (sum of
squared lengths) - with the smallest weighted norm of what is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolake.llm.tokens import encoder, strings
from recolake.session import materialize

BUCKET = 4096  # pieces packed together


def cut(docs: DataFrame, tokenizer: str, length: int, end_id: int, id_col: str, text_col: str,
        keep_ids: bool = False, cache: int | None = None) -> DataFrame:
    """Pieces of every row: doc_id, uid (numbers the piece), piece, start,
    length, ids_crc32 and, on request, ids."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], dtype="<i4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, uid = encoder(tokenizer, cache), TaskContext.get().partitionId() << 40
        for b in batches:
            rows: list[tuple] = []
            size = 0
            for i, ids in enumerate(enc.encode(strings(b.column("text")))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else b""))
                    size += len(rows[-1][5]) + 64
                if size >= 1 << 22 or i == b.num_rows - 1:
                    at, k, start, n, crc, part = zip(*rows)
                    cols = [b.column("doc_id").take(pa.array(at)), pa.array(range(uid, uid + len(rows)), pa.int64()),
                            pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                            pa.array(crc, pa.int64())]
                    names = ["doc_id", "uid", "piece", "start", "length", "ids_crc32"]
                    if keep_ids:
                        cols.append(pa.ListArray.from_arrays(
                            pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)),
                            pa.array(np.frombuffer(b"".join(part), dtype="<i4"))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)
                    uid += len(rows)
                    rows, size = [], 0

    return src.mapInArrow(pieces, f"doc_id {id_type}, uid long, piece int, start long, length long, ids_crc32 long"
                          + ", ids array<int>" * keep_ids)


def best_fit(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float],
             ) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, longest pieces first.

    A piece is charged (length, 1, length squared).  Among the open sequences
    it fits under every capacity, the one with the least weighted norm of the
    residual shares takes it, the oldest in a tie; a piece that fits none opens
    a sequence, and takes one for itself if it alone exceeds the pieces or cost."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    cap, w = np.array(capacity, dtype=float), np.sqrt(np.array(weights, dtype=float))
    seq, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    left = np.empty((64, 3))  # residual capacities of the open sequences
    name = np.empty(64, dtype=np.int64)
    least = int(lengths.min()) if n else 0
    live = made = 0
    for i in order.tolist():
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        rest = left[:live] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            at = int(fits[np.argmin((((rest[fits] / cap) * w) ** 2).sum(axis=1))])
        else:
            if live == len(left):
                left, name = np.concatenate((left, np.empty_like(left))), np.concatenate((name, np.empty_like(name)))
            at, left[live], name[live] = live, cap, made
            live, made = live + 1, made + 1
        seq[i], offset[i] = name[at], cap[0] - left[at, 0]
        left[at] -= need
        if (left[at] < [least, 1, float(least) ** 2]).any():  # nothing to come fits it
            live -= 1
            left[at], name[at] = left[live], name[live]
    return seq, offset


def pack(docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 1, max_pieces: int | None = None,
         max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False, cache: int | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids on request).

    A row's ids are those of its whole text (null: empty) and ``end_id``; only
    longer ones than ``length`` are cut.  No sequence holds more than ``length``
    tokens, ``max_pieces`` pieces or ``max_cost`` attention cost (None: as much
    as the tokens allow).  Rows that repeat an id are packed like any others; an
    empty table gives an empty result; other input columns are not read.
    ``cache`` bounds the pieces of text that a worker remembers (``tokens.CACHE``).
    """
    pieces = materialize(cut(docs, tokenizer, length, end_id, id_col, text_col, keep_ids, cache), "pieces")
    capacity = (float(length), float(max_pieces or length), float(max_cost or length * length))
    if capacity[2] < length * length:
        raise ValueError("max_cost must admit a piece of full length")
    buckets = max(1, -(-pieces.count() // BUCKET))
    # the ids stay where they are; a bucket holds numbers only
    dealt = pieces.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(buckets)).alias("bucket"))

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        seq, offset = best_fit(pdf["length"].to_numpy(), capacity, weights)
        return pd.DataFrame({"uid": pdf["uid"], "sequence_id": (int(key[0]) << 32) + seq, "offset": offset})

    placed = dealt.groupBy("bucket").applyInPandas(place, "uid long, sequence_id long, offset long")
    return pieces.join(placed, "uid").drop("uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)
