"""Repeated line runs by a suffix order over line identifiers.

Every document is a sequence of its lines that hold a visible character.  The
suffixes that start at each line are ranked by distributed prefix doubling:
ranks of length 1 order the lines, and the ranks of length 2h order the pairs
(rank of length h here, rank of length h a step of h further).  A rank that only
one suffix has cannot be part of a repeat of that length; it leaves, and the
doubling ends when no rank is shared.

The suffixes of one rank of length h are an interval of the suffix order in
which all longest common prefixes reach h.  In each interval the earliest suffix
stays and the h lines at the others are later copies.  A repeat of any length
from h to 2h is covered by the intervals of length h at its first and last h
lines, so the lengths ``run``, 2 ``run``, 4 ``run`` ... reveal every repeated run
whole; overlapping ones join into the maximal ones, which are deleted.

Lines are compared by two 64-bit hashes: among 10^12 different lines two share
both with odds of about 10^-15.

A line in a third of all documents is one rank: its group is counted with
map-side combining, and rows meet their rank in a sort-merge join, which Spark
splits where it is skewed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolake.llm.common import WS, packed, unpacked
from recolake.session import materialize

PLACE = ["id", "digest", "at"]  # a line: its document and its number among the document's lines


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{WS[1:-1]}]"))


def _ranked(rows: DataFrame, parts: list[str], name: str) -> DataFrame:
    """The rows whose ``parts`` occur at least twice, with ``rank`` (rises with
    the parts) and ``first`` (the earliest place) of their group."""
    groups = (rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*PLACE)).alias("first"))
              .where("n > 1").repartitionByRange(*parts).sortWithinPartitions(*parts)
              .select(*parts, "first", F.monotonically_increasing_id().alias("rank")))
    groups = materialize(groups, f"{name}_ranks")
    return materialize(rows.join(groups, parts).select(*PLACE, "rank", "first"), name)


def _doubled(rows: DataFrame, step: int) -> DataFrame:
    """Each suffix with its rank ``a`` and the rank ``b`` of the one ``step``
    lines on; suffixes without such a one leave."""
    by_at = Window.partitionBy("id", "digest").orderBy("at").rangeBetween(step, step)
    return (rows.withColumn("b", F.max("rank").over(by_at)).where("b IS NOT NULL")
            .select(*PLACE, F.col("rank").alias("a"), "b"))


def _later(rows: DataFrame, length: int) -> DataFrame:
    """Runs of ``length`` lines that also start at an earlier line."""
    return rows.where(F.struct(*PLACE) > F.col("first")).select(*PLACE, F.lit(length).alias("length"))


def repeated_runs(docs: DataFrame, run: int = 2, min_words: int | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Maximal runs of lines to delete: id, digest (of the text), first_line and
    n_lines, counted from 0 over the lines with a visible character, and longest
    (the greatest length at which an interval has lines of it).

    A run is deleted where ``run`` consecutive lines of it also start at an
    earlier line, and so is a single line of ``min_words`` words or more;
    documents are in order of id (null first), then digest."""
    words = F.regexp_count(F.col("line"), F.lit(f"[^{WS[1:-1]}]+"))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("digest"),
                      F.posexplode(_lines(F.col(f"`{text_col}`"))).alias("at", "line"))
    src = src.select(*PLACE, F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
                     (words >= (1 << 30 if min_words is None else min_words)).alias("long")).dropDuplicates(PLACE)
    long = src.where("long").select(*PLACE, "a", "b") if min_words is not None and run > 1 else None
    rows, length = _ranked(src.drop("long"), ["a", "b"], "line_suffixes"), 1
    found = []
    if long is not None:
        found.append(_later(rows.join(long.select(*[F.col(c).alias(f"_{c}") for c in PLACE]), [
            F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE], "left_semi"), 1))
    while length < run:
        step = min(length, run - length)
        rows, length = _ranked(_doubled(rows, step), ["a", "b"], "line_suffixes"), length + step
    while not rows.isEmpty():
        found.append(_later(rows, length))
        rows, length = _ranked(_doubled(rows, length), ["a", "b"], "line_suffixes"), 2 * length
    found = found or [_later(rows, length)]
    later = found[0]
    for more in found[1:]:
        later = later.unionAll(more)
    by_doc = Window.partitionBy("id", "digest").orderBy("at", "length")
    end = F.max(F.col("at") + F.col("length")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    return (later.withColumn("new", F.coalesce(F.col("at") > end, F.lit(True)))
            .withColumn("nth", F.sum(F.col("new").cast("int")).over(by_doc))
            .groupBy("id", "digest", "nth")
            .agg(F.min("at").alias("first_line"), F.max(F.col("at") + F.col("length")).alias("end"),
                 F.max("length").alias("longest"))
            .select("id", "digest", "first_line", (F.col("end") - F.col("first_line")).alias("n_lines"), "longest"))


def line_dedup(docs: DataFrame, run: int = 2, min_words: int | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Every input row with ``n_lines``, ``n_removed`` (lines with a visible
    character, and those of them deleted), ``kept_text`` and ``kept_sha256``
    (hex of its UTF-8) added; input columns of these names are replaced.

    Lines without a visible character are no part of runs and stay.  Null and
    empty texts have no lines; the kept text of null is empty.  Rows that
    repeat an id and a text are one document and get the same result; an empty
    table gives an empty result.
    """
    if run < 1:
        raise ValueError("run must be at least 1")
    runs = (repeated_runs(docs, run, min_words, id_col, text_col).groupBy("id", "digest")
            .agg(F.collect_list(F.struct("first_line", "n_lines")).alias("runs")))  # bounded by the document
    runs = materialize(runs, "line_runs").withColumnsRenamed({"id": "run_id", "digest": "run_digest"})
    src = packed(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    # runs grow with the texts: the same join at every size, never a broadcast
    met = src.join(runs.hint("merge"), F.col("id").eqNullSafe(F.col("run_id")) & (F.col("digest") == F.col("run_digest")), "left")

    def rebuild(texts: pa.Array, found: pa.Array) -> pa.Array:
        total, gone, kept, sha = [], [], [], []
        for text, at in zip(texts.to_pylist(), found.to_pylist()):
            lines = (text or "").split("\n")
            full = np.array([bool(x.encode().strip(b" \t\x0b\x0c\r")) for x in lines])
            drop = np.zeros(int(full.sum()), dtype=bool)
            for r in at or ():
                drop[r["first_line"]:r["first_line"] + r["n_lines"]] = True
            stays = ~full
            stays[full] = ~drop
            out = "\n".join(x for x, s in zip(lines, stays) if s)
            total.append(len(drop))
            gone.append(int(drop.sum()))
            kept.append(out)
            sha.append(hashlib.sha256(out.encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
             pa.array(sha, pa.string())], ["n_lines", "n_removed", "kept_text", "kept_sha256"])

    udf = F.arrow_udf(rebuild, "struct<n_lines: long, n_removed: long, kept_text: string, kept_sha256: string>")
    done = met.withColumn("done", udf("text", "runs"))
    return unpacked(done, docs, {c: F.col(f"done.{c}") for c in ("n_lines", "n_removed", "kept_text", "kept_sha256")})
