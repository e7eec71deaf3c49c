"""Exact deduplication by content sort (DataFrame functions only).

Texts are equal when identical after the white space is deleted.  Rows are
range-partitioned on their normalised bytes (Spark samples the splitters; the
splitter key is a bounded prefix, a digest and a slot, so that sampling never
sends whole texts to the driver), each partition is sorted externally, equal
texts become neighbours, and the window operator compares the whole normalised
text of each row with its neighbour's to find the runs.

Hot groups: one pre-aggregated pass (map-side combined on the digest) counts
the copies of every text.  A text with more than ``max(64, rows / (8 P))``
copies (P: shuffle width) is dealt over several slots next to each other, each
a run of its own; the group's winner and size then come from the pre-aggregate.
At most 8 P texts can be that frequent, which bounds the broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolake.llm.common import WS, packed, unpacked, width
from recolake.session import materialize

PREFIX = 32  # code points of the normalised text that lead the splitter key


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row with ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` added (input columns of these names are replaced).

    Of equal texts the row with the most code points in the original text
    stays, then the smallest id (null ids last); exactly one row of a group
    has ``kept``.  A null text counts as empty; empty texts form one group; a
    group of null ids has a null ``keep_id``; an empty table gives an empty
    result.  Rows that repeat an id and a text are copies like any others.
    """
    runs, out = _runs(docs, id_col, text_col)
    return unpacked(runs, docs, out)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, with their columns as they are, that have ``kept`` in
    ``content_sort_dedup``."""
    runs, out = _runs(docs, id_col, text_col)
    return unpacked(runs.where(out["kept"]), docs, {})


def _runs(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, Column]]:
    """Rows (``row``: the input columns) at their places in the runs, and the
    output columns as expressions of them."""
    src = packed(docs, id_col, text_col)
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), f"{WS}+", "")
    size = F.char_length(F.coalesce(F.col("text"), F.lit("")))
    # how a row ranks in its group
    rank = [(-F.col("n")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("c")]

    p = width(docs)
    frequent = max(64, docs.count() // (8 * p))
    hot = materialize(
        src.select("id", F.sha2(norm, 256).alias("sha"), size.alias("n"))
        .groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*rank)).alias("best"))
        .where(F.col("copies") > frequent), "content_sort_hot")

    slots = F.ceil(F.col("copies") / F.lit(frequent))
    slot = F.pmod(F.xxhash64("id"), F.coalesce(slots, F.lit(1)))
    keyed = (src.withColumn("sha", F.sha2(norm, 256)).withColumn("prefix", F.substring(norm, 1, PREFIX))
             .join(F.broadcast(hot), "sha", "left")
             .withColumn("slot", slot))
    # A range partitioning on (prefix, sha, slot) already clusters the window's
    # keys, so the runs need no second exchange.
    dealt = keyed.repartitionByRange("prefix", "sha", "slot").withColumn("norm", norm).withColumn("n", size)
    run = Window.partitionBy("prefix", "sha", "slot", "norm")
    order = run.orderBy(F.desc("n"), F.col("id").asc_nulls_last())
    runs = (dealt.withColumn("place", F.row_number().over(order))
            .withColumn("first", F.first(F.struct(*rank)).over(order))
            .withColumn("members", F.count(F.lit(1)).over(run)))
    alone = F.col("copies").isNull()
    # the rows of one id share a slot, so one slot of a hot text holds the winner
    wins = F.col("first").eqNullSafe(F.col("best"))
    return runs, {
        "keep_id": F.when(alone, F.col("first.c")).otherwise(F.col("best.c")),
        "group_size": F.coalesce(F.col("copies"), F.col("members")).cast("long"),
        "kept": (F.col("place") == 1) & F.when(alone, F.lit(True)).otherwise(wins),
        "text_sha256": F.col("sha"),
    }
