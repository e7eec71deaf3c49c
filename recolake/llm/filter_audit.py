"""Audit of how filters interact: what each removes at its place in every order.

A document's failures are a bit mask.  Per part, the counts of the masks form a
decision diagram: a level per filter, a pass and a fail edge per node, equal
nodes shared, each node weighted by the documents below it.  Along the
all-pass path of an order, the fail edge of a level carries what this filter
removes there and the pass edge what is kept.  All orders are visited by
swapping neighbouring levels, one swap per order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolake.session import materialize

Count = tuple[int, int, int]  # documents, good ones, toxic ones


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels k (k and k + 1 are swapped) whose swaps visit every order of n
    filters once, from the order as given: the last filter wanders through each
    order of the others."""
    if n < 2:
        return
    last, inner = n - 1, adjacent_swaps(n - 1)
    while True:
        down = list(range(last - 1, -1, -1))
        yield from down
        k = next(inner, None)
        if k is None:
            return
        yield k + 1  # the wanderer stands in front
        yield from reversed(down)
        k = next(inner, None)
        if k is None:
            return
        yield k  # the wanderer stands at the end


@dataclass(frozen=True, eq=False)
class Node:
    low: "Node | None"  # documents that pass the level's filter
    high: "Node | None"
    weight: Count


class Diagram:
    """Count-weighted decision diagram of failure masks (bit k: filter k fails)."""

    def __init__(self, n: int, counts: dict[int, Count]):
        self.order = list(range(n))
        self._nodes: dict[tuple, Node] = {}
        self.root = self._build(counts, 0, 0)

    def _build(self, counts: dict[int, Count], level: int, mask: int) -> Node:
        if level == len(self.order):
            return self._leaf(counts.get(mask, (0, 0, 0)))
        return self._node(self._build(counts, level + 1, mask), self._build(counts, level + 1, mask | 1 << level))

    def _leaf(self, weight: Count) -> Node:
        return self._nodes.setdefault(weight, Node(None, None, weight))

    def _node(self, low: Node, high: Node) -> Node:
        key = (id(low), id(high))  # nodes live as long as the diagram, so ids are theirs
        if key not in self._nodes:
            self._nodes[key] = Node(low, high, tuple(map(sum, zip(low.weight, high.weight))))
        return self._nodes[key]

    def swap(self, level: int) -> None:
        """The filters of ``level`` and the next one change places.  Nodes below
        stay as they are; those above are rebuilt over the new ones."""
        done: dict[tuple[Node, int], Node] = {}

        def rebuilt(node: Node, depth: int) -> Node:
            if (node, depth) not in done:
                if depth < level:
                    new = self._node(rebuilt(node.low, depth + 1), rebuilt(node.high, depth + 1))
                else:
                    new = self._node(self._node(node.low.low, node.high.low), self._node(node.low.high, node.high.high))
                done[node, depth] = new
            return done[node, depth]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Count, Count]]:
        """Along the all-pass path: the filter, what it removes, what is kept."""
        node = self.root
        for f in self.order:
            yield f, node.high.weight, node.low.weight
            node = node.low

    def only(self) -> dict[int, int]:
        """Documents that fail one filter alone."""
        out, node = {}, self.root
        for k, f in enumerate(self.order):
            end = node.high
            for _ in self.order[k + 1:]:
                end = end.low
            out[f] = end.weight[0]
            node = node.low
        return out


def audit_part(counts: dict[int, Count], filters: str) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) of every order and step."""
    n = len(filters)
    fails = {f: sum(c[0] for mask, c in counts.items() if mask >> f & 1) for f in range(n)}
    diagram = Diagram(n, counts)
    only, total, rows = diagram.only(), dict.fromkeys(range(n), 0), []
    swaps = adjacent_swaps(n)
    while True:
        order = "".join(filters[f] for f in diagram.order)
        for step, (f, gone, kept) in enumerate(diagram.steps(), 1):
            total[f] += gone[0]
            rows.append((order, step, kept[0], gone[0], fails[f] - gone[0], only[f], gone[1], gone[2], f))
        level = next(swaps, None)
        if level is None:
            break
        diagram.swap(level)
    return [(*r[:-1], total[r[-1]]) for r in rows]


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """Rows of AUDIT for every part of ``counts`` (part, mask, n, good, toxic; a
    mask stands once per part).  A part has at most 2 ** len(filters) rows
    here, whatever its documents; parts are spread over the tasks."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        by_mask = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in pdf.itertuples()}
        rows = [(pdf["part"].iloc[0], *r) for r in audit_part(by_mask, filters)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in AUDIT.split(", ")])

    return counts.groupBy("part").applyInPandas(run, AUDIT)


UPPER = bytes(range(65, 91))
SYMBOLS = re.compile(rb"[#$%&*|]")


def failures(text: bytes) -> int:
    """Bits of the text's own filters: A under 100 words, B 100 x distinct words
    under 80 x words, C 100 x capitals A-Z over 10 x code points, D a symbol."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * capitals > 10 * points) << 2
            | (SYMBOLS.search(text) is not None) << 3)


FILTERS = "ABCDE"


def with_failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` (failures A to D) and ``digest`` (SHA-256
    of the text; two different texts share one with odds under 2 ** -128 even
    among 2 ** 60 texts)."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{part_col}`").cast("string").alias("part"),
                      F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = np.empty(b.num_rows, dtype=np.int32)
            digests = []
            for k, t in enumerate(b.column("text")):
                text = t.as_py() or b""
                masks[k] = failures(text)
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(masks),
                                              pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    return src.mapInArrow(scan, f"doc_id {kind}, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """Documents (n), good ones (quality 1) and toxic ones (toxic 1) by part and
    mask of failures, E being bit 4.

    E fails for a row if a smaller id has the same text.  Rows are counted by
    text and id first, so copies are summed before the shuffle and no text, how
    often it ever stands, meets whole in one task.
    """
    marks = (labels.groupBy(F.col(f"`{id_col}`").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    rows = materialize(with_failures(docs, id_col, text_col, part_col).withColumn("part", F.coalesce("part", F.lit(""))),
                       "filter_failures")
    rows = (rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
            .join(marks, "doc_id", "left"))
    kinds = ["digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
             F.coalesce("toxic", F.lit(0)).alias("toxic")]
    # of every kind of row of a text: how many there are, the least id and how many have it
    texts = rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"),
                                     F.min_by("n", "doc_id").alias("n_first"))
    least = texts.groupBy("digest").agg(F.min("first").alias("least"))
    both = texts.join(least, "digest").select(
        "part", "mask", "good", "toxic", "n",
        # without any id in the text's rows none is smaller
        F.when(F.col("least").isNull(), F.col("n")).when(F.col("first") == F.col("least"), F.col("n_first"))
        .otherwise(F.lit(0)).alias("passing"))
    split = both.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), F.col("passing").alias("n")),
        F.struct((F.col("mask") + F.lit(16)).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))).alias("m"))
    return (split.select("part", "good", "toxic", "m.mask", "m.n").where("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                 F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """AUDIT of the five filters A to E over ``docs``: one row per part (value of
    ``part_col``; null: the empty string), order of the filters and step.

    A null text counts as empty: no word, so it fails A alone (and E, if a
    smaller id has an empty text too).  Repeated rows count each; of equal
    texts all rows of the smallest id pass E, and a null id is larger than any
    (rows of null id alone all pass).  A label counts if any of the document's
    label rows has it; documents without labels, or without id, are neither
    good nor toxic.  Parts are those of the table, so an empty one gives no row.
    Other columns, whatever their names, are not read.
    """
    return audit(mask_counts(docs, labels, id_col, text_col, part_col), FILTERS)
