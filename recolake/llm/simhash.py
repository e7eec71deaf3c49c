"""SimHash near-duplicates through deletion-variant signatures.

A document's fingerprint is the bitwise majority over the XXH64 of its word
shingles.  Two fingerprints within three bits differ by at most one bit in one
of their two 32-bit halves, so each distinct fingerprint is indexed by

* its two halves as they are (2 keys), and
* each half with one bit taken out, for every bit (64 keys).

Fingerprints that meet under an exact key are compared with each other; under
a one-wildcard key only those that differ in the wildcard bit are (the others
meet under the exact key already).  Every match is verified on all 64 bits.

Copies: documents of one fingerprint are collapsed first.  A key that many
fingerprints share is cut into blocks and compared block against block; a
comparison emits a spanning forest of its links, never all pairs, so output
grows with the members.  Components come from alternating large-star and
small-star rounds over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recolake.session import materialize

BITS, HALF = 64, 32
BLOCK = 1024  # fingerprints of one key compared in one block
CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None, k: int, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: A-Z lower-cased, words split at
    ASCII white space, ``k``-word shingles with repeats; a text of fewer words
    is one shingle; without words (or null) it is 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(k, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends, starts = ends[k - 1:].tolist(), starts[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, dtype=np.int64), len(starts)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return src.mapInArrow(scan, f"doc_id {id_type}, fp long")


def _index(fps: DataFrame) -> DataFrame:
    """(key, side, fp): key numbers half and wildcard (0: none) in its upper
    bits and holds the half's remaining bits below; side is the wildcard bit."""
    halves = F.array(*[F.struct(F.lit(i).alias("h"), v.alias("v")) for i, v in enumerate(
        (F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))))])
    rows = fps.select("fp", F.explode(halves).alias("x")).select("fp", "x.h", "x.v", F.explode(
        F.sequence(F.lit(0), F.lit(HALF))).alias("w"))
    bit = F.when(F.col("w") > 0, F.expr(f"element_at(array({','.join(f'{1 << i}L' for i in range(HALF))}), w)"))
    rows = rows.withColumn("bit", F.coalesce(bit, F.lit(0)))
    return rows.select(
        (((F.col("h") * (HALF + 1) + F.col("w")).cast("long") * F.lit(1 << HALF))
         + F.col("v").bitwiseAND(F.bitwise_not("bit"))).alias("key"),
        (F.col("v").bitwiseAND(F.col("bit")) != 0).alias("side"), "fp")


def _forest(fp: np.ndarray, side: np.ndarray, block: np.ndarray, wild: bool, cross: bool,
            bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph on ``fp`` that joins those at
    ``bits`` or fewer differing bits (across sides for a wildcard key, across
    blocks for a pair of blocks)."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    if wild:
        near &= side[:, None] != side[None, :]
    if cross:
        near &= block[:, None] != block[None, :]
    unseen = np.ones(len(fp), dtype=bool)
    links = []
    for root in range(len(fp)):
        if not unseen[root]:
            continue
        unseen[root] = False
        stack = [root]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(near[u] & unseen)
            unseen[new] = False
            links += [(u, v) for v in new.tolist()]
            stack += new.tolist()
    return links


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b), a > b as signed longs, whose components are those of the
    graph that joins distinct fingerprints at ``bits`` <= 3 differing bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves guarantee one with at most one differing bit only up to 3 bits")
    by_key = Window.partitionBy("key")
    shared = (_index(fps)
              .withColumn("n", F.count(F.lit(1)).over(by_key))
              .withColumn("both", F.min("side").over(by_key) != F.max("side").over(by_key))
              .withColumn("wild", F.pmod(F.shiftright("key", HALF), F.lit(HALF + 1)) > 0)
              .where(F.when(F.col("wild"), F.col("both")).otherwise(F.col("n") > 1))
              .withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    # each block goes to its pairing with every block of its key
    paired = (shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "side", "fp", "wild", "block", F.least("block", "other").alias("p"),
                      F.greatest("block", "other").alias("q"))
              .repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = ["key", "p", "q", "fp", "side", "block", "wild"]
        rest = None
        for b in _and_last(batches):
            t = {c: b.column(c).to_numpy(zero_copy_only=False) for c in cols} if b is not None else None
            if rest is not None:
                t = {c: np.concatenate((rest[c], t[c])) for c in cols} if t else rest
            if not t or not len(t["key"]):
                continue
            new = np.flatnonzero((np.diff(t["key"]) != 0) | (np.diff(t["p"]) != 0) | (np.diff(t["q"]) != 0)) + 1
            edges = [0, *new.tolist()]
            if b is None:
                edges.append(len(t["key"]))
            out = []
            for i, j in zip(edges, edges[1:]):
                fp = t["fp"][i:j].view(np.uint64)
                out += [(fp[u], fp[v]) for u, v in _forest(
                    fp, t["side"][i:j], t["block"][i:j], bool(t["wild"][i]), t["p"][i] != t["q"][i], bits)]
            rest = {c: t[c][edges[-1]:] for c in cols}
            if out:
                pairs = np.array(out, dtype=np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1)), pa.array(pairs.min(axis=1))],
                                                 ["a", "b"])

    return paired.mapInArrow(compare, "a long, b long").distinct()


def _and_last(batches):
    """The batches, then None."""
    yield from batches
    yield None


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of
    ``edges`` (a, b with a > b), by alternating large-star and small-star."""
    edges = materialize(edges.select("a", "b").where("a <> b"), "cc")
    while True:
        before = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not before[0]:
            break
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.where("a <> b"), "cc")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "cc")
        if edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _named(hashed: DataFrame, bits: int) -> DataFrame:
    """``fp``, the ``least`` doc_id of each fingerprint, and the ``root`` that
    names its component."""
    nodes = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_nodes")
    roots = components(links(nodes.select("fp"), bits))
    return (nodes.join(roots, nodes.fp == roots.node, "left")
            .select("fp", "least", F.coalesce("root", "fp").alias("root")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest
    doc_id whose fingerprint is reachable over links of ``bits`` or fewer
    differing bits.  Null and empty texts have fingerprint zero and link like
    any other.  Null ids never name a component unless all its ids are null.
    Rows that repeat an id keep a row each.  An empty table gives an empty
    result.  Other input columns, whatever their names, are not read.
    """
    hashed = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash_fp")
    named = _named(hashed, bits)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = named.join(least, "root").select("fp", "component_id")
    return (hashed.join(label, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    bits: int = 3) -> DataFrame:
    """The input rows without near duplicates: of each group the row of the
    smallest id stays (null ids last), of several with that id the one whose
    text has the smallest SHA-256, and one of those that share it too.  A null
    text counts as empty; an empty table gives an empty result; the columns come
    back as they are, whatever their names."""
    named = F.col(f"`{id_col}`")
    # names a row but for those equal in id and text; a null id adds nothing to it
    name = F.concat_ws("|", F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256), named.cast("string")).alias("name")
    places = docs.select(F.struct(named.isNull().alias("unknown"), named.alias("id"), name).alias("place"),
                         F.col(f"`{text_col}`").alias("text"))
    hashed = materialize(fingerprints(places, "place", "text", shingle), "simhash_fp")
    stay = _named(hashed, bits).groupBy("root").agg(F.min("least").alias("least")).select("least.name")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name)
    # the same join at every size; its partitions are those of the window
    nth = F.row_number().over(Window.partitionBy("name").orderBy("name"))
    return (rows.join(stay.hint("merge"), "name", "left_semi").withColumn("nth", nth).where("nth = 1")
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
