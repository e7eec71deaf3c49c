"""Periodic runs of words by a descending-LCP Kruskal over suffix classes.

Suffixes of a text are sorted by prefix doubling; neighbours in this order are
edges weighted by their longest common prefix (LCP).  Taken by falling weight,
an edge unites two classes of suffixes, each an ordered set of positions, so
the members of a class share at least the current LCP.  Two positions i < j
that become neighbours in a united set have exactly this LCP l; if their
distance p is no more than l, words i to j + l repeat with period p, and they
are a run if the word before i breaks the period.  Every run is seeded at its
first position s: no member of the class of s and s + p stands between them, as
it would give the run a smaller period.

Many texts share one numpy pass for sorting.  Edges below ``lcp_floor`` are
left out: no run of the wanted size is seeded there.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 17  # words sorted in one numpy pass; a longer text is a pass of its own

Run = tuple[int, int, int]  # start, length, period


def lcp_floor(min_length: int, min_exponent: int) -> int:
    """The least LCP that seeds a run of the wanted size: a run of period p has
    max(min_length, min_exponent * p) words or more, all but p in the LCP."""
    return min(max(min_length, min_exponent * p) - p for p in range(1, max(min_length, 1) + 1))


def suffix_edges(words: np.ndarray, text: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share ``floor`` (1 or more) words, as two
    positions and their LCP, by falling LCP.  ``words`` are numbers, ``text``
    (never falling) says whose; no common prefix leaves its text."""
    n = len(words)
    if not n:
        return (np.zeros(0, dtype=np.int64),) * 3
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    # a class's rank is the place of its first member in the order, so a round
    # that splits classes leaves the others' ranks as they are
    dense, size = np.unique(words.astype(np.int64) + text.astype(np.int64) * (int(words.max()) + 1),
                            return_inverse=True, return_counts=True)[1:]
    rank = (np.cumsum(size) - size)[dense].astype(np.int32)
    ranks, depth = [rank], 1  # ranks[k]: order by the first 2 ** k words
    alive = np.flatnonzero(size[dense] > 1)
    while len(alive):
        beyond = alive + depth
        key = rank[alive].astype(np.int64) * (n + 1)
        key += np.where(beyond < end[alive], rank[np.minimum(beyond, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        alive, key = alive[order], key[order]
        old, place = rank[alive], np.arange(len(alive))
        split = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.concatenate(([True], old[1:] != old[:-1]))
        first = np.maximum.accumulate(np.where(split, place, 0))
        rank = rank.copy()
        rank[alive] = old + first - np.maximum.accumulate(np.where(group, place, 0))
        ranks.append(rank)
        depth *= 2
        single = split & np.append(split[1:], True)
        alive = alive[~single]
    near = floor.bit_length() - 1
    if near >= len(ranks):
        return (np.zeros(0, dtype=np.int64),) * 3
    kept = np.flatnonzero(np.bincount(ranks[near], minlength=n)[ranks[near]] > 1)
    order = kept[np.argsort(rank[kept], kind="stable")]
    a, b = order[:-1], order[1:]
    same = ranks[near][a] == ranks[near][b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = a + lcp, b + lcp
        inside = (i < end[a]) & (j < end[b])
        lcp += (inside & (ranks[k][np.minimum(i, n - 1)] == ranks[k][np.minimum(j, n - 1)])).astype(np.int64) << k
    order = np.argsort(-lcp, kind="stable")
    order = order[:int(np.count_nonzero(lcp >= floor))]
    return a[order], b[order], lcp[order]


def find_runs(words: np.ndarray, text: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> dict[int, list[Run]]:
    """Runs of each text that has one, by start and period, starts counted from
    the text's first word.  ``min_exponent`` is 2 or more."""
    first = {int(t): int(i) for t, i in zip(*np.unique(text, return_index=True))}
    classes: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}  # start and length: least period
    edges = (x.tolist() for x in suffix_edges(words, text, lcp_floor(min_length, min_exponent)))
    of = text.tolist()
    words = words.tolist()

    def seed(i: int, j: int, lcp: int) -> None:
        p = j - i
        if lcp >= (min_exponent - 1) * p and p + lcp >= min_length and (
                i == 0 or of[i - 1] != of[i] or words[i - 1] != words[j - 1]):
            found[i, p + lcp] = min(p, found.get((i, p + lcp), p))

    for a, b, lcp in zip(*edges):
        large, small = classes.setdefault(a, [a]), classes.setdefault(b, [b])
        if len(large) < len(small):
            large, small = small, large
        last = len(small) - 1
        for k, x in enumerate(small):
            at = bisect_left(large, x)
            if at and (k == 0 or small[k - 1] < large[at - 1]):
                seed(large[at - 1], x, lcp)
            if at < len(large) and (k == last or small[k + 1] > large[at]):
                seed(x, large[at], lcp)
        if last:
            large += small
            large.sort()
        else:
            insort(large, small[0])
        for x in small:
            classes[x] = large
    out: dict[int, list[Run]] = {}
    for (start, length), period in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        t = of[start]
        out.setdefault(t, []).append((start - first[t], length, period))
    return out


def strongest(runs: list[Run]) -> Run:
    """The run of greatest length / period; ties: smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words, without those that a run contains after its first period."""
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period:start + length] = b"\1" * (length - period)
    return b" ".join([w for w, g in zip(words, gone) if not g])


RUN = "struct<start: long, length: long, period: long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  min_exponent: int = 4) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length and
    period, by start, then period), strongest (the run of greatest length /
    period, null without runs) and kept_text (words that no run contains after
    its first period, joined by one space).

    Words are maximal runs of other characters than space and the controls 9 to
    13.  Null, empty and white texts have no word, no run and an empty
    kept_text; repeated rows and rows with a null id are treated one by one; an
    empty table gives an empty result.  Columns beside the id and the text,
    whatever their names, are not read.  A text is worked on whole, in memory
    that grows with its length alone.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def work(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in texts], dtype=np.int64)
        codes: dict[bytes, int] = {}
        words = np.fromiter((codes.setdefault(w, len(codes)) for t in texts for w in t), dtype=np.int64,
                            count=int(sizes.sum()))
        runs = find_runs(words, np.repeat(np.arange(len(texts)), sizes), min_length, min_exponent)
        as_dict = lambda r: dict(zip(("start", "length", "period"), r))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids) if ids else pa.array([]), pa.array(sizes),
             pa.array([[as_dict(r) for r in runs.get(k, ())] for k in range(len(texts))], pa.list_(_RUN)),
             pa.array([as_dict(strongest(runs[k])) if k in runs else None for k in range(len(texts))], _RUN),
             pa.array([collapse(t, runs.get(k, ())) for k, t in enumerate(texts)], pa.binary())],
            ["doc_id", "n_words", "runs", "strongest", "kept_text"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, size = [], [], 0
            for k, t in enumerate(b.column("text")):
                own = (t.as_py() or b"").split()
                if size and size + len(own) > CHUNK:
                    yield work(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(b.column("doc_id").slice(k, 1))
                texts.append(own)
                size += len(own)
            if texts:
                yield work(ids, texts)

    return (src.mapInArrow(scan, f"doc_id {kind}, n_words long, runs array<{RUN}>, strongest {RUN}, kept_text binary")
            .withColumn("kept_text", F.col("kept_text").cast("string")))
