"""Repeated passages across documents, located by sharded Aho-Corasick automata.

A window is ``window`` consecutive words; it goes where its words also start a
window in a document with a smaller id.

1. Anchors.  Of the half-length word grams inside a window, the one of least
   hash is its anchor, so equal windows have equal anchors.  Runs of windows
   with one anchor are one row each (a thirteenth of the windows).  An anchor
   found in one document only has no repeated window.
2. Confirmed passages.  Where all occurrences of an anchor agree on every word
   its windows touch, the first document to hold it holds all those windows
   first.  Where they differ, the windows themselves are grouped.  Either way
   each repeated window gets its holder, the first document with it, and a
   holder's windows join into passages.
3. Automata.  Holders are dealt into shards of bounded size.  A shard's
   passages are cut into half-window blocks, one of which lies whole in every
   window of theirs, and compiled into one automaton over word numbers.  The
   documents that share a window with a holder of the shard (known from step 2)
   are streamed through it whole; every block found is extended to both sides,
   word by word, and counts from ``window`` words on.  A shard that many
   documents visit is copied to several tasks.

Hashes only choose candidates; what is removed has been compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recolake.session import materialize

SHARD_WORDS = 250_000  # passage words in a shard, about
SHARD_DOCS = 2_000  # documents streamed through one copy of a shard, about
CHUNK = 50_000  # words of a holder that stay together
KEY = ["id", "digest"]  # a document; the digest of its text tells rows of one id apart

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)  # masks of the first bytes
LONG = 64  # bytes of a word beyond which it is hashed on its own
TOGETHER = 1 << 16  # bytes of texts hashed in one go


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash and the place of every word of a text, eight bytes of all words
    at a time."""
    white = np.ones(len(text) + 2, bool)
    _WHITE.take(np.frombuffer(text, np.uint8), out=white[1:-1])
    edge = np.flatnonzero(white[1:] != white[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    eights = np.ndarray(len(text) + 1, "<u8", text + bytes(8), 0, (1,))  # the eight bytes from every place on
    h = size.astype(np.uint64)
    at, left, own = start, size, None
    for _ in range(0, LONG, 8):
        lane = eights.take(at) & _LOW.take(left, mode="clip")
        if own is None:
            h = _mix(h * np.uint64(_BASE) ^ lane)
        else:
            h[own] = _mix(h[own] * np.uint64(_BASE) ^ lane)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        own = more if own is None else own[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(text[start[i]:start[i] + size[i]])
    return h, start


class Hashed:
    """Hashes of every span of a word sequence, by prefix sums modulo 2^64."""

    def __init__(self, h: np.ndarray):
        self.n = len(h)
        power, self.inverse = _power_tables(self.n)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[:self.n], dtype=np.uint64)))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        at = np.arange(self.n - k + 1)
        return self.spans(at, at + k)


def _hashed(texts: Iterable[bytes]) -> Iterator[Hashed]:
    """Each text's words hashed, short texts together."""
    def together(some: list[bytes]) -> Iterator[Hashed]:
        h, start = _word_hashes(b" ".join(some))
        end = np.cumsum([len(t) + 1 for t in some])
        cut = np.searchsorted(start, end).tolist()
        return (Hashed(h[i:j]) for i, j in zip([0, *cut], cut))

    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= TOGETHER:
            yield from together(held)
            held, size = [], 0
    yield from together(held)


def anchor_runs(words: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window, number of windows and context hash of every
    run of windows that share an anchor occurrence."""
    return _anchor_runs(next(_hashed([b" ".join(words)])), window)


def _anchor_runs(hashed: Hashed, window: int) -> tuple[np.ndarray, ...]:
    half = window // 2
    grams = hashed.grams(half)
    best = np.lib.stride_tricks.sliding_window_view(grams, window - half + 1).argmin(axis=1)
    best += np.arange(len(best))
    first = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
    count = np.diff(np.concatenate((first, [len(best)])))
    shape = (count * 1009 + (best[first] - first)).astype(np.uint64)
    return grams[best[first]], first, count, _mix(hashed.spans(first, first + count - 1 + window) ^ _mix(shape))


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("digest"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))


@F.arrow_udf(T.BinaryType())
def _squeeze(texts: pa.Array) -> pa.Array:
    z = zstandard.ZstdCompressor(level=1)
    return pa.array([z.compress(t.as_py()) for t in texts], pa.binary())


def _inflated(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(z)


def _unsqueeze(z: bytes) -> list[bytes]:
    return _inflated(z).split()


def _keyed(rows: list[tuple], batch: pa.RecordBatch, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    """Rows (row of the batch, values...) as KEY and the named columns."""
    cols = list(zip(*rows))
    at = pa.array(np.concatenate([np.full(len(v), i, dtype=np.int64) for i, v in zip(cols[0], cols[1])]))
    return pa.RecordBatch.from_arrays(
        [batch.column(c).take(at) for c in KEY] + [pa.array(np.concatenate(c), t) for c, t in zip(cols[1:], types)],
        KEY + names)


def _scan_anchors(window: int):
    names = ["anchor", "start", "n", "context"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for i, hashed in enumerate(_hashed(t.as_py() for t in b.column("text"))):
                if hashed.n >= window:
                    a, start, n, c = _anchor_runs(hashed, window)
                    rows.append((i, a.view(np.int64), start.astype(np.int32), n.astype(np.int32), c.view(np.int64)))
                    held += len(a)
                if held > 200_000:
                    yield _keyed(rows, b, names, types)
                    rows, held = [], 0
            if rows:
                yield _keyed(rows, b, names, types)
    return scan


def _scan_windows(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            # documents with windows to look at
            some = np.flatnonzero(pc.list_value_length(b.column("runs")).to_numpy(zero_copy_only=False) > 0).tolist()
            for i, hashed in zip(some, _hashed(_inflated(b.column("z")[i].as_py()) for i in some)):
                runs = b.column("runs")[i].as_py()
                at = np.unique(np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs]))
                rows.append((i, hashed.spans(at, at + window).view(np.int64), at.astype(np.int32)))
                held += len(at)
                if held > 200_000:
                    yield _keyed(rows, b, ["w", "start"], [pa.int64(), pa.int32()])
                    rows, held = [], 0
            if rows:
                yield _keyed(rows, b, ["w", "start"], [pa.int64(), pa.int32()])
    return scan


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint (start, end) of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut_passages(window: int):
    """Passages of the holders: words joined by spaces, passages by newlines."""
    def cut(z: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(z, runs):
            words = _unsqueeze(text.as_py())
            spans = merged([(r["start"], r["start"] + r["n"] - 1 + window) for r in found.as_py()])
            out.append(zstandard.ZstdCompressor(level=1).compress(b"\n".join(b" ".join(words[a:e]) for a, e in spans)))
        return pa.array(out, pa.binary())
    return F.arrow_udf(cut, "binary")


def _common(a: str, i: int, b: str, j: int, step: int) -> int:
    """Equal characters of ``a`` from ``i`` and ``b`` from ``j``, to the right
    (step 1) or to the left of them (step -1)."""
    most = min(len(a) - i, len(b) - j) if step > 0 else min(i, j)
    if most <= 0 or a[i if step > 0 else i - 1] != b[j if step > 0 else j - 1]:
        return 0
    n, size = 0, 64
    while n < most:
        size = min(size, most - n)
        x, y = ((a[i + n:i + n + size], b[j + n:j + n + size]) if step > 0 else
                (a[i - n - size:i - n], b[j - n - size:j - n]))
        if x == y:
            n, size = n + size, size * 2
        elif size == 1:
            break
        else:
            size = max(1, size // 2)
            most = min(most, n + 2 * size + 1)
    return n


class Shard:
    """The automaton of a shard's passages."""

    def __init__(self, window: int):
        self.window, self.block = window, window // 2
        self.number: dict[bytes, str] = {}
        self.passages: list[tuple] = []  # holder, word numbers as characters
        self.automaton = None

    def add(self, holder, passages: bytes) -> None:
        for p in zstandard.ZstdDecompressor().decompressobj().decompress(passages).split(b"\n"):
            numbers = []
            for w in p.split():
                numbers.append(self.number.setdefault(w, chr(len(self.number) + 1)))
            self.passages.append((holder, "".join(numbers)))

    def compile(self) -> None:
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.passages):
            for at in range(0, len(text) - self.block + 1, self.block):
                places.setdefault(text[at:at + self.block], []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for block, at in places.items():
            self.automaton.add_word(block, at)
        self.automaton.make_automaton()

    def locate(self, doc_id, words: list[bytes]) -> list[tuple[int, int]]:
        """Spans (start, end) of ``words`` equal to ``window`` words or more of
        a passage whose holder has a smaller id."""
        if self.automaton is None:
            self.compile()
        if not self.passages:
            return []
        number = self.number.get
        text = "".join([number(w, "\0") for w in words])
        gone, reached, size, block = bytearray(len(text)), {}, len(text), self.block
        for last, places in self.automaton.iter(text):
            at = last - block + 1
            for k, there in places:
                holder, passage = self.passages[k]
                if not holder < doc_id:
                    continue
                shift = at - there
                # nothing new where the whole passage would lie on words that go
                if gone.find(0, max(0, shift), min(size, shift + len(passage))) < 0 or reached.get((k, shift), -1) > at:
                    continue
                right = _common(text, at + block, passage, there + block, 1) + block
                left = _common(text, at, passage, there, -1)
                reached[k, shift] = at + right
                if left + right >= self.window:
                    gone[at - left:at + right] = b"\1" * (left + right)
        spans, at = [], gone.find(1)
        while at >= 0:
            end = gone.find(0, at)
            end = size if end < 0 else end
            spans.append((at, end))
            at = gone.find(1, end)
        return spans


def _stream(window: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = Shard(window), None
        for b in batches:
            at, start, n = [], [], []
            cols = [b.column(c).to_pylist() for c in ("shard", "salt", "kind", "id")]
            for i, (s, salt, kind, doc_id) in enumerate(zip(*cols)):
                if (s, salt) != name:
                    shard, name = Shard(window), (s, salt)
                z = b.column("z")[i].as_py()
                if kind == 0:
                    shard.add(doc_id, z)
                    continue
                for a, e in shard.locate(doc_id, _unsqueeze(z)):
                    at.append(i)
                    start.append(a)
                    n.append(e - a)
            if at:
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(pa.array(at)) for c in KEY] + [pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                    [*KEY, "start", "n"])
    return stream


def _shard_of(holder: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(f"{holder}.id", f"{holder}.digest", F.floor(F.col(f"{holder}.start") / CHUNK)),
                  F.lit(shards)).cast("int")


def repeated_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   ) -> tuple[DataFrame, DataFrame]:
    """Spans to remove (id, digest, start, n, in words; they may overlap) and
    the documents they are in (id, digest, z: the zstd-compressed text).

    Documents of null id have no place in the order of ids: they neither hold
    nor lose passages."""
    if window < 2:
        raise ValueError("a window has at least two words")
    src = _packed(docs, id_col, text_col).where("id IS NOT NULL")
    id_type = src.schema["id"].dataType.simpleString()
    place = F.struct("id", "digest", "start")
    anchors = materialize(src.mapInArrow(
        _scan_anchors(window), f"id {id_type}, digest long, anchor long, start int, n int, context long"), "anchors")
    shared = (anchors.groupBy("anchor")
              .agg(F.min(place).alias("holder"), F.max("id").alias("most"), F.min("context").alias("c0"),
                   F.max("context").alias("c1"), F.max("n").alias("windows"))
              .where("holder.id < most")
              .select("anchor", "holder", "windows", (F.col("c0") == F.col("c1")).alias("agree")))
    shared = materialize(shared, "shared_anchors")
    met = materialize(anchors.join(shared.select("anchor", "holder", "agree"), "anchor")
                      .select(*KEY, "start", "n", "holder", "agree"), "shared_runs")

    # documents with a shared anchor, and their windows that must be looked at one by one
    runs = met.groupBy(*KEY).agg(F.collect_list(F.when(~F.col("agree"), F.struct("start", "n"))).alias("runs"))
    found = materialize(
        src.withColumn("z", _squeeze("text")).select(*KEY, "z").join(runs, KEY).dropDuplicates(KEY), "candidates")
    windows = materialize(found.mapInArrow(_scan_windows(window), f"id {id_type}, digest long, w long, start int"),
                          "windows")
    held = materialize(windows.groupBy("w").agg(F.min(place).alias("holder"), F.max("id").alias("most"))
                       .where("holder.id < most").select("w", "holder"), "held_windows")

    passages = (shared.where("agree").select("holder", F.col("windows").alias("n"))
                .unionByName(held.select("holder", F.lit(1).alias("n")))
                .select("holder.*", "n"))
    words = passages.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    visits = (met.where("agree AND id > holder.id").select(*KEY, "holder")
              .unionByName(windows.join(held, "w").where("id > holder.id").select(*KEY, "holder"))
              .select(*KEY, _shard_of("holder", shards).alias("shard")).distinct())
    visits = materialize(visits, "visits")
    copies = visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_DOCS)).cast("int").alias("copies"))
    holders = _holders(passages, found, shards, window)
    left = (holders.join(copies, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .select("shard", "salt", F.lit(0).alias("kind"), *KEY, "z"))
    right = (visits.join(copies, "shard").join(found.select(*KEY, "z"), KEY)
             .select("shard", F.pmod(F.xxhash64(*KEY), F.col("copies")).cast("int").alias("salt"),
                     F.lit(1).alias("kind"), *KEY, "z"))
    dealt = (left.unionByName(right).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
             .select("shard", "salt", "kind", *KEY, "z"))
    spans = dealt.mapInArrow(_stream(window), f"id {id_type}, digest long, start int, n int")
    return spans, found.select(*KEY, "z")


def _holders(passages: DataFrame, found: DataFrame, shards: int, window: int) -> DataFrame:
    """Passages of each holder by chunk: shard, id, digest, z."""
    by_chunk = (passages.withColumn("chunk", F.floor(F.col("start") / CHUNK))
                .groupBy(*KEY, "chunk").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    return (by_chunk.join(found.select(*KEY, "z"), KEY)
            .select(F.pmod(F.xxhash64("id", "digest", "chunk"), F.lit(shards)).cast("int").alias("shard"), *KEY,
                    _cut_passages(window)("z", "spans").alias("z")))


def substring_dedup(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (hex, of
    the kept words joined by one space, UTF-8) and, on request, kept_text.

    Words are split at ASCII white space and compared unchanged.  A word goes if
    a window over it also starts in a document of smaller id; rows of one id do
    not count against each other, and rows that repeat an id and a text get the
    same result.  Null and empty texts have no words; null ids lose nothing; an
    empty table gives an empty result; other input columns are not read.
    """
    spans, texts = repeated_spans(docs, window, id_col, text_col)
    by_doc = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("spans"))  # bounded by the document
    text = F.arrow_udf(_kept(with_text), "struct<n: long, gone: long, sha: string, kept: string>")
    cleaned = (texts.join(by_doc, KEY).select(F.col("id").alias("id2"), F.col("digest").alias("digest2"),
                                              text("z", "spans").alias("new")))
    plain = F.arrow_udf(_whole(with_text), "struct<n: long, gone: long, sha: string, kept: string>")
    rows = _packed(docs, id_col, text_col).select(*KEY, plain("text").alias("old"))
    both = rows.join(cleaned, (F.col("id") == F.col("id2")) & (F.col("digest") == F.col("digest2")), "left")
    now = both.select("id", F.coalesce("new", "old").alias("r"))
    return now.select(F.col("id").alias("doc_id"), F.col("r.n").alias("n_words"), F.col("r.gone").alias("n_removed"),
                      F.col("r.sha").alias("kept_sha256"), *[F.col("r.kept").alias("kept_text")] * with_text)


def _results(rows: list[tuple[int, int, bytes]], with_text: bool) -> pa.Array:
    return pa.StructArray.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
         pa.array([r[2].decode() if with_text else None for r in rows], pa.string())], ["n", "gone", "sha", "kept"])


def _whole(with_text: bool):
    def whole(texts: pa.Array) -> pa.Array:
        split = (t.as_py().split() for t in texts)
        return _results([(len(w), 0, b" ".join(w)) for w in split], with_text)
    return whole


def _kept(with_text: bool):
    def kept(z: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for t, s in zip(z, spans.to_pylist()):
            words, out, at = _unsqueeze(t.as_py()), [], 0
            cut = merged([(x["start"], x["start"] + x["n"]) for x in s])
            for a, e in cut:
                out += words[at:a]
                at = e
            rows.append((len(words), sum(e - a for a, e in cut), b" ".join(out + words[at:])))
        return _results(rows, with_text)
    return kept
