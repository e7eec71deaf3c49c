import hashlib
import random
import re

import pytest
from helpers import DOCS, clashing, edge_docs, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from recolake.llm import substring_dedup as sub
from recolake.llm.line_dedup import line_dedup, repeated_runs
from recolake.llm.queries import QUERIES
from recolake.llm.substring_dedup import Shard, _common, anchor_runs, merged, repeated_spans, substring_dedup

WORD = "[^\x20\x09-\x0D]"


def brute_words(rows, window):
    first = {}
    split = [(i, re.findall(f"{WORD}+", t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1) if i is not None else ():
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k:k + window])] < i
                for j in range(k, k + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passages(spark, seed=0, docs=60):
    """Texts that share passages in many contexts, lengths around the window."""
    rng = random.Random(seed)
    shared = [prose(rng, n, 9) for n in (9, 10, 11, 14, 30)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(5)):
            parts += [prose(rng, rng.randrange(6), 5), rng.choice(shared)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts), "en", "s", 0))
    rows += [(100 + i, rows[7][1], "en", "s", 0) for i in range(6)]
    rows += [(200, "a " * 40, "en", "s", 0), (201, "a " * 25, "en", "s", 0), (202, "b a a a a a a a a a a", "en", "s", 0)]
    rows += [(7, "another text of an id", "en", "s", 0), (None, rows[7][1], "en", "s", 0), (3, None, None, None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS)


def got_words(docs, window, **k):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in substring_dedup(docs, window, **k).collect()), key=str)


@pytest.mark.parametrize("window,seed", [(10, 0), (11, 1), (2, 2)])
def test_passages_equal_brute_force(spark, monkeypatch, window, seed):
    monkeypatch.setattr(sub, "SHARD_WORDS", 20)
    monkeypatch.setattr(sub, "SHARD_DOCS", 3)
    docs = passages(spark, seed)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got_words(docs, window) == sorted(brute_words(rows, window), key=str)


def test_edge_documents_equal_brute_force(spark):
    docs = clashing(edge_docs(spark, null_id=True))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_words(rows, 50)
    assert got_words(docs, 50) == sorted(want, key=str) and any(r[2] for r in want)
    kept = {r["doc_id"]: r for r in substring_dedup(docs, 50, with_text=True).collect()}
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in kept.values())


def test_long_holders_are_dealt_by_chunk(spark, monkeypatch):
    monkeypatch.setattr(sub, "CHUNK", 64)
    monkeypatch.setattr(sub, "SHARD_WORDS", 50)
    text = prose(random.Random(4), 700)
    docs = spark.createDataFrame([(1, text, "", "", 0), (2, "x " + text, "", "", 0),
                                  (3, " ".join(text.split()[100:400]), "", "", 0)], DOCS)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got_words(docs, 50) == sorted(brute_words(rows, 50), key=str)


def test_no_documents_and_no_repeats(spark):
    assert substring_dedup(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(i, prose(random.Random(i), 80), "", "", 0) for i in range(5)], DOCS)
    assert {r[2] for r in got_words(docs, 50)} == {0}
    with pytest.raises(ValueError):
        repeated_spans(docs, 1)


@settings(max_examples=200, deadline=None)
@given(a=st.text("ab", max_size=200), b=st.text("ab", max_size=200), data=st.data())
def test_common_prefix_and_suffix(a, b, data):
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    right = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
    left = next((k for k in range(min(i, j)) if a[i - k - 1] != b[j - k - 1]), min(i, j))
    assert _common(a, i, b, j, 1) == right and _common(a, i, b, j, -1) == left


@settings(max_examples=100, deadline=None)
@given(words=st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=10, max_size=60))
def test_anchor_runs_cover_every_window_and_depend_on_it_alone(words):
    anchors, start, n, _ = anchor_runs(words, 10)
    assert start.tolist() == [0, *(start + n)[:-1].tolist()] and n.sum() == len(words) - 9
    for a, s, c in zip(anchors.tolist(), start.tolist(), n.tolist()):
        for k in range(s, s + c):
            assert anchor_runs(words[k:k + 10], 10)[0].tolist() == [a]


WORDS_OF = st.binary(max_size=90).map(lambda b: b.translate(None, bytes([*range(9, 14), 32]))) | st.sampled_from([b"abcdefgh", b"abcdefghabcdefgh"])


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.lists(WORDS_OF, max_size=12), max_size=5), blank=st.sampled_from([b" ", b"\x0b", b" \r\n", b"\t\x0c"]))
def test_words_of_many_texts_are_hashed_together(texts, blank):
    """Words end where ``split`` ends them; equal words, and no others, have equal hashes."""
    found = [*sub._hashed(blank.join(w) for w in texts)]
    split = [blank.join(w).split() for w in texts]
    assert [h.n for h in found] == [len(w) for w in split]
    known = {}
    for w, h in zip(split, found):
        for word, x in zip(w, h.grams(1).tolist() if w else []):
            assert known.setdefault(word, x) == x
    assert len(set(known.values())) == len(known)


def test_merged_spans():
    assert merged([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)] and merged([]) == []


def test_shard_without_passages():
    assert Shard(4).locate(1, [b"a"] * 9) == []


def brute_lines(rows, run, min_words=None):
    docs = sorted(((i is not None, i or 0, n), i, t) for n, (i, t) in enumerate(rows))
    seen, single, out = set(), set(), []
    for _, i, t in docs:
        lines = (t or "").split("\n")
        full = [k for k, x in enumerate(lines) if re.search(WORD, x)]
        gone = set()
        for k in range(len(full) - run + 1):
            g = tuple(lines[x] for x in full[k:k + run])
            if g in seen:
                gone.update(full[k:k + run])
            seen.add(g)
        for k in full:
            if min_words is not None and len(re.findall(f"{WORD}+", lines[k])) >= min_words and (lines[k],) in single:
                gone.add(k)
            single.add((lines[k],))
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((i, len(full), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def line_docs(spark, seed=0):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "long line", "\x1c", "é"]) for _ in range(rng.randrange(12))),
             "en", "s", 0) for i in range(40)]
    rows += [(90, None, None, None, None), (91, "same\n" * 9, "en", "s", 0), (92, "only", "en", "s", 0)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("run,min_words,seed", [(1, None, 0), (2, None, 1), (3, None, 2), (4, None, 4), (5, None, 3),
                                                (2, 2, 5), (4, 2, 6), (3, 1, 7), (1, 2, 8)])
def test_lines_equal_brute_force(spark, run, min_words, seed):
    docs = line_docs(spark, seed)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["kept_sha256"])
                  for r in line_dedup(clashing(docs), run, min_words).collect()), key=str)
    assert got == brute_lines(rows, run, min_words)


def test_runs_are_maximal(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd", "", "", 0), (2, "x\nb\nc\nd\ny\na\nb", "", "", 0)], DOCS)
    runs = sorted((r["id"], r["first_line"], r["n_lines"]) for r in repeated_runs(docs, 2).collect())
    assert runs == [(2, 1, 3), (2, 5, 2)]


def test_doubling_goes_on_until_no_rank_is_shared(spark):
    """A run of 21 lines in two documents: intervals of 2, 4, 8 and 16 lines; a
    document that repeats itself; one text in many documents."""
    long = [f"line {i}" for i in range(30)]
    docs = spark.createDataFrame([
        (1, "\n".join(long), "", "", 0), (2, "\n".join(["x", *long[4:25], "y"]), "", "", 0),
        (3, "\n".join(["p", "q"] * 10), "", "", 0), *[(10 + i, "same\ntext\nthrice", "", "", 0) for i in range(40)],
        *[(60, "one id\none text", "", "", 0)] * 50], DOCS)
    runs = {(r["id"], r["first_line"]): (r["n_lines"], r["longest"]) for r in repeated_runs(docs, 2).collect()}
    assert runs == {(2, 1): (21, 16), (3, 2): (18, 16), **{(10 + i, 0): (3, 2) for i in range(1, 40)}}


def test_repeated_rows_and_empty_tables_of_lines(spark):
    assert line_dedup(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "a\nb", "", "", 0), (1, "a\nb", "", "", 0), (None, "a\nb", "", "", 0)], DOCS)
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in line_dedup(docs).collect())
    assert got == [("1", 2), ("1", 2), ("None", 0)]
    with pytest.raises(ValueError):
        line_dedup(docs, 0)


def test_a_line_repeated_between_new_ones_is_deleted(spark, tmp_path):
    rows = [(i, f"start {i}\nthe same line\nend {i}", "en", "s", 0) for i in range(5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["n_lines"], r["n_removed"], r["kept_sha256"])
                 for r in QUERIES["op9_line_dedup_lines"].run(spark, str(tmp_path)).collect())
    assert got == brute_lines([r[:2] for r in rows], 1) and [r[2] for r in got] == [0, 1, 1, 1, 1]
