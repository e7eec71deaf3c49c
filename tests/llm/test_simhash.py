import random

import numpy as np
import pytest
import xxhash
from helpers import DOCS, clashing, edge_docs, edge_rows
from pyspark.sql import functions as F

from recolake.llm import simhash
from recolake.llm.simhash import components, fingerprint, links, representatives, simhash_groups


def brute_fp(text, k=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(fps, bits=3):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint_equals_the_definition():
    for _, t, *_ in edge_rows():
        assert fingerprint(None if t is None else t.encode(), 3) == brute_fp(t)
    assert fingerprint(b"A B C", 3) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_chunks_do_not_change_the_fingerprint(monkeypatch):
    t = " ".join(f"w{i}" for i in range(500)).encode()
    whole = fingerprint(t, 3)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(t, 3) == whole


@pytest.mark.parametrize("block", [4, 1024])
def test_links_reach_every_pair_within_three_bits(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1}
    for f in list(fps)[:60]:
        for d in (1, 2, 3, 4):
            g = f
            for b in rng.sample(range(64), d):
                g ^= 1 << b
            fps.add(g)
    dense = rng.getrandbits(64)  # a cluster whose members meet under many keys
    fps |= {dense ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = links(df)
    pairs = [(a % 2**64, b % 2**64) for a, b in found.collect()]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in pairs)
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in components(found).collect()}
    want = brute_roots(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_long_chain_and_star_components(spark):
    edges = [(i + 1, i) for i in range(60)] + [(1000 + i, 999) for i in range(100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 999 for i in range(999, 1100))


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_groups_equal_brute_force(spark, wrap):
    docs = wrap(edge_docs(spark))
    rows = simhash_groups(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    roots = brute_roots([brute_fp(t) for t in texts.values()])
    least = {}
    for i, t in texts.items():
        r = roots[brute_fp(t)]
        least[r] = min(least.get(r, i), i)
    assert len(rows) == docs.count()
    for r in rows:
        f = brute_fp(texts[r["doc_id"]])
        assert r["fingerprint"] == f"{f:016x}" and r["component_id"] == least[roots[f]]


def test_empty_table_and_null_ids(spark):
    assert simhash_groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = simhash_groups(edge_docs(spark, null_id=True)).where(F.col("doc_id").isNull()).collect()
    assert len(rows) == 1 and rows[0]["component_id"] is None


def test_one_row_of_each_group_stays(spark):
    near, other, lone = (" ".join(f"{w}{i}" for i in range(300)) for w in "abc")
    rows = [(None, near, "en", "s", 0), (None, near + " ", "en", "s", 1), (None, other, "en", "s", 2),
            (5, near, "en", "s", 3), (4, near + "  ", "en", "s", 4), (4, near, "en", "s", 5), (4, near, "en", "s", 6),
            (4, other, "en", "s", 7), (3, other + " ", "en", "s", 8), (None, lone, "en", "s", 9),
            (None, lone + " ", "en", "s", 10), (None, None, "en", "s", 11), (None, "", "en", "s", 12)]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    out = representatives(docs)
    assert out.columns == docs.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "").strip()) for r in out.collect())
    assert got == sorted([("4", near), ("3", other), ("None", lone), ("None", "")])
