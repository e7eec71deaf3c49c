import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, clashing, edge_docs, prose

from recolake.llm import mixing
from recolake.llm.mixing import entropy, mixed, schedule, solve, weights_at


def words(t):
    return len(re.findall("[^\x20\x09-\x0D]+", t or ""))


def test_entropy_target_is_met():
    tokens = {"a": 700, "b": 200, "c": 100, "none": 0}
    low, high = entropy(weights_at(tokens, 1)), math.log(3)
    for target in (low + 0.1, (low + high) / 2, high - 0.01):
        mix = solve(tokens, target_entropy=target)
        assert abs(entropy(mix.weights) - target) < 1e-4 and abs(sum(mix.weights.values()) - 1) < 1e-12
        assert min(mix.passes[k] for k in "abc") == 1.0 and mix.passes["none"] == 1.0
    assert solve(tokens, target_entropy=low / 2).exponent == 1.0
    assert solve(tokens, target_entropy=9).exponent == 0.0


def test_repetition_limit_is_met():
    tokens = {"a": 1000, "b": 250, "c": 10}
    for most in (1.0, 1.5, 4.0):
        mix = solve(tokens, max_passes=most)
        assert max(mix.passes.values()) == pytest.approx(most, abs=1e-4) and min(mix.passes.values()) == 1.0
    assert solve(tokens, max_passes=1e9).exponent == 0.0
    half = solve(tokens, budget=630)
    assert all(v == pytest.approx(0.5) for v in half.passes.values())
    assert solve({}, max_passes=2).passes == {} and solve({"x": 0}, max_passes=2).passes == {"x": 1.0}


@pytest.mark.parametrize("bucket_rows", [4, 512])
@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_schedule_is_a_permutation_of_every_pass(spark, monkeypatch, bucket_rows, wrap):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    docs = wrap(edge_docs(spark, n=120, null_id=True))
    rows = schedule(docs, block_tokens=700, max_passes=2.5).collect()
    held = defaultdict(Counter)
    for d in docs.collect():
        held[d["source"] or ""][d["doc_id"], words(d["text"])] += 1
    tokens = {s: sum(n * c for (_, n), c in v.items()) for s, v in held.items()}
    mix = solve(tokens, max_passes=2.5)
    by = defaultdict(list)
    for r in rows:
        by[r["source"], r["pass"]].append(r)
        assert r["block"] == r["start"] // (mix.weights[r["source"]] * 700)
    for s, n in mix.passes.items():
        for p in range(math.ceil(n)):
            got = sorted(by.pop((s, p)), key=lambda r: (r["start"], r["n_tokens"]))
            at = p * tokens[s]
            for r in got:
                assert r["start"] == at
                at += r["n_tokens"]
            count = Counter((r["doc_id"], r["n_tokens"]) for r in got)
            if p < math.ceil(n) - 1 or n == int(n):
                assert count == held[s]
            else:
                assert not count - held[s] and at >= n * tokens[s]
    assert not by
    # the rows are those the schedule reads
    a = Counter((r["doc_id"], r["source"]) for r in rows)
    out = mixed(docs, max_passes=2.5)
    assert out.columns == docs.columns
    assert a == Counter((r["doc_id"], r["source"] or "") for r in out.collect())


def test_texts_without_tokens_at_the_end_of_a_pass_stay(spark):
    rows = [(i, prose(__import__("random").Random(i), 9) if i < 4 else [None, "", " \n"][i % 3], "en",
             "big" if i % 2 else "small", 0) for i in range(60)]
    rows += [(100, prose(__import__("random").Random(9), 60), "en", "big", 0)]
    rows += [(None, None, "en", "big", 0)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    first = Counter(r["doc_id"] for r in schedule(docs, max_passes=2.0).collect() if r["pass"] == 0)
    assert first == Counter(r[0] for r in rows)
    assert not Counter(r[0] for r in rows) - Counter(r["doc_id"] for r in mixed(docs, max_passes=2.0).collect())


def test_mixed_rows_come_in_the_order_of_the_blocks(spark):
    rng = __import__("random").Random(2)
    docs = spark.createDataFrame([(i, prose(rng, rng.randrange(1, 40)), "en", "big" if i % 6 else "small", 0)
                                  for i in range(400)], DOCS)
    plan = schedule(docs, block_tokens=500, max_passes=2.0).collect()
    tokens = Counter()
    for d in docs.collect():
        tokens[d["source"]] += words(d["text"])
    weights = solve(dict(tokens), max_passes=2.0).weights

    def place(r):
        digest = hashlib.md5(f"11|{r['pass']}|{r['doc_id']}".encode()).hexdigest()
        return r["start"] / (weights[r["source"]] * 500), int(digest[:15], 16)

    plan.sort(key=place)
    assert [r["block"] for r in plan] == sorted(r["block"] for r in plan) and plan[-1]["block"] > 5
    got = mixed(docs, max_passes=2.0, block_tokens=500)
    assert [r["doc_id"] for r in got.collect()] == [r["doc_id"] for r in plan]


def test_blocks_hold_the_weights(spark):
    docs = spark.createDataFrame([(i, prose(__import__("random").Random(i), 20), None, "big" if i % 5 else "small", 0)
                                  for i in range(2000)], DOCS)
    rows = schedule(docs, block_tokens=4000, max_passes=2.0).collect()
    mix = solve({"big": 32000, "small": 8000}, max_passes=2.0)
    for b in (0, 3, 7):
        got = Counter()
        for r in rows:
            if r["block"] == b:
                got[r["source"]] += r["n_tokens"]
        for s, w in mix.weights.items():
            assert abs(got[s] - 4000 * w) <= 20


def test_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert schedule(empty, max_passes=2).count() == 0 and mixed(empty, max_passes=2).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS)
    assert schedule(nulls).count() == 3 and mixed(nulls).count() == 3


@pytest.mark.parametrize("limits", [{"max_passes": 2.0}, {"target_entropy": 1.0}, {}, {"max_passes": 3.0, "budget": 900.0}])
def test_more_sources_than_the_driver_takes_give_the_same(spark, monkeypatch, limits):
    docs = edge_docs(spark, n=150, null_id=True)
    rows = lambda: sorted(map(str, schedule(docs, block_tokens=700, **limits).collect()))
    want = rows()
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    assert rows() == want
    nulls = spark.createDataFrame([(None, None, None, f"s{i}", None) for i in range(5)], DOCS)
    assert schedule(nulls, **limits).count() == 5


def test_sql_keeps_texts_without_tokens(spark, tmp_path):
    """The query equals its SQL on a table with texts without tokens."""
    from oracle_harness import digest

    from recolake.llm.queries import QUERIES
    rng = __import__("random").Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 30)) if i % 5 == 0 else [None, "", " \n"][i % 3], "en", f"s{i % 3}", 0)
            for i in range(200)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    q = QUERIES["op2_mixing"]
    got = q.run(spark, str(tmp_path))
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    res = con.execute(q.sql)
    cols = [c[0] for c in res.description]
    n, want, _ = digest(cols, res.fetchall())
    assert digest(got.columns, [tuple(r) for r in got.collect()])[:2] == (n, want) and n >= 200
