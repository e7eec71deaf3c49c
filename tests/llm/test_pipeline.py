import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, clashing, edge_docs, prose
from pyspark.sql import functions as F
from test_simhash import brute_fp, brute_roots
from test_tokens import WORD, check_packed, plain

import corpus_pipeline
from recolake.llm.language_id import has_letter
from recolake.llm.mixing import solve
from recolake.session import materialize


def brute(rows):
    """Rows after each of the first three stages, and what the fourth reads."""
    rows = [r for r in rows if has_letter(r["text"])]
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub("[\x20\x09-\x0D]", "", r["text"])].append(r)
    rows = [min(v, key=lambda r: (-len(r["text"]), r["doc_id"])) for v in groups.values()]
    roots = brute_roots([brute_fp(r["text"]) for r in rows])
    least = {}
    for r in rows:
        k = roots[brute_fp(r["text"])]
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    return rows, [r for r in rows if least[roots[brute_fp(r["text"])]] == r["doc_id"]]


@pytest.fixture(scope="module")
def docs(spark):
    import random
    near = prose(random.Random(9), 900)
    extra = [(500, near, "en", "s1", 0), (501, near.replace(" ", "  "), "en", "s2", 0),
             (502, near + " end", "en", "s0", 0), (503, "12 34 !", "en", "s0", 0)]
    return materialize(edge_docs(spark, n=80).union(spark.createDataFrame(extra, DOCS)), "pipeline_docs")


def test_stages_equal_brute_force(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        at = materialize(stage(spark, at, ""), "stage")
        out[name] = at
        if name != names[-1]:
            assert at.columns == docs.columns
    exact, near = brute(docs.collect())
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    assert ids(out["language_id"].collect()) == ids([r for r in docs.collect() if has_letter(r["text"])])
    assert ids(out["exact_dedup"].collect()) == ids(exact)
    assert ids(out["simhash_near_dedup"].collect()) == ids(near) and len(near) < len(exact)
    mixed = Counter(ids(out["mixing"].collect()))
    assert set(mixed) == set(ids(near))
    tokens = Counter()
    for r in near:
        tokens[r["source"] or ""] += len(re.findall("[^\x20\x09-\x0D]+", r["text"]))
    passes = solve(dict(tokens), max_passes=corpus_pipeline.MAX_PASSES).passes
    for r in near:
        assert int(passes[r["source"] or ""]) <= mixed[r["doc_id"]] <= -(-passes[r["source"] or ""] // 1)
    pieces = out["best_fit_packing"].collect()
    check_packed(pieces, corpus_pipeline.SEQUENCE)
    length = Counter()
    for p in pieces:
        length[p["doc_id"]] += p["length"]
    for r in near:
        assert length[r["doc_id"]] == mixed[r["doc_id"]] * (len(plain(WORD, r["text"])) + 1)


def test_run_on_the_smallest_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    check_packed(rows, corpus_pipeline.SEQUENCE)
    assert rows


def test_stages_take_nothing(spark):
    at = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, "")
        assert at.count() == 0


def test_stages_keep_their_input_columns(spark):
    """Columns named like outputs or working columns, a name with a dot, null
    and repeated ids, a text of a megabyte: what a stage keeps is as it was."""
    docs = edge_docs(spark, n=60, null_id=True)
    more = [(None, "another row without an id", None, None, 0), (7, "the id seven once more, another text", "en", "s1", 1),
            (900, "word " * 200_000, "en", "s2", 1)]
    docs = clashing(docs.unionAll(spark.createDataFrame(more, docs.schema)))
    for c in ("group_size", "text_sha256", "language_of_row", "language", "name", "nth", "h", "lang_pred"):
        docs = docs.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id").cast("string")))
    docs = materialize(docs.withColumn("a.b", F.col("n_chars") + 1), "pipeline_clashing")
    key = lambda r: tuple(map(str, r))
    at, before = docs, {key(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = materialize(stage(spark, at, ""), "stage")
        assert at.schema.simpleString() == docs.schema.simpleString(), name
        rows = {key(r) for r in at.collect()}
        assert rows and rows <= before, name
        before = rows
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, "").collect()
    check_packed(pieces, corpus_pipeline.SEQUENCE)
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in at.collect()}
    assert None in {p["doc_id"] for p in pieces}
