import re
from collections import Counter

import pytest
from helpers import DOCS, clashing, edge_docs

from recolake.llm.quality_rules import fit, score_quality

WORD = "[^\x20\x09-\x0D]"


def brute(text):
    w = re.findall(f"{WORD}+", text or "")
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def odd_docs(spark):
    base = "one two three four five six seven eight nine ten"
    texts = [base, f"{base} x {base}", f"{base} {base} {base}", "a " * 40, "a a a a a a a a a", "q\nq\n\n \nq\nr",
             "#*$ <a> 5% | x&y", "\x1c\x85 \xa0 é ÀÉ ☃", "\r\n".join([base] * 4), "a b " * 500 + base, None, "", " "]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("make", [odd_docs, edge_docs, lambda s: clashing(edge_docs(s, null_id=True))])
def test_statistics_equal_brute_force(spark, make):
    docs = make(spark)
    rows = score_quality(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["quality_prob"] >= 0.5)


def test_empty_table(spark):
    assert score_quality(spark.createDataFrame([], DOCS)).count() == 0


def test_fit_finds_the_accurate_rules():
    # rules 0 and 1 agree with the class, rule 2 votes at random
    patterns = [((1, 1, 1), 400), ((1, 1, -1), 400), ((-1, -1, 1), 100), ((-1, -1, -1), 100)]
    prior, w = fit(patterns)
    assert prior > 0 and w[0] > 2 * w[2] and w[1] > 2 * w[2]
    assert fit([]) == (0.0, [])


def test_labels_agree_on_most_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = score_quality(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "base_failed", "kept").collect()
    good = [r for r in got if r["quality"] == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    bad = [r for r in got if r["quality"] == 0]
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad)
