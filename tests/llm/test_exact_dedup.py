import hashlib
import re

import pytest
from helpers import DOCS, clashing, edge_docs

from recolake.llm.exact_dedup import content_sort_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, got = brute(rows), content_sort_dedup(docs).collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        norm = re.sub("[\x20\x09-\x0D]", "", r["text"] or "")
        assert (r["keep_id"], r["group_size"]) == want[norm]
        assert r["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept[norm] = kept.get(norm, 0) + 1
    assert kept == dict.fromkeys(want, 1)
    return got


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_equals_brute_force(spark, wrap):
    got = check(wrap(edge_docs(spark, null_id=True)))
    assert "text" in got[0].asDict()


def test_hot_group_over_many_slots(spark):
    rows = [(i, "the same  text" if i % 3 else "the same\ntext", "en", "s", 14) for i in range(3000)]
    rows += [(5000 + i, f"text {i}", "en", "s", 8) for i in range(500)] + rows[:7]
    docs = spark.createDataFrame(rows, DOCS)
    got = check(docs)
    assert sum(r["kept"] for r in got) == 501


def test_empty_table_and_only_nulls(spark):
    assert content_sort_dedup(spark.createDataFrame([], DOCS)).count() == 0
    got = check(spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS))
    assert [r["group_size"] for r in got] == [3, 3, 3]
