import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCS, clashing, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recolake.llm import tokens
from recolake.llm.packing import best_fit, pack
from recolake.llm.token_table import read_tokens, with_ids_crc32, write_tokens
from recolake.llm.tokens import Encoder
from recolake.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ENC = {p: Encoder(p) for p in (BYTE, WORD)}
PLAIN, LIBRARY = {}, {}  # LIBRARY: as it comes
for _p in (BYTE, WORD):
    PLAIN[_p] = Tokenizer.from_file(_p)
    PLAIN[_p].encode_special_tokens = True


def plain(path, text):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=1500, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 'sStTé́Σσ1²½.,!|<>_"),
                                       st.characters(blacklist_categories=("Cs",))), max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(path, text):
    (got,) = ENC[path].encode([text])
    assert np.frombuffer(got, "<i4").tolist() == plain(path, text)


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=500, deadline=None)
@given(parts=st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", " "]),
                                st.text(alphabet=" \n\taBé's1.,<|>", max_size=8)), max_size=8))
def test_added_tokens_in_a_text_are_those_of_the_plain_library(path, parts):
    texts = ["", "".join(parts), "a<|endoftext|>b", "a b"]
    library = Tokenizer.from_file(path) if path not in LIBRARY else LIBRARY[path]
    LIBRARY[path] = library
    got = [np.frombuffer(b, "<i4").tolist() for b in ENC[path].encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_small_piece_table_changes_nothing(path, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 10)
    rng = random.Random(1)
    texts = [None, "", "x" * 300] + [" ".join(f"w{rng.randrange(99)}'s" for _ in range(30)) for _ in range(20)]
    enc = Encoder(path)
    assert [np.frombuffer(b, "<i4").tolist() for b in enc.encode(texts)] == [plain(path, t) for t in texts]


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_token_table_round_trip(spark, wrap):
    docs = wrap(edge_docs(spark, null_id=True))
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, BYTE)
    rows = sorted(read_tokens(spark, path).collect(), key=lambda r: r["start"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    order = [r["doc_id"] for r in rows]
    assert order[0] is None and order[1:] == sorted(order[1:])
    at = 0
    for r in rows:
        assert r["ids"] == plain(BYTE, texts[r["doc_id"]]) + [0]
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += len(r["ids"])
    crc = {r["doc_id"]: r["ids_crc32"] for r in with_ids_crc32(read_tokens(spark, path)).collect()}
    for r in rows:
        assert crc[r["doc_id"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_token_files_have_bounded_groups_and_indexes(spark):
    import glob

    import pyarrow.parquet as pq
    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1), path, BYTE,
                 layout={"parquet.block.size": 64 << 10, "parquet.page.row.count.limit": 50})
    files = sorted(glob.glob(f"{path}/tokens/*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_row_groups for m in groups) > len(files)
    ids = {m.schema.column(c).path: c for m in groups[:1] for c in range(m.num_columns)}
    col = groups[0].row_group(0).column(ids["ids.list.element"])
    assert "RLE_DICTIONARY" in col.encodings and col.has_offset_index and col.has_column_index
    assert "DELTA_BINARY_PACKED" in groups[0].row_group(0).column(ids["n_tokens"]).encodings
    plan = read_tokens(spark, path, ())._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan  # counters alone are read


def test_token_table_of_nothing(spark):
    path = scratch_path(spark, "tokens")
    write_tokens(spark.createDataFrame([], DOCS), path, BYTE)
    assert read_tokens(spark, path).count() == 0


def check_packed(rows, length, max_pieces=10**9, max_cost=10**18):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for v in by.values():
        v.sort(key=lambda r: r["offset"])
        at = 0
        for r in v:
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and len(v) <= max_pieces and sum(r["length"] ** 2 for r in v) <= max_cost
    return by


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_pieces_and_sequences(spark, wrap):
    docs = wrap(edge_docs(spark, null_id=True))
    rows = pack(docs, WORD, length=256, keep_ids=True).collect()
    check_packed(rows, 256)
    from collections import Counter
    want = Counter()
    for d in docs.collect():
        ids = plain(WORD, d["text"]) + [1]
        for k, at in enumerate(range(0, len(ids), 256)):
            want[d["doc_id"], k, at, tuple(ids[at:at + 256])] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows)
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_all_capacities_hold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack(docs, WORD, length=512, max_pieces=3, max_cost=512 * 512).collect()
    check_packed(rows, 512, 3, 512 * 512)
    with pytest.raises(ValueError):
        pack(docs, WORD, length=512, max_cost=5)


def test_best_fit_is_close_to_the_bound_and_exact_on_a_small_case():
    rng = np.random.default_rng(0)
    n = np.minimum(4096, rng.lognormal(5.5, 1, 4000).astype(int) + 1)
    seq, offset = best_fit(n, (4096, 4096, 4096**2), (1, 0.01, 0.01))
    used = np.bincount(seq, weights=n)
    assert used.max() <= 4096 and len(used) <= np.ceil(n.sum() / 4096) * 1.005 + 1
    seq, _ = best_fit(np.array([60, 50, 40, 50]), (100, 9, 1e9), (1, 0.01, 0.01))
    assert seq.max() == 1


def test_packing_nothing(spark):
    assert pack(spark.createDataFrame([], DOCS), WORD).count() == 0
