import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import DATA, documents, twins
from hypothesis import given, settings
from hypothesis import strategies as st

from docketflow.llm import kernels as K
from docketflow.llm.packing import CAPACITY, LEAST, UnitIds, default_tokenizer, op8_packing, pack, share_cut


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, tokenizer):
    """Every id in exactly one piece, every sequence without gaps and within the capacity."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids, at = np.array(ids_of(tokenizer, text), "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= CAPACITY
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_query_round_trip(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()}
    rows = op8_packing(spark, f"{DATA}/sf0.01").collect()
    n = check(rows, texts, tokenizer)
    assert sum(r.length for r in rows) > 0.98 * n * CAPACITY


def test_edges(spark, tokenizer):
    texts = [None, "", " ", "a", "don't, 's ,'s it''s", "<|endoftext|> A<|ENDOFTEXT|>b", "x1y2,3.4", "é É ß…. a…,b", "word " * 3000, "Ünïcödé😀!!a", "a\x00b\x1c c"]
    rows = pack(documents(spark, texts, id="clash", k=3), default_tokenizer(), keep_ids=True).withColumnRenamed("id", "doc_id").collect()
    check(rows, dict(enumerate(texts)), tokenizer)
    assert sum((r.ids for r in sorted((r for r in rows if r.doc_id == 8), key=lambda r: r.start)), []) == ids_of(tokenizer, texts[8])
    twice = pack(documents(spark, ["same words"] * 4, ids=[1, 1, None, None]), default_tokenizer()).collect()
    assert len(twice) == 4 and len({(r.sequence_id, r.offset) for r in twice}) == 4
    assert pack(documents(spark, []), default_tokenizer()).count() == 0


def test_documents_are_cut_for_free_places_only(spark):
    rows = op8_packing(spark, f"{DATA}/sf0.01").collect()
    used = collections.Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    short = {r.doc_id for r in rows if r.doc_tokens <= CAPACITY}
    cut = {r.doc_id for r in rows if r.doc_tokens <= CAPACITY and r.length < r.doc_tokens}
    assert len(cut) < 0.1 * len(short)
    assert sum(r.length < LEAST <= r.doc_tokens for r in rows) < 0.05 * len(rows)
    assert sum(used.values()) > 0.98 * len(used) * CAPACITY


@pytest.mark.parametrize("words", [1, 700, 1100, 2046, 2047, 2048, 5000])
def test_documents_of_one_length(spark, tokenizer, words):
    texts = ["the " * words] * 60
    rows = pack(documents(spark, texts), default_tokenizer()).withColumnRenamed("id", "doc_id").collect()
    n = check(rows, dict(enumerate(texts)), tokenizer)
    ids = sum(r.length for r in rows)
    assert n <= -(-ids // CAPACITY) * 1.12 + 1


def test_small_capacity_and_long_parts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr("docketflow.llm.packing.PART", 1000)
    text = "one two, three " * 2000
    rows = pack(documents(spark, [text, text]), default_tokenizer(), keep_ids=True).withColumnRenamed("id", "doc_id").collect()
    check(rows, {0: text, 1: text}, tokenizer)
    for i in (0, 1):
        assert sum((r.ids for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)), []) == ids_of(tokenizer, text)


def test_share_cut():
    assert share_cut([], 2048) == 0
    assert share_cut([(0, 1, 10**6), (1, 10, 11_000)], 2048) == 0
    assert 0.45 < share_cut([(1, 1000, 1_100_000)], 2048) < 0.52


UNITS = UnitIds(default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aB1 ,.'’<|>!s\n\t́é…"), st.characters(codec="utf-8")), max_size=30), min_size=1, max_size=5))
def test_unit_ids_equal_the_tokenizer(texts):
    raw, starts = K.text_buffers(pa.array(texts))
    ids, at = UNITS.ids(raw, starts, 0, len(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == ids_of(UNITS.tokenizer, text)


def test_twin_words_and_any_collision(spark, tokenizer, monkeypatch):
    texts = [*twins(1024), *twins(2048), "a b", "b a c", " ".join(twins(1024))]
    rows = pack(documents(spark, texts), default_tokenizer()).withColumnRenamed("id", "doc_id").collect()
    check(rows, dict(enumerate(texts)), tokenizer)
    monkeypatch.setattr(K, "word_hashes", lambda part, lo, hi, pairs, seed: (hi - lo).astype(np.uint64))  # every two words of one length collide
    units = UnitIds(default_tokenizer())
    for some in (texts, ["aa bb aa"], ["cc"], ["aa"]):
        raw, starts = K.text_buffers(pa.array(some))
        ids, at = units.ids(raw, starts, 0, len(some))
        assert [ids[at[k] : at[k + 1]].tolist() for k in range(len(some))] == [ids_of(tokenizer, t) for t in some]
