import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from awareness_mart.llm import packing
from awareness_mart.llm.packing import CAPACITY, TOKENIZER, TokenCache, best_fit, packed

DOCS = "/root/testdata/sf0.001/documents.parquet"


def check(rows, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), CAPACITY)):
            part = np.array(ids[at : at + CAPACITY], "<u4")
            want.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(map(str, want))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(bins), -(-sum(w[3] for w in want) // CAPACITY)


def test_whole_table(spark):
    docs = spark.read.parquet(DOCS)
    used, least = check(packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= 1.03 * least + 1


def test_rounds_merge_what_tasks_leave(spark, monkeypatch):
    docs = spark.read.parquet(DOCS).repartition(12)
    used, least = check(packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= 1.03 * least + 1


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    texts = [(1, None), (1, ""), (None, "a b"), (2, "word " * 9000), (3, "x\x1cy"), (3, "x\x1cy")]
    rows = [(i, t, 7, "p") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, used int, pieces string")
    check(packed(docs).collect(), texts)
    assert packed(docs.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZ é'́Σİ中<|endoftext|>.,!?|:9\x1c  \nst", max_size=40))
def test_cached_ids_are_those_of_the_whole_text(text):
    raw = CACHE.encode([text])[0]
    assert np.frombuffer(raw, "<u4").tolist() == CACHE.tokenizer.encode(text, add_special_tokens=False).ids


CACHE = TokenCache(TOKENIZER)


@given(st.lists(st.integers(1, 10), max_size=60))
def test_best_fit_fills_bins_without_gaps(sizes):
    places = best_fit(sizes, 10)
    bins = defaultdict(list)
    for (bin_, at), size in zip(places, sizes, strict=True):
        bins[bin_].append((at, size))
    for items in bins.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= 10
    assert sum(sum(s for _, s in items) <= 5 for items in bins.values()) <= 1


def test_a_clear_of_the_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_CHUNKS", 2)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 2)
    cache = TokenCache(TOKENIZER)
    for text in ("one two, three. one", "four five 6 don't", "one two"):
        raw = cache.encode([text])[0]
        assert np.frombuffer(raw, "<u4").tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids
