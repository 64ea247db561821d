import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from awareness_mart.llm.bpe import VOCABULARY, BatchEncoder, MergeTable, decoded, encoded, token_digest

HOSTILE = [
    "", " ", "\x1c\x1d a", "aaaa aaaaa a" * 3, "don't we'll I'M 's", "x<|endoftext|>y <|startoftext|><|endoftext|>",
    "<|endoftext |> <|ENDOFTEXT|>", "ΑΣ Σ ΟΔΟΣ", "İstanbul ẞ ﬁ", "é ́x a b c\x85d", "日本語のテキスト 한국어",
    "🙂🙂👩‍👩‍👧", "12345 1,000.50", "ᲉꟋ\U00010d50 ՘", "a" * 3000, "abcdefghij" * 500, "\u0000 nul", "ǅ ŉ ᾳ",
]


def _mix(seed):
    rng = random.Random(seed)
    letters = "abcdeéßñ ÄΣ\t\n'sdl<|>0123中.,-_#́​　"
    return ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_same_ids_and_text_as_the_library(library):
    texts = HOSTILE + _mix(1) + [chr(c) + " x" + chr(c) for c in range(32, 0x3000, 7)]
    encoder = BatchEncoder(VOCABULARY)
    wanted = library.encode_batch(texts, add_special_tokens=False)
    for text, raw, want in zip(texts, encoder.encode([t.encode() for t in texts]), wanted, strict=True):
        ids = [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]
        assert ids == want.ids, text
        assert encoder.decode(ids) == library.decode(want.ids, skip_special_tokens=False), text
    assert encoder.merges.ordered


def _slow(word, ranks):
    """One merge at a time, lowest rank first, then leftmost."""
    word = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        _, i = min(found)
        word[i : i + 2] = [word[i] + word[i + 1]]


@pytest.mark.parametrize("pairs", [["a b", "b a", "a a", "ab ab", "aa aa"], ["ab a", "a a", "a b", "b ab"]])
def test_rounds_equal_single_merges(pairs):
    """Also where a merge needs what a later one makes."""
    merges = [p.split() for p in pairs]
    tokens = ["a", "b"] + [a + b for a, b in merges]
    model = {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges, "end_of_word_suffix": None}
    rng = random.Random(3)
    words = ["".join(rng.choices("ab", k=rng.randrange(1, 14))) for _ in range(400)]
    ranks = {tuple(m): i for i, m in enumerate(merges)}
    table = MergeTable(model)
    ids, ends = table.encode(words)
    got = [[tokens[i] for i in x] for x in np.split(ids, ends[:-1])]
    assert got == [_slow(w, ranks) for w in words]


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        MergeTable({"type": "BPE", "byte_fallback": True, "vocab": {}, "merges": [], "end_of_word_suffix": None})


def test_rows(spark, library):
    texts = [None, "", *HOSTILE, "long " * 400_000]
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted([tuple(r) for r in token_digest(encoded(docs)).collect()], key=str)

    def line(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), said)]
        return (i, len(ids), *sha)

    assert got == sorted([line(i, t) for i, t, _ in rows], key=str)
    assert encoded(docs.limit(0)).count() == 0


def test_decoding_from_ids(spark):
    vocab = json.load(open(VOCABULARY))["model"]["vocab"]
    rows = [(1, [vocab["the</w>"], 49407, 10**6]), (2, []), (None, None)]
    got = decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>")).orderBy(F.col("doc_id").asc_nulls_last())
    assert [tuple(r) for r in got.collect()] == [(1, "the</w> <|endoftext|>"), (2, ""), (None, None)]
