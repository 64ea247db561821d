"""The corpus queries against their SQL, and the pipeline against a brute-force version."""

from collections import Counter

import pytest
from compare import compare, duck

import corpus_pipeline
from awareness_mart.llm.common import lower_words, read
from awareness_mart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, name):
    assert [p for p in compare(spark, duck(SF), name, SF) if p != "no rows"] == []


def test_queries_beyond_sql():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert sorted({int(n[2:].split("_")[0]) for n in set(QUERIES) - set(ORACLES)}) == [1, 2, 3, 4, 5, 6, 13]


def grams(words, n):
    return [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]


def shingled(words):
    return set(grams(words, min(5, len(words)))) if words else set()


def repeated(words):
    windows = grams(words, 3)
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({k + j for k, w in enumerate(windows) if w in often for j in range(3)})


def test_stages_keep_what_brute_force_keeps(spark):
    docs = {r.doc_id: r.text or "" for r in read(spark, SF, "documents").collect()}
    items = [shingled(lower_words(r.text.encode())) for r in read(spark, SF, "benchmark").collect()]
    words = {i: t.encode().split() for i, t in docs.items()}
    kept = [i for i, w in words.items() if len(w) >= 50 and 100 * repeated(w) <= 50 * len(w)]
    sets = {i: shingled(lower_words(docs[i].encode())) for i in kept}
    group = {i: i for i in kept}
    for _ in range(8):
        for a in kept:
            for b in kept:
                if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    single = [i for i in kept if group[i] == i]
    clean = [i for i in single if not any(100 * len(s & sets[i]) >= 75 * len(s) for s in items)]

    found, now = {}, read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, SF)
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found[name] = sorted(r.doc_id for r in now.select("doc_id").collect())
    assert found["quality"] == sorted(kept)
    assert found["near_dedup"] == sorted(single)
    assert found["decontaminate"] == found["secrets"] == sorted(clean)
    assert {r.doc_id for r in corpus_pipeline.STAGES[4][1](spark, now, SF).collect()} == set(clean)
