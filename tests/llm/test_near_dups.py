import random

import numpy as np
import pytest

from awareness_mart.llm.components import components
from awareness_mart.llm.near_dups import merged, near_duplicates, registers
from awareness_mart.llm import common
from awareness_mart.llm.common import lower_words, shingle_set, shingles, word_hashes

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    """doc_id -> (n, component) by comparing all pairs of sets of words."""
    sets = {}
    for i, text in rows:
        w = lower_words(text.encode() if text else None)
        width = min(5, len(w))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if w else set()
    part = {i: i for i in sets}
    changed = True
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]
    ]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(part[a], part[b])
            changed |= part[a] != low or part[b] != low
            part[a] = part[b] = low
    return {i: (len(sets[i]), part[i]) for i in sets}


def edited(words, share, rng):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


def test_groups_of_copies_as_by_all_pairs(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for group in (1, 2, 5, 60):
        for _ in range(3):
            base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 200))]
            for _ in range(group):
                rows.append((n := n + 1, " ".join(edited(base, rng.choice([0, 0.01, 0.03, 0.05]), rng))))
    rows += [(900, "a b c"), (901, "A\tB\n c "), (902, "a b"), (903, ""), (904, None), (905, " \n")]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_bucket_of_many_blocks(spark, monkeypatch):
    from awareness_mart.llm import near_dups

    monkeypatch.setattr(near_dups, "BLOCK", 7)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(edited(base, 0.03, rng))) for k in range(80)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_nulls_repeats_extra_columns_and_no_rows(spark):
    text = "one two three four five six seven"
    rows = [(None, text, 1), (4, text, 2), (4, text, 2), (2, text.upper(), None), (None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    found = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert found == {(None, None, True), (4, 2, False), (2, 2, True)}
    assert near_duplicates(docs).count() == 5
    assert near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_words_have_one_hash_wherever_they_stand(monkeypatch, piece):
    monkeypatch.setattr(common, "PIECE", piece)
    rng = random.Random(11)
    alphabet = "aAbZ\u00e9\u2003\x00\x1f \t\n\x0b\x0c\r"
    hash_of = {}
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))).encode()
        words, found = lower_words(text), word_hashes(text).tolist()
        assert len(words) == len(found)
        for word, h in zip(words, found):
            assert hash_of.setdefault(word, h) == h
    assert len(set(hash_of.values())) == len(hash_of)
    assert word_hashes(None).size == word_hashes(b" \n").size == shingle_set(word_hashes(b"")).size == 0


def test_shingle_set_has_the_size_of_the_set_of_shingles():
    rng = random.Random(12)
    for n in (1, 4, 5, 6, 400):
        text = " ".join(rng.choice("abcd") for _ in range(n)).encode()
        assert len(shingle_set(word_hashes(text))) == len(np.unique(shingles(lower_words(text))))


def test_registers_merge():
    a = shingles([b"w%d" % k for k in range(300)])
    b = shingles([b"v%d" % k for k in range(9000)])
    assert (merged(registers(a), registers(b)) == registers(np.concatenate([a, b]))).all()


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_a_path(spark, n):
    links = [(k, k + 1) for k in range(n)] + [(100, 100), (None, 3), (200, 300)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert sorted(found) == sorted([(k, 0) for k in range(n + 1)] + [(200, 200), (300, 200)])


def test_large_buckets_of_several_classes(spark, monkeypatch):
    """Texts that share registers without being linked, beside a large class."""
    from awareness_mart.llm import near_dups

    monkeypatch.setattr(near_dups, "BLOCK", 5)
    rng = random.Random(8)
    rows = []
    for group, share in ((0, 0.01), (1, 0.01), (2, 0.06)):
        base = [f"w{k}" for k in range(100)] + [f"g{group}.{k}" for k in range(40)]
        rows += [(1000 * group + k, " ".join(edited(base, share, rng))) for k in range(40)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_blocks_of_unlike_classes_meet_once(spark, monkeypatch):
    from awareness_mart.llm import near_dups

    monkeypatch.setattr(near_dups, "BLOCK", 3)
    classes = {k: 0 if k < 20 else 20 if k < 28 else k for k in range(36)}
    marked = spark.createDataFrame([(k, 7, c) for k, c in classes.items()], "doc_id long, bucket long, class long")
    rows = near_dups._unlike(marked).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.lo, r.hi), []).append(r)
    met = [
        (min(x.doc_id, y.doc_id), max(x.doc_id, y.doc_id))
        for (lo, hi), held in groups.items()
        for i, x in enumerate(held)
        for y in held[:i]
        if x["class"] != y["class"] and (lo == hi or x.block != y.block)
    ]
    wanted = {(a, b) for a in classes for b in classes if a < b and classes[a] != classes[b]}
    assert len(met) == len(set(met)) and set(met) == wanted
    alone = marked.where("class = 0")
    assert near_dups._unlike(alone).count() == 0
