"""Quality rules and benchmark search on the cases that tables seldom hold."""

import random

import corpus_pipeline
from awareness_mart.llm.common import lower_words, without
from awareness_mart.llm.decontaminate import contained_items
from awareness_mart.llm.quality import judged, rejected_hosts, measures

DOCS = "doc_id bigint, text string, source string"


def repeated_words(words):
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    hit = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {k, k + 1, k + 2}
    return len(hit)


def test_measures_as_by_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a", "b", " ", " ", "\n", "é#", "\t", "\x0b", " ", "$"], k=rng.randrange(60))) for _ in range(200)]
    texts += ["a b c " * 40, "", None, "\n \n", "one"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], DOCS)
    for r in measures(docs).collect():
        text = texts[r.doc_id] or ""
        words = [w.decode() for w in text.encode().split()]
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated_words(words)


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(k, "few words", "bad") for k in range(90)] + [(90 + k, good, "bad") for k in range(5)]
    rows += [(200 + k, good, f"h{k % 9}") for k in range(300)] + [(900, good, None), (None, good, "h1")]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in judged(docs).collect()}
    assert not found[92].kept and found[92].host_failed and not found[92].base_failed
    assert found[900].kept and found[205].kept and found[None].kept
    assert [r.host for r in rejected_hosts(measures(docs)).collect()] == ["bad"]
    assert judged(docs.limit(0)).collect() == []


def test_an_outlying_host_loses_the_documents_that_fail(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(k, good + " #" * 30 if k % 5 < 3 else good, "junk") for k in range(200)]
    rows += [(1000 + k, good + " #" * 30 if k % 12 == 0 else good, f"h{k % 19}") for k in range(1900)]
    docs = spark.createDataFrame([*rows, (5000, good + " #" * 30, None)], DOCS)
    found = {r.doc_id: r for r in judged(docs, by_rule=True).collect()}
    assert len(found) == len(rows) + 1
    assert {k for k, r in found.items() if not r.kept} == {k for k in range(200) if k % 5 < 3}
    assert all(r.rule_failed != r.kept and not r.host_failed for r in found.values())
    assert {k for k, r in found.items() if r.kept} == {r.doc_id for r in corpus_pipeline.quality(spark, docs, "").collect()}
    alone = judged(docs.where("source = 'junk'"), by_rule=True)
    assert alone.where("not kept").count() == 0 and judged(docs.limit(0), by_rule=True).collect() == []


def test_rows_without_id_are_dropped_by_their_text(spark):
    docs = spark.createDataFrame([(None, "x", "s"), (None, None, "s"), (1, "y", "s")], DOCS)
    bad = judged(docs).where("not kept and n_words = 1")
    assert [(r.doc_id, r.text) for r in without(docs, bad).collect()] == [(None, None)]


def shingle_set(text):
    w = lower_words(text.encode() if text else None)
    n = min(5, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def test_items_of_all_sizes_in_short_and_long_documents(spark):
    rng = random.Random(9)
    draw = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [(k, draw(n)) for k, n in enumerate([3, 5, 6, 8, 9, 12, 13, 20, 21, 40, 60, 150, 700])]
    docs = []
    for k in range(300):
        words = draw(rng.choice([0, 5, 50, 400, 6000]))
        for _, item in rng.sample(items, 2):
            part = [w if rng.random() > 0.03 else "z" for w in item[rng.randrange(2) :]]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((k, " ".join(words)))
    docs += [(1000, None), (1001, ""), (None, " ".join(items[9][1])), (1002, "w1 W2"), (1002, "w1 W2")]
    rows = [(i, " ".join(w).upper()) for i, w in items] + [(90, None), (91, ""), (None, "w1 w2")]
    want = []
    sets = [(i, shingle_set(t)) for i, t in rows]
    for d, text in docs:
        own = shingle_set(text)
        want += [(d, i, len(s), len(s & own)) for i, s in sets if s and 100 * len(s & own) >= 75 * len(s)]
    found = contained_items(
        spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, item_id int"),
        spark.createDataFrame(rows, "item_id bigint, text string"),
    ).drop("row_hash").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want)) and len(want) > 250


def test_several_passes_and_no_rows(spark, monkeypatch):
    from awareness_mart.llm import decontaminate

    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 40)
    items = spark.createDataFrame([(k, f"a{k} b{k} c{k} d{k} e{k} f{k}") for k in range(9)], "item_id bigint, text string")
    docs = items.selectExpr("item_id as doc_id", "text")
    assert sorted(r.item_id for r in contained_items(docs, items).collect()) == list(range(9))
    assert contained_items(docs.limit(0), items).collect() == []
    assert contained_items(docs, items.limit(0)).collect() == []
