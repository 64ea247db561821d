"""Long, null, empty, repeated and clashing input, and tables on which a verdict depends."""

import random
import time
from collections import Counter

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from awareness_mart.llm import chat, language
from awareness_mart.llm.common import running
from awareness_mart.llm.queries import ORACLES, QUERIES
from awareness_mart.llm.secret_scan import redacted, report


def test_roles_of_any_length(spark):
    roles = ["user" * 25_000, "a:" * 3000 + "\\", "\\" * 2001 + ":", ": ", "", "\U0001f600:\n: x"]
    rows = [(k, t, role, f"text {k} : \\{role[:9]}") for k, role in enumerate(roles) for t in range(2)]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.expanded(rows).groupBy("conv_id").agg(F.max_by("formatted", "example").alias("f"))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in back.select("conv_id", chat.parsed(F.col("f")).alias("turns")).collect()}
    assert got == {k: [(role, f"text {k} : \\{role[:9]}")] * 2 for k, role in enumerate(roles)}


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_folds_any_length(spark, n):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda x: x).alias("a"))
    a = F.slice("a", 1, n) if n else F.array().cast("array<int>")
    got = df.select(running(a, F.lit(0), lambda s, x: s + x, lambda s, x: s + x, "int").alias("r")).first().r
    assert got == [sum(range(k + 1)) for k in range(n)]


def test_many_spans_in_one_text(spark):
    """A text of 40,000 spans; the time must not grow with their square."""
    took = []
    for n in (20_000, 40_000):
        text = ("%032x " % 7) * n + "end é"
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.time()
        assert report(docs).first().n_hex == n
        assert redacted(docs).first().text == "[SECRET] " * n + "end é"
        took.append(time.time() - started)
    assert took[1] < 3 * took[0] + 5, took


def test_short_random_runs_are_scored(spark):
    rng = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = ["con", "fig", "ura", "tion", "man", "ager", "hand", "ler", "ser", "vice", "_"]
    rows = [(k, 'token = "%s"' % "".join(rng.choices(chars, k=40))) for k in range(200)]
    rows += [(1000 + k, "the %s runs" % "".join(rng.choices(syllables, k=5))) for k in range(600)]
    rows += [(9000 + k, "see %s here" % "".join(rng.choices(chars, k=16))) for k in range(50)]
    found = {r.doc_id: r.spans for r in report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[9000 + k] == "markov:4:20" for k in range(50)) > 25
    assert not any("markov" in s for i, s in found.items() if 1000 <= i < 9000)


def test_many_languages(spark):
    """More languages than fit in a few masks; each has letters of its own."""
    rows = [(k, "".join(chr(0x4E00 + 20 * k + j) for j in range(20)) * 3, f"l{k:03}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predicted(docs, F.lit(False)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {k: lang for k, _, lang in rows}


def _hosts(spark, folder):
    """A host of junk among hosts that fail a rule here and there."""
    rng = random.Random(6)
    rows = []
    for k in range(400):
        host = f"h{k % 8}"
        junk = rng.random() < (0.96 if host == "h3" else 0.05)
        words = [f"w{rng.randrange(9999)}" for _ in range(80)]
        rows.append((k, " ".join(words + ["#" * 30] * junk), "en", host if k % 50 else None, 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return {k: ("#" in text, host) for k, text, _, host, _ in rows}


def test_hosts_decide_documents(spark, tmp_path):
    rows = _hosts(spark, str(tmp_path))
    found = {r.doc_id: r for r in QUERIES["op9_host_quality"](spark, str(tmp_path)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {k for k, r in found.items() if not r.kept} == {k for k, (_, host) in rows.items() if host == "h3"}
    connection = duck("/nowhere")
    connection.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, connection, "op9_host_quality", str(tmp_path)) == [] and ORACLES
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()}
    assert kept == {k for k, (_, host) in rows.items() if host != "h3"}


STAGES = corpus_pipeline.STAGES[:4]
CLASHING = ["__id", "__hash", "__m", "__key", "__base", "spans", "verdict", "kept", "bad", "host", "row_hash", "component_id", "n"]


@pytest.mark.parametrize("name,stage", STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    """Nulls in any column, empty and long texts, repeated rows and clashing names."""
    words = " ".join(f"word{k}" for k in range(70))
    rows = [
        (1, words, "en", "a", 3),
        (1, words, "en", "a", 3),
        (None, words + " more of it " + "x" * 10, None, None, None),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "long " + " ".join(f"v{k}" for k in range(200_000)), "en", None, 1),
        (5, "token = abcdefgh12 " + " ".join(f"u{k}" for k in range(60)), "en", "b", 1),
        (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    sf = "/root/testdata/sf0.001"
    got = stage(spark, docs, sf)
    assert got.columns == docs.columns
    ids = sorted((r.doc_id, r.text is None) for r in got.collect() if r.doc_id is not None)
    wanted = {
        "quality": [(1, False), (1, False), (4, False), (5, False)],
        "near_dedup": [(1, False), (1, False), (2, True), (3, False), (4, False), (5, False)],
    }.get(name, [(1, False), (1, False), (2, True), (3, False), (4, False), (5, False)])
    assert ids == wanted
    assert all(r[c] == k for r in got.collect() for k, c in enumerate(CLASHING))
    if name == "secrets":
        text = got.where("doc_id = 5").first()
        assert text.text.startswith("[SECRET] u0") and text.n_chars == len(text.text)
        assert got.where("doc_id = 2").first().n_chars is None
    assert stage(spark, docs.limit(0), sf).collect() == []


def test_language_decisions_by_brute_force(spark):
    """Masks, chance and decision counted one n-gram at a time."""
    rng = random.Random(8)
    alphabets = {"aa": "abcdefgh ", "bb": "efghijkl ", "cc": "abijmnop "}
    rows = []
    for k in range(120):
        lang = rng.choice(list(alphabets))
        rows.append((k, "".join(rng.choices(alphabets[lang], k=rng.randrange(0, 90))), lang if k % 4 else None))
    rows += [(200, None, "aa"), (201, "123 ,.", "bb"), (202, "Zz", "cc")]
    counts = {lang: Counter() for lang in alphabets}
    for _, text, lang in rows:
        if lang and text is not None:
            for a, b in language.positions(text):
                counts[lang].update(a.tolist())
                counts[lang].update(b.tolist())
    share = {x: {p: n / sum(c.values()) for p, n in c.items()} for x, c in counts.items()}
    best = {p: max(s.get(p, 0) for s in share.values()) for s in share.values() for p in s}
    on = {
        x: {p for p, v in s.items() if v >= language.LEAST_SHARE and v >= language.AGAINST_BEST * best[p]}
        for x, s in share.items()
    }

    def decide(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        pairs = [p for a, b in language.positions(text) for p in zip(a.tolist(), b.tolist())]
        scores = []
        for x in sorted(on):
            chance = (len(on[x]) / language.POSITIONS) ** 2
            found = sum(a in on[x] and b in on[x] for a, b in pairs) / len(pairs)
            scores.append((min(max((found - chance) / (1 - chance), 0), 1), x))
        top = max(s for s, _ in scores)
        return next(x for s, x in scores if s == top), top

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for r in language.predicted(docs, F.lit(False)).collect():
        lang, score = decide(rows[[i for i, _, _ in rows].index(r.doc_id)][1])
        assert (r.lang_pred, r.score) == (lang, pytest.approx(score)), r
