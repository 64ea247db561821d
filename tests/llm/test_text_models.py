"""Token counts, page text, toxicity, language and chat on fixtures and by brute force."""

import hashlib
import random
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from awareness_mart.llm import chat, html_extract, language, token_counts, toxicity
from awareness_mart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def by_whole_text(text, rule, starts=None):
    tokenizer = Tokenizer.from_file(token_counts.TOKENIZER)
    tokenizer.encode_special_tokens = True
    starts = token_counts.line_starts(text) if starts is None else np.array(starts)
    counts = [0] * len(starts)
    for a, b in tokenizer.encode(text).offsets:
        owners = [int(np.searchsorted(starts, x, "right")) - 1 for x in range(a, b)]
        best = max(sorted(set(owners)), key=owners.count)
        counts[{"start": owners[0], "end": owners[-1], "most": best}[rule]] += 1
    return counts


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB é中\n\n\n\t.,9'<|endoftext|>", max_size=50), st.sampled_from(token_counts.RULES))
def test_token_spans_are_those_of_the_whole_text(text, rule):
    spans = token_counts._known(token_counts.TOKENIZER)
    found = token_counts.attributed(spans, spans.parts([text])[0], token_counts.line_starts(text), rule)
    assert found.tolist() == by_whole_text(text, rule)


def test_token_counts_of_odd_rows_and_given_sections(spark):
    rows = [(None, "a\n\n\nb", None, 1), (2, "", None, 1), (2, None, None, 1), (3, "hello world " * 5000, [4, 4, None, 99999], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, at array<int>, section int")
    found = token_counts.token_counts(docs, "most", starts_col="at").collect()
    assert [r.n_tokens for r in found if r.doc_id is None] == by_whole_text("a\n\n\nb", "most")
    assert [tuple(r) for r in found if r.doc_id == 2] == [(2, 0, 0, 0, 0)] * 2
    assert [r.n_tokens for r in found if r.doc_id == 3] == by_whole_text("hello world " * 5000, "most", [0, 4])
    assert token_counts.token_counts(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        token_counts.token_counts(docs, "half")


PAGE = (
    "<html><head><title>x</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li>Home"
    "<li>News</ul></nav><div class='sidebar'>Side</div><div id=body><div>Same on all pages</div><h1>%s &amp; co</h1>"
    "<p>%s <b>bold</b>\n  more<p>last &lt;one&gt;</div><section class=comments><p>I say</p></section>"
    "<form>Mail <input></form><footer>&copy; me</footer></body></html>"
)


def test_wrapper_drops_what_pages_share(spark):
    text = {k: (f"Title {k} " + "long " * k, f"Text number {k} " * 9) for k in range(9)}
    rows = [(k, "http://a.example/x", PAGE % t, "u") for k, t in text.items()]
    rows += [(100, "http://b.example/x", PAGE % ("Alone", "page"), "u"), (101, "nonsense", None, "u"), (None, None, "", "u"), (102, "http://a.example/y", "<p>plain", "u")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = {r.page_id: r for r in html_extract.extracted(pages).collect()}
    for k, (title, body) in text.items():
        blocks = [f"{title} & co", f"{body} bold more", "last <one>"]
        assert found[k].text == "\n\n".join(" ".join(b.split()) for b in blocks)
        assert found[k].n_chars == len(found[k].text)
    assert found[100].text.endswith("Alone & co\n\npage bold more\n\nlast <one>")
    assert (found[101].text, found[None].text, found[102].text) == ("", "", "plain")
    assert html_extract.extracted(pages.limit(0)).collect() == []


def test_short_articles_under_long_shared_text():
    page = "<body><div>%s</div><article><h1>Title %d</h1><p>Story %d.<div>%s</div></article></body>"
    pages = [page % ("Read this first. " * 40, k, k, "All rights reserved. " * 20) for k in range(5)]
    wrapper = html_extract.induce([*pages, *pages])
    assert [html_extract.extract(p, wrapper) for p in pages] == [f"Title {k}\n\nStory {k}." for k in range(5)]
    assert "All rights" in html_extract.extract(pages[0], html_extract.induce([pages[0], pages[0] + " "]))


def test_silent_elements_end_where_they_end():
    read = lambda page: html_extract.extract(page, None)
    assert read("<p>a<svg class='i'/><p>b<math /><p>c<svg><text>x</text></svg>d") == "a\n\nb\n\ncd"
    assert read("<p>a<svg-icon name=x></svg-icon> b<template-x> c<object-y>") == "a b c"
    assert read("<p>a<svg><p>b<noscript>c") == "a\n\nbc"
    assert read("<p>a<script>b</scripts><p>c") == read("<p>a<style/>b") == "a"
    assert read("<p>a<SCRIPT>if (x < y) '</p>'</script ><p>b") == "a\n\nb"


def test_parts_that_hold_the_article_stay():
    read = lambda page: html_extract.extract(page, None)
    art = "<article%s><header><h1>Head</h1></header><p>Long text of it.</article>"
    for open_ in ("<div class='content has-sidebar'>", "<div id='main-with-nav'>", "<div class='widget'>", "<form>"):
        for own in ("", " class='post long-form'", " class='share-target'", " class='share'"):
            page = "<body><header>Site</header>" + open_ + art % own + "</body>"
            assert read(page) == "Head\n\nLong text of it."
    page = art % "" + "<section class='comments'><article class='comment'>I say</article></section>"
    assert read(page) == "Head\n\nLong text of it."
    pages = [f"<body><nav>Home</nav><form id=all><p>Text {k}. {'word ' * 30}{k}</form><div>me</div>" for k in range(4)]
    wrapper = html_extract.induce(pages)
    for k, page in enumerate(pages):
        assert html_extract.extract(page, wrapper) == f"Text {k}. {'word ' * 30}{k}"
    assert "word" in read(pages[0]) and "Home" not in read(pages[0])


def test_all_pages_of_a_host_are_counted_by_layout(spark):
    body = lambda k: f"<article><h1>T{k}</h1><p>Story {k} {'x' * (k % 5)}.%s</article>"
    rare = "<div class=alert-%d>Minority notice.</div>"
    rows = []
    for k in range(60):
        if k % 10 == 0:
            page = f"<body><table><tr><td>Old layout.<tr><td><div id=text{k}><h2>T{k}</h2>Story {k}.</div></table>"
        else:
            page = "<body><div>Shared.</div>" + body(k) % (rare % k if k % 10 == 1 else "")
        rows += [(k, "http://a.example/", page)] * (30 if k == 7 else 1)
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in html_extract.extracted(pages).collect():
        assert r.text.split("\n\n")[0] == f"T{r.page_id}", r
        assert "notice" not in r.text and "Shared" not in r.text and "Old" not in r.text and f"Story {r.page_id}" in r.text


def plain_matching(a, b):
    xs, ys = html_extract.folded(a), html_extract.folded(b)
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, (label, left) in enumerate(xs):
        for j, (other, right) in enumerate(ys):
            pair = plain_matching(html_extract.merged(left), html_extract.merged(right)) if label == other else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + pair)
    return 1 + best[-1][-1]


def test_trees_of_every_size_are_aligned_in_full():
    rng = random.Random(4)
    inner = ["", "<p>x", "<p>x<h2>y</h2>", "<ul><li>z</ul><p>x"]
    for n in (3, 20, 90):
        for _ in range(12):
            tree = lambda: "".join(f"<div class={rng.choice('abc')}>{rng.choice(inner)}</div>" for _ in range(rng.randrange(n)))
            a, b = html_extract.parse(tree()), html_extract.parse(tree())
            assert html_extract.matching(a, b)[0] == plain_matching(a, b)
    parts = [f"<p>{k}</p><h2>{k}</h2>" for k in range(400)]
    a, b = html_extract.parse("".join(parts)), html_extract.parse("<h2>new</h2>" + "".join(parts))
    pairs = html_extract.matching(a, b)[1]
    assert len(pairs) == 801 and all(x.parts == y.parts for _, x, y in pairs[1:])


def test_tree_matching_aligns_the_largest_common_tree():
    a = html_extract.parse("<div><p>1</p></div><ul><li>x</ul><div class=z>2</div>")
    b = html_extract.parse("<ul><li>y</ul><div class=z>2</div><div><p>1</p></div>")
    size, pairs = html_extract.matching(a, b)
    assert size == 4 and {p for p, _, _ in pairs} == {"", "/ul#0", "/ul#0/li#0", "/div z#0"}


def test_deep_and_broken_pages():
    page = "<div>" * 5000 + "deep" + "<p>a<ul><li>b</ul>" * 2000 + "<p class='x"
    assert html_extract.extract(page, html_extract.induce([page, page + "<p>q"])).startswith("deep")
    assert html_extract.extract("text <3 &am", None) == "text <3 &am"


def brute_segments(scores):
    """Maximal segments by definition: the best segment, then left and right of it."""
    if not any(s > 0 for s in scores):
        return []
    sums = [0, *accumulate(scores)]
    value, _, i, j = max(
        (round(sums[j] - sums[i], 9), -(j - i), -i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)
    )
    i = -i
    right = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j, value), *right]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-5.03, -2.01, -1.07, 1.11, 2.17, 4.29]), max_size=14))
def test_segments_are_maximal(scores):
    found = toxicity.segments([(k, k + 1, s) for k, s in enumerate(scores)])
    assert sorted(round(s, 6) for _, _, s in found) == sorted(round(s, 6) for _, _, s in brute_segments(scores))


def test_toxicity_learns_words_and_scores_odd_rows(spark):
    rng = random.Random(1)
    calm = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(400):
        words = rng.choices(calm, k=80)
        if k % 4 == 0:
            words[rng.randrange(80)] = rng.choice(["vile", "rotten"])
            words[rng.randrange(80)] = "vile"
        rows.append((k, " ".join(words), 1.0))
    rows += [(1000, None, 1.0), (1001, "", 1.0), (None, "vile rotten vile", 1.0), (1002, "vile rotten " * 20000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(5, None)], "doc_id bigint, toxic int")
    held = F.coalesce(F.col("doc_id") >= 200, F.lit(False))
    found = {r.doc_id: r for r in toxicity.scored(docs, labels, held).collect()}
    assert all(found[k].predicted == (k % 4 == 0) for k in range(400))
    assert found[1002].predicted and not found[1000].predicted and found[1000].score == found[1001].score
    assert toxicity.scored(docs.limit(0), labels, held).collect() == []
    alone = toxicity.scored(docs, labels.limit(0), held).collect()
    assert {round(r.score, 3) for r in alone} == {0.0} and len(alone) == len(rows)


def test_toxicity_with_more_words_than_are_broadcast(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        words = rng.choices([f"w{n}" for n in range(100)], k=40)
        if k % 3 == 0:
            words += rng.choices(["vile", "rotten", "Rottenness", "nastily", "nastiest", "éééébc"], k=3)
        rows.append((k, " ".join(words)))
    rows += [(7, rows[0][1]), (None, "rottenly vile"), (400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id bigint, toxic int")
    score = lambda: sorted(
        (r.doc_id or -1, round(r.score, 9), round(r.best, 9), r.passages, round(r.share, 9))
        for r in toxicity.scored(docs, labels, F.coalesce(F.col("doc_id") >= 200, F.lit(False))).collect()
    )
    whole = score()
    monkeypatch.setattr(toxicity, "LEXICON", 2)
    assert score() == whole and len({x[1] for x in whole}) > 5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    found = QUERIES["op5_language_bloom"](spark, sf).where("held_out").collect()
    assert np.mean([docs.lang[r.doc_id] == r.lang_pred for r in found]) > 0.97


def test_language_of_odd_rows(spark):
    rows = [(k, t, x) for k, (t, x) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5)]
    rows += [(20, None, "en"), (21, " 12 ..", None), (22, "", "de"), (None, "THE DOG", None), (23, "und der hund " * 90000, None)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, lang string, lang_pred string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs, F.lit(False)).collect()}
    assert found[20] == found[21] == found[22] == ("und", 0.0)
    assert found[None][0] == "en" and found[23][0] == "de" and all(0 <= s <= 1 for _, s in found.values())
    assert {r.lang_pred for r in language.predicted(docs, F.lit(True)).collect()} == {"und"}
    assert language.predicted(docs.limit(0), F.lit(False)).collect() == []


def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(6)
    parts = ["###", "#", "</turn>", "\\", "\n", ": ", "assistant", "é", "</", "turn>", "### user: ", ":", ""]
    make = lambda: "".join(rng.choices(parts, k=rng.randrange(7)))
    talks = {c: [(rng.choice(["user", "assistant", make()]), make()) for _ in range(rng.randrange(1, 7))] for c in range(150)}
    rows = [(c, k, r, t, 0) for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    rows += [(None, None, None, None, 0), (-1, 0, "assistant", "long " * 40000, 0)]
    talks |= {None: [("", "")], -1: [("assistant", "long " * 40000)]}
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, example int")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    examples = chat.expanded(table)
    for r in chat.digest(examples).collect():
        turns = talks[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns)), turns
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), sha(loss))
    counts = {r.conv_id: r["count"] for r in examples.groupBy("conv_id").count().collect()}
    assert counts == {c: max(1, sum(r == "assistant" for r, _ in t) + (t[-1][0] != "assistant")) for c, t in talks.items()}
    assert chat.digest(chat.expanded(table.limit(0))).collect() == []


def test_what_recurs_among_varying_siblings_stays(spark):
    """Headings, paragraphs and items that many articles share are theirs; whole containers are notices."""
    def page(k):
        return (
            f"<body><div class=content><h1>Title {k}</h1><p>Story {k} of the day.</p><h2>Summary</h2>"
            f"<p>Point {k}.</p><p>Same line.</p><ul><li>Same item<li>Item {k}</ul>"
            "<div class=box><h3>Join us</h3><p>Every week.</p></div></div></body>"
        )

    rows = [(k, "http://h.example/a", page(k)) for k in range(30)]
    found = html_extract.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    for r in found.collect():
        k = r.page_id
        assert r.text.split("\n\n") == [
            f"Title {k}", f"Story {k} of the day.", "Summary", f"Point {k}.", "Same line.", "Same item", f"Item {k}"
        ]


def test_controls_and_named_adverts_are_no_text():
    read = lambda page: html_extract.extract(page, None)
    assert read("<p>A <select><option>opt</select><button type=x>Buy</button><label>Lab</label>"
                "<textarea>ta</textarea> b.") == "A b."  # fmt: skip
    assert read("<div><p>Text.</p><div class='box ad-slot'>Buy</div><div class=top_ads>Now</div>"
                "<div class=ad-hoc>x</div></div>") == "Text."  # fmt: skip
    assert read("<div class=adventure>Text.</div>") == "Text."
    assert read("<p>open <button>never closed") == "open never closed"


@pytest.mark.parametrize("share", [1, 1000])
def test_pages_of_rare_layouts_are_read_alike(spark, monkeypatch, share):
    """Whether wrappers are sent to the tasks or joined by key, the texts are the same."""
    monkeypatch.setattr(html_extract, "HOT_SHARE", share)
    monkeypatch.setattr(html_extract, "HELD", 300)
    rows, wanted = [(-1, None, "<p>x"), (-2, "http://h0.example/", None)], {-1: "x", -2: ""}
    rng = random.Random(4)
    for k in range(60):
        host = min(k % 7, 3)
        names = [f"class=c{host}", "", "id=x"][k % (host + 1) if host < 3 else 0]
        lines = [f"Line {rng.randrange(10**6)} of {k}." for _ in range(rng.randrange(1, 5))]
        body = "".join(f"<p>{x}</p>" for x in lines)
        html = f"<body><nav>Menu</nav><div {names}>{body}</div><div class=legal><p>Rights of h{host}.</p></div></body>"
        rows.append((k, f"http://h{host}.example/{k}", html))
        wanted[k] = "\n\n".join(lines)
    found = html_extract.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    assert got == {k: (t, len(t)) for k, t in wanted.items()}
