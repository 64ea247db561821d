"""Toxic passages: maximum-scoring segments over word log-odds, calibrated by extreme values.

Words of toxic and other training texts are counted over all of them, once a text, so that
one text's repetitions weigh no more than a mention; log-odds use a Dirichlet prior with the
words' overall shares (Monroe et al., 2008). Words that differ
significantly carry their log-odds, all words cost DRIFT. One linear pass per text finds
all maximal segments (Ruzzo and Tompa, 1999). A segment's score S counts as
lambda * S - ln n, whose distribution over other texts is of the Gumbel kind; a logistic
curve over the best of them, their number and the share of toxic words gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

PRIOR = 0.1  # weight of the Dirichlet prior, as a share of all counts
STEMS = (4, 6)  # beginnings of words that are counted like words
LEAST_Z = 4.0
LEAST_COUNT = 5
LEXICON = 200_000  # more significant words than this are joined to the texts' words, not broadcast
DRIFT = 0.05
SIGNIFICANT = 0.01  # expected number of such segments in a text that isn't toxic
FIT_ROWS = 100_000  # labelled rows, at most twice as many, that the logistic curve is fitted to
_FLUSH = 400_000

_WORD = re.compile(r"[^\W_]+")


def stems(word: str) -> list[str]:
    """Beginnings of a longer word, marked as such."""
    return [f"{word[:n]}*" for n in STEMS if len(word) > n]


class Weights(dict):
    """word -> its weight, or that of a stem, whichever is larger; remembers some words."""

    def __init__(self, model: dict[str, float]) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float | None:
        known = [self.model[x] for x in (word, *stems(word)) if x in self.model]
        weight = max(known, key=abs) if known else None
        if len(self) < _FLUSH:
            self[word] = weight
        return weight


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic texts, other texts) of the task, summed as far as memory is bounded."""
    sums: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        toxic, other = zip(*sums.values(), strict=True) if sums else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(toxic, pa.int64()), pa.array(other, pa.int64())],
            names=["word", "n_toxic", "n_other"],
        )

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            at = 0 if toxic else 1
            words = set(_WORD.findall((text.as_py() or "").lower()))
            for word in words.union(x for w in words for x in stems(w)):
                own = sums.get(word)
                if own is None:
                    own = sums[word] = [0, 0]
                own[at] += 1
            if len(sums) > _FLUSH:
                yield out()
                sums.clear()
    yield out()


class Found(dict):
    """word -> its weight, of the words of a text that have one."""

    def __missing__(self, word: str) -> None:
        return None


def log_odds(labelled: DataFrame) -> tuple[dict[str, float] | DataFrame, float]:
    """Weights of all significant words, and lambda, from all rows (text, toxic).

    The weights are a dictionary, or a table (word, w) of more than LEXICON words.
    """
    rows = labelled.where("toxic is not null").select("text", F.col("toxic").cast("int"))
    words = written(
        rows.mapInArrow(_counts, "word string, n_toxic bigint, n_other bigint")
        .groupBy("word")
        .agg(F.sum("n_toxic").alias("a"), F.sum("n_other").alias("b")),
        "words",
    )
    total = words.agg(F.sum("a"), F.sum("b")).first()
    n, m = float(total[0] or 0), float(total[1] or 0)
    if not n or not m:
        return {}, 1.0
    prior, all_prior = PRIOR * (F.col("a") + F.col("b")), PRIOR * (n + m)
    odds = F.log((F.col("a") + prior) / (n + all_prior - F.col("a") - prior)) - F.log(
        (F.col("b") + prior) / (m + all_prior - F.col("b") - prior)
    )
    deviation = F.sqrt(1 / (F.col("a") + prior) + 1 / (F.col("b") + prior))
    strong = written(
        words.select("word", "b", odds.alias("w"), (odds / deviation).alias("z"))
        .where((F.abs("z") >= LEAST_Z) & (F.col("a") + F.col("b") >= LEAST_COUNT))
        .select("word", "b", "w"),
        "lexicon",
    )
    if strong.count() > LEXICON:
        return strong.select("word", "w"), _table_lambda(strong, m)
    rows = sorted(strong.collect())
    weights = {r["word"]: r["w"] for r in rows}
    scores = np.array([r["w"] - DRIFT for r in rows] + [-DRIFT])
    shares = np.array([r["b"] / m for r in rows])
    return weights, _lambda(scores, np.append(shares, 1 - shares.sum()))


def _lambda(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * score)) = 1; 1 if there is none."""
    if not (scores > 0).any() or (scores * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while high < 64 and (shares * np.exp(high * scores)).sum() < 1:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return high


def _table_lambda(strong: DataFrame, total: float) -> float:
    """_lambda of a table (word, b, w), by passes over it that try some values each."""
    score, share = F.col("w") - DRIFT, F.col("b") / total
    best, mean, known = strong.agg(F.max(score), F.sum(score * share), F.sum(share)).first()
    rest = 1 - known
    if best <= 0 or mean - DRIFT * rest >= 0:
        return 1.0

    def sums(values: list[float]) -> list[float]:
        found = strong.agg(*[F.sum(share * F.exp(score * v)).alias(f"v{k}") for k, v in enumerate(values)]).first()
        return [x + rest * math.exp(-DRIFT * v) for x, v in zip(found, values, strict=True)]

    tried = [0.0] + [2.0**k for k in range(7)]
    for _ in range(13):
        enough = [x >= 1 for x in sums(tried[1:-1])] + [True]
        k = enough.index(True)
        low, high = tried[k], tried[k + 1]
        tried = [low + (high - low) * k / 32 for k in range(33)]
    return high


def segments(scores: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring (begin, end, score) of runs (begin, end, score), in linear time."""
    # begin, end, sum before, sum through, and the last one before with a smaller sum before
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for begin, end, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((begin, end, before, total, j))
                break
            begin, _, before, _, next_ = found[j]
            del found[j:]
            j = next_
    return [(b, e, through - left) for b, e, left, through, _ in found]


def runs(text: str | None, weights: Weights) -> tuple[list[tuple[int, int, float]], int]:
    """Scores of a text's words, neighbours without weight as one run; and its words."""
    words = _WORD.findall((text or "").lower())
    out, at = [], 0
    for k, weight in enumerate(map(weights.__getitem__, words)):
        if weight is not None:
            if k > at:
                out.append((at, k, -DRIFT * (k - at)))
            out.append((k, k + 1, weight - DRIFT))
            at = k + 1
    return out, len(words)


FEATURES = "best double, passages double, share double"


def _features(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Features of texts by a broadcast (weights, lambda); weights of None are in the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, rate = model.value
        weights = None if weights is None else Weights(weights)
        for batch in batches:
            own = batch["found"].to_pylist() if weights is None else [None] * batch.num_rows
            rows = []
            for text, found in zip(batch["text"], own, strict=True):
                known = Found((x["word"], x["w"]) for x in found or []) if weights is None else weights
                scored, n = runs(text.as_py(), known)
                size = math.log(n + 1)
                found = [rate * s - size for _, _, s in segments(scored)]
                positive = sum(s > 0 for _, _, s in scored)
                passages = sum(x > -math.log(SIGNIFICANT) for x in found)
                rows.append((max(found, default=-size), math.log1p(passages), positive / (n + 5)))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], *[pa.array(c, pa.float64()) for c in columns]],
                names=["doc_id", "held_out", "best", "passages", "share"],
            )

    return run


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, text in zip(*[batch[c].to_pylist() for c in ("a", "b", "text")], strict=True):
            words = sorted(set(_WORD.findall(text.lower())))
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a] * n, pa.int64()), pa.array([b] * n, pa.int64()), pa.array(words, pa.string())],
                names=["a", "b", "word"],
            )


def _with_weights(rows: DataFrame, strong: DataFrame) -> DataFrame:
    """rows with found: (word, w) of the words of their text that strong (word, w) knows.

    What Weights does, by joins: a word has its weight or that of a stem, whichever is larger.
    Texts are known by 128 bits of hash.
    """
    keyed = rows.withColumn("a", F.xxhash64("text")).withColumn("b", F.xxhash64(F.lit(1), "text"))
    pairs = keyed.where("text is not null").select("a", "b", "text").mapInArrow(
        _distinct_words, "a bigint, b bigint, word string"
    )
    forms = [F.struct(F.lit(0).alias("turn"), F.col("word").alias("form"))]
    for k, n in enumerate(STEMS):
        stem = F.struct(F.lit(-1 - k).alias("turn"), F.concat(F.substring("word", 1, n), F.lit("*")).alias("form"))
        forms.append(F.when(F.length("word") > n, stem))
    looked_up = pairs.select("word").distinct().select(
        "word", F.explode(F.array_compact(F.array(*forms))).alias("x")
    ).select("word", "x.turn", "x.form")
    known = looked_up.join(strong.withColumnRenamed("word", "form"), "form").groupBy("word").agg(
        F.max(F.struct(F.abs("w").alias("size"), "turn", "w"))["w"].alias("w")
    )
    found = pairs.join(known, "word").groupBy("a", "b").agg(F.collect_set(F.struct("word", "w")).alias("found"))
    return keyed.join(found, ["a", "b"], "left").select("doc_id", "held_out", "text", "found")


def fit(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic weights (last: intercept), means and deviations by Newton's method."""
    data = np.array(rows, float)
    if not len(data) or len(set(data[:, -1])) < 2:
        rate = float(data[:, -1].mean()) if len(data) else 0.0
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        return np.array([0, 0, 0, math.log(rate / (1 - rate))]), np.zeros(3), np.ones(3)
    x, y = data[:, :-1], data[:, -1]
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        w = w + np.linalg.solve(curve, slope)
    return w, mean, spread


def scored(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of docs (doc_id, text).

    Learns from labels (doc_id, toxic) of rows that are not held out. Null and empty texts
    have no words and get the score of a text without toxic words. Without labels, or with
    one label only, every score is that label's share. Rows that repeat are scored each
    time; rows without id learn nothing; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out.alias("held_out"), "text")
    labels = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int"))
    # One plan at every size: labels grow with the texts and are no lookup.
    weights, rate = log_odds(rows.where("not held_out").join(labels.hint("merge"), "doc_id"))
    if isinstance(weights, DataFrame):
        rows, weights = _with_weights(rows, weights), None
    shared = spark.sparkContext.broadcast((weights, rate))
    features = written(
        rows.mapInArrow(_features(shared), f"doc_id bigint, held_out boolean, {FEATURES}"), "features"
    )
    known = features.where("not held_out").join(labels, "doc_id")
    step = known.count() // FIT_ROWS + 1
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    w, mean, spread = fit(sample.select("best", "passages", "share", "toxic").collect())
    names = ["best", "passages", "share"]
    linear = sum(
        (F.col(c) - float(mean[k])) / float(spread[k]) * float(w[k]) for k, c in enumerate(names)
    )
    score = 1 / (1 + F.exp(-(linear + float(w[-1]))))
    return features.select(
        "doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), *names
    )
