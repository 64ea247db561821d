"""Language of texts by Bloom filters of n-grams that hold a bit per language.

Characters in n-grams of three and four are hashed to two of 2^18 positions. Training
counts, per language and position, over all labelled texts; a language's bit is set where
its share is high enough in itself and against the language with the highest. Looking up an
n-gram ANDs the masks of its positions: one read says which languages contain it. Hits per
language, less those that the filter's fill explains, decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

POSITIONS = 1 << 18
GRAMS = (3, 4)
LEAST_SHARE = 2e-5  # of a language's n-grams that fall on a position
AGAINST_BEST = 0.2  # of the highest share that any language has there
_SLICE = 1 << 20  # characters that are hashed at a time
_ROW = 4096  # positions in a row of counts


@cache
def _letters() -> np.ndarray:
    """Per code point: 1 if it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def positions(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two positions of each n-gram; runs without letters count as one space."""
    for at in range(0, len(text), _SLICE):
        raw = text[max(0, at - 3) : at + _SLICE].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, "<u4")
        codes = np.where(_letters()[codes], codes, 32).astype(np.uint64)
        codes = codes[(codes != 32) | np.append(True, codes[:-1] != 32)]
        codes = np.concatenate([[32], codes[1:] if codes[0] == 32 else codes, [32]])
        codes = codes.astype(np.uint64)
        for n in GRAMS:
            if len(codes) < n:
                continue
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ codes[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            yield (h % np.uint64(POSITIONS)).astype(np.int64), (
                (h >> np.uint64(40)) % np.uint64(POSITIONS)
            ).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of the task: counts of its positions, in rows of _ROW."""
    counts: dict[str, np.ndarray] = {}
    waiting: dict[str, list[np.ndarray]] = {}

    def empty(lang: str) -> None:
        own = np.bincount(np.concatenate(waiting.pop(lang)), minlength=POSITIONS)
        counts[lang] = counts[lang] + own if lang in counts else own

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"].to_pylist(), strict=True):
            for pair in positions(text.as_py()):
                waiting.setdefault(lang, []).extend(pair)
            if sum(map(len, waiting.get(lang, ()))) > _SLICE:
                empty(lang)
    for lang in list(waiting):
        empty(lang)
    for lang, own in counts.items():
        rows = own.reshape(-1, _ROW)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(used), pa.string()),
                pa.array(used.astype(np.int32)),
                pa.array([rows[k].astype("<i8").tobytes() for k in used], pa.binary()),
            ],
            names=["lang", "row", "counts"],
        )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counts of equal (lang, row); the task holds one sum for each of its keys."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for lang, row, raw in zip(*[batch[c].to_pylist() for c in batch.schema.names], strict=True):
            own = np.frombuffer(raw, "<i8")
            sums[lang, row] = sums[lang, row] + own if (lang, row) in sums else own
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in sums], pa.string()),
                pa.array([k[1] for k in sums], pa.int32()),
                pa.array([v.tobytes() for v in sums.values()], pa.binary()),
                pa.array([int(v.sum()) for v in sums.values()], pa.int64()),
            ],
            names=["lang", "row", "counts", "total"],
        )


class Filter:
    """Masks per position, one slice of 64 languages each, and what chance explains."""

    def __init__(self, langs: list[str]) -> None:
        self.langs = langs
        self.masks = np.zeros((max(1, -(-len(langs) // 64)), POSITIONS), np.uint64)
        self.chance = np.zeros(len(langs))

    def add(self, lang: int, at: slice, share: np.ndarray, best: np.ndarray) -> None:
        """Set a language's bit where its share of a row of positions is high enough."""
        on = (share >= LEAST_SHARE) & (share >= AGAINST_BEST * best)
        self.masks[lang // 64, at] |= on.astype(np.uint64) << np.uint64(lang % 64)
        self.chance[lang] += on.sum()

    def close(self) -> None:
        self.chance = (self.chance / POSITIONS) ** 2

    def hits(self, text: str) -> tuple[np.ndarray, int]:
        """N-grams that each language contains, and all n-grams."""
        total, found = 0, np.zeros(len(self.langs))
        for a, b in positions(text):
            total += len(a)
            for s, masks in enumerate(self.masks):
                both = masks[a] & masks[b]
                for k in range(64 * s, min(64 * s + 64, len(self.langs))):
                    found[k] += np.count_nonzero(both & (np.uint64(1) << np.uint64(k % 64)))
        return found, total

    def decide(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        found, total = self.hits(text)
        share = np.clip((found / total - self.chance) / (1 - self.chance), 0, 1)
        best = int(share.argmax())
        return self.langs[best], float(share[best])


def train(labelled: DataFrame) -> Filter:
    """A filter from all rows (text, lang); rows without text or lang are left out."""
    rows = labelled.where("text is not null and lang is not null").select(
        "text", F.col("lang").cast("string")
    )
    kind = "lang string, row int, counts binary"
    summed = f"{kind}, total bigint"
    sums = written(rows.mapInArrow(_count, kind).repartition("lang", "row").mapInArrow(_add, summed), "grams")
    totals = {r["lang"]: r["n"] for r in sums.groupBy("lang").agg(F.sum("total").alias("n")).collect()}
    # Of any number of languages the driver holds one row of counts, and their masks.
    langs = {lang: k for k, lang in enumerate(sorted(totals))}
    best = np.zeros(POSITIONS)

    def shares() -> Iterator[tuple[int, slice, np.ndarray]]:
        for r in sums.toLocalIterator():
            at = slice(r["row"] * _ROW, (r["row"] + 1) * _ROW)
            yield langs[r["lang"]], at, np.frombuffer(r["counts"], "<i8") / max(1.0, totals[r["lang"]])

    for _, at, share in shares():
        np.maximum(best[at], share, out=best[at])
    model = Filter(list(langs))
    for lang, at, share in shares():
        model.add(lang, at, share, best[at])
    model.close()
    return model


def _decide(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.decide(x.as_py()) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([x for _, x in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def predicted(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of docs (doc_id, text, lang).

    Learns from rows that are not held out. und, with score 0, if the text is null or has
    no letter, or if nothing was learned; equal scores go to the first language by name.
    The score is the share of n-grams that the language contains, corrected for chance.
    Rows that repeat count each time; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs.where(~held_out)))
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(
        _decide(model), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
