"""Hard negatives of anchors by a secondary sort of scored pairs.

A pair of an anchor and a row becomes a key whose bytes sort by anchor, descending score,
positives before negatives, and row id. Keys are dealt by anchor and sorted within the
partitions; one pass over the stream opens a window at each positive and gives the negatives
that follow to the open windows. Nothing is held but the windows of one anchor.

Scores are taken in blocks: the anchors of a pass, of bounded size, against the rows of a
task. Before the shuffle each task keeps what can still matter: the best positives, and then,
as the windows of all positives are known, the best negatives of each window. The first of
all tasks together are among the first of each, so no result is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import exact_type, matrix, scaled

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80  # a negative scores at least this share of the positive
ANCHOR_BYTES = 16 << 20  # vectors of anchors that a pass holds; more anchors take more passes
BLOCK = 256  # anchors that are scored against a batch of rows at a time

_LOW = np.iinfo(np.int64).min
_TOP_BIT = np.uint64(1 << 63)
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("row", ">u8")])
_PAIR = "anchor_id bigint, pair binary"
_NAMES = ["anchor_id", "pair"]
_FOUND = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def _ordered(x: np.ndarray) -> np.ndarray:
    """64-bit integers as unsigned ones of the same order."""
    return x.astype(np.int64).view(np.uint64) ^ _TOP_BIT


def _signed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) ^ _TOP_BIT).view(np.int64)


def packed_pairs(anchor: np.ndarray, score: np.ndarray, kind: int, row: np.ndarray) -> pa.RecordBatch:
    """Pairs as (anchor_id, pair); pairs sort by anchor, descending score, kind and row id."""
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"], keys["score"] = _ordered(anchor), ~_ordered(score)
    keys["kind"], keys["row"] = kind, _ordered(row)
    ends = np.arange(len(keys) + 1, dtype=np.int32) * np.int32(_KEY.itemsize)
    pair = pa.Array.from_buffers(
        pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())]
    )
    return pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int64)), pair], names=_NAMES)


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, score, kind, row) of each pair."""
    keys = np.frombuffer(b"".join(batch["pair"].to_pylist()), _KEY)
    return zip(
        _signed(keys["anchor"]).tolist(),
        _signed(~keys["score"].astype(np.uint64)).tolist(),
        keys["kind"].tolist(),
        _signed(keys["row"]).tolist(),
        strict=True,
    )


class _Best:
    """The best few rows of each anchor: highest score first, ties by smaller id."""

    def __init__(self, n_anchors: int, few: int) -> None:
        self.few = few
        self.score = np.full((n_anchors, few), _LOW)
        self.row = np.zeros((n_anchors, few), np.int64)

    def add(self, start: int, scores: np.ndarray, rows: np.ndarray) -> None:
        """Take in scores (anchors from start on, rows); _LOW marks what does not count."""
        stop, few = start + len(scores), self.few
        best, ids = self.score[start:stop], self.row[start:stop]
        least = best[:, -1]
        if scores.shape[1] > few:
            cut = scores.shape[1] - few
            least = np.maximum(least, np.partition(scores, cut, axis=1)[:, cut])
        a, r = np.nonzero((scores >= least[:, None]) & (scores > _LOW))
        if not len(a):
            return
        known_a, known = np.nonzero(best > _LOW)
        anchor = np.concatenate([a, known_a])
        score = np.concatenate([scores[a, r], best[known_a, known]])
        row = np.concatenate([rows[r], ids[known_a, known]])
        order = np.lexsort((row, -score, anchor))
        anchor, score, row = anchor[order], score[order], row[order]
        begins = np.append(True, anchor[1:] != anchor[:-1])
        rank = np.arange(len(anchor)) - np.maximum.accumulate(
            np.where(begins, np.arange(len(anchor)), 0)
        )
        first = rank < few
        best[:] = _LOW
        best[anchor[first], rank[first]] = score[first]
        ids[anchor[first], rank[first]] = row[first]


class _Anchors:
    """The anchors of a pass: ids, labels, integer vectors, and later their positives' scores."""

    def __init__(self, rows: list, size: int, kind: type) -> None:
        self.id = np.array([r["vec_id"] for r in rows], np.int64)
        codes: dict = {}
        self.code = np.array([codes.setdefault(r["label"], len(codes)) for r in rows], np.int64)
        self.codes = codes
        vectors = matrix(pa.array([bytes(r["vector"]) for r in rows], pa.binary()), size)
        self.vector = vectors.astype(kind)
        self.bound = np.full((len(rows), POSITIVES), _LOW)

    def scored(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first anchor, scores, equal labels, rows' ids) per block of anchors."""
        rows = batch["vec_id"].to_numpy()
        known = self.codes
        label = np.array([known.get(x, -1) for x in batch["label"].to_pylist()], np.int64)
        vectors = matrix(batch["vector"], self.vector.shape[1]).astype(self.vector.dtype).T
        for start in range(0, len(self.id), BLOCK):
            part = slice(start, start + BLOCK)
            scores = (self.vector[part] @ vectors).astype(np.int64)
            yield start, scores, self.code[part, None] == label, rows


def _best_positives(shared):
    """Each task's best rows of an anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = _Best(len(anchors.id), POSITIVES)
        for batch in batches:
            if not batch.num_rows:
                continue
            for start, scores, same, rows in anchors.scored(batch):
                other = anchors.id[start : start + BLOCK, None] != rows
                best.add(start, np.where(same & other, scores, _LOW), rows)
        a, k = np.nonzero(best.score > _LOW)
        yield packed_pairs(anchors.id[a], best.score[a, k], 0, best.row[a, k])

    return run


def _best_negatives(shared):
    """Each task's best rows of other labels in each window of an anchor, each row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        windows = [_Best(len(anchors.id), NEGATIVES) for _ in range(POSITIVES)]
        for batch in batches:
            if not batch.num_rows:
                continue
            for start, scores, same, rows in anchors.scored(batch):
                bound = anchors.bound[start : start + BLOCK]
                for w, window in enumerate(windows):
                    top = np.maximum(bound[:, w], 0)[:, None]
                    inside = ~same & (scores <= top) & (100 * scores >= LEAST_PERCENT * top)
                    inside &= bound[:, w, None] >= 0
                    window.add(start, np.where(inside, scores, _LOW), rows)
        found = []
        for window in windows:
            a, k = np.nonzero(window.score > _LOW)
            found.append(np.stack([a, window.score[a, k], window.row[a, k]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield packed_pairs(anchors.id[pairs[:, 0]], pairs[:, 1], 1, pairs[:, 2])

    return run


def _first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first pairs of each anchor in a sorted stream."""
    last, seen = None, 0
    for batch in batches:
        kept = []
        for anchor, _, _, _ in _unpacked(batch):
            last, seen = anchor, seen + 1 if anchor == last else 1
            kept.append(seen <= POSITIVES)
        yield batch.filter(pa.array(kept, pa.bool_()))


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Negatives of the windows that positives open in a sorted stream."""
    last, windows = None, []
    for batch in batches:
        found = []
        for anchor, score, kind, row in _unpacked(batch):
            if anchor != last:
                last, windows = anchor, []
            if kind == 0:
                windows.append([row, score, 0])
                continue
            for window in windows:
                positive, top, n = window
                if n < NEGATIVES and 100 * score >= LEAST_PERCENT * top:
                    window[2] = n + 1
                    found.append((anchor, positive, n + 1, row, top, score))
        names = [field.split()[0] for field in _FOUND.split(", ")]
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(c), pa.int32() if name == "rank" else pa.int64())
                for c, name in zip(columns, names, strict=True)
            ],
            names=names,
        )


def _sorted(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor_id").sortWithinPartitions("pair")


def _pass(vectors: DataFrame, rows: list, size: int, kind: type) -> DataFrame:
    """The negatives of some anchors against all rows."""
    context = vectors.sparkSession.sparkContext
    anchors = _Anchors(rows, size, kind)
    shared = context.broadcast(anchors)
    near = _sorted(vectors.mapInArrow(_best_positives(shared), _PAIR))
    positives = written(near.mapInArrow(_first_positives, _PAIR), "positives")
    # At most a few positives for each anchor of the pass.
    place = {a: i for i, a in enumerate(anchors.id.tolist())}
    seen = [0] * len(place)
    for r in positives.orderBy("pair").select("pair").collect():
        key = np.frombuffer(bytes(r["pair"]), _KEY)
        i = place[int(_signed(key["anchor"])[0])]
        anchors.bound[i, seen[i]] = _signed(~key["score"].astype(np.uint64))[0]
        seen[i] += 1
    shared.destroy()
    shared = context.broadcast(anchors)
    close = vectors.mapInArrow(_best_negatives(shared), _PAIR)
    found = written(_sorted(positives.unionByName(close)).mapInArrow(_mined, _FOUND), "negatives")
    shared.destroy()
    return found


def hard_negatives(rows: DataFrame, anchors: Column, vector: str = "embedding") -> DataFrame:
    """The first negatives of each anchor's first positives, with scores and rank.

    rows has vec_id, label and the vector; anchors says which rows are anchors; other columns
    are not read. A score is the inner product of floor(256 * x). Rows with a null vec_id, a
    null label, a null vector or a null or non-finite component take no part. Of rows that
    share a vec_id the one with the smallest label and vector takes part. Shorter vectors
    count as if zeros followed. A positive below zero has no negatives, and an anchor without
    positives or negatives no row; no rows give none.
    """
    spark = rows.sparkSession
    is_anchor = F.coalesce(anchors, F.lit(False)).alias("is_anchor")
    given = rows.select("vec_id", F.struct("label", is_anchor).alias("label"), vector)
    whole = scaled(given, SCALE, vector).where("vec_id is not null and label.label is not null")
    least = whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "peak")).alias("row"))
    vectors = written(
        least.select(
            "vec_id",
            F.col("row.label.label").alias("label"),
            F.col("row.label.is_anchor").alias("is_anchor"),
            "row.vector",
            "row.peak",
        ),
        "vectors",
    )
    longest, peak = vectors.agg(F.max(F.octet_length("vector")), F.max("peak")).first()
    chosen = vectors.where("is_anchor").select("vec_id", "label", "vector")
    n_bytes = chosen.agg(F.sum(F.octet_length("vector") + 16)).first()[0] or 0
    if not n_bytes:
        return spark.createDataFrame([], _FOUND)
    size = longest // 4
    kind = exact_type(100 * max(size, 1) * max(peak, 1) ** 2)
    n_passes = -(-n_bytes // ANCHOR_BYTES)
    vectors = vectors.select("vec_id", "label", "vector")
    found = None
    for k in range(n_passes):
        mine = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_passes)) == k).collect()
        if mine:
            part = _pass(vectors, mine, size, kind)
            found = part if found is None else found.unionByName(part)
    return found
