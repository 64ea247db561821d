"""Benchmark items inside documents: MinHash search by size class, then exact containment.

Items are classed by the power of two that holds their number of shingles. For each class
the documents' shingles are cut into blocks of that size, whose MinHash registers merge
from those of smaller blocks, and every pair of neighbouring blocks is a window. A passage
as long as the item lies in one window, whose similarity with the item is then at least
0.17, so that one of 64 registers agrees but for a chance below 1e-5. Items that agree in
a register are held against the whole document's shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_words, row_hash, shingles

REGISTERS = 64
CONTAINED_PERCENT = 75
ITEM_BYTES = 16_000_000  # text of the items that one pass over the documents looks for
_STEP = 200_000  # shingles that are searched at a time, whole documents

_RANDOM = np.random.default_rng(8_117)
_A = (_RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)
_LOW = np.uint32(0xFFFF)


class Items:
    """Shingle sets of one block of items, and per size class the registers to look up."""

    def __init__(self, rows: list[tuple[int | None, bytes]]) -> None:
        kept = [(i, s) for i, t in rows if len(s := np.unique(shingles(lower_words(t))))]
        self.ids = [i for i, _ in kept]
        self.sets = [s for _, s in kept]
        self.classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        size_class = [max(len(s) - 1, 0).bit_length() for s in self.sets]
        for c in set(size_class):
            items = [k for k, own in enumerate(size_class) if own == c]
            least = [
                ((self.sets[k] >> np.uint64(32)).astype(np.uint32)[None, :] * _A[:, None]
                 + _B[:, None]).min(axis=1)
                for k in items
            ]
            values = np.stack(least).astype(np.uint64)
            keys = (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(32)) | values
            order = np.argsort(keys, axis=None, kind="stable")
            owners = np.repeat(np.array(items), REGISTERS)[order]
            seen = np.zeros((REGISTERS, 1 << 16), bool)
            for r in range(REGISTERS):
                seen[r, (values[:, r] & np.uint64(_LOW)).astype(np.int64)] = True
            self.classes[c] = (keys.ravel()[order], owners, seen)

    def search(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(document, item, shingles found) of the items that documents contain."""
        filled = [k for k, s in enumerate(docs) if len(s)]
        if not filled or not self.classes:
            return
        smallest = min(self.classes)
        width = 1 << smallest
        parts = [docs[k] for k in filled]
        padded = [np.append(s, np.repeat(s[-1:], -len(s) % width)) for s in parts]
        owner = np.repeat(filled, [len(s) // width for s in padded])
        x = (np.concatenate(padded) >> np.uint64(32)).astype(np.uint32)
        x = np.ascontiguousarray(x.reshape(-1, width).T)
        likely = set()
        for r in range(REGISTERS):
            least = (x * _A[r] + _B[r]).min(axis=0)
            for c in range(smallest, max(self.classes) + 1):
                if c in self.classes:
                    likely.update(self._agreeing(c, r, least, owner, 1 << (c - smallest)))
                if len(least) % 2:
                    least = np.append(least, least[-1:])
                least = np.minimum(least[::2], least[1::2])
        known: dict[int, np.ndarray] = {}
        for k, item in sorted(likely):
            if k not in known:
                known[k] = np.unique(docs[k])
            own = self.sets[item]
            at = np.searchsorted(known[k], own).clip(max=len(known[k]) - 1)
            found = int((known[k][at] == own).sum())
            if 100 * found >= CONTAINED_PERCENT * len(own):
                yield k, item, found

    def _agreeing(
        self, c: int, r: int, least: np.ndarray, owner: np.ndarray, step: int
    ) -> Iterator[tuple[int, int]]:
        """(document, item) of the windows whose register r equals an item's."""
        keys, owners, seen = self.classes[c]
        window = np.minimum(least, np.append(least[1:], least[-1:]))
        at = np.flatnonzero(seen[r, window & _LOW])
        wanted = (np.uint64(r) << np.uint64(32)) | window[at].astype(np.uint64)
        first = np.searchsorted(keys, wanted)
        last = np.searchsorted(keys, wanted, side="right")
        for w, i, j in zip(at[first < last], first[first < last], last[first < last], strict=True):
            for k in np.unique(owner[w * step : (w + 2) * step]):
                for item in owners[i:j]:
                    yield int(k), int(item)


def _search(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(broadcast.value)
        for batch in batches:
            rows, docs, total, at = [], [], 0, 0
            for k, text in enumerate(batch["text"]):
                docs.append(shingles(lower_words(text.as_py())))
                total += len(docs[-1])
                if total >= _STEP or k == batch.num_rows - 1:
                    rows += [(at + d, i, n) for d, i, n in items.search(docs)]
                    docs, total, at = [], 0, k + 1
            hit = pa.array([d for d, _, _ in rows], pa.int64())
            size = [len(items.sets[i]) for _, i, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(hit),
                    batch["row_hash"].take(hit),
                    pa.array([items.ids[i] for _, i, _ in rows], pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array([n for _, _, n in rows], pa.int64()),
                ],
                names=["doc_id", "row_hash", "item_id", "n_shingles", "n_found"],
            )

    return run


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, row_hash, item_id, n_shingles, n_found) per document row and item it contains.

    An item is contained if at least 75 % of its distinct five-word shingles occur in the
    document (A-Z lowered); one of fewer words only if the document is that sequence. Null
    or empty texts on either side match nothing; null ids are returned as they are; rows
    that repeat are reported each time; other columns are not read. Items are looked for in
    passes over the documents, each with up to ITEM_BYTES of item text in memory.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        row_hash(F.col("text")).alias("row_hash"),
        F.col("text").cast("binary").alias("text"),
    )
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = total // ITEM_BYTES + 1
    found = []
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        block = spark.sparkContext.broadcast([(r[0], bytes(r[1] or b"")) for r in part.collect()])
        found.append(
            rows.mapInArrow(
                _search(block),
                "doc_id bigint, row_hash bigint, item_id bigint, n_shingles bigint, n_found bigint",
            )
        )
    return reduce(DataFrame.union, found)
