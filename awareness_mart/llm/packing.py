"""Best-fit packing of token sequences by hierarchical residual rounds.

Each task packs its own pieces by best fit and emits bins; those that are nearly full are
closed. The others become the items of the next round, in fewer and fuller tasks, until
one task holds the rest or a round no longer pays. Bins carry the places of their pieces,
never their tokens, so that the rounds move little. Every round is a written table: a lost
executor repeats a task, not a round.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import written

CAPACITY = 2048
END = 0
FULL = 0.995  # a bin this full is closed at once
CHUNK = 40_000  # items that a task packs at a time
WORTH = 0.95  # a round must leave fewer open bins than this share
KNOWN_CHUNKS = 400_000
KNOWN_WORDS = 700_000

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

_MARKS = string.punctuation.replace("'", "")  # a run of them at a word's end is one part to the tokenizer
# str.split() cuts at these four too, the tokenizer does not.
_ODD = "\x1c\x1d\x1e\x1f"


class TokenCache:
    """Ids of texts as little-endian bytes, from those of the parts between white space.

    The tokenizer never joins across white space, so a text's ids are those of its parts.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Encode runs of letters or of symbols, each of which ends in exactly one word end."""
        encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
        ids = np.array(encoded, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        raw, begin = ids.tobytes(), 0
        if len(cuts) != len(words):
            self.words.update((w, self._direct(w)) for w in words)
            return
        for word, end in zip(words, (cuts * 4).tolist(), strict=True):
            self.words[word] = raw[begin:end]
            begin = end

    def _learn(self, parts: set[str]) -> None:
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        split, new = [], set()
        for part in parts:
            word = part.rstrip(_MARKS)
            if word.isalpha() and (
                word.isascii() or word.lower().isalpha() and is_normalized("NFC", word)
            ):
                mark = part[len(word) :]
                split.append((part, word, mark))
                new.add(word)
                new.add(mark)
            else:
                self.parts[part] = self._direct(part)
        self.words[""] = b""
        words = list(new.difference(self.words))
        for i in range(0, len(words), 2000):
            self._learn_words(words[i : i + 2000])
        known = self.words
        self.parts.update((part, known[word] + known[mark]) for part, word, mark in split)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.parts) > KNOWN_CHUNKS:
            self.parts.clear()
        cut = [t.split() if t and not any(c in t for c in _ODD) else None for t in texts]
        missing: set[str] = set()
        for parts in cut:
            if parts:
                missing.update(set(parts).difference(self.parts))
        self._learn(missing)
        find = self.parts.__getitem__
        return [
            b"".join(map(find, parts)) if parts is not None else self._direct(text or "")
            for text, parts in zip(texts, cut, strict=True)
        ]


_CACHES: dict[str, TokenCache] = {}


def cache_of(path: str) -> TokenCache:
    if path not in _CACHES:
        _CACHES[path] = TokenCache(path)
    return _CACHES[path]


def best_fit(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item: largest first, each into the fullest bin with room.

    Bit s of one number says whether a bin with space s is open.
    """
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    open_bins: dict[int, list[int]] = {}
    spaces, n = 0, 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin_ = open_bins[space].pop()
            if not open_bins[space]:
                spaces ^= 1 << space
        else:
            bin_, space, n = n, capacity, n + 1
        places[i] = (bin_, capacity - space)
        left = space - size
        if left:
            if not open_bins.setdefault(left, []):
                spaces |= 1 << left
            open_bins[left].append(bin_)
    return places


_PIECE = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_BINS = (
    "used int, closed boolean, pieces array<struct<doc_id: bigint, piece: int, start: bigint, "
    "length: bigint, ids_crc32: bigint, offset: bigint>>"
)


def _bins(sizes: list[int], held: list[list[tuple]], capacity: int) -> pa.RecordBatch:
    """Items, each a list of pieces, as packed bins."""
    bins: dict[int, list[tuple]] = {}
    used: dict[int, int] = {}
    for (bin_, at), size, pieces in zip(best_fit(sizes, capacity), sizes, held, strict=True):
        bins.setdefault(bin_, []).extend((*p[:5], p[5] + at) for p in pieces)
        used[bin_] = max(used.get(bin_, 0), at + size)
    names = [f.name for f in _PIECE]
    rows = [[dict(zip(names, p, strict=True)) for p in pieces] for pieces in bins.values()]
    fill = [used[b] for b in bins]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(fill, pa.int32()),
            pa.array([f >= FULL * capacity for f in fill], pa.bool_()),
            pa.array(rows, pa.list_(_PIECE)),
        ],
        names=["used", "closed", "pieces"],
    )


def _first(path: str, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sizes, held = cache_of(path), [], []
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for first in range(0, len(ids), 500):
                encoded = cache.encode(texts[first : first + 500])
                for doc_id, raw in zip(ids[first : first + 500], encoded, strict=True):
                    raw += END.to_bytes(4, "little")
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        piece = raw[at : at + 4 * capacity]
                        sizes.append(len(piece) // 4)
                        held.append([(doc_id, k, at // 4, sizes[-1], zlib.crc32(piece), 0)])
                if len(sizes) >= CHUNK:
                    yield _bins(sizes, held, capacity)
                    sizes, held = [], []
        yield _bins(sizes, held, capacity)

    return run


def _next(capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, held = [], []
        for batch in batches:
            sizes += batch["used"].to_pylist()
            held += [[tuple(p.values()) for p in ps] for ps in batch["pieces"].to_pylist()]
            if len(sizes) >= CHUNK:
                yield _bins(sizes, held, capacity)
                sizes, held = [], []
        yield _bins(sizes, held, capacity)

    return run


def packed(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of docs (doc_id, text) in sequences of at most capacity tokens.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece. A document is
    its token ids and one END; a null or empty text is END alone. Only documents longer
    than a sequence are cut. Null and repeated ids are packed row by row; no rows give no
    rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    table = written(rows.mapInArrow(_first(path, capacity), _BINS), "bins")
    done, rest = [table.where("closed")], table.where("not closed")
    open_bins = rest.count()
    while True:
        tasks = -(-open_bins // CHUNK)
        if not open_bins:
            break
        table = written(
            rest.select("used", "pieces").repartition(tasks).mapInArrow(_next(capacity), _BINS),
            "bins",
        )
        rest = table.where("not closed")
        before, open_bins = open_bins, rest.count()
        if tasks == 1 or open_bins > WORTH * before:
            done.append(table)
            break
        done.append(table.where("closed"))
    bins = reduce(DataFrame.union, done).select(
        F.monotonically_increasing_id().alias("sequence_id"), "pieces"
    )
    pieces = bins.select("sequence_id", F.explode("pieces").alias("p")).select("sequence_id", "p.*")
    return pieces.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
