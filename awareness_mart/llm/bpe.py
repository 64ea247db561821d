"""Byte-pair encoding by merge rounds over many words at once, and decoding.

The words of a batch lie in one flat array of symbols. A round packs every two neighbours
into a number, finds its rank by binary search over the sorted pairs of the vocabulary, and
merges in each word its lowest-ranked pair, wherever it stands, from the left. A word that
has no pair left is done. Words are cut as the vocabulary file says; a part between blanks
is encoded once per batch, and a bounded number of parts is remembered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
KNOWN_PARTS = 400_000  # most parts between blanks that a Python worker remembers
TOGETHER = 5_000  # parts that are cut by one call and merged in the same rounds
SLICE = 1 << 22  # bytes of text, about, that are encoded at a time

_NONE = np.iinfo(np.int64).max
_UNSUPPORTED = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")


class MergeTable:
    """The merges of a byte-level vocabulary as sorted pair keys with their ranks and results."""

    def __init__(self, model: dict) -> None:
        odd = [name for name in _UNSUPPORTED if model.get(name)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain BPE vocabulary: {model['type']} {odd}")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # Where no merge needs what a later one makes, all equal pairs of a word merge at once.
        born = np.full(max(vocab.values()) + 1, -1)
        born[made] = np.arange(len(made))
        self.ordered = bool(np.all(np.maximum(born[left], born[right]) < np.arange(len(made))))
        letters = [(ord(c), c) for c in vocab if len(c) == 1]
        self.inner = np.full(max(c for c, _ in letters) + 1, -1, np.int64)
        self.last = self.inner.copy()
        for code, c in letters:
            self.inner[code] = vocab[c]
            self.last[code] = vocab.get(c + end, -1)

    def _ranks(self, symbols: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in keys and rank of each symbol with its right neighbour; _NONE if no pair."""
        key = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ranks = np.where(same & (self.keys[at] == key), self.ranks[at], _NONE)
        return at, np.append(ranks, _NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of byte-level letters, end to end, and where each word's ids end.

        Rounds grow with the distinct pairs of a word.
        """
        if not words:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes) - 1
        symbols = self.inner[codes]
        symbols[ends] = self.last[codes[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        while len(symbols):
            same = word[1:] == word[:-1]
            at, ranks = self._ranks(symbols, same)
            starts = np.flatnonzero(np.append(True, ~same))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            live = least != _NONE
            done_symbols.append(symbols[~live])
            done_words.append(word[~live])
            place = np.flatnonzero(live & (ranks == least))
            if self.ordered:
                # Of neighbouring matches (the same symbol thrice) every second one merges.
                begins = np.append(True, np.diff(place) != 1)[: len(place)]
                run = np.maximum.accumulate(np.where(begins, np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - run) % 2 == 0]
            else:
                place = place[np.append(True, np.diff(word[place]) != 0)[: len(place)]]
            symbols[place] = self.made[at[place]]
            live[place + 1] = False
            symbols, word = symbols[live], word[live]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order].astype("<u4"), np.cumsum(np.bincount(word, minlength=len(words)))


class BatchEncoder:
    """Ids and texts of whole batches by one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.merges = MergeTable(parts["model"])
        # Only its rules for cutting text into words are used.
        rules = Tokenizer.from_file(path)
        self.normalise = rules.normalizer.normalize_str
        self.cut = rules.pre_tokenizer.pre_tokenize_str
        # Whole control tokens in a text are found before anything else.
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        self.names = {i: w for w, i in parts["model"]["vocab"].items()}
        self.names.update((i, w) for w, i in self.special.items())
        self.known: dict[bytes, bytes] = {}

    def _pieces(self, part: str) -> list[str | int]:
        """Words of a part between blanks, and ids of the control tokens in it."""
        found: list[str | int] = []
        for piece in self.marks.split(part) if self.marks else [part]:
            if piece in self.special:
                found.append(self.special[piece])
            elif piece:
                found.extend(word for word, _ in self.cut(self.normalise(piece)))
        return found

    def _cut_together(self, parts: list[str]) -> tuple[list[str], np.ndarray] | None:
        """Words of several parts, and how many words each part and those before it have."""
        joined = self.normalise(" ".join(parts))
        blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
        if len(blanks) != len(parts) - 1:
            return None
        cut = self.cut(joined)
        begins = np.fromiter((place[0] for _, place in cut), np.int64, len(cut))
        return [word for word, _ in cut], np.append(np.searchsorted(begins, blanks), len(cut))

    def _learn(self, parts: list[bytes]) -> None:
        """Remember the ids of parts between blanks; printable ones are cut by one call."""
        plain: list[tuple[bytes, str]] = []
        odd: list[tuple[bytes, str]] = []
        for part in parts:
            text = part.decode("utf-8", "replace")
            fits = text.isprintable() and not any(mark in text for mark in self.special)
            (plain if fits else odd).append((part, text))
        together = self._cut_together([text for _, text in plain]) if plain else None
        if together:
            words, n_words = together
            ids, ends = self.merges.encode(words)
            raw, ends = ids.tobytes(), np.append(0, ends)[n_words] * 4
            begin = 0
            for (part, _), end in zip(plain, ends.tolist(), strict=True):
                self.known[part] = raw[begin:end]
                begin = end
        else:
            odd += plain
        for part, text in odd:
            pieces = self._pieces(text)
            ids, ends = self.merges.encode([p for p in pieces if isinstance(p, str)])
            cuts = iter(np.split(ids, ends[:-1]))
            self.known[part] = b"".join(
                next(cuts).tobytes() if isinstance(p, str) else p.to_bytes(4, "little")
                for p in pieces
            )

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids per UTF-8 text. No rule joins anything across a blank."""
        cut = [text.split() for text in texts]
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        new = list({part for parts in cut for part in parts if part not in self.known})
        for i in range(0, len(new), TOGETHER):
            self._learn(new[i : i + TOGETHER])
        return [b"".join(map(self.known.__getitem__, parts)) for parts in cut]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, as the file names no decoder; unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder_of(path: str) -> BatchEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]


def _slices(texts: list[bytes]) -> Iterator[slice]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    yield slice(start, len(texts))


def encoded(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded) per row of docs (doc_id, text, ...): token ids and what they read as.

    A null or empty text has no ids and decodes to the empty text; rows that repeat or lack
    a doc_id each keep their row; no rows give no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = [x or b"" for x in batch["text"].to_pylist()]
            for part in _slices(texts):
                raw = encoder.encode(texts[part])
                ends = np.cumsum([0, *[len(x) // 4 for x in raw]]).astype(np.int32)
                values = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
                said = [encoder.decode(values[i:j].tolist()) for i, j in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][part],
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                        pa.array(said, pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def decoded(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) per row of tokens (doc_id, ids, ...); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            said = [None if x is None else encoder.decode(x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(said, pa.string())], names=["doc_id", "text"]
            )

    rows = tokens.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id bigint, text string")


def token_digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded()."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
