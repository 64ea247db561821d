"""Tokens per section: texts are encoded whole, and token spans are joined with section spans.

Sections are the lines of a text with their line feeds, or given spans. A token that
crosses boundaries goes to one section by the rule: "start" (that of its first character),
"end" (that of its last) or "most" (that with most of its characters, the first if equal).
Counts of the sections add up to those of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RULES = ("start", "end", "most")
KNOWN_PARTS = 300_000
_BATCH = 200  # texts that are encoded at a time

# The tokenizer cuts a text into these parts and never joins tokens across them.
_PARTS = regex.compile(public_tokenizers.PATTERN)


class Spans:
    """Token spans of texts, in code points, from those of their parts."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.offsets: list[list[tuple[int, int]]] = []
        self.sizes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def parts(self, texts: list[str]) -> list[np.ndarray]:
        """Per text the numbers of its parts, by which offsets, sizes and counts go."""
        if len(self.index) > KNOWN_PARTS:
            self.clear()
        cut = [_PARTS.findall(t) for t in texts]
        new = list(set().union(*cut) - self.index.keys())
        for part, encoding in zip(new, self.tokenizer.encode_batch(new), strict=True):
            self.index[part] = len(self.offsets)
            self.offsets.append(encoding.offsets)
        self.sizes = np.append(self.sizes, [len(p) for p in new]).astype(np.int64)
        self.counts = np.append(self.counts, [len(x) for x in self.offsets[len(self.counts) :]])
        self.counts = self.counts.astype(np.int64)
        find = self.index.__getitem__
        return [np.fromiter(map(find, parts), np.int64, len(parts)) for parts in cut]


def line_starts(text: str) -> np.ndarray:
    """Where lines begin; a text without characters is one line."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.append(0, np.flatnonzero(codes == 10) + 1)
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(codes) else starts


def section_of(begin: int, end: int, starts: np.ndarray, rule: str) -> int:
    """The section that a token (begin, end) counts for."""
    first, last = (int(np.searchsorted(starts, x, "right")) - 1 for x in (begin, end - 1))
    if rule == "start" or first == last:
        return first
    if rule == "end":
        return last
    edges = np.clip(np.append(starts[first : last + 1], end), begin, end)
    return first + int(np.diff(edges).argmax())


def attributed(spans: Spans, parts: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section of a text: whole parts at once, parts on a boundary token by token."""
    sizes = spans.sizes[parts]
    begins = np.cumsum(sizes) - sizes
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, begins + sizes - 1, "right") - 1
    inside = first == last
    counts = np.bincount(
        first[inside], weights=spans.counts[parts[inside]], minlength=len(starts)
    ).astype(np.int64)
    for k in np.flatnonzero(~inside):
        for a, b in spans.offsets[parts[k]]:
            counts[section_of(begins[k] + a, begins[k] + b, starts, rule)] += 1
    return counts


def _attribute(path: str, rule: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _known(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                texts = [x or "" for x in part["text"].to_pylist()]
                given = part["starts"].to_pylist()
                rows: list[list[np.ndarray]] = [[], [], [], [], []]
                for k, (text, parts) in enumerate(zip(texts, spans.parts(texts), strict=True)):
                    starts = line_starts(text)
                    if given[k] is not None:
                        inner = [x for x in given[k] if x is not None and 0 < x < len(text)]
                        starts = np.unique(np.array([0, *inner], np.int64))
                    n = len(starts)
                    values = (
                        np.full(n, k),
                        np.arange(n, dtype=np.int64),
                        starts,
                        np.append(starts[1:], len(text)),
                        attributed(spans, parts, starts, rule),
                    )
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(columns[0]), *columns[1:]],
                    names=["doc_id", "section", "start", "end", "n_tokens"],
                )

    return run


_SPANS: dict[str, Spans] = {}


def _known(path: str) -> Spans:
    if path not in _SPANS:
        _SPANS[path] = Spans(path)
    return _SPANS[path]


def token_counts(
    docs: DataFrame, rule: str = "start", path: str = TOKENIZER, starts_col: str | None = None
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens) per section of each row of docs (doc_id, text).

    Sections are lines, or begin at 0 and at the positions of starts_col (array of code
    points; null: lines; nulls and positions outside the text are passed over). start and
    end are code points, end exclusive. A null or empty text has one empty section without
    tokens. Null and repeated ids are counted row by row; no rows give no rows; other
    columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    starts = F.lit(None) if starts_col is None else F.col(starts_col)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), "text", starts.cast("array<bigint>").alias("starts")
    )
    return rows.mapInArrow(
        _attribute(path, rule),
        "doc_id bigint, section bigint, start bigint, end bigint, n_tokens bigint",
    )
