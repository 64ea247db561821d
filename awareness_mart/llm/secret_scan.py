"""Secrets in text: three patterns, and character Markov models of random and ordinary strings.

The patterns label their own training samples: what they match is random, every other run of
12 or more key characters that is spelled like words or an identifier is ordinary. Both
first-order models count character pairs over all documents; a run is reported if the
log-likelihood ratio favours the random model. All of it is built-in functions; the models
are at most 128 x 128 numbers.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, materialised, running, unused

# Fixed patterns. Greedy runs of a class with a least length equal the longest runs of it.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Runs of key characters that are scored: from 20, or from 12 with a digit or a capital after a
# small letter. The ordinary ones among all runs from 12 are samples.
_KEY = "[A-Za-z0-9+/_=-]"
SAMPLE = rf"(?<!{_KEY}){_KEY}{{12,}}+"
RUN = rf"(?<!{_KEY})(?:{_KEY}{{20,}}+|(?=[A-Za-z+/_=-]*+[0-9]|{_KEY}*?[a-z][A-Z]){_KEY}{{12,}}+)"
ORDINARY = r"[A-Za-z_/+=-]+[0-9]{0,4}"  # words and identifiers: digits only at their end
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
CODES = 128
PRIOR = 20.0  # pseudo-counts after each character, dealt by the shares of the characters
MIN_MEAN = 1.0  # nats a pair of characters that a run must favour the random model by,
MIN_TOTAL = 19.0  # and in all: short runs need more a pair

_SPAN = "struct<start: bigint, kind: int, end: bigint, value: string>"
BLOCK = 4096  # code points of a text that are looked through for a place in it


def _found(text: Column, pattern: str, kind: int, value: str, keep) -> Column:
    """Spans of the matches that keep() accepts; start and end count code points.

    The pieces between matches and the matches themselves add up to the positions.
    """
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if value == "group" else whole
    steps = F.zip_with(
        F.zip_with(pieces, whole, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m"))),
        values,
        lambda s, v: F.struct(s["gap"].alias("gap"), F.length(s["m"]).alias("n"), v.alias("v")),
    )

    spans = running(
        steps,
        F.lit(0).cast("bigint"),
        lambda at, s: at + s["gap"] + F.coalesce(s["n"], F.lit(0)),
        lambda at, s: F.struct(
            (at + s["gap"]).alias("start"),
            F.lit(kind).alias("kind"),
            (at + s["gap"] + F.coalesce(s["n"], F.lit(0))).alias("end"),
            s["v"].alias("value"),
        ),
        _SPAN,
    )
    hits = F.filter(spans, lambda s: s["value"].isNotNull() & keep(s["value"]))
    return F.when(text.rlike(pattern), hits).otherwise(F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, sorted by start, then kind."""
    every = F.concat(
        _found(text, ASSIGN, 0, "group", lambda v: F.length(v) >= ASSIGN_VALUE),
        _found(text, ACCESS, 1, "whole", lambda v: F.lit(True)),
        _found(text, HEX, 2, "whole", lambda v: F.lit(True)),
    )
    return F.sort_array(every)


def _codes(value: Column) -> Column:
    """The pairs of neighbouring characters of a run, as numbers below CODES squared."""
    chars = F.split(value, "")
    rest = F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))),
        rest,
        lambda a, b: F.ascii(a) * CODES + F.ascii(b),
    )
    return F.filter(pairs, lambda c: c.between(0, CODES * CODES - 1))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, random against ordinary."""
    text = F.coalesce("text", F.lit(""))
    plain = lambda v: v.rlike(f"^{ORDINARY}$")
    found = materialised(
        docs.select(text.alias("text")),
        base=base_spans(F.col("text")),
        runs=_found(F.col("text"), SAMPLE, 3, "whole", plain),
    )
    every = F.concat("base", _others(F.col("base"), F.col("runs")))
    samples = found.select(F.explode(every).alias("s")).select(
        F.when(F.col("s.kind") < 3, 1).otherwise(0).alias("label"), "s.value"
    )
    pairs = samples.select("label", F.explode(_codes(F.col("value"))).alias("code"))
    counts = {
        (r["label"], r["code"]): r["n"]
        for r in pairs.groupBy("label", "code").agg(F.count("*").alias("n")).collect()
    }
    codes = [ord(c) for c in ALPHABET]
    shares = {}
    for label in (1, 0):
        row = [1 + sum(counts.get((label, a * CODES + b), 0) for a in codes) for b in codes]
        shares[label] = [n / sum(row) for n in row]
    model = [0.0] * (CODES * CODES)
    for a in codes:
        logs = []
        for label in (1, 0):
            row = [
                counts.get((label, a * CODES + b), 0) + PRIOR * share
                for b, share in zip(codes, shares[label], strict=True)
            ]
            total = math.log(sum(row))
            logs.append([math.log(n) - total for n in row])
        for b, random, words in zip(codes, *logs, strict=True):
            model[a * CODES + b] = random - words
    return model


def _apart(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span; runs overlap none of their own.

    All spans in order of start: a run must begin at or after the end of every base span
    before it and end at or before the start of the next one.
    """
    every = F.sort_array(F.concat(base, runs))
    zero = F.lit(0).cast("bigint")

    def reach(at: Column, s: Column) -> Column:
        return F.when(s["kind"] < 3, F.greatest(at, s["end"])).otherwise(at)

    ahead = running(every, zero, reach, lambda at, s: at, "bigint")
    late = F.lit(2**62).cast("bigint")

    def first(at: Column, s: Column) -> Column:
        return F.when(s["kind"] < 3, s["start"]).otherwise(at)

    behind = F.reverse(running(F.reverse(every), late, first, lambda at, s: at, "bigint"))
    checked = F.zip_with(
        every,
        F.zip_with(ahead, behind, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda s, x: F.when(
            (s["kind"] == 3) & (s["start"] >= x["a"]) & (s["end"] <= x["b"]), s
        ),
    )
    return F.array_compact(checked)


def _others(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span; most texts have only the one or the other."""
    return bound(
        F.struct(base.alias("base"), runs.alias("runs")),
        lambda x: F.when((F.size(x["base"]) == 0) | (F.size(x["runs"]) == 0), x["runs"]).otherwise(
            _apart(x["base"], x["runs"])
        ),
    )


def scanned(docs: DataFrame, model: list[float] | None = None, into: str = "spans") -> DataFrame:
    """docs with column into: sorted (start, kind, end, value) of all secrets of each text.

    kind counts KINDS; positions are code points, end exclusive. A run that the models
    report is left out where it overlaps a match of a pattern. Null and empty texts have no
    spans; ids are not read; rows that repeat are scanned each time. Without any sample both
    models are equal and report nothing. An older column of that name is replaced. The time
    grows with a text and its spans, not with their square.
    """
    model = train(docs) if model is None else model
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    text = F.coalesce("text", F.lit(""))

    def random(value: Column) -> Column:
        parts = F.transform(_codes(value), lambda c: F.get(table, c))
        total = F.aggregate(parts, F.lit(0.0), lambda t, x: t + x)
        return total >= F.greatest(F.lit(MIN_TOTAL), MIN_MEAN * (F.length(value) - 1))

    rows = docs.drop(into)
    base, runs = unused(rows, "__base"), unused(rows, "__runs")
    found = {base: base_spans(text), runs: _found(text, RUN, 3, "whole", random)}
    rows = materialised(rows, **found)
    kept = F.sort_array(F.concat(base, _others(F.col(base), F.col(runs))))
    return rows.withColumn(into, kept).drop(base, runs)


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) per row of docs."""
    spans = F.col("spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter(spans, lambda s: s["kind"] < 3)
    return scanned(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a text in blocks of BLOCK."""
    parts = F.transform(
        F.sequence(F.floor(start / BLOCK), F.floor((end - 1) / BLOCK)),
        lambda k: F.substring(
            F.get(blocks, k.cast("int")),
            (F.greatest(start - k * BLOCK, F.lit(0)) + 1).cast("int"),
            (F.least(end - k * BLOCK, F.lit(BLOCK)) - F.greatest(start - k * BLOCK, F.lit(0))).cast("int"),
        ),
    )
    return F.when(end > start, F.array_join(parts, "")).otherwise("")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of every text replaced by mark; overlapping spans by one.

    All columns stay, a column named spans too. Null texts stay null.
    """
    names, spans = docs.columns, unused(docs, "spans")
    blocks, gaps = unused(docs, "__blocks"), unused(docs, "__gaps")
    zero = F.lit(0).cast("bigint")
    kept = running(
        F.col(spans),
        zero,
        lambda at, s: F.greatest(at, s["end"]),
        lambda at, s: F.struct(at.alias("start"), s["start"].alias("end")),
        "struct<start: bigint, end: bigint>",
    )
    last = F.array_max(F.transform(F.col(spans), lambda s: s["end"]))
    rest = F.struct(last.alias("start"), F.length("text").cast("bigint").alias("end"))
    apart = F.concat(F.filter(kept, lambda g: g["end"] >= g["start"]), F.array(rest))
    hit = F.size(spans) > 0
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / BLOCK).cast("int"))
    cut = F.transform(starts, lambda k: F.substring(F.col("text"), k * BLOCK + 1, F.lit(BLOCK)))
    rows = materialised(
        scanned(docs, into=spans),
        **{blocks: F.when(hit, cut), gaps: F.when(hit, apart)},
    )
    clean = F.array_join(
        F.transform(gaps, lambda g: _cut(F.col(blocks), g["start"], g["end"])), mark
    )
    return rows.withColumn("text", F.when(hit, clean).otherwise(F.col("text"))).select(names)
