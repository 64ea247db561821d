"""Quality rules per document, and verdicts on whole hosts by shrunk failure rates.

Every rule's failure rate of a host is shrunk by a beta prior fitted to the rates of all
hosts (moments). A host whose shrunk rate of any rule reaches HOST_LIMIT is rejected with
all its documents. A host whose rate of a rule is significantly above the other hosts' can
lose the documents that fail this rule (outlying_hosts); its clean ones stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, materialised, row_hash, words_of, written
from .vectors import looked_up

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_LIMIT = 0.7
OUTLYING = 3.0  # standard deviations that a host's rate is above the other hosts' on either side
SYMBOLS = "#*$%&|<>"

# Failures that count against a host.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "copied_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_words": "not (word_chars between 2 * n_words and 15 * n_words)",
}


def _covered(starts: Column) -> Column:
    """Words in three-word windows that start at these sorted positions."""
    steps = F.zip_with(
        starts,
        F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
        lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3))),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def measures(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """Counts per row of docs (doc_id, text, host): words, symbols, repeated lines and words.

    All by built-in functions on one row; windows are compared by 64-bit hash. Null text
    counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    rows = materialised(
        docs.select("doc_id", F.col(host_col).alias("host"), "text"),
        w=words_of(F.col("text")),
        lines=lines,
    ).select(
        "doc_id",
        "host",
        row_hash(F.col("text")).alias("row_hash"),
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "w",
    )
    windows = F.transform(
        "w",
        lambda x, i: F.struct(
            F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")
        ),
    )
    full = F.greatest(F.size("w") - 2, F.lit(0))
    rows = materialised(rows, s=F.sort_array(F.slice(windows, F.lit(1), full))).drop("w")
    twice = F.array_compact(
        F.zip_with(
            "s",
            F.slice("s", F.lit(2), F.greatest(F.size("s"), F.lit(1))),
            lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
        )
    )
    starts = F.sort_array(F.array_distinct(F.flatten(twice)))
    rows = materialised(rows, starts=starts).drop("s")
    return rows.withColumn("n_repeat_words", _covered(F.col("starts")).cast("bigint")).drop("starts")


def _failures(measured: DataFrame) -> DataFrame:
    """(host, n, failures by rule ...)."""
    return measured.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"),
        *[F.sum(F.expr(failed).cast("bigint")).alias(rule) for rule, failed in RULES.items()],
    )


def rejected_hosts(measured: DataFrame) -> DataFrame:
    """(host, <rule>_rate ...) of hosts whose shrunk failure rate of some rule is too high."""
    hosts = _failures(measured)
    rates = {rule: F.col(rule) / F.col("n") for rule in RULES}
    prior = hosts.agg(
        *[F.avg(rate).alias(f"{rule}_m") for rule, rate in rates.items()],
        *[F.var_pop(rate).alias(f"{rule}_v") for rule, rate in rates.items()],
    ).first()
    shrunk = {}
    for rule in RULES:
        mean, spread = prior[f"{rule}_m"] or 0.0, prior[f"{rule}_v"] or 0.0
        weight = max(1.0, mean * (1 - mean) / spread - 1) if spread else 1.0
        shrunk[rule] = (F.col(rule) + mean * weight) / (F.col("n") + weight)
    return hosts.where(F.greatest(*shrunk.values()) >= HOST_LIMIT).select(
        "host", *[rate.alias(f"{rule}_rate") for rule, rate in shrunk.items()]
    )


def outlying_hosts(measured: DataFrame) -> DataFrame:
    """(host, <rule>_high ...) of hosts whose failure rate of some rule is significantly high.

    A beta prior is fitted to the rates of the other hosts (moments). The host's posterior
    rate less OUTLYING deviations has to lie above their mean plus OUTLYING deviations; these
    are at least what chance makes in hosts of their sizes. A host without others is judged
    by none.
    """
    hosts = _failures(measured)
    rate = {rule: F.col(rule) / F.col("n") for rule in RULES}
    noise = {rule: r * (1 - r) / F.col("n") for rule, r in rate.items()}
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        *[F.sum(r).alias(f"{rule}_1") for rule, r in rate.items()],
        *[F.sum(r * r).alias(f"{rule}_2") for rule, r in rate.items()],
        *[F.sum(x).alias(f"{rule}_x") for rule, x in noise.items()],
    ).first()
    others = float(max(sums["hosts"] - 1, 1))
    high = {}
    for rule in RULES:
        first, second, chance = (F.lit(float(sums[f"{rule}_{k}"] or 0.0)) for k in "12x")
        mean = F.greatest((first - rate[rule]) / others, F.lit(0.0))
        spread = F.greatest(
            (second - rate[rule] * rate[rule]) / others - mean * mean, (chance - noise[rule]) / others, F.lit(1e-12)
        )
        weight = F.greatest(F.lit(1.0), mean * (1 - mean) / spread - 1)
        size = F.col("n") + weight
        posterior = (F.col(rule) + mean * weight) / size
        deviation = F.sqrt(posterior * (1 - posterior) / (size + 1))
        above = posterior - OUTLYING * deviation > mean + OUTLYING * F.sqrt(spread)
        high[rule] = above & F.lit(sums["hosts"] > 1)
    return hosts.select("host", *[c.alias(f"{rule}_high") for rule, c in high.items()]).where(
        " or ".join(f"{rule}_high" for rule in RULES)
    )


def judged(docs: DataFrame, host_col: str = "source", by_rule: bool = False) -> DataFrame:
    """measures() with base_failed, host_failed and kept per row of docs.

    With by_rule also rule_failed: the document fails a rule that its host fails significantly
    more often than the other hosts; such documents aren't kept.

    A document fails the base rules with fewer than 50 words or with more than half of its
    words in repeated windows; it is kept if it passes them and its host is not rejected.
    A row without host belongs to none and is judged by its text alone; rows that repeat
    count each time; no rows give no rows; other columns are not read.
    """
    measured = written(measures(docs, host_col), "measures")
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"))
    bad = rejected_hosts(measured).select("host", F.lit(True).alias("bad"))
    verdicts = hosts.join(bad, "host", "left")
    high = [F.lit(False).alias(f"{rule}_high") for rule in RULES]
    if by_rule:
        verdicts = verdicts.join(outlying_hosts(measured), "host", "left")
        high = [F.coalesce(f"{rule}_high", F.lit(False)).alias(f"{rule}_high") for rule in RULES]
    verdict = F.struct(F.coalesce("bad", F.lit(False)).alias("bad"), *high)
    verdicts = written(verdicts.select("host", "n_docs", verdict.alias("verdict")), "verdicts")
    found = looked_up(measured, verdicts, "host", "n_docs", "verdict")
    base = F.expr(RULES["few_words"]) | F.expr(RULES["repeated"])
    failed = F.expr(" or ".join(f"(verdict.{rule}_high and {failed})" for rule, failed in RULES.items()))
    kept = ~base & ~F.col("verdict.bad") & ~failed
    return found.select(
        *measured.columns,
        base.alias("base_failed"),
        F.col("verdict.bad").alias("host_failed"),
        *([failed.alias("rule_failed")] if by_rule else []),
        kept.alias("kept"),
    )
