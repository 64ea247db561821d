"""Near duplicates by SetSketch registers (Ertl, 2021): band, estimate jointly, verify.

A text's set is its distinct five-word shingles. Each of 240 registers keeps the smallest
of the exponentially distributed hashes of the set, truncated to a power of BASE. Registers
of parts merge by maximum. Texts that agree in one band of five registers are compared:
the joint likelihood of their registers, with both set sizes known, must favour a Jaccard
similarity above LOWEST; then the full sets decide.

A link of similarity 0.75 misses all 48 bands with a chance below 1e-6 and falls below
LOWEST, five standard deviations away, with less. Two texts of one size that share nothing
agree in a register with 1/42, so in a given band with 1/42^5, about 1 in 130 million:
buckets hold next to no strangers up to billions of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    group_starts,
    shingle_set,
    whole_groups,
    word_hashes,
    written,
)
from .components import components

REGISTERS = 240
BAND = 5
BANDS = REGISTERS // BAND
BASE = 1.1
RATE = 20.0
TOP = 255
LINK_PERCENT = 75
LOWEST = 0.6
BLOCK = 600  # members of a bucket, about, that are compared with each other in one group

_RANDOM = np.random.default_rng(20_211)
_A = (_RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)
_SLICE = 512
_ROOM = np.empty((REGISTERS, _SLICE), np.uint32)  # a task's own; no memory is asked for per text


def registers(distinct: np.ndarray) -> np.ndarray:
    """SetSketch registers (bytes) of a set of 64-bit hashes."""
    x = (distinct >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _SLICE):
        part = x[None, i : i + _SLICE]
        room = _ROOM[:, : part.shape[1]]
        np.multiply(part, _A[:, None], out=room)
        room += _B[:, None]
        np.minimum(least, room.min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    values = np.floor(1 - np.log(exponential) / np.log(BASE))
    return np.clip(values, 0, TOP).astype(np.uint8)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def _slope(x: np.ndarray) -> np.ndarray:
    return (BASE - 1) / BASE / (1 - x * (BASE - 1) / BASE) / np.log(BASE)


def more_similar(
    k: np.ndarray, l: np.ndarray, n: np.ndarray, m: np.ndarray, than: float = LOWEST
) -> np.ndarray:
    """Whether the maximum-likelihood similarity of register rows k and l exceeds a bound.

    n and m are the set sizes. The log-likelihood is concave, so the sign of its slope at
    the bound tells on which side the maximum lies.
    """
    larger = (k > l).sum(axis=1)
    smaller = (k < l).sum(axis=1)
    equal = REGISTERS - larger - smaller
    u = n / (n + m)
    v = 1 - u
    j = np.minimum(than, np.minimum(u / v, v / u) * 0.999)
    x, y = u - v * j, v - u * j
    p, q = _chance(x), _chance(y)
    slope_p, slope_q = v * _slope(x), u * _slope(y)
    rest = np.maximum(1 - p - q, 1e-12)
    return -larger * slope_p / p - smaller * slope_q / q + equal * (slope_p + slope_q) / rest > 0


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, sketches = [], [], []
        for text in batch["text"]:
            words = word_hashes(text.as_py())
            distinct = shingle_set(words)
            sizes.append(len(distinct))
            keys.append(xxhash.xxh3_128_digest(words) if len(words) else None)
            sketches.append(registers(distinct).tobytes() if len(words) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(keys, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(sketches, pa.binary()),
            ],
            names=["doc_id", "text_key", "n_shingles", "registers"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, registers) per row; key and registers null without words."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return docs.mapInArrow(
        _sketch, "doc_id bigint, text_key binary, n_shingles bigint, registers binary"
    )


def _members(texts: DataFrame) -> DataFrame:
    """(doc_id, bucket, size) of the buckets with two or more texts."""
    key = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.shiftleft(b.cast("bigint"), 8 * BAND)
        + F.conv(F.hex(F.substring("registers", b * BAND + 1, F.lit(BAND))), 16, 10).cast("bigint"),
    )
    bands = texts.select("doc_id", F.explode(key).alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return bands.join(sizes, "bucket").select("doc_id", "bucket", "size")


def _dealt(members: DataFrame, classes: str = "doc_id") -> DataFrame:
    """Members of each bucket (doc_id, bucket, size) in blocks that are compared in themselves.

    Every bucket deals its members anew, so that what two blocks of one bucket keep apart
    can meet in another bucket.
    """
    block = F.pmod(F.xxhash64("doc_id", "bucket"), F.ceil(F.col("size") / BLOCK)).cast("int")
    return members.select(
        "bucket",
        block.alias("lo"),
        block.alias("hi"),
        block.alias("block"),
        (F.col("size") > BLOCK).alias("several"),
        F.col(classes).alias("class"),
        "doc_id",
    )


def _unlike(marked: DataFrame) -> DataFrame:
    """Members (doc_id, bucket, class) in pairs of blocks that hold different classes.

    A large class has blocks of its own, which are never paired with each other; the small
    ones of a bucket share blocks. So a bucket of one class gives no row at all, and one of
    a large class and a few others as many rows as it has members.
    """
    size = marked.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    own = F.when(F.col("n") > BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(0)
    size = size.select("bucket", "class", own.alias("own"), F.when(own == 0, F.col("n")).alias("n"))
    pool = size.groupBy("bucket").agg(
        F.ceil(F.coalesce(F.sum("n"), F.lit(0)) / BLOCK).alias("pool"), F.sum("own").alias("others")
    )
    before = Window.partitionBy("bucket").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    large = (
        size.where("own > 0")
        .withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0)))
        .select("bucket", "class", "own", "before")
    )
    rows = marked.join(pool, "bucket").join(large, ["bucket", "class"], "left")
    start = F.col("pool") + F.col("before")
    last = F.col("pool") + F.col("others") - 1
    block = F.when(
        F.col("own").isNotNull(), start + F.pmod(F.xxhash64("doc_id"), F.col("own"))
    ).otherwise(F.pmod(F.xxhash64("class"), F.col("pool")))
    none = F.array().cast("array<bigint>")

    def numbers(first, through):
        return F.when(through >= first, F.sequence(first, through)).otherwise(none)

    zero = F.lit(0).cast("bigint")
    elsewhere = F.when(
        F.col("own").isNotNull(), F.concat(numbers(zero, start - 1), numbers(start + F.col("own"), last))
    ).otherwise(numbers(zero, last))
    return rows.select(
        "bucket", "class", "doc_id", block.alias("block"), F.explode(elsewhere).alias("other")
    ).select(
        "bucket",
        F.least("block", "other").cast("int").alias("lo"),
        F.greatest("block", "other").cast("int").alias("hi"),
        F.col("block").cast("int").alias("block"),
        F.lit(False).alias("several"),
        "class",
        "doc_id",
    )


_GROUP = ["bucket", "lo", "hi"]


def _likely(
    table: pa.Table, open_: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group that are likely links, as long as open_ says they are wanted.

    A pair counts in its first common band only, unless that bucket has several blocks.
    """
    n = table.num_rows
    sketch = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint8).reshape(n, -1)
    size = table["n_shingles"].to_numpy()
    block = table["block"].to_numpy()
    class_ = table["class"].to_numpy()
    several = table["several"].to_numpy()
    band = table["bucket"].to_numpy() >> 8 * BAND
    mixed_blocks = table["lo"].to_numpy() != table["hi"].to_numpy()
    starts = group_starts(table, _GROUP)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    for lag in range(1, int(np.diff(np.append(starts, n)).max())):
        a = np.flatnonzero(group[lag:] == group[:-lag])
        b = a + lag
        small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        fits = (100 * small >= LINK_PERCENT * large) & (class_[a] != class_[b]) & open_(a, b)
        fits &= ~mixed_blocks[a] | (block[a] != block[b])
        a, b = a[fits], b[fits]
        if not len(a):
            continue
        k, l = sketch[a], sketch[b]
        first = (k == l).reshape(len(a), BANDS, BAND).all(axis=2).argmax(axis=1)
        fits = (first == band[a]) | several[a]
        fits &= more_similar(k, l, size[a], size[b])
        yield a[fits], b[fits]


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, _GROUP):
        wanted = np.zeros(table.num_rows, bool)
        for a, b in _likely(table, lambda a, b, wanted=wanted: ~(wanted[a] & wanted[b])):
            wanted[a] = wanted[b] = True
        yield from table.filter(pa.array(wanted)).to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of classes whose full sets are similar enough; a spanning forest per group."""
    for table in whole_groups(batches, _GROUP):
        sets = [np.frombuffer(x, np.uint64) for x in table["shingle_set"].to_pylist()]
        class_ = table["class"].to_numpy()
        starts = np.append(group_starts(table, _GROUP), table.num_rows)
        part = np.arange(table.num_rows)
        found = []
        for a, b in _likely(table, lambda a, b, part=part: part[a] != part[b]):
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                if part[i] == part[j]:
                    continue
                total = len(sets[i]) + len(sets[j])
                union = np.union1d(sets[i], sets[j]).size
                if 100 * (total - union) >= LINK_PERCENT * union:
                    found.append((class_[i], class_[j]))
                    g = np.searchsorted(starts, i, "right")
                    mine = part[starts[g - 1] : starts[g]]
                    mine[mine == part[i]] = part[j]
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(word_hashes(x.as_py())).tobytes() for x in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sets, pa.binary())], names=["doc_id", "shingle_set"]
        )


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "doc_id")


_MEMBER = (
    "bucket bigint, lo int, hi int, block int, several boolean, class bigint, doc_id bigint, "
    "n_shingles bigint, registers binary"
)


def _compared(docs: DataFrame, texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Verified links (a, b) of classes that connect what is similar enough in each pair of blocks."""
    member = blocks.join(texts.select("doc_id", "n_shingles", "registers"), "doc_id").select(
        *[field.split()[0] for field in _MEMBER.split(", ")]
    )
    near = written(_grouped(member).mapInArrow(_with_partner, _MEMBER), "candidates")
    wanted = near.select("doc_id").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    sets = rows.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(
        _sets, "doc_id bigint, shingle_set binary"
    )
    return _grouped(near.join(sets, "doc_id")).mapInArrow(_verified, "a bigint, b bigint")


def _contracted(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) after links (a, b) between components or unlabelled nodes."""
    new = components(links)
    renamed = new.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = labels.join(renamed, "component", "left").select(
        "node", F.coalesce("now", "component").alias("component")
    )
    return written(old.union(new.join(labels, "node", "left_anti")), "labels")


def _joined(docs: DataFrame, texts: DataFrame, hot: DataFrame, labels: DataFrame) -> DataFrame:
    """labels after links between the blocks of buckets that have several (doc_id, bucket).

    One member for each class that links have made so far is dealt into new blocks, as long
    as that halves the classes. What is then left in different classes is compared in full.
    """
    before = None
    while True:
        marked = written(
            hot.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
                "doc_id", "bucket", F.coalesce("component", "doc_id").alias("class")
            ),
            "marked",
        )
        first = marked.groupBy("bucket", "class").agg(F.min("doc_id").alias("doc_id"))
        sizes = first.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        left = written(first.join(sizes, "bucket"), "classes")
        open_ = left.count()
        if not open_:
            return labels
        if before is not None and 2 * open_ > before:
            several = left.select("bucket").distinct()
            unlike = _unlike(marked.join(several, "bucket", "left_semi"))
            return _contracted(labels, _compared(docs, texts, unlike))
        before = open_
        labels = _contracted(labels, _compared(docs, texts, _dealt(left, "class")))


def linked(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of the distinct texts that are linked; others have no row."""
    members = written(_members(texts), "members")
    labels = components(_compared(docs, texts, _dealt(members)))
    largest = members.agg(F.max("size")).first()[0] or 0
    if largest <= BLOCK:
        return labels
    hot = members.where(F.col("size") > BLOCK).select("doc_id", "bucket")
    return _joined(docs, texts, hot, written(labels, "labels"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of docs (doc_id, text, ...).

    component_id is the smallest doc_id that links reach; kept marks that document. Equal
    word sequences are one class and are compared once. A text that is null or has no word
    has no shingles and is linked with nothing, also not with another empty one. A row
    without doc_id is linked with nothing, has no component and is kept. Rows that share a
    doc_id are one document. No rows give no rows; other columns are not read.
    """
    sketch = written(sketches(docs), "sketches")
    known = sketch.where("doc_id is not null and text_key is not null")
    texts = written(
        known.groupBy("text_key").agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("registers").alias("registers"),
        ),
        "texts",
    )
    found = linked(docs, texts)
    classes = (
        texts.select("text_key", F.col("doc_id").alias("class_id"))
        .join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("text_key", F.coalesce("component", "class_id").alias("component"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return sketch.join(classes, "text_key", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
