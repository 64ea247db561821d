"""What the corpus operators share: scratch tables, words, shingles and grouped batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are separated by space, tab, line feed, vertical tab, form feed and carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

SHINGLE_WORDS = 5
KNOWN_WORDS = 300_000  # most words whose hash a Python worker remembers

_P = np.uint64(0x9E3779B97F4A7C15)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediates: spark.checkpoint.dir; on one machine, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors, computed once."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for table in tables:
        jvm, files = table.sparkSession._jvm, table.inputFiles()
        if files:
            path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            conf = table.sparkSession._jsparkSession.sessionState().newHadoopConf()
            path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, WORD_GAP)).otherwise(
        F.array().cast("array<string>")
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that df lacks, whatever its case: name, or name with underscores after it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialised(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that later expressions read without computing them again.

    A lambda that refers to a plain projection has that projection copied into it and
    evaluated once per element; a generator in between prevents that.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept, held = df.columns, unused(df, "__m")
    return df.select("*", F.explode(F.array(row)).alias(held)).select(
        *kept, *[F.col(held)[n].alias(n) for n in columns]
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


TOGETHER = 256  # items of an array that are folded before their results are joined


def running(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    out: Callable[[Column, Column], Column],
    kind: str,
) -> Column:
    """out(state, item), of type kind, per item of an array, with state folded over those before.

    Appending copies an array, so that items are folded some at a time: long arrays take time
    in proportion to their length, not to its square.
    """
    none = F.array().cast(f"array<{kind}>")

    def few(state: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(state.alias("state"), none.alias("out")),
            lambda s, x: F.struct(
                step(s["state"], x).alias("state"),
                F.array_append(s["out"], out(s["state"], x)).alias("out"),
            ),
        )

    def whole(given: Column) -> Column:
        last = F.ceil(F.size(given) / TOGETHER).cast("int")
        folded = F.aggregate(
            F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))),
            F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")),
            lambda s, k: bound(
                few(s["state"], F.slice(given, k * TOGETHER + 1, F.lit(TOGETHER))),
                lambda r: F.struct(
                    r["state"].alias("state"), F.array_append(s["out"], r["out"]).alias("out")
                ),
            ),
        )
        return F.flatten(folded["out"])

    return bound(items, whole)


def without(docs: DataFrame, bad: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the rows whose (doc_id, row_hash) is in bad; nulls are equal here."""
    id_, hash_ = unused(docs, "__id"), unused(docs, "__hash")
    bad = bad.select(F.col("doc_id").alias(id_), F.col("row_hash").alias(hash_)).distinct()
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (row_hash(docs[text_col]) == F.col(hash_))
    return docs.join(bad, same, "left_anti")


def row_hash(text: Column) -> Column:
    """With doc_id, what tells rows apart where ids are null or repeated."""
    return F.xxhash64(text)


class WordHashes(dict):
    """word -> 64-bit hash; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < KNOWN_WORDS:
            self[word] = value
        return value


HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text, A-Z lowered; bytes.split cuts at exactly the six blanks."""
    return text.lower().split() if text else []


def shingles(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of all runs of five words, in order; of the whole text if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = total * _P + h[k : n + k]
    return mixed(total)


# A byte's share in the hash of its word: random, 0 for blanks, equal for A-Z and a-z.
_BYTE = np.random.default_rng(20_212).integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[list(BLANKS.encode())] = 0
_IS_BLANK = _BYTE == 0
_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
PIECE = 1 << 20  # bytes of a text whose words are hashed at once, up to the next blank


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]))


_POWERS = [_powers(_P, PIECE), _powers(_INVERSE, PIECE)]


def _piece_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of the words of some bytes: sums of byte share times power of place in the word."""
    n = len(codes)
    if n > PIECE:
        power, inverse = _powers(_P, n), _powers(_INVERSE, n)
    else:
        power, inverse = _POWERS
    edges = np.diff(np.concatenate([[True], _IS_BLANK[codes], [True]]).view(np.int8))
    begin, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    through = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[codes] * power[:n])])
    return mixed((through[end] - through[begin]) * inverse[begin])


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, A-Z lowered, in order, without a list of them."""
    codes = np.frombuffer(text or b"", np.uint8)
    parts, start = [], 0
    while len(codes) - start > PIECE:
        stop = start + PIECE
        while stop < len(codes) and not _IS_BLANK[codes[stop - 1]]:
            blanks = np.flatnonzero(_IS_BLANK[codes[stop : stop + PIECE]])
            stop = stop + int(blanks[0]) + 1 if len(blanks) else min(stop + PIECE, len(codes))
        parts.append(_piece_hashes(codes[start:stop]))
        start = stop
    parts.append(_piece_hashes(codes[start:]))
    return np.concatenate(parts)


def shingle_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of the whole text if it is shorter."""
    if not len(h):
        return h
    width = min(SHINGLE_WORDS, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = total * _P + h[k : n + k]
    total = np.sort(mixed(total))
    new = np.ones(n, bool)
    np.not_equal(total[1:], total[:-1], out=new[1:])
    return total[new]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by keys; holds back the last, open group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = group_starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1]))
            held = table.slice(int(starts[-1])).to_batches()
        else:
            held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group of equal keys begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
