"""Product codes of vectors by Lloyd rounds whose members stay with their owners.

Vectors of integers are cut into parts; each position of a part has a codebook. The parts
lie in files by (position, entry, salt), and the task that reads such a file owns them: it
sums what is resident for the next codebook and then looks for the nearest entry again.
Parts that keep their entry stay in place; only the others go through the next shuffle to
their new owners. Salts follow the counts, so an entry that attracts a third of all parts
has many owners. Every state is a written table: a lost executor repeats a task. What the
driver holds is the codebooks and a count per entry.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch_folder, written
from .vectors import exact_type, looked_up, matrix, scaled

SCALE = 1024
POSITIONS = 4
ENTRIES = 256
ROUNDS = 4
OWNED = 65_536  # members of an entry that share an owner, about, but
OWNERS = 1024  # no more of them than one in so many of all that are placed

_MEMBER = "position int, entry int, spread int, part binary"


class Codebooks:
    """Entries (positions, entries, width) of integers, and the exact nearest-entry search."""

    def __init__(self, entries: np.ndarray, peak: int) -> None:
        self.entries = entries
        # Means lie within the components, so no distance exceeds this.
        self.kind = exact_type(4 * max(entries.shape[2], 1) * max(peak, 1) ** 2)

    def nearest(self, position: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lowest of several, and its squared distance."""
        book = self.entries[position].astype(self.kind)
        parts = parts.astype(self.kind)
        away = (book * book).sum(axis=1) - 2 * (parts @ book.T)
        entry = away.argmin(axis=1)
        least = away[np.arange(len(parts)), entry] + (parts * parts).sum(axis=1)
        return entry.astype(np.int32), least.astype(np.int64)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _spread(start: int, n: int) -> np.ndarray:
    """A number per member that deals them evenly, the same whenever a task is repeated."""
    return ((np.arange(start, start + n, dtype=np.uint64) * np.uint64(2654435761)) >> np.uint64(7)).astype(
        np.uint32
    ).view(np.int32) & np.int32(0x7FFFFFFF)


def _binary(parts: np.ndarray) -> pa.Array:
    width = parts.shape[1] * 4
    ends = np.arange(len(parts) + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(parts, "<i4")
    return pa.Array.from_buffers(
        pa.binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())]
    )


def _first_members(whole: DataFrame, books: Codebooks) -> DataFrame:
    """Every part of every vector with its nearest entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, (n_positions, _, width) = 0, books.entries.shape
        for batch in batches:
            parts = matrix(batch["vector"], n_positions * width).reshape(-1, n_positions, width)
            for position in range(n_positions):
                mine = parts[:, position]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(mine), position, np.int32)),
                        pa.array(books.nearest(position, mine)[0]),
                        pa.array(_spread(start, len(mine))),
                        _binary(mine),
                    ],
                    names=["position", "entry", "spread", "part"],
                )
            start += len(parts)

    return whole.select("vector").mapInArrow(run, _MEMBER)


def _owned(members: DataFrame, counts: list) -> DataFrame:
    """Members at their owners: files by (position, entry, salt), salts by the counts."""
    spark = members.sparkSession
    share = max(1, min(OWNED, sum(r["count"] for r in counts) // OWNERS))
    rows = [(r["position"], r["entry"], -(-r["count"] // share)) for r in counts]
    salts = F.broadcast(spark.createDataFrame(rows, "position int, entry int, salts bigint"))
    placed = members.join(salts, ["position", "entry"]).select(
        "position", "entry", "spread", F.expr("cast(spread % salts as int)").alias("salt"), "part"
    )
    dealt = placed.repartition("position", "entry", "salt").sortWithinPartitions("position", "entry")
    return written(dealt.drop("salt"), "owners")


def _counted(members: DataFrame) -> list:
    return members.groupBy("position", "entry").count().collect()


def _updated(resident: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries after each owner has summed its resident members."""
    n_positions, n_entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_positions * n_entries, width), np.int64)
        members = np.zeros(n_positions * n_entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = matrix(batch["part"], width).astype(np.int64)
            key = batch["position"].to_numpy() * n_entries + batch["entry"].to_numpy()
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            np.add.at(sums, key[starts], np.add.reduceat(parts, starts, axis=0))
            np.add.at(members, key, 1)
        mine = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(mine.astype(np.int32)),
                pa.array(members[mine]),
                pa.array(list(sums[mine]), pa.list_(pa.int64())),
            ],
            names=["slot", "members", "sums"],
        )

    if not width:
        return books.entries
    partial = resident.select("position", "entry", "part").mapInArrow(
        run, "slot int, members bigint, sums array<bigint>"
    )
    totals = partial.groupBy("slot").agg(
        F.sum("members").alias("members"),
        F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"),
    )
    entries = books.entries.copy().reshape(-1, width)
    for row in totals.collect():
        entries[row["slot"]] = np.array(row["sums"], np.int64) // row["members"]
    return entries.reshape(books.entries.shape)


def _reassigned(resident: DataFrame, books: Codebooks) -> DataFrame:
    """Resident members with their nearest entry now, and whether it is another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books.entries.shape[2]
        for batch in batches:
            parts, position = matrix(batch["part"], width), batch["position"].to_numpy()
            entry = np.empty(len(parts), np.int32)
            for p in np.unique(position):
                mine = position == p
                entry[mine] = books.nearest(int(p), parts[mine])[0]
            moved = pa.array(entry != batch["entry"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [moved, batch["position"], pa.array(entry), batch["spread"], batch["part"]],
                names=["moved", "position", "entry", "spread", "part"],
            )

    return resident.mapInArrow(run, "moved boolean, " + _MEMBER)


def _migrated(resident: list[DataFrame], books: Codebooks) -> list[DataFrame]:
    """The state after a round: who stays, where it was, and who moved, at its new owner."""
    spark = resident[0].sparkSession
    path = f"{scratch_folder(spark)}/lloyd-{uuid.uuid4().hex}"
    now = _reassigned(_all(resident), books).sortWithinPartitions("moved", "position", "entry")
    now.write.partitionBy("moved").parquet(path)
    table = spark.read.schema(_MEMBER + ", moved boolean").parquet(path)
    counts = table.groupBy("moved", "position", "entry").count().collect()

    def half(moved: str) -> DataFrame:
        return spark.read.schema(_MEMBER).parquet(f"{path}/moved={moved}")

    state = [half("false")] if any(not r["moved"] for r in counts) else []
    movers = [r for r in counts if r["moved"]]
    if movers:
        leaving = half("true")
        state.append(_owned(leaving, movers))
        discard(leaving)
    discard(*resident)
    return state


def _all(resident: list[DataFrame]) -> DataFrame:
    first, *others = resident
    for table in others:
        first = first.unionByName(table)
    return first


def _first_entries(whole: DataFrame, size: int, n_entries: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids, as the first entries."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    rows = whole.orderBy(*order).limit(n_entries).select("vector").collect()
    vectors = matrix(pa.array([bytes(r["vector"]) for r in rows], pa.binary()), size)
    parts = vectors.reshape(len(rows), POSITIONS, size // POSITIONS)
    return np.ascontiguousarray(parts.transpose(1, 0, 2)).astype(np.int64)


def fitted(whole: DataFrame, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks for integer vectors (vec_id, vector, peak, ...); None without rows.

    Vectors shorter than the longest, or than the next multiple of the positions, count as
    if zeros followed. With fewer vectors than entries there are fewer entries.
    """
    longest, peak = whole.agg(F.max(F.octet_length("vector")), F.max("peak")).first()
    if longest is None:
        return None
    size = -(-(longest // 4) // POSITIONS) * POSITIONS
    books = Codebooks(_first_entries(whole, size, n_entries), peak)
    members = _first_members(whole, books)
    resident = [_owned(members, _counted(members))]
    for round_ in range(rounds):
        books = Codebooks(_updated(_all(resident), books), peak)
        if round_ < rounds - 1:
            resident = _migrated(resident, books)
    discard(*resident)
    return books


def encoded(whole: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) per vector: hex indexes of its nearest entries, distance."""
    n_positions, _, width = books.entries.shape
    label = whole.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = matrix(batch["vector"], n_positions * width).reshape(-1, n_positions, width)
            found = [books.nearest(p, parts[:, p]) for p in range(n_positions)]
            codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            text = codes.tobytes().hex()
            step = 2 * n_positions
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["label"],
                    pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()),
                    pa.array(sum(d for _, d in found)),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    rows = whole.select("vec_id", "label", "vector")
    return rows.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def vector_codes(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per row whose vector is whole.

    rows has vec_id, label and the vector; other columns are not read. A row whose vector is
    null or holds a null or non-finite component goes. Rows that repeat or share a vec_id
    each count and keep their row; one without vec_id comes last among the first entries;
    null labels are one label. No rows give no rows.
    """
    whole = scaled(rows, SCALE, vector)
    books = fitted(whole)
    if books is None:
        return rows.sparkSession.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        )
    codes = written(encoded(whole, books), "codes")
    sums = written(
        codes.groupBy("label").agg(
            F.count("*").alias("members"), F.sum("error").alias("label_error")
        ),
        "errors",
    )
    return looked_up(codes, sums, "label", "members", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
