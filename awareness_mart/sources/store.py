"""Tables as versions of parquet files on shared storage.

A table directory holds one ``version=<run>`` directory per load. Inside it rows
sit in one of two slices:

* ``slice=current`` is replaced: only the newest published version counts;
* ``slice=history`` is kept: the rows of all published versions count.

A full refresh writes everything as current. An append-only table writes
everything as history. A dimension with closed rows writes the rows it closes as
history once and only rewrites its current slice, so a nightly load does not
copy years of closed versions.

A load writes all its versions first and publishes them with one append to the
publication log, so readers see either the whole load or none of it. Files being
read are never overwritten.

The tables of ``schemas.PARTITIONED`` are plain partitioned tables without versions: a
load replaces the parts that it changed by Spark's dynamic partition overwrite and leaves
the files of all others alone. Their new parts are written aside while the load runs and
put in place when it is published, after the dimensions they refer to and before the load
is reported as finished; a publication that is cut off in between is repaired by running
the load again.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..schemas import PARTITIONED

# Zstandard files are smaller than those of Spark's default codec.
_FILES = {"compression": "zstd"}
_LOG = "seq BIGINT, name STRING, version STRING, keeps_history BOOLEAN"
_VERSION, _SLICE = StructField("version", StringType()), StructField("slice", StringType())


def scratch_dir(spark: SparkSession) -> str:
    """A new directory below the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting only a local session may fall back to a folder of this
    machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/awareness-{uuid.uuid4().hex}"


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job has made and nothing reads any more."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """A part of a job that leaves only the tables it writes on disk.

    What ``written`` made inside is deleted at the end, so nothing that reads it may be
    handed out. Shuffle files go when their query ends; else they stay until the driver
    happens to collect its garbage, which may be after the job.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    outer = _made.set([])
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
        for path in _made.get():
            removed(spark, path)
        _made.reset(outer)


def written(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared scratch folder and read back.

    For an intermediate that several steps use: it is computed once, and a lost
    executor costs a file read instead of the whole lineage. Inside ``tidy`` it is
    deleted at the end.
    """
    path = scratch_dir(df.sparkSession)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.options(**_FILES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _visible(found: list[tuple[str, bool]]) -> list[str]:
    """Of a table's versions, oldest first, those that kept history, and the newest."""
    return [v for v, keeps in found[:-1] if keeps] + [v for v, _ in found[-1:]]


class MartStore:
    """One load's view of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, StructType]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas
        self.published: dict[str, list[tuple[str, bool]]] = {}
        self.pending: dict[str, bool] = {}
        self.appended: set[str] = set()
        self.parts_pending: dict[str, DataFrame] = {}
        self.aside: list[str] = []
        self.seen: dict[str, list[tuple[str, bool]]] = {}
        self.seq = 0
        self._read_log()
        self._next_run()

    def _next_run(self) -> None:
        self.run = f"v{uuid.uuid4().hex}"

    def _read_log(self) -> None:
        """Published versions per table, oldest first: one small row per table and load."""
        try:
            rows = self.spark.read.schema(_LOG).json(f"{self.root}/_published").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        for row in sorted(rows, key=lambda r: r.seq):
            self.published.setdefault(row.name, []).append((row.version, row.keeps_history))
            self.seq = row.seq

    def reload(self) -> None:
        """See what others have published since; what this load wrote stays pending.

        What was read before stays the state that ``publish`` compares with.
        """
        self.published = {}
        self._read_log()

    def versions(self, table: str) -> list[str]:
        """Versions that hold rows of the table: the newest and those that kept history."""
        found = list(self.published.get(table, []))
        if table in self.pending:
            found.append((self.run, self.pending[table]))
        return _visible(found)

    def remove_superseded(self) -> None:
        """Delete the published versions that no reader sees any more.

        To be called when no other job still reads what it found before the last publication.
        """
        self.reload()
        for table, found in self.published.items():
            for version in {v for v, _ in found} - {*_visible(found)}:
                removed(self.spark, f"{self.root}/{table}/version={version}")

    def write(self, table: str, rows: DataFrame, history: bool | Column = False) -> DataFrame:
        """Write this load's version and return the table as this load now sees it.

        ``history`` says which rows to keep for good; the others form the new
        current slice.
        """
        if table in self.pending:
            raise ValueError(f"{table} was already written in this load")
        rows = rows.select(*self.schemas[table].names)
        self._remember(table)
        path = f"{self.root}/{table}/version={self.run}"
        if isinstance(history, bool):
            rows.write.options(**_FILES).parquet(f"{path}/slice={'history' if history else 'current'}")
        else:
            part = F.when(history, F.lit("history")).otherwise(F.lit("current"))
            parts = rows.withColumn("slice", part).write.options(**_FILES)
            parts.partitionBy("slice").parquet(path)
        self.pending[table] = history is not False
        return self._rows(table)

    def write_checked(
        self, table: str, rows: DataFrame, reason: Column, record: Column, copies: Column
    ) -> DataFrame:
        """Replace a table by the rows without a reason, and keep the others as rejected records.

        Both go to one write; ``checked`` counts what it wrote.
        """
        if table in self.pending:
            raise ValueError(f"{table} was already written in this load")
        self._remember(table)
        bad = reason.isNotNull()
        part = F.when(bad, F.lit("rejected")).otherwise(F.lit("current"))
        rows.select(
            *[F.when(~bad, F.col(c)).alias(c) for c in self.schemas[table].names],
            reason.alias("reason"),
            F.when(bad, record).alias("record"),
            copies.alias("copies"),
            part.alias("slice"),
        ).write.options(**_FILES).partitionBy("slice").parquet(
            f"{self.root}/{table}/version={self.run}"
        )
        self.pending[table] = False
        return self._rows(table)

    def _newest(self, table: str, fields: str) -> DataFrame:
        """Columns of the newest version of a table of ``write_checked``, with their slice."""
        versions = self.versions(table)
        if not versions:
            return self.spark.createDataFrame([], f"{fields}, slice string")
        path = f"{self.root}/{table}/version={versions[-1]}"
        return self.spark.read.schema(f"{fields}, slice string").parquet(path)

    def rejected(self, table: str) -> DataFrame:
        """(reason, record) of the records that the newest ``write_checked`` kept out."""
        rows = self._newest(table, "reason string, record string")
        return rows.filter("slice = 'rejected'").select("reason", "record")

    def checked(self, table: str) -> tuple[int, int, int]:
        """Rows that the newest ``write_checked`` stored, rejected, and left out as repeated."""
        counts = self._newest(table, "copies bigint").agg(
            F.count_if(F.col("slice") == "current"),
            F.count_if(F.col("slice") == "rejected"),
            F.sum(F.when(F.col("slice") == "current", F.col("copies") - 1)),
        )
        return tuple(int(n or 0) for n in counts.first())

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to an append-only table; jobs that append do not get in each other's way."""
        self.write(table, rows, history=True)
        self.appended.add(table)

    def replace_parts(
        self, table: str, rows: DataFrame, behind: dict[str, Column] | None = None
    ) -> None:
        """Replace the parts of a partitioned table that rows has; put in place by ``publish``.

        ``behind`` gives columns as expressions that are evaluated behind the shuffle by part.
        """
        column = PARTITIONED[table]
        names = [c for c in self.schemas[table].names if c != column]
        path = scratch_dir(self.spark)
        self.aside.append(path)
        self._remember(table)
        layout = self._layout(table)
        values = {c: F.col(c) for c in (*names, column)} | (behind or {})
        typed = [value.cast(layout[c].dataType).alias(c) for c, value in values.items()]
        rows.hint("rebalance", column).select(*typed).write.options(**_FILES).partitionBy(
            column
        ).parquet(path)
        self.parts_pending[table] = self.spark.read.schema(layout).parquet(path)

    def _layout(self, table: str) -> StructType:
        schema, column = self.schemas[table], PARTITIONED[table]
        if column in schema.names:
            return schema
        return StructType([*schema.fields, StructField(column, IntegerType())])

    def parts(self, table: str) -> DataFrame:
        """The published rows of a partitioned table, with the column that names their part."""
        self._remember(table)
        layout = self._layout(table)
        try:
            return self.spark.read.schema(layout).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # No rows by the plan itself: a join with them shuffles nothing.
            return self.spark.createDataFrame([], layout).limit(0)

    def _remember(self, table: str) -> None:
        """Keep the state of a table that this load has seen first since it last published it."""
        self.seen.setdefault(table, list(self.published.get(table, [])))

    def read(self, table: str, slice_: str | None = None) -> DataFrame:
        """The table, or only its ``current`` or ``history`` slice."""
        if table in PARTITIONED:
            return self.parts(table).select(*self.schemas[table].names)
        self._remember(table)
        return self._rows(table, slice_)

    def _rows(self, table: str, slice_: str | None = None) -> DataFrame:
        schema = self.schemas[table]
        versions = self.versions(table)
        if not versions:
            return self.spark.createDataFrame([], schema)
        layout = StructType([*schema.fields, _VERSION, _SLICE])
        rows = (
            self.spark.read.schema(layout)
            .option("basePath", f"{self.root}/{table}")
            .parquet(*[f"{self.root}/{table}/version={v}" for v in versions])
        )
        current = (F.col("slice") == "current") & (F.col("version") == versions[-1])
        history = F.col("slice") == "history"
        wanted = {None: current | history, "current": current, "history": history}[slice_]
        return rows.filter(wanted).select(*schema.names)

    def publish(self) -> None:
        """Make everything this load wrote visible, at once.

        Fails, and publishes nothing, if another job has published one of the same tables
        since this store first read or wrote it: its changes would be lost. Append-only
        tables take part in no conflict. The log takes no lock; jobs that publish the same
        table in the same instant must be kept apart.
        """
        mine = [t for t in (*self.pending, *self.parts_pending) if t not in self.appended]
        self.reload()
        late = sorted(t for t in mine if self.published.get(t, []) != self.seen[t])
        if late:
            raise ValueError(f"{', '.join(late)} changed since this load read them")
        last = self.appended if self.parts_pending else set()
        self._log({t: keeps for t, keeps in self.pending.items() if t not in last})
        for table, rows in self.parts_pending.items():
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer = writer.options(**_FILES)
            writer.partitionBy(PARTITIONED[table]).parquet(f"{self.root}/{table}")
        self._log({t: True for t in (*self.parts_pending, *last)})
        for path in self.aside:
            removed(self.spark, path)
        self.aside = []
        for table in mine:
            del self.seen[table]
        self.pending, self.parts_pending, self.appended = {}, {}, set()
        self._next_run()

    def _log(self, tables: dict[str, bool]) -> None:
        """Append a publication of this run's tables to the log."""
        if not tables:
            return
        self.seq += 1
        entries = [(self.seq, t, self.run, keeps) for t, keeps in tables.items()]
        self.spark.createDataFrame(entries, _LOG).coalesce(1).write.mode("append").json(
            f"{self.root}/_published"
        )
        for table, keeps in tables.items():
            self.published.setdefault(table, []).append((self.run, keeps))
