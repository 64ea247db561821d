"""Read the landed JSON feeds and flatten them to staging rows.

Every ``flatten_*`` returns one row per delivered record, with NULL keys where a
record lacks them; ``accepted`` and ``rejected`` split those rows. A column ``_raw`` of
the delivered rows, the whole record, is handed on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import lenient_date, lenient_double, ntz, person_key, row_hash_plain
from ..schemas import FEEDS, RECIPIENT_EVENTS

# Child feeds are only kept for staged parents: child -> (parent, key).
PARENTS = {
    "user_detail": ("users", "user_id"),
    "recipients": ("tests", "pst_id"),
    "enrollments": ("training", "campaign_id"),
}

IN_PROGRESS = "In Progress"  # fixed value

# Columns a staged row must have.
REQUIRED: dict[str, list[str]] = {
    "users": ["user_id", "ehash"],
    "user_detail": ["user_id"],
    "tests": ["campaign_id", "pst_id"],
    "recipients": ["pst_id", "user_id", "template_id"],
    "training": ["campaign_id"],
    "enrollments": ["enrollment_id", "campaign_id", "user_id"],
}


# Columns that enter the row hash, of the feeds whose flattened rows still hold all of them.
HASHED: dict[str, list[str]] = {
    "tests": ["campaign_id", "pst_id", "name", "started_at", "duration_days"],
    "recipients": ["pst_id", "user_id", *RECIPIENT_EVENTS],
    "enrollments": ["enrollment_id", "user_id", "enrollment_date", "status"],
}


_DAMAGED = "_corrupt_record"


def read_records(
    spark: SparkSession, path: str, feed: str, multi_line: bool = False
) -> DataFrame:
    """Like ``read_feed``, but text that is not JSON is a record of its own, and ``_raw`` holds
    every record as delivered, to tell later what was rejected.

    A damaged line spoils that line only; with ``multi_line`` it spoils its file.
    """
    fields = StructType([*FEEDS[feed].fields, StructField(_DAMAGED, StringType())])
    rows = (
        spark.read.schema(fields)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _DAMAGED)
        .json(path)
    )
    return rows.withColumn("_raw", F.struct(*rows.columns)).drop(_DAMAGED)


def read_feed(spark: SparkSession, path: str, feed: str, multi_line: bool = False) -> DataFrame:
    """Read one feed. A JSON array, the form of a delivered page, gives a row per element.

    With one record or one page per line (the default) large files are split
    over tasks. ``multi_line`` reads pages that are spread over several lines,
    one file per task. Text that is not JSON fails the read. For enrolments the
    campaign is the ``campaign_id=...`` directory the page was landed in.
    """
    return (
        spark.read.schema(FEEDS[feed])
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
    )


def only_active(raw: DataFrame) -> DataFrame:
    """Keep active records; one that carries no status was delivered as active."""
    return raw.filter(F.coalesce(F.col("status"), F.lit("active")) == "active")


def _raw(delivered: DataFrame) -> list[str]:
    return [c for c in delivered.columns if c == "_raw"]


def _midnight(text: Column) -> Column:
    return lenient_date(text).cast("timestamp_ntz")


def _row_hash(feed: str) -> Column:
    return row_hash_plain(*[F.col(c) for c in HASHED[feed]])


def _stamped(df: DataFrame, run_ts: datetime, feed: str) -> DataFrame:
    return df.withColumns({"load_ts": ntz(run_ts), "hash_row": _row_hash(feed)})


def flatten_users(raw: DataFrame, run_ts: datetime) -> DataFrame:
    email = F.lower("email")
    pct = lenient_double(F.col("phish_prone_percentage"))
    return raw.select(
        F.col("id").alias("user_id"),
        person_key(F.col("email")).alias("ehash"),
        pct.cast("decimal(5,2)").alias("phish_prone_pct"),
        ntz(run_ts).alias("load_ts"),
        row_hash_plain(F.col("id"), email, pct).alias("hash_row"),
        *_raw(raw),
    )


def flatten_user_detail(raw: DataFrame, run_ts: datetime) -> DataFrame:
    score = lenient_double(F.col("current_risk_score"))
    return raw.select(
        F.col("id").alias("user_id"),
        score.cast("decimal(9,4)").alias("current_risk_score"),
        ntz(run_ts).alias("load_ts"),
        row_hash_plain(F.col("id"), score).alias("hash_row"),
        *_raw(raw),
    )


def flatten_tests(raw: DataFrame, run_ts: datetime) -> DataFrame:
    flat = raw.select(
        "campaign_id",
        "pst_id",
        "status",
        "name",
        _midnight(F.col("started_at")).alias("started_at"),
        F.col("duration").alias("duration_days"),
        *_raw(raw),
    )
    return _stamped(flat, run_ts, "tests")


def flatten_recipients(raw: DataFrame, run_ts: datetime) -> DataFrame:
    landed = {c: c for c in RECIPIENT_EVENTS} | {"qr_code_scanned_at": "qr_code_scanned"}
    flat = raw.select(
        "pst_id",
        F.col("user.id").alias("user_id"),
        F.col("template.id").alias("template_id"),
        F.col("template.name").alias("template"),
        *[_midnight(F.col(landed[c])).alias(c) for c in RECIPIENT_EVENTS],
        *_raw(raw),
    )
    return _stamped(flat, run_ts, "recipients")


def flatten_training(raw: DataFrame, run_ts: datetime) -> DataFrame:
    start = lenient_date(F.col("start_date"))
    hashed = [F.col("campaign_id"), F.col("name"), F.col("status"), start.cast("timestamp_ntz")]
    return raw.select(
        "campaign_id",
        "name",
        "status",
        start.alias("start_date"),
        ntz(run_ts).alias("load_ts"),
        row_hash_plain(*hashed).alias("hash_row"),
        *_raw(raw),
    )


def flatten_enrollments(raw: DataFrame, run_ts: datetime) -> DataFrame:
    flat = raw.select(
        "enrollment_id",
        "campaign_id",
        F.col("user.id").alias("user_id"),
        _midnight(F.col("enrollment_date")).alias("enrollment_date"),
        "status",
        *_raw(raw),
    )
    return _stamped(flat, run_ts, "enrollments")


FLATTEN: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {
    "users": flatten_users,
    "user_detail": flatten_user_detail,
    "tests": flatten_tests,
    "recipients": flatten_recipients,
    "training": flatten_training,
    "enrollments": flatten_enrollments,
}


def complete(feed: str) -> Column:
    """True when a flattened row carries every required column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED[feed]])


def accepted(flat: DataFrame, feed: str) -> DataFrame:
    """Complete rows; of the training campaigns only those in progress."""
    rows = flat.filter(complete(feed))
    return rows.filter(F.col("status") == IN_PROGRESS) if feed == "training" else rows


def rejected(flat: DataFrame, feed: str) -> DataFrame:
    return flat.filter(~complete(feed))


def reject_reason(feed: str) -> Column:
    """Why a flattened row with ``_raw`` is not staged: damaged text or a missing value; else NULL."""
    lacks = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED[feed]])
    return (
        F.when(F.col("_raw")[_DAMAGED].isNotNull(), F.lit("damaged"))
        .when(~complete(feed), F.concat(F.lit("lacks "), lacks))
        .otherwise(F.lit(None).cast("string"))
    )


def record_text() -> Column:
    """The delivered record of a flattened row with ``_raw``: its text if damaged, else JSON."""
    return F.coalesce(F.col("_raw")[_DAMAGED], F.to_json(F.col("_raw").dropFields(_DAMAGED)))


def once_per_key(rows: DataFrame, keys: list[str], extra: Column) -> DataFrame:
    """One row per key with the number of its ``_copies``; rows that ``extra`` marks all stay.

    Of rows that differ beyond their key the one with the largest values stays. As an
    aggregate with a partial step, copies of one key cost one row per task.
    """
    rest = [c for c in rows.columns if c not in keys]
    own = F.when(extra, F.monotonically_increasing_id()).alias("_own")
    kept = rows.groupBy(*keys, own).agg(
        F.max(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    return kept.select(*keys, "_row.*", "_copies")


def children_of(child: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent was staged."""
    return child.join(parents.select(key), key, "left_semi")


def hashed_after(
    child: DataFrame, feed: str, join: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``join`` of flattened rows, with the row hash made behind it where the rows allow that.

    The join shuffles the rows, and 32 bytes of each that no codec shrinks stay out of it. The
    events of a recipient, all midnights, pass it as the first day and the days since then.
    """
    if feed not in HASHED or "hash_row" not in child.columns:
        return join(child)
    rows = child.drop("hash_row")
    if feed == "recipients":
        days = [F.col(e).cast("date") for e in RECIPIENT_EVENTS]
        rows = rows.withColumn("_first", F.least(*days))
        gaps = F.array(*[F.date_diff(day, F.col("_first")) for day in days])
        joined = join(rows.withColumn("_gaps", gaps).drop(*RECIPIENT_EVENTS))
        for i, event in enumerate(RECIPIENT_EVENTS):
            day = F.date_add("_first", F.col("_gaps")[i])
            joined = joined.withColumn(event, day.cast("timestamp_ntz"))
    else:
        joined = join(rows)
    return joined.withColumn("hash_row", _row_hash(feed)).select(*child.columns)


def staged_rows(flat: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is staged of each flattened feed: accepted rows, children of staged parents only."""
    staged: dict[str, DataFrame] = {}
    for feed in FLATTEN:
        staged[feed] = accepted(flat[feed], feed)
        if feed in PARENTS:
            parent, key = PARENTS[feed]
            known = staged[parent]
            staged[feed] = hashed_after(
                staged[feed], feed, lambda rows, known=known, key=key: children_of(rows, known, key)
            )
    return staged
