"""Rows of the three fact tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag, ntz
from ..operators.calendar import with_date_key
from ..operators.changes import merge_once, upsert
from ..operators.latest import latest_per_key
from ..schemas import RECIPIENT_FLAGS
from ..sources.store import written

SECONDS_PER_DAY = 86400


def presence_flags(recipients: DataFrame) -> DataFrame:
    """Event times to 0/1 flags; the other columns stay."""
    events = list(RECIPIENT_FLAGS.values())
    others = [c for c in recipients.columns if c not in events]
    return recipients.select(
        *others, *[flag(F.col(event)).alias(name) for name, event in RECIPIENT_FLAGS.items()]
    )


# The flags of a recipient as bits of one number, so that joins and merges carry one column.
FLAGS = "_flags"


def pack_flags(recipients: DataFrame) -> DataFrame:
    """Event times to one column ``_flags``, a bit per event; the other columns stay."""
    events = list(RECIPIENT_FLAGS.values())
    bits = [F.when(F.col(e).isNotNull(), 1 << i).otherwise(0) for i, e in enumerate(events)]
    others = [c for c in recipients.columns if c not in events]
    return recipients.select(*others, reduce(lambda a, b: a.bitwiseOR(b), bits).alias(FLAGS))


def unpack_flags() -> dict[str, Column]:
    """The 0/1 flags of ``_flags``, by name."""
    return {
        name: F.getbit(F.col(FLAGS), F.lit(i)).cast("int") for i, name in enumerate(RECIPIENT_FLAGS)
    }


def describe_tests(tests: DataFrame, dim_campaign: DataFrame, dates: DataFrame) -> DataFrame:
    """What the fact takes from a test: campaign key, start date key, duration.

    Tests of unknown campaigns are left out; an unknown date leaves its key NULL.
    """
    campaigns = dim_campaign.filter(
        F.col("is_current") & (F.col("campaign_type") == "phishing")
    ).select("campaign_id", "campaign_key")
    return with_date_key(
        tests.join(campaigns, "campaign_id"), "started_at", dates, "started_date_key"
    ).select(
        "pst_id",
        "campaign_key",
        "started_date_key",
        (F.col("duration_days").cast("long") * SECONDS_PER_DAY).alias("duration_seconds"),
    )


def recipient_rows(
    recipients: DataFrame, described: DataFrame, dim_user: DataFrame, dim_template: DataFrame
) -> DataFrame:
    """Recipients with their dimension keys, from the tests of ``describe_tests``."""
    packed = packed_recipient_rows(recipients, described, dim_user, dim_template)
    flags = [c.alias(name) for name, c in unpack_flags().items()]
    at = packed.columns.index(FLAGS)
    return packed.select(*packed.columns[:at], *flags, *packed.columns[at + 1 :])


def packed_recipient_rows(
    recipients: DataFrame, described: DataFrame, dim_user: DataFrame, dim_template: DataFrame
) -> DataFrame:
    """``recipient_rows`` with the flags still in one column.

    The tests come with campaign and date: those are small next to the
    recipients, which so take part in three joins instead of five. They come last, since
    only they make a row wider. Unknown tests and people drop the row; an unknown
    template leaves its key NULL.
    """
    users = dim_user.filter("is_current").select("user_id", "user_key")
    templates = dim_template.filter("is_current").select("template_id", "template_key")
    flags = pack_flags(recipients).select("pst_id", "user_id", "template_id", FLAGS, "load_ts")
    return (
        flags.join(users, "user_id")
        .drop("user_id")
        .join(templates, "template_id", "left")
        .drop("template_id")
        .join(described, "pst_id")
        .select(
            "user_key",
            "campaign_key",
            "template_key",
            "pst_id",
            FLAGS,
            "started_date_key",
            "duration_seconds",
            "load_ts",
        )
    )


# How rows merge into the two upserted facts: the match key, what an update takes. The
# first load time of a row stays.
RECIPIENT_KEYS = ["pst_id", "user_key"]
RECIPIENT_UPDATES = [
    "campaign_key",
    "template_key",
    *RECIPIENT_FLAGS,
    "started_date_key",
    "duration_seconds",
]
ENROLLMENT_KEYS = ["enrollment_id"]
ENROLLMENT_UPDATES = ["user_key", "campaign_key", "status", "enrollment_date_key"]


def merge_recipients(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """The first load time of a row stays; the result status is never filled.

    ``rows`` are those of ``recipient_rows`` or ``packed_recipient_rows``.
    """
    packed = FLAGS in rows.columns
    unpacked = unpack_flags() if packed else {}
    return upsert(
        fact,
        rows,
        keys=RECIPIENT_KEYS,
        take_source=[c for c in RECIPIENT_UPDATES if c not in unpacked],
        keep_target=["load_ts"],
        insert_defaults={"result_status": F.lit(None).cast("string")},
        packed=FLAGS if packed else None,
        unpacked=unpacked,
    )


def merged_parts(
    fact: DataFrame,
    rows: DataFrame,
    keys: list[str],
    updates: list[str],
    changed: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Stored rows after their updates, and the rows to insert, which still lack a key.

    Both come from one join, whose rows are written: their source is shuffled once. Columns
    that the source lacks are NULL in new rows. ``changed`` names a column of the stored rows
    that says whether they differ from what they were. If the rows are those of
    ``packed_recipient_rows``, the flags are still to be made by ``opened_flags``.
    """
    packed = FLAGS in rows.columns
    both = written(
        merge_once(
            fact,
            rows,
            keys,
            updates,
            known="_known",
            changed=changed or "_differs",
            packed=FLAGS if packed else None,
            unpacked=unpack_flags() if packed else None,
        )
    )
    columns = [*fact.columns, *([FLAGS] if packed else [])]
    stored = both.filter("_known").select(*columns, *([changed] if changed else []))
    return stored, both.filter("not _known").select(*columns)


def opened_flags() -> dict[str, Column]:
    """The flags of merged rows: those of ``_flags`` where the row has it, else the stored ones."""
    has = F.col(FLAGS).isNotNull()
    return {name: F.when(has, c).otherwise(F.col(name)) for name, c in unpack_flags().items()}


def enrollment_rows(
    enrollments: DataFrame, dim_user: DataFrame, dim_campaign: DataFrame, dates: DataFrame
) -> DataFrame:
    """Enrolments with their dimension keys; unknown people and campaigns drop the row."""
    users = dim_user.filter("is_current").select("user_id", "user_key")
    campaigns = dim_campaign.filter(
        F.col("is_current") & F.col("campaign_type").isin("training", "policy")
    ).select("campaign_id", "campaign_key")
    return with_date_key(
        enrollments.join(campaigns, "campaign_id").join(users, "user_id"),
        "enrollment_date",
        dates,
        "enrollment_date_key",
    ).select(
        "user_key", "campaign_key", "enrollment_id", "status", "enrollment_date_key", "load_ts"
    )


def merge_enrollments(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """The completion date and the first load time of a row stay."""
    return upsert(
        fact,
        rows,
        keys=ENROLLMENT_KEYS,
        take_source=ENROLLMENT_UPDATES,
        keep_target=["load_ts"],
        insert_defaults={"completion_date_key": F.lit(None).cast("int")},
    )


def snapshot_rows(
    users: DataFrame,
    details: DataFrame,
    dim_user: DataFrame,
    fact: DataFrame,
    day_key: int,
    run_ts: datetime,
) -> DataFrame:
    """Today's snapshot rows that are not stored yet; the first run of a day wins."""
    current = dim_user.filter("is_current").select("user_id", "user_key")
    scores = latest_per_key(
        details.select("user_id", "current_risk_score", "load_ts"), ["user_id"], "load_ts"
    ).select("user_id", "current_risk_score")
    stored = fact.filter(F.col("snapshot_date_key") == day_key).select("user_key")
    return (
        users.select("user_id", "phish_prone_pct")
        .join(current, "user_id")
        .join(scores, "user_id", "left")
        .join(stored, "user_key", "left_anti")
        .select(
            "user_key",
            F.lit(day_key).alias("snapshot_date_key"),
            "phish_prone_pct",
            "current_risk_score",
            ntz(run_ts).alias("load_ts"),
        )
    )
