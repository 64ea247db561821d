"""The nightly jobs: stage the feeds, stage HR, load the mart."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact
from ..operators.bridge import bridge_apply, membership_pairs
from ..operators.calendar import FIRST_DAY, LAST_DAY, calendar, require_day
from ..operators.changes import scd2_changes
from ..operators.keys import assign_keys, fill_keys, highest_key
from ..schemas import FACT_BUCKETS, TABLES
from ..sources.feeds import (
    FLATTEN,
    IN_PROGRESS,
    PARENTS,
    hashed_after,
    once_per_key,
    only_active,
    read_records,
    record_text,
    reject_reason,
)
from ..sources.hr import active_hr_units
from ..sources.masters import stage_phishing_campaigns, stage_training_names, stage_units
from ..sources.store import MartStore, tidy, written
from . import dashboards, facts
from .campaigns import campaign_source
from .constraints import audit_mart
from .history import merge_total_history, merge_unit_history, person_measures, unit_rollup
from .monitoring import all_ready, load_status, quota_line
from .reports import current_results
from .templates import new_templates

FEED_TABLES = {
    "users": "stg_users",
    "user_detail": "stg_user_detail",
    "tests": "stg_pst",
    "recipients": "stg_recipient",
    "training": "stg_training",
    "enrollments": "stg_enrollment",
}

# Names of the sources in the status table.
VENDOR, HR, MASTER, MART = "Vendor", "HR", "Master", "DWH"

# NULL and the value beside a column count as the same when versions are compared.
USER_TRACKED = {"ehash": bytearray(b"\x00")}
UNIT_TRACKED = {"unit_naam": ""}
CAMPAIGN_TRACKED = {"name": "", "status": "", "start_date_key": -1}


def tidied(job: Callable) -> Callable:
    """A job on a store of which only the tables stay on disk."""

    @wraps(job)
    def run(store: MartStore, *args, **kwargs):
        with tidy(store.spark):
            return job(store, *args, **kwargs)

    return run


def _finish(store: MartStore, source: str, run_ts: datetime) -> None:
    """Report that a source has finished its run of the day."""
    event = [(source, run_ts.date(), True, run_ts)]
    store.append("status_events", store.spark.createDataFrame(event, TABLES["status_events"]))


def _stage(store: MartStore, feed: str, rows: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Write one flattened feed: what is staged, and beside it what is rejected, in one pass."""
    rows = rows.withColumn("_reason", reject_reason(feed))
    bad = F.col("_reason").isNotNull()
    rows = rows.withColumn("_record", F.when(bad, record_text())).drop("_raw")
    if feed == "training":
        rows = rows.filter(bad | (F.col("status") == IN_PROGRESS))
    if feed in PARENTS:
        parent, key = PARENTS[feed]
        known = parents[parent].select(key, F.lit(True).alias("_known")).distinct()

        def of_staged(child: DataFrame) -> DataFrame:
            return child.join(known, key, "left").filter(bad | F.col("_known")).drop("_known")

        rows = hashed_after(rows, feed, of_staged)
    copies = F.lit(1).cast("long")
    if feed == "user_detail":
        rows, copies = once_per_key(rows, ["user_id", "load_ts"], bad), F.col("_copies")
    return store.write_checked(FEED_TABLES[feed], rows, F.col("_reason"), F.col("_record"), copies)


@tidied
def run_staging(
    store: MartStore,
    landed: dict[str, str],
    run_ts: datetime,
    multi_line: bool = False,
    calls: int = 0,
) -> None:
    """Replace the staging tables by the landed feeds.

    Parents are written first; their children are matched against what was written. Every
    feed is read once: records that lack a required value or are no JSON are kept with a
    reason (``store.rejected``), repeated risk scores are staged once, and what was stored,
    rejected and left out is added to ``load_counts``. ``calls`` is the number of requests
    that fetching took; it is added to the day's use, and ``log`` gets the band that it is in.
    """
    store.reload()
    staged: dict[str, DataFrame] = {}
    counts = []
    for feed, table in FEED_TABLES.items():
        raw = read_records(store.spark, landed[feed], feed, multi_line)
        rows = FLATTEN[feed](only_active(raw) if feed == "users" else raw, run_ts)
        staged[feed] = _stage(store, feed, rows, staged)
        counts.append((run_ts, feed, *store.checked(table)))
    spark = store.spark
    store.append("load_counts", spark.createDataFrame(counts, TABLES["load_counts"]))
    used = [(VENDOR, run_ts.date(), calls, run_ts)]
    store.append("usage_events", spark.createDataFrame(used, TABLES["usage_events"]))
    store.append("log", written(quota_line(load_status(store), VENDOR, run_ts)))
    _finish(store, VENDOR, run_ts)
    store.publish()


@tidied
def run_hr(
    store: MartStore,
    staff: DataFrame,
    units: DataFrame,
    run_ts: datetime,
    charset: str = "UTF-8",
) -> None:
    """Replace the staged HR extract."""
    store.reload()
    store.write("stg_hr", active_hr_units(staff, units, run_ts, charset))
    _finish(store, HR, run_ts)
    store.publish()


def run_history(
    store: MartStore,
    users: DataFrame,
    hr: DataFrame,
    units: DataFrame,
    run_ts: datetime,
) -> None:
    """Write this month's averages per unit and in total, from one rollup.

    A second run in a month replaces that month's rows; other months stay.
    """
    month = written(unit_rollup(users, hr, units))
    day = run_ts.date()
    store.write("history_units", merge_unit_history(store.read("history_units"), month, day))
    store.write("history_total", merge_total_history(store.read("history_total"), month, day))
    store.publish()


def run_monthly(store: MartStore, run_ts: datetime, completed: str) -> None:
    """Write this month's averages from the mart itself: its people, units and facts.

    ``completed`` is the enrolment status that counts as done.
    """
    store.reload()
    people = store.read("dim_user")
    types = store.read("dim_campaign").select("campaign_key", "campaign_type")
    rows = dashboards.measures(
        current_results(store.read("fact_snapshot"), people, ["snapshot_date_key"]),
        current_results(store.read("fact_recipient"), people, ["pst_id"]),
        store.read("fact_enrollment").join(types, "campaign_key"),
        completed,
    )
    versions = people.withColumnRenamed("user_id", "id")
    users = person_measures(rows, versions, last_key_of_month(run_ts.date()))
    hr = store.read("stg_hr").select("ehash", F.col("unit").alias("groep"))
    run_history(store, users, hr, store.read("mst_units").select("unit"), run_ts)


def last_key_of_month(day: date) -> int:
    """The date key of the last day of the month."""
    return day.year * 10000 + day.month * 100 + monthrange(day.year, day.month)[1]


def _load_dimension(
    store: MartStore, table: str, source: DataFrame, keys: list[str], tracked: dict, **options
) -> DataFrame:
    """Load a history-keeping dimension: closed rows are added to its history slice."""
    surrogate = store.schemas[table].names[0]
    changes = written(
        scd2_changes(
            store.read(table, "current"), source, keys, tracked, surrogate=surrogate, **options
        )
    )
    keyed = fill_keys(changes, surrogate, keys, highest_key(store.read(table), surrogate))
    return store.write(table, keyed, history=~F.col("is_current"))


@tidied
def _merge_fact(
    store: MartStore,
    table: str,
    rows: DataFrame,
    keys: list[str],
    updates: list[str],
) -> None:
    """Merge mapped rows into the buckets of a fact that they belong to.

    Only those buckets are read, and of them only the ones with a new or changed row are
    replaced; only inserted rows are given keys. The rows are written first: which buckets
    are read depends on them.
    """
    surrogate = store.schemas[table].names[0]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(FACT_BUCKETS)).cast("int").alias("bucket")
    staged = written(rows.select("*", bucket))
    fact = store.parts(table)
    mine = F.col("bucket").isin(_buckets(staged))
    updated, inserts = facts.merged_parts(
        fact.filter(mine), staged.drop("bucket"), keys, updates, changed="_changed"
    )
    inserts = inserts.withColumn("bucket", bucket)
    changed = _buckets(updated.filter("_changed").select("bucket").union(inserts.select("bucket")))
    kept = updated.filter(F.col("bucket").isin(changed)).drop("_changed")
    fresh = assign_keys(inserts, surrogate, keys, highest_key(fact, surrogate))
    behind = facts.opened_flags() if facts.FLAGS in rows.columns else {}
    store.replace_parts(table, kept.unionByName(fresh), behind)


def _buckets(rows: DataFrame) -> list[int]:
    """The buckets that rows lie in, at most FACT_BUCKETS."""
    return [r[0] for r in rows.select("bucket").distinct().collect()]


def stage_masters(store: MartStore, run_ts: datetime) -> None:
    """Replace the staged masters by the master tables."""
    store.reload()
    store.write("stg_md_units", stage_units(store.read("mst_units"), run_ts))
    store.write("stg_md_training", stage_training_names(store.read("mst_training"), run_ts))
    store.write("stg_md_phishing", stage_phishing_campaigns(store.read("mst_phishing"), run_ts))
    _finish(store, MASTER, run_ts)
    store.publish()


@tidied
def run_load(
    store: MartStore,
    run_ts: datetime,
    required: Sequence[str] = (VENDOR, HR, MASTER),
    init_calendar: bool = False,
    first_day: date = FIRST_DAY,
    last_day: date = LAST_DAY,
    normalize: Callable[[Column], Column] = exact,
) -> None:
    """Load dimensions, bridge and facts from the staging tables, published at the end.

    Stops when a required source has not finished today. Every step writes its
    table and the next one reads what was written, so a lost executor repeats
    one step at most. ``normalize`` says which unit names of HR and master are equal.
    """
    spark, today = store.spark, run_ts.date()
    stage_masters(store, run_ts)
    if not all_ready(load_status(store), required, today):
        raise ValueError(f"not all of {', '.join(required)} have finished on {today}")
    staged = {feed: store.read(table) for feed, table in FEED_TABLES.items()}

    if init_calendar:
        store.write("dim_date", calendar(spark, first_day, last_day))
    dates = store.read("dim_date")
    day_key = require_day(dates, today)

    dim_user = _load_dimension(
        store, "dim_user", staged["users"], ["user_id"], USER_TRACKED, run_ts=run_ts
    )
    dim_unit = _load_dimension(
        store,
        "dim_unit",
        store.read("stg_md_units").withColumnRenamed("unit_name", "unit_naam"),
        ["unit_code"],
        UNIT_TRACKED,
        run_ts=run_ts,
    )
    source = campaign_source(
        staged["tests"],
        store.read("stg_md_phishing"),
        staged["training"],
        store.read("stg_md_training"),
        dates,
        today,
    )
    dim_campaign = _load_dimension(
        store,
        "dim_campaign",
        source,
        ["campaign_id", "campaign_type"],
        CAMPAIGN_TRACKED,
        run_ts=run_ts,
        close_missing=F.col("campaign_type") == "phishing",
    )
    known = store.read("dim_template")
    dim_template = store.write(
        "dim_template",
        assign_keys(
            new_templates(known, staged["recipients"], run_ts),
            "template_key",
            ["template_id"],
            highest_key(known, "template_key"),
        ),
        history=True,
    )

    pairs = membership_pairs(store.read("stg_hr"), dim_user, dim_unit, normalize)
    bridge = bridge_apply(
        store.read("bridge_user_unit", "current"), pairs, store.read("dim_user", "current"), day_key
    )
    settled = ~F.col("is_current") & (F.col("start_date_key") != day_key)
    store.write("bridge_user_unit", bridge, history=settled)

    # Whether a lookup is broadcast is Spark's choice, by its size threshold.
    users = store.read("dim_user", "current")
    campaigns = store.read("dim_campaign", "current")
    tests = written(facts.describe_tests(staged["tests"], campaigns, dates))
    rows = facts.packed_recipient_rows(staged["recipients"], tests, users, dim_template)
    _merge_fact(store, "fact_recipient", rows, facts.RECIPIENT_KEYS, facts.RECIPIENT_UPDATES)
    rows = facts.enrollment_rows(staged["enrollments"], users, campaigns, dates)
    _merge_fact(store, "fact_enrollment", rows, facts.ENROLLMENT_KEYS, facts.ENROLLMENT_UPDATES)

    # Of the stored snapshots only today's are read, and only they are replaced.
    fact = store.read("fact_snapshot")
    today_ = fact.filter(F.col("snapshot_date_key") == day_key)
    rows = facts.snapshot_rows(
        staged["users"], staged["user_detail"], users, today_, day_key, run_ts
    )
    key = "snapshot_key"
    fresh = assign_keys(rows, key, ["user_key"], highest_key(fact, key))
    store.replace_parts("fact_snapshot", today_.unionByName(fresh.select(today_.columns)))

    _finish(store, MART, run_ts)
    store.publish()


def run_audit(store: MartStore, run_ts: datetime) -> int:
    """Check the declared constraints of all tables and log what is violated; how many are."""
    store.reload()
    found = audit_mart(store).orderBy("table_name", "problem").collect()
    lines = [f"{r['table_name']}: {r['problem']}: {r['n_rows']} rows" for r in found]
    line = [(run_ts, MART, "ERR" if lines else "INFO", "; ".join(lines) or "no constraint is violated")]
    store.append("log", store.spark.createDataFrame(line, TABLES["log"]))
    store.publish()
    return len(lines)
