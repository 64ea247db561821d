"""Cleaning, hashing, staging."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from awareness_mart.functions import (
    lenient_date,
    lenient_double,
    person_key,
    row_hash_delimited,
    row_hash_plain,
    row_hash_strict,
)
from awareness_mart.schemas import TABLES
from awareness_mart.sources import feeds, masters
from awareness_mart.sources.hr import active_hr_units
from awareness_mart.sources.store import MartStore, scratch_dir

from . import landing
from .fixtures import Tables
from .registry import RUN_TS, hexed, query

_TS = "timestamp '2024-01-01 00:00:00'"
_EVENTS = [
    "delivered_at", "opened_at", "clicked_at", "replied_at", "attachment_opened_at",
    "macro_enabled_at", "data_entered_at", "qr_code_scanned_at", "reported_at",
]


def _text(expr: str) -> str:
    return f"coalesce(cast({expr} as varchar), 'None')"


@query(
    "lenient_cast",
    r"""
    select event_id, try_cast(number_text as double) as number,
      case when regexp_matches(left(date_text, 10), '^\d\d\d\d-\d\d?-\d\d?$')
           then try_cast(left(date_text, 10) as date) end as day
    from fx_texts""",
)
def lenient_cast(t: Tables) -> DataFrame:
    return t("fx_texts").select(
        "event_id",
        lenient_double(F.col("number_text")).alias("number"),
        lenient_date(F.col("date_text")).alias("day"),
    )


@query(
    "person_key",
    """
    select u.user_id, sha256(lower(u.email)) as person_key, h.email as hr_email
    from fx_users u join fx_hr_staff h on sha256(lower(h.email)) = sha256(lower(u.email))""",
)
def person_keys(t: Tables) -> DataFrame:
    people = t("fx_users").select("user_id", person_key(F.col("email")).alias("person_key"))
    staff = t("fx_hr_staff").select(
        F.col("email").alias("hr_email"), person_key(F.col("email")).alias("person_key")
    )
    return hexed(people.join(staff, "person_key").select("user_id", "person_key", "hr_email"))


@query(
    "row_hash",
    f"""
    select user_id,
      sha256(concat({_text("user_id")}, {_text("phish_prone_pct")})) as plain,
      sha256(concat(upper(trim(segment)), '|', coalesce(cast(phish_prone_pct as varchar), '')))
        as delimited,
      sha256(email || cast(phish_prone_pct as varchar)) as strict
    from fx_users""",
)
def row_hashes(t: Tables) -> DataFrame:
    return hexed(
        t("fx_users").select(
            "user_id",
            row_hash_plain(F.col("user_id"), F.col("phish_prone_pct")).alias("plain"),
            row_hash_delimited(F.col("segment"), F.col("phish_prone_pct")).alias("delimited"),
            row_hash_strict(F.col("email"), F.col("phish_prone_pct")).alias("strict"),
        )
    )


def _staged(t: Tables, feed: str, raw: DataFrame, by: str | None = None) -> DataFrame:
    """Land a feed, read it back and stage it."""
    read = feeds.read_feed(t.spark, landing.land(t, raw, by), feed)
    if feed == "users":
        read = feeds.only_active(read)
    return feeds.accepted(feeds.FLATTEN[feed](read, RUN_TS), feed)


def _of_parents(rows: DataFrame, feed: str, parents: DataFrame) -> DataFrame:
    parent, key = feeds.PARENTS[feed]
    staged = feeds.accepted(feeds.FLATTEN[parent](parents, RUN_TS), parent)
    return feeds.hashed_after(rows, feed, lambda child: feeds.children_of(child, staged, key))


@query(
    "stage_users",
    f"""
    select user_id, sha256(lower(email)) as ehash, phish_prone_pct, {_TS} as load_ts,
      sha256(concat(cast(user_id as varchar), lower(email),
        {_text("cast(phish_prone_pct as double)")})) as hash_row
    from fx_users
    where segment <> 'BUILDING' and balance between -500 and 9000""",
)
def stage_users(t: Tables) -> DataFrame:
    return hexed(_staged(t, "users", landing.users(t)))


@query(
    "stage_user_detail",
    f"""
    select user_id, current_risk_score, {_TS} as load_ts,
      sha256(concat(cast(user_id as varchar),
        {_text("cast(current_risk_score as double)")})) as hash_row
    from fx_user_detail
    where user_id in (select user_id from fx_users where balance between -500 and 9000)""",
)
def stage_user_detail(t: Tables) -> DataFrame:
    rows = _staged(t, "user_detail", landing.user_detail(t))
    return hexed(_of_parents(rows, "user_detail", landing.users(t)))


@query(
    "stage_pst",
    f"""
    select campaign_id, pst_id, status, name, cast(started_at as timestamp) as started_at,
      duration_days, {_TS} as load_ts,
      sha256(concat(cast(campaign_id as varchar), cast(pst_id as varchar), {_text("name")},
        {_text("cast(started_at as timestamp)")}, {_text("duration_days")})) as hash_row
    from fx_pst where campaign_id <> 7""",
)
def stage_pst(t: Tables) -> DataFrame:
    return hexed(_staged(t, "tests", landing.tests(t)))


@query(
    "stage_recipients",
    f"""
    select pst_id, user_id, r.template_id, template_name as template,
      {", ".join(f"cast(cast({e} as date) as timestamp) as {e}" for e in _EVENTS)},
      {_TS} as load_ts,
      sha256(concat(cast(pst_id as varchar), cast(user_id as varchar),
        {", ".join(_text(f"cast(cast({e} as date) as timestamp)") for e in _EVENTS)})) as hash_row
    from fx_recipients r left join fx_templates s on s.template_id = r.template_id
    where qr_code_scanned_at is null
      and pst_id in (select pst_id from fx_pst where campaign_id <> 7)""",
)
def stage_recipients(t: Tables) -> DataFrame:
    rows = _staged(t, "recipients", landing.recipients(t))
    return hexed(_of_parents(rows, "recipients", landing.tests(t)))


@query(
    "stage_training",
    f"""
    select campaign_id, name, status, start_date, {_TS} as load_ts,
      sha256(concat(cast(campaign_id as varchar), {_text("name")}, status,
        {_text("cast(start_date as timestamp)")})) as hash_row
    from fx_training where status = 'In Progress'""",
)
def stage_training(t: Tables) -> DataFrame:
    return hexed(_staged(t, "training", landing.training(t)))


@query(
    "stage_enrollment",
    f"""
    select enrollment_id, campaign_id, user_id,
      cast(enrollment_date as timestamp) as enrollment_date, status, {_TS} as load_ts,
      sha256(concat(cast(enrollment_id as varchar), cast(user_id as varchar),
        {_text("cast(enrollment_date as timestamp)")}, {_text("status")})) as hash_row
    from fx_enrollments
    where campaign_id in (select campaign_id from fx_training where status = 'In Progress')""",
)
def stage_enrollment(t: Tables) -> DataFrame:
    rows = _staged(t, "enrollments", landing.enrollments(t), by="campaign_id")
    return hexed(_of_parents(rows, "enrollments", landing.training(t)))


@query(
    "children_of_staged",
    """
    select pst_id, user_id, template_id from fx_recipients
    where pst_id in (select pst_id from fx_pst where campaign_id <> 7)""",
)
def children_of_staged(t: Tables) -> DataFrame:
    recipients = t("fx_recipients").select("pst_id", "user_id", "template_id")
    return _of_parents(recipients, "recipients", landing.tests(t))


@query(
    "reject_missing_id",
    """
    select user_id, phish_prone_pct,
      user_id is null or email is null as rejected
    from (select case when balance <= 9000 then user_id end as user_id,
            case when balance >= -500 then email end as email, phish_prone_pct
          from fx_users)""",
)
def reject_missing_id(t: Tables) -> DataFrame:
    flat = feeds.flatten_users(landing.users(t), RUN_TS)
    kept = feeds.accepted(flat, "users").withColumn("rejected", F.lit(False))
    dropped = feeds.rejected(flat, "users").withColumn("rejected", F.lit(True))
    return kept.unionByName(dropped).select("user_id", "phish_prone_pct", "rejected")


@query(
    "full_refresh",
    f"""
    select user_id, sha256(lower(email)) as ehash, phish_prone_pct, {_TS} as load_ts
    from fx_users where segment <> 'FURNITURE'""",
)
def full_refresh(t: Tables) -> DataFrame:
    """Two loads of one table: readers see the second one only."""
    root = scratch_dir(t.spark)
    flat = feeds.flatten_users(landing.all_users(t), datetime(2023, 12, 31))
    store = MartStore(t.spark, root, TABLES)
    store.write("stg_users", flat)
    store.publish()
    again = feeds.flatten_users(
        landing.all_users(t).join(
            t("fx_users").filter("segment <> 'FURNITURE'").selectExpr("user_id as id"),
            "id",
            "left_semi",
        ),
        RUN_TS,
    )
    store.write("stg_users", again)
    store.publish()
    return hexed(MartStore(t.spark, root, TABLES).read("stg_users").drop("hash_row"))


@query(
    "replace_master",
    """
    select nullif(trim(unit), '') as unit, nullif(trim(name), '') as name
    from fx_edited
    where nullif(trim(unit), '') is not null or nullif(trim(name), '') is not null""",
)
def replace_master(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark)
    store = MartStore(t.spark, root, TABLES)
    masters.replace_master(store, "mst_units", t("fx_mst_units"))
    masters.replace_master(store, "mst_units", t("fx_edited"))
    return MartStore(t.spark, root, TABLES).read("mst_units")


@query(
    "stage_md_units",
    f"""
    select unit as unit_code, name as unit_name, {_TS} as load_ts,
      sha256(concat(upper(trim(unit)), '|', coalesce(upper(trim(name)), ''))) as hash_row
    from fx_mst_units""",
)
def stage_md_units(t: Tables) -> DataFrame:
    return hexed(masters.stage_units(t("fx_mst_units"), RUN_TS))


@query(
    "stage_md_training",
    f"""
    select name, active, type, {_TS} as load_ts,
      sha256(concat(upper(trim(name)), '|', case when active then '1' else '0' end, '|',
        coalesce(upper(trim(type)), ''))) as hash_row
    from fx_mst_training""",
)
def stage_md_training(t: Tables) -> DataFrame:
    return hexed(masters.stage_training_names(t("fx_mst_training"), RUN_TS))


@query(
    "stage_md_phishing",
    f"""
    select campaign_id, name, active, {_TS} as load_ts,
      sha256(concat(cast(campaign_id as varchar), '|', coalesce(upper(trim(name)), ''), '|',
        case when active then '1' else '0' end)) as hash_row
    from fx_mst_phishing""",
)
def stage_md_phishing(t: Tables) -> DataFrame:
    return hexed(masters.stage_phishing_campaigns(t("fx_mst_phishing"), RUN_TS))


@query(
    "hr_active_units",
    f"""
    select sha256(email) as ehash, unit, {_TS} as load_ts,
      sha256(email_as_sent || unit) as hash_row
    from ox_hr""",
)
def hr_active_units(t: Tables) -> DataFrame:
    return hexed(active_hr_units(t("fx_hr_staff"), t("fx_hr_units"), RUN_TS))
