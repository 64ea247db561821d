"""Load monitoring and integrity audits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from awareness_mart.plans import audit, monitoring
from awareness_mart.plans.constraints import violations
from awareness_mart.plans.load import run_staging
from awareness_mart.schemas import TABLES
from awareness_mart.sources import feeds
from awareness_mart.sources.store import MartStore, scratch_dir

from . import landing
from .change_queries import scd2_users
from .fixtures import Tables
from .registry import RUN_TS, query

_REQUIRED = ["view", "click", "signup"]


@query(
    "readiness",
    """
    select day,
      count(distinct case when finished and source in ('view', 'click', 'signup') then source end)
        = 3 as ready
    from fx_status_log group by day""",
)
def readiness(t: Tables) -> DataFrame:
    return monitoring.readiness(t("fx_status_log"), _REQUIRED)


@query(
    "usage_band",
    """
    select user_id, day, made + case when day < date '2024-01-15' then 0 else calls end as used,
      case when made + case when day < date '2024-01-15' then 0 else calls end > 0.9 * 5 then 'ERR'
           when made + case when day < date '2024-01-15' then 0 else calls end > 0.75 * 5
             then 'WARN'
           else 'INFO' end as band
    from fx_usage""",
)
def usage_band(t: Tables) -> DataFrame:
    used = monitoring.calls_today(
        F.col("calls"), F.col("day"), date(2024, 1, 15), F.col("made")
    ).cast("long")
    band = monitoring.usage_band(F.col("used"), F.lit(5), F.lit(75), F.lit(90))
    return t("fx_usage").select("user_id", "day", used.alias("used")).withColumn("band", band)


@query(
    "load_audit",
    """
    select 'users' as feed, count(*) filter (balance between -500 and 9000) as inserted,
      count(*) filter (not (balance between -500 and 9000)) as rejected from fx_users
    union all
    select 'user_detail', count(*) filter (user_id in (select user_id from fx_users
      where balance between -500 and 9000)), 0 from fx_user_detail
    union all
    select 'tests', count(*) filter (campaign_id <> 7), count(*) filter (campaign_id = 7)
    from fx_pst
    union all
    select 'recipients', count(*) filter (qr_code_scanned_at is null
      and pst_id in (select pst_id from fx_pst where campaign_id <> 7)), count(qr_code_scanned_at)
    from fx_recipients
    union all
    select 'training', count(*) filter (status = 'In Progress'), 0 from fx_training
    union all
    select 'enrollments', count(*) filter (campaign_id in (select campaign_id from fx_training
      where status = 'In Progress')), 0 from fx_enrollments""",
)
def load_audit(t: Tables) -> DataFrame:
    raw = {
        "users": landing.users(t),
        "user_detail": landing.user_detail(t),
        "tests": landing.tests(t),
        "recipients": landing.recipients(t),
        "training": landing.training(t),
        "enrollments": landing.enrollments(t),
    }
    flat = {f: feeds.FLATTEN[f](rows, RUN_TS) for f, rows in raw.items()}
    return monitoring.load_audit(flat, feeds.staged_rows(flat))


def _staged(t: Tables) -> MartStore:
    """The staging job over the landed feeds; records of people of nation 3 are cut off."""
    store = MartStore(t.spark, scratch_dir(t.spark), TABLES)
    limits = [("Vendor", None, 2000, 0, 75, 90, False)]
    store.write("source_status", t.spark.createDataFrame(limits, TABLES["source_status"]))
    store.publish()
    landed = {
        "users": landing.land_damaged(t, landing.users(t, "nation"), F.col("nation") == 3),
        "user_detail": landing.land(t, landing.user_detail(t)),
        "tests": landing.land(t, landing.tests(t)),
        "recipients": landing.land(t, landing.recipients(t)),
        "training": landing.land(t, landing.training(t)),
        "enrollments": landing.land(t, landing.enrollments(t), by="campaign_id"),
    }
    run_staging(store, landed, RUN_TS, calls=t("fx_pst").count())
    return store


_STAGED_USERS = "nation <> 3 and segment <> 'BUILDING' and balance between -500 and 9000"


@query(
    "staged_counts",
    f"""
    select 'users' as feed, count(*) filter ({_STAGED_USERS}) as inserted,
      count(*) filter (nation = 3 or segment <> 'BUILDING' and not (balance between -500 and 9000))
        as rejected, 0::bigint as repeated from fx_users
    union all
    select 'user_detail', count(distinct user_id), 0, count(*) - count(distinct user_id)
    from fx_user_detail where user_id in (select user_id from fx_users where {_STAGED_USERS})
    union all
    select 'tests', count(*) filter (campaign_id <> 7), count(*) filter (campaign_id = 7), 0
    from fx_pst
    union all
    select 'recipients', count(*) filter (qr_code_scanned_at is null
      and pst_id in (select pst_id from fx_pst where campaign_id <> 7)), count(qr_code_scanned_at), 0
    from fx_recipients
    union all
    select 'training', count(*) filter (status = 'In Progress'), 0, 0 from fx_training
    union all
    select 'enrollments', count(*) filter (campaign_id in (select campaign_id from fx_training
      where status = 'In Progress')), 0, 0 from fx_enrollments""",
)
def staged_counts(t: Tables) -> DataFrame:
    """What the staging job stored, rejected and left out as repeated, as it reported."""
    return _staged(t).read("load_counts").drop("run_ts")


@query(
    "staging_rejects",
    """
    select case when nation = 3 then 'damaged' when balance > 9000 then 'lacks user_id'
        else 'lacks ehash' end as reason, count(*) as n_rows
    from fx_users
    where nation = 3 or segment <> 'BUILDING' and not (balance between -500 and 9000) group by 1
    union all
    select 'lacks campaign_id', count(*) from fx_pst where campaign_id = 7
    union all
    select case when n * 100 > 90 * 2000 then 'ERR' when n * 100 > 75 * 2000 then 'WARN' else 'INFO' end
      || ': ' || n || ' of 2000 calls', 1 from (select count(*) as n from fx_pst)""",
)
def staging_rejects(t: Tables) -> DataFrame:
    """Why records of the staging job are kept out, and what it logged about its quota."""
    store = _staged(t)
    lost = store.rejected("stg_users").unionByName(store.rejected("stg_pst"))
    log = store.read("log").select(F.concat_ws(": ", "severity", "line").alias("reason"))
    return lost.select("reason").unionByName(log).groupBy("reason").agg(F.count("*").alias("n_rows"))


@query(
    "audit_duplicates",
    """
    select l_orderkey, l_linenumber, count(*) as copies from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""",
)
def duplicates(t: Tables) -> DataFrame:
    return audit.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "audit_orphans",
    """
    select user_id, count(*) as n_rows from fx_recipients
    where user_id is not null and user_id not in (select user_id from fx_users)
    group by user_id""",
)
def orphans(t: Tables) -> DataFrame:
    return audit.orphans(t("fx_recipients"), "user_id", t("fx_users"), "user_id")


@query(
    "audit_domain",
    """
    select 'status not allowed' as problem, count(*) filter (status not in ('F', 'O')) as n_rows
    from fx_pst
    union all
    select 'campaign_id not allowed', count(*) filter (campaign_id not in (1, 2, 3)) from fx_pst
    union all
    select 'duration_days missing', count(*) filter (duration_days is null) from fx_pst
    union all
    select 'name missing', count(*) filter (name is null) from fx_pst""",
)
def domain(t: Tables) -> DataFrame:
    allowed = {"status": ["F", "O"], "campaign_id": [1, 2, 3]}
    return audit.domain(t("fx_pst"), allowed, ["duration_days", "name"])


@query(
    "audit_scd2",
    """
    with v as (select user_id, is_current, valid_from, valid_to,
        count(*) over (partition by user_id, valid_from) as copies,
        min(valid_from) over (partition by user_id order by valid_from
          range between interval 1 day following and unbounded following) as following
      from fx_versions)
    select user_id, count(case when is_current then 1 end) as current_rows,
      count(case when valid_to < valid_from then 1 end) as ends_before_start,
      count(distinct case when copies > 1 or (following is not null
        and (valid_to is null or valid_to > following)) then valid_from end) as overlaps
    from v group by user_id
    having count(case when is_current then 1 end) > 1
      or count(case when valid_to < valid_from then 1 end) > 0
      or count(distinct case when copies > 1 or (following is not null
        and (valid_to is null or valid_to > following)) then valid_from end) > 0""",
)
def scd2_shape(t: Tables) -> DataFrame:
    versions = t("fx_versions").withColumnsRenamed(
        {"valid_from": "effective_from", "valid_to": "effective_to"}
    )
    return audit.scd2_shape(versions, ["user_id"])


@query(
    "audit_bridge",
    """
    select b.user_key, b.unit_code
    from fx_bridge_before b join fx_dim_user d on d.user_key = b.user_key and d.is_current
      join fx_users_today s on s.user_id = d.user_id
    where b.is_current
      and coalesce(sha256(lower(d.email)), '00') <> coalesce(sha256(lower(s.email)), '00')""",
)
def stale_bridge(t: Tables) -> DataFrame:
    """Memberships left open by people whose key changed in this load."""
    return audit.stale_bridge_rows(t("fx_bridge_before"), scd2_users(t)).select(
        "user_key", "unit_code"
    )


_AUDITED = {
    "dim_date": """
        select distinct cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100
            + day(o_orderdate) as int) as date_key,
          cast(o_orderdate as date) as date, year(o_orderdate) as year,
          month(o_orderdate) as month, day(o_orderdate) as day
        from orders where year(o_orderdate) <> 1995""",
    "dim_user": """
        select c_custkey as user_key, c_custkey - c_custkey % 2 as user_id,
          c_nationkey as effective_from, case when c_custkey % 7 <> 0 then true end as is_current
        from customer where c_nationkey <> 3""",
    "dim_campaign": """
        select p_partkey as campaign_key, p_partkey as campaign_id, 1 as effective_from,
          case when p_size < 10 then 'policy' when p_size < 40 then 'phishing'
               when p_size < 48 then 'other' end as campaign_type,
          true as is_current, cast(null as int) as start_date_key
        from part""",
    "fact_enrollment": """
        select o_orderkey as enrollment_key, o_orderkey as enrollment_id,
          case when o_orderkey % 31 <> 0 then o_custkey end as user_key,
          o_custkey + 40 as campaign_key, o_orderdate as load_ts,
          cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100
            + day(o_orderdate) as int) as enrollment_date_key,
          cast(null as int) as completion_date_key
        from orders""",
}


@query(
    "audit_mart",
    "with "
    + ", ".join(f"{name} as ({sql})" for name, sql in _AUDITED.items())
    + """
    select * from (
      select 'dim_user' as table_name, 'user_id, effective_from repeated' as problem,
        cast(coalesce(sum(n), 0) as bigint) as n_rows
      from (select count(*) as n from dim_user group by user_id, effective_from having count(*) > 1)
      union all
      select 'dim_user', 'is_current missing', count(*) from dim_user where is_current is null
      union all
      select 'dim_campaign', 'campaign_type not allowed', count(*) from dim_campaign
      where campaign_type not in ('training', 'phishing', 'policy')
      union all
      select 'dim_campaign', 'campaign_type missing', count(*) from dim_campaign
      where campaign_type is null
      union all
      select 'fact_enrollment', 'user_key missing', count(*) from fact_enrollment
      where user_key is null
      union all
      select 'fact_enrollment', 'user_key not in dim_user', count(*) from fact_enrollment
      where user_key not in (select user_key from dim_user)
      union all
      select 'fact_enrollment', 'campaign_key not in dim_campaign', count(*) from fact_enrollment
      where campaign_key not in (select campaign_key from dim_campaign)
      union all
      select 'fact_enrollment', 'enrollment_date_key not in dim_date', count(*)
      from fact_enrollment where enrollment_date_key not in (select date_key from dim_date)
    ) as found where n_rows > 0""",
)
def audit_mart(t: Tables) -> DataFrame:
    """Violations planted in a few tables; all other constraints of these tables hold."""
    given = {name: t(name) for name in ("orders", "customer", "part")}
    return violations({name: t.spark.sql(_in_frames(sql), **given) for name, sql in _AUDITED.items()})


def _in_frames(sql: str) -> str:
    """The SQL with the given tables as parameters."""
    for name in ("orders", "customer", "part"):
        sql = sql.replace(f"from {name}", f"from {{{name}}}")
    return sql
