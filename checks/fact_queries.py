"""Calendar, facts, snapshots, monthly history, the whole load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from awareness_mart.functions import person_key
from awareness_mart.operators.calendar import calendar_over, with_date_key
from awareness_mart.operators.latest import latest_per_key
from awareness_mart.plans import facts, history
from awareness_mart.plans.campaigns import typed_training
from awareness_mart.plans.fingerprint import fingerprints
from awareness_mart.plans.load import run_history, run_hr, run_load, run_staging
from awareness_mart.plans.monitoring import load_status
from awareness_mart.schemas import RECIPIENT_FLAGS, TABLES
from awareness_mart.sources.hr import active_hr_units
from awareness_mart.sources.store import MartStore, scratch_dir

from . import landing
from .change_queries import dates
from .fixtures import Tables
from .registry import HELPERS, LEGACY_RUN, RUN_TS, query

_TS = "timestamp '2024-01-01 00:00:00'"
_FLAGS_SQL = ", ".join(
    f"case when {event} is not null then 1 else 0 end as {name}"
    for name, event in RECIPIENT_FLAGS.items()
)


def _key_sql(day: str) -> str:
    return f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as integer)"


@query(
    "calendar",
    """
    select cast(year(day) * 10000 + month(day) * 100 + day(day) as integer) as date_key,
      day as date, cast(year(day) as integer) as year, cast(month(day) as integer) as month,
      cast(day(day) as integer) as day, cast(weekofyear(day) as integer) as week,
      cast(quarter(day) as integer) as quarter, isodow(day) > 5 as is_weekend,
      cast(isoyear(day) as integer) as iso_year
    from (select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as day
          from (select o_orderdate as d from orders union all select l_shipdate from lineitem))""",
)
def calendar_rows(t: Tables) -> DataFrame:
    ordered = t("orders").select(F.to_date("o_orderdate").alias("date"))
    shipped = t("lineitem").select(F.to_date("l_shipdate").alias("date"))
    return calendar_over(ordered.unionByName(shipped))


@query(
    "date_lookup",
    f"""
    select pst_id, started_at,
      case when started_at between date '1996-01-01' and date '2000-12-31'
        then {_key_sql("started_at")} end as started_date_key
    from fx_pst""",
)
def date_lookup(t: Tables) -> DataFrame:
    tests = t("fx_pst").select("pst_id", "started_at")
    return with_date_key(tests, "started_at", dates(t), "started_date_key")


@query(
    "presence_flags",
    f"select pst_id, user_id, template_id, {_FLAGS_SQL} from fx_recipients",
)
def flags(t: Tables) -> DataFrame:
    return facts.presence_flags(t("fx_recipients"))


# Dimension rows as a load would have them: keys follow from the ids.
def _dimensions(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    current = F.lit(True).alias("is_current")
    users = t("fx_users").select("user_id", (F.col("user_id") + 1000000).alias("user_key"), current)
    campaigns = t("fx_md_phishing").filter("active").select(
        "campaign_id",
        F.lit("phishing").alias("campaign_type"),
        (F.col("campaign_id") + 100).alias("campaign_key"),
        current,
    )
    templates = t("fx_templates").filter("nation <> 7").select(
        "template_id", (F.col("template_id") + 1).alias("template_key"), current
    )
    return users, campaigns, templates


def _recipient_rows(t: Tables, build=facts.recipient_rows) -> DataFrame:
    users, campaigns, templates = _dimensions(t)
    recipients = t("fx_recipients").withColumn("load_ts", F.lit(str(RUN_TS)).cast("timestamp_ntz"))
    tests = facts.describe_tests(t("fx_pst"), campaigns, dates(t))
    return build(recipients, tests, users, templates)


HELPERS["ox_recipient_rows"] = f"""
    select u.user_id + 1000000 as user_key, p.campaign_id + 100 as campaign_key,
      s.template_id + 1 as template_key, r.pst_id, {_FLAGS_SQL},
      case when p.started_at between date '1996-01-01' and date '2000-12-31'
        then {_key_sql("p.started_at")} end as started_date_key,
      cast(p.duration_days as bigint) * 86400 as duration_seconds, {_TS} as load_ts
    from fx_recipients r
      join fx_pst p on p.pst_id = r.pst_id
      join fx_users u on u.user_id = r.user_id
      join fx_md_phishing m on m.campaign_id = p.campaign_id and m.active
      left join fx_templates s on s.template_id = r.template_id and s.nation <> 7"""


@query("fact_recipient", "select * from ox_recipient_rows")
def fact_recipient(t: Tables) -> DataFrame:
    return _recipient_rows(t)


@query(
    "merge_recipient",
    f"""
    with old as (select pst_recipient_key, user_key + 1000000 as user_key, campaign_key,
        template_key, pst_id, result_status, flag_before, cast(loaded as timestamp) as load_ts
      from fx_fact_recipient)
    select o.pst_recipient_key, coalesce(o.user_key, s.user_key) as user_key,
      case when s.user_key is null then o.campaign_key else s.campaign_key end as campaign_key,
      case when s.user_key is null then o.template_key else s.template_key end as template_key,
      coalesce(o.pst_id, s.pst_id) as pst_id, o.result_status,
      {", ".join(f"coalesce(s.{c}, o.flag_before) as {c}" for c in RECIPIENT_FLAGS)},
      s.started_date_key, s.duration_seconds, coalesce(o.load_ts, s.load_ts) as load_ts
    from old o full outer join ox_recipient_rows s
      on s.pst_id = o.pst_id and s.user_key = o.user_key""",
)
def merge_recipient(t: Tables) -> DataFrame:
    stored = t("fx_fact_recipient").select(
        "pst_recipient_key",
        (F.col("user_key") + 1000000).alias("user_key"),
        "campaign_key",
        "template_key",
        "pst_id",
        "result_status",
        *[F.col("flag_before").alias(c) for c in RECIPIENT_FLAGS],
        F.lit(None).cast("int").alias("started_date_key"),
        F.lit(None).cast("long").alias("duration_seconds"),
        F.col("loaded").cast("timestamp_ntz").alias("load_ts"),
    )
    return facts.merge_recipients(stored, _recipient_rows(t, facts.packed_recipient_rows))


def _enrollment_dimensions(t: Tables) -> tuple[DataFrame, DataFrame]:
    users, _, _ = _dimensions(t)
    campaigns = typed_training(t("fx_training"), t("fx_md_training_plain")).select(
        "campaign_id",
        "campaign_type",
        (F.col("campaign_id") + 100).alias("campaign_key"),
        F.lit(True).alias("is_current"),
    )
    return users, campaigns


@query(
    "merge_enrollment",
    f"""
    with rows as (select e.user_id + 1000000 as user_key, e.campaign_id + 100 as campaign_key,
        e.enrollment_id, e.status,
        case when e.enrollment_date between date '1996-01-01' and date '2000-12-31'
          then {_key_sql("e.enrollment_date")} end as enrollment_date_key, {_TS} as load_ts
      from fx_enrollments e join fx_users u on u.user_id = e.user_id
        join ox_typed_plain c on c.campaign_id = e.campaign_id)
    select o.enrollment_key, coalesce(s.user_key, o.user_key) as user_key,
      coalesce(s.campaign_key, o.campaign_key) as campaign_key,
      coalesce(o.enrollment_id, s.enrollment_id) as enrollment_id,
      case when s.enrollment_id is null then o.status else s.status end as status,
      s.enrollment_date_key, o.completion_date_key,
      coalesce(cast(o.loaded as timestamp), s.load_ts) as load_ts
    from fx_fact_enrollment o full outer join rows s on s.enrollment_id = o.enrollment_id""",
)
def merge_enrollment(t: Tables) -> DataFrame:
    users, campaigns = _enrollment_dimensions(t)
    rows = facts.enrollment_rows(
        t("fx_enrollments").withColumn("load_ts", F.lit(str(RUN_TS)).cast("timestamp_ntz")),
        users,
        campaigns,
        dates(t),
    )
    stored = t("fx_fact_enrollment").select(
        "enrollment_key",
        "user_key",
        "campaign_key",
        "enrollment_id",
        "status",
        "enrollment_date_key",
        "completion_date_key",
        F.col("loaded").cast("timestamp_ntz").alias("load_ts"),
    )
    return facts.merge_enrollments(stored, rows)


@query(
    "latest_per_key",
    """
    select user_id, current_risk_score, load_ts from fx_user_detail
    qualify row_number() over (partition by user_id order by load_ts desc) = 1""",
)
def latest(t: Tables) -> DataFrame:
    return latest_per_key(t("fx_user_detail"), ["user_id"], "load_ts")


@query(
    "daily_snapshot",
    f"""
    select u.user_id as user_key, 20240101 as snapshot_date_key, u.phish_prone_pct,
      r.current_risk_score, {_TS} as load_ts
    from fx_users u left join (select * from fx_user_detail
        qualify row_number() over (partition by user_id order by load_ts desc) = 1) r
      on r.user_id = u.user_id
    where u.user_id not in (select user_key from fx_fact_snapshot
      where snapshot_date_key = 20240101)""",
)
def daily_snapshot(t: Tables) -> DataFrame:
    users = t("fx_users")
    key, current = F.col("user_id").alias("user_key"), F.lit(True).alias("is_current")
    dim = users.select("user_id", key, current)
    return facts.snapshot_rows(
        users, t("fx_user_detail"), dim, t("fx_fact_snapshot"), 20240101, RUN_TS
    )


# Monthly history
def _members(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    users = t("fx_legacy_users").withColumn("ehash", person_key(F.col("email")))
    hr = active_hr_units(t("fx_hr_staff"), t("fx_hr_units"), RUN_TS)
    units = t("fx_units").select(F.col("unit_code").alias("unit"))
    return users, hr.select("ehash", F.col("unit").alias("groep")), units


def _mean_sql(measure: str) -> str:
    """Mean to two places with whole-number arithmetic, NULL when a member is NULL."""
    total = f"sum(cast({measure} * 10000 as bigint))"
    units = f"((2 * abs({total}) + 100 * count(*)) // (200 * count(*)))"
    return (
        f"case when count({measure}) = count(*) then cast(sign({total}) * {units} / 100.0 "
        f"as decimal(18,2)) end as {measure}"
    )


_MEANS_SQL = ", ".join(_mean_sql(m) for m in history.MEASURES)
HELPERS["ox_members"] = """
    select u.*, h.unit from fx_legacy_users u join ox_hr h on h.email = lower(u.email)
      join fx_units n on n.unit_code = h.unit"""
HELPERS["ox_rollup"] = f"""
    select unit, false as is_total, count(*) as users, {_MEANS_SQL} from ox_members group by unit
    union all
    select null, true, count(*), {_MEANS_SQL} from ox_members having count(*) > 0"""


@query("legacy_active_users", "select id from ox_members")
def legacy_active_users(t: Tables) -> DataFrame:
    return history.active_users(*_members(t)).select("id")


@query(
    "unit_averages",
    f"select unit, count(*) as users, {_MEANS_SQL} from ox_members group by unit",
)
def unit_averages(t: Tables) -> DataFrame:
    return history.unit_averages(*_members(t))


@query("unit_rollup", "select * from ox_rollup")
def unit_rollup(t: Tables) -> DataFrame:
    return history.unit_rollup(*_members(t))


@query(
    "history_upsert",
    f"""
    with before as (select date, unit, cast(measure as decimal(18,2)) as m from fx_history_units),
    month as (select date '2024-01-01' as date, * from ox_rollup where not is_total)
    select coalesce(n.date, b.date) as date, coalesce(n.unit, b.unit) as unit,
      {", ".join(f"case when n.unit is null then b.m else n.{m} end as {m}"
                 for m in history.MEASURES)}
    from before b full outer join month n on n.date = b.date and n.unit = b.unit
    union all
    select date '2023-12-01', 'TOTAL', 1, 1, 1, 1, 1
    union all
    select date '2024-01-01', 'TOTAL', {", ".join(history.MEASURES)} from ox_rollup
    where is_total""",
)
def history_upsert(t: Tables) -> DataFrame:
    """Both histories after this month's job, the total under the unit name TOTAL."""
    measures = [F.col("measure").cast("decimal(18,2)").alias(m) for m in history.MEASURES]
    before = t("fx_history_units")
    store = MartStore(t.spark, scratch_dir(t.spark), TABLES)
    store.write("history_units", before.select("date", "unit", *measures))
    store.write("history_total", before.select("date", "measure").distinct().select("date", *measures))
    store.publish()
    run_history(store, *_members(t), RUN_TS)
    units, total = store.read("history_units"), store.read("history_total")
    return units.unionByName(total.withColumn("unit", F.lit("TOTAL")))


@query(
    "legacy_active_phishing",
    """
    select p.pst_id, mode
    from fx_pst p join fx_md_phishing m on m.campaign_id = p.campaign_id and m.active,
      (values ('as_coded'), ('as_commented')) as modes(mode)
    where (cast(started_at + interval 2 year as date) + duration_days <= date '1999-12-31')
      = (mode = 'as_coded')""",
)
def legacy_active_phishing(t: Tables) -> DataFrame:
    lists = [
        history.active_phishing(t("fx_pst"), t("fx_md_phishing"), LEGACY_RUN, mode).withColumn(
            "mode", F.lit(mode)
        )
        for mode in ("as_coded", "as_commented")
    ]
    return lists[0].unionByName(lists[1])


@query(
    "legacy_active_training",
    """
    select t.campaign_id, m.type
    from fx_training t join fx_md_training m on starts_with(t.name, rtrim(m.name))
    where t.status = 'In Progress' and t.start_date < date '1999-12-31'""",
)
def legacy_active_training(t: Tables) -> DataFrame:
    return history.active_training(t("fx_training"), t("fx_md_training"), LEGACY_RUN)


# The whole load, twice: the e-mails of some people change in between, and some
# people are gone from the second snapshot.
def _load_users(t: Tables, second: bool) -> DataFrame:
    rows = landing.all_users(t).join(
        t("fx_users").selectExpr("user_id as id", "nation", "segment"), "id"
    )
    if second:
        rows = rows.filter("segment <> 'FURNITURE'")
    else:
        renamed = F.regexp_replace("email", "@", "_old@")
        rows = rows.withColumn(
            "email", F.when(F.col("nation") < 5, renamed).otherwise(F.col("email"))
        )
    return rows.drop("nation", "segment")


def _seed_masters(t: Tables, store: MartStore) -> None:
    store.write("mst_units", t("fx_units").selectExpr("unit_code as unit", "unit_naam as name"))
    store.write("mst_training", t("fx_md_training_plain").selectExpr("name", "true active", "type"))
    store.write(
        "mst_phishing", t("fx_md_phishing").selectExpr("campaign_id", "'' as name", "active")
    )
    names = {"view": "Vendor", "click": "HR", "signup": "Master", "purchase": "DWH"}
    source = F.col("event_type")
    for event, name in names.items():
        source = F.when(F.col("event_type") == event, name).otherwise(source)
    empty = {c: F.lit(None).cast("int") for c in TABLES["source_status"].names[2:6]}
    store.write(
        "source_status",
        t("events")
        .select(source.alias("source"))
        .distinct()
        .withColumns({"run_date": F.lit(None).cast("date"), **empty, "finished": F.lit(False)}),
    )
    store.publish()


def load_twice(t: Tables) -> MartStore:
    root = scratch_dir(t.spark)
    _seed_masters(t, MartStore(t.spark, root, TABLES))
    landed = {
        "user_detail": landing.land(t, landing.user_detail(t)),
        "tests": landing.land(t, landing.all_tests(t)),
        "recipients": landing.land(t, landing.all_recipients(t)),
        "training": landing.land(t, landing.training(t)),
        "enrollments": landing.land(t, landing.enrollments(t), by="campaign_id"),
    }
    for second in (False, True):
        when = datetime(2003, 9, 6 if second else 5, 1, 30)
        store = MartStore(t.spark, root, TABLES)
        run_staging(store, landed | {"users": landing.land(t, _load_users(t, second))}, when)
        run_hr(store, t("fx_hr_staff"), t("fx_hr_units"), when)
        store.remove_superseded()
        run_load(
            store,
            when,
            init_calendar=not second,
            first_day=date(1995, 1, 1),
            last_day=date(2005, 12, 31),
        )
    return MartStore(t.spark, root, TABLES)


def _line(*values: str) -> str:
    return " || '|' || ".join(f"coalesce(cast({v} as varchar), '-')" for v in values)


_FIRST, _SECOND = "'2003-09-05 01:30:00'", "'2003-09-06 01:30:00'"


def _date_key_sql(day: str) -> str:
    return (
        f"case when {day} between date '1995-01-01' and date '2005-12-31' then {_key_sql(day)} end"
    )


_FLAG_VALUES = [f"case when {event} is not null then 1 else 0 end" for event in RECIPIENT_FLAGS.values()]


def _recipient_line(version: str, load: str) -> str:
    return _line(
        "g.pst_id", "g.user_id", version, "g.campaign_id", "'phishing'", "g.template_id", "null",
        *_FLAG_VALUES, _date_key_sql("g.started_at"), "cast(g.duration_days as bigint) * 86400", load,
    )


# Every row of the mart after both loads, as text with natural keys.
_CONTENTS = f"""
    select 'dim_user' as name, {_line(
        "user_id", f"sha256(case when renamed then replace(email, '@', '_old@') else email end)",
        _FIRST, f"case when renamed and not gone then {_SECOND} end", "not (renamed and not gone)",
    )} as line from people
    union all
    select 'dim_user', {_line("user_id", "sha256(email)", _SECOND, "null", "true")}
    from people where renamed and not gone
    union all
    select 'dim_unit', {_line("unit_code", "unit_naam", _FIRST, "null", "true")} from fx_units
    union all
    select 'dim_campaign', {_line(
        "campaign_id", "'phishing'", "name", "status", _date_key_sql("start_date"), _FIRST,
        f"case when campaign_end_date < date '2001-09-06' then {_SECOND} end",
        "campaign_end_date >= date '2001-09-06'",
    )} from ox_phishing
    union all
    select 'dim_campaign', {_line(
        "c.campaign_id", "campaign_type", "t.name", "t.status", _date_key_sql("t.start_date"),
        _FIRST, "null", "true",
    )} from ox_typed_plain c join fx_training t
      on t.campaign_id = c.campaign_id and t.status = 'In Progress'
    union all
    select 'dim_template', {_line("template_id", "template_name", _FIRST, "null", "true")}
    from fx_templates where template_id in (select template_id from fx_recipients)
    union all
    select 'dim_date', {_line(_key_sql("d"), "d")}
    from (select cast(unnest(generate_series(date '1995-01-01', date '2005-12-31', interval 1 day))
      as date) as d)
    union all
    select 'bridge_user_unit', {_line(
        "user_id", f"case when renamed then {_SECOND} else {_FIRST} end", "unit_name",
        "case when renamed then 20030906 else 20030905 end", "null", "true", "'1.0000'",
    )} from paired where not (renamed and gone)
    union all
    select 'fact_recipient', {_recipient_line(_FIRST, _FIRST)} from told g
    union all
    select 'fact_recipient', {_recipient_line(_SECOND, _SECOND)} from told g where moved
    union all
    select 'fact_enrollment', {_line(
        "e.enrollment_id", "e.user_id", f"case when moved then {_SECOND} else {_FIRST} end",
        "e.campaign_id", "c.campaign_type", "e.status", _date_key_sql("e.enrollment_date"), "null",
        _FIRST,
    )} from enrolled e join ox_typed_plain c on c.campaign_id = e.campaign_id
    union all
    select 'fact_snapshot', {_line("user_id", "version", "day", "phish_prone_pct", "score", "load")}
    from (select user_id, {_FIRST} as version, 20030905 as day, {_FIRST} as load from people
        union all
        select user_id, case when renamed then {_SECOND} else {_FIRST} end, 20030906, {_SECOND}
        from people where not gone)
      join (select user_id, phish_prone_pct from fx_users) using (user_id)
      left join (select user_id, max(current_risk_score) as score from fx_user_detail
        group by user_id) using (user_id)
    union all
    select 'source_status', {_line(
        "coalesce(source, event_type)", "case when source is not null then '2003-09-06' end",
        "source is not null",
    )} from (select distinct event_type from events) left join (values ('view', 'Vendor'),
      ('click', 'HR'), ('signup', 'Master'), ('purchase', 'DWH')) as n(event_type, source)
      using (event_type)"""


@query(
    "end_to_end_load",
    f"""
    with people as (select user_id, lower(email) as email, nation < 5 as renamed,
        segment = 'FURNITURE' as gone from fx_users),
    hr as (select lower(s.email) as email, n.unit_name from fx_hr_staff s
        join fx_hr_units n on n.unit_id = s.unit_code join fx_units u on u.unit_code = n.unit_name
      where kind = 'I' and in_service <= date '2003-09-01' and out_service > date '2003-09-01'),
    paired as (select p.*, h.unit_name from people p join hr h on h.email = p.email),
    got as (select r.*, p.renamed and not p.gone and c.campaign_end_date >= date '2001-09-06'
        as moved from fx_recipients r join people p
        on p.user_id = r.user_id join fx_pst t on t.pst_id = r.pst_id
        join ox_phishing c on c.campaign_id = t.campaign_id),
    enrolled as (select e.*, p.renamed and not p.gone as moved from fx_enrollments e
        join people p on p.user_id = e.user_id
        join fx_training t on t.campaign_id = e.campaign_id and t.status = 'In Progress'
        join ox_typed_plain c on c.campaign_id = e.campaign_id),
    told as (select g.*, t.campaign_id, t.started_at, t.duration_days
      from got g join fx_pst t on t.pst_id = g.pst_id),
    contents as ({_CONTENTS}),
    prints as (select name, cast(sum(cast('0x' || substr(md5(line), 1, 15) as bigint))
      as decimal(38,0)) as fingerprint from contents group by name),
    counts as (
    select 'dim_user' as name, count(*) + count(case when renamed and not gone then 1 end)
      as n_rows, count(*) as n_current from people
    union all
    select 'dim_unit', count(*), count(*) from fx_units
    union all
    select 'dim_campaign', count(*), count(case when still then 1 end)
    from (select campaign_id, campaign_end_date >= date '2001-09-06' as still from ox_phishing
      union all select c.campaign_id, true from ox_typed_plain c join fx_training t
        on t.campaign_id = c.campaign_id and t.status = 'In Progress')
    union all
    select 'dim_template', count(distinct template_id), count(distinct template_id)
      from fx_recipients
    union all
    select 'dim_date', 4018, 4018
    union all
    select 'bridge_user_unit', count(*), count(*) from paired where not (renamed and gone)
    union all
    select 'fact_recipient', count(*) + count(case when moved then 1 end),
      count(clicked_at) + count(case when moved then clicked_at end)
      from got
    union all
    select 'fact_enrollment', count(*), count(case when moved then 1 end) from enrolled
    union all
    select 'fact_snapshot', count(*) + count(case when not gone then 1 end),
      count(phish_prone_pct) + count(case when not gone then phish_prone_pct end)
      from people join fx_users using (user_id)
    union all
    select 'source_status', count(distinct event_type), 4 from events)
    select counts.*, fingerprint from counts join prints using (name)""",
)
def end_to_end_load(t: Tables) -> DataFrame:
    """Row counts and fingerprints of the mart after two loads.

    ``n_current`` counts current rows of dimensions and bridge; for the facts it
    counts clicks, enrolments moved to a new user row, and known percentages.
    """
    store = load_twice(t)
    current = F.count_if("is_current")
    newest = F.lit(datetime(2003, 9, 6, 1, 30).isoformat(sep=" ")).cast("timestamp_ntz")
    moved_users = store.read("dim_user").filter(
        (F.col("effective_from") == newest) & F.col("is_current")
    )
    enrollments = store.read("fact_enrollment").join(
        moved_users.select("user_key", F.lit(True).alias("_moved")), "user_key", "left"
    )
    frames = {
        "dim_user": (store.read("dim_user"), current),
        "dim_unit": (store.read("dim_unit"), current),
        "dim_campaign": (store.read("dim_campaign"), current),
        "dim_template": (store.read("dim_template"), current),
        "dim_date": (store.read("dim_date"), F.count(F.lit(1))),
        "bridge_user_unit": (store.read("bridge_user_unit"), current),
        "fact_recipient": (store.read("fact_recipient"), F.sum("clicks_count")),
        "fact_enrollment": (enrollments, F.count_if("_moved")),
        "fact_snapshot": (store.read("fact_snapshot"), F.count("phish_prone_pct")),
        "source_status": (load_status(store), F.count_if("finished")),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), n.cast("long").alias("n_current")).select(
            F.lit(name).alias("name"), "n_rows", "n_current"
        )
        for name, (df, n) in frames.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.join(fingerprints(store), "name")
