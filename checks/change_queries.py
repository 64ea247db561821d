"""Change tracking: dimensions, bridge, updates, surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from awareness_mart.functions import any_differs, differs, person_key
from awareness_mart.operators.bridge import bridge_apply, membership_pairs
from awareness_mart.operators.calendar import calendar
from awareness_mart.operators.changes import (
    insert_missing,
    keyed_update,
    missing_from,
    new_or_changed,
    scd2_apply,
)
from awareness_mart.operators.keys import fill_keys, highest_key
from awareness_mart.operators.prefix import prefix_join
from awareness_mart.plans.campaigns import (
    campaign_source,
    campaign_summary,
    phishing_retained,
    typed_training,
)
from awareness_mart.plans.load import CAMPAIGN_TRACKED, UNIT_TRACKED, USER_TRACKED
from awareness_mart.plans.templates import new_templates, template_candidates
from awareness_mart.sources.hr import active_hr_units

from .fixtures import Tables
from .registry import RETENTION_RUN, RUN_TS, hexed, query

_TS = "timestamp '2024-01-01 00:00:00'"


def _validity(df: DataFrame) -> DataFrame:
    """Day columns of a fixture to the timestamps of a dimension."""
    return df.withColumns(
        {
            "effective_from": F.col("valid_from").cast("timestamp_ntz"),
            "effective_to": F.col("valid_to").cast("timestamp_ntz"),
        }
    ).drop("valid_from", "valid_to")


def dim_user(t: Tables) -> DataFrame:
    return _validity(t("fx_dim_user")).withColumn("ehash", person_key(F.col("email")))


def users_today(t: Tables) -> DataFrame:
    return t("fx_users_today").select("user_id", person_key(F.col("email")).alias("ehash"))


def _scd2_sql(
    dim: str, src: str, key: str, keys: list[str], tracked: dict[str, str], close: str = "false"
) -> str:
    """Expected dimension after a load, from the rules spelled out row by row."""
    on = " and ".join(f"d.{k} = s.{k}" for k in keys)
    differs_ = " or ".join(
        f"coalesce(d.{c}, {null}) <> coalesce(s.{c}, {null})" for c, null in tracked.items()
    )
    closed = f"(d.is_current and ((s._seen and ({differs_})) or (s._seen is null and {close})))"
    names = ", ".join(f"d.{c}" for c in [*keys, *tracked])
    opened = ", ".join(f"s.{c}" for c in [*keys, *tracked])
    return f"""
    select d.{key}, {names}, cast(d.valid_from as timestamp) as effective_from,
      case when {closed} then {_TS} else cast(d.valid_to as timestamp) end as effective_to,
      d.is_current and not coalesce({closed}, false) as is_current
    from ({dim}) d left join (select *, true as _seen from ({src})) s on {on} and d.is_current
    union all
    select null, {opened}, {_TS}, null, true
    from ({src}) s left join (select * from ({dim}) where is_current) d on {on}
    where d.is_current is null or {differs_}"""


_DIM_USER = "select *, sha256(lower(email)) as ehash from fx_dim_user"
_USERS = "select user_id, sha256(lower(email)) as ehash from fx_users_today"


@query("scd2_user", _scd2_sql(_DIM_USER, _USERS, "user_key", ["user_id"], {"ehash": "'00'"}))
def scd2_user(t: Tables) -> DataFrame:
    return hexed(scd2_users(t))


def scd2_users(t: Tables) -> DataFrame:
    return scd2_apply(dim_user(t), users_today(t), ["user_id"], USER_TRACKED, RUN_TS, "user_key")


@query(
    "scd2_unit",
    _scd2_sql(
        "select * from fx_dim_unit",
        "select * from fx_units_today",
        "unit_key",
        ["unit_code"],
        {"unit_naam": "''"},
    ),
)
def scd2_unit(t: Tables) -> DataFrame:
    return scd2_apply(
        _validity(t("fx_dim_unit")),
        t("fx_units_today"),
        ["unit_code"],
        UNIT_TRACKED,
        RUN_TS,
        "unit_key",
    )


def dates(t: Tables) -> DataFrame:
    """A calendar that ends before the last start dates do."""
    return calendar(t.spark, RETENTION_RUN.replace(1996, 1, 1), RETENTION_RUN.replace(2000, 12, 31))


def source(t: Tables) -> DataFrame:
    return campaign_source(
        t("fx_pst"),
        t("fx_md_phishing"),
        t("fx_training"),
        t("fx_md_training"),
        dates(t),
        RETENTION_RUN,
    )


@query("campaign_source", "select * from ox_campaigns")
def campaigns(t: Tables) -> DataFrame:
    return source(t)


@query(
    "scd2_campaign",
    _scd2_sql(
        "select *, campaign_id as campaign_key from fx_dim_campaign",
        "select * from ox_campaigns",
        "campaign_key",
        ["campaign_id", "campaign_type"],
        {"name": "''", "status": "''", "start_date_key": "-1"},
        "d.campaign_type = 'phishing'",
    ),
)
def scd2_campaign(t: Tables) -> DataFrame:
    dim = _validity(t("fx_dim_campaign")).withColumn("campaign_key", F.col("campaign_id"))
    return scd2_apply(
        dim,
        source(t),
        ["campaign_id", "campaign_type"],
        CAMPAIGN_TRACKED,
        RUN_TS,
        "campaign_key",
        close_missing=F.col("campaign_type") == "phishing",
    )


@query(
    "campaign_summary",
    """
    select campaign_id, min(name) as name, max(status) as status, min(started_at) as start_date,
      max(started_at + coalesce(duration_days, 0)) as campaign_end_date
    from fx_pst group by campaign_id""",
)
def summary(t: Tables) -> DataFrame:
    return campaign_summary(t("fx_pst"))


@query("phishing_retained", "select * from ox_phishing")
def retained(t: Tables) -> DataFrame:
    return phishing_retained(t("fx_pst"), t("fx_md_phishing"), RETENTION_RUN)


@query("training_types", "select * from ox_typed")
def training_types(t: Tables) -> DataFrame:
    return typed_training(t("fx_training"), t("fx_md_training"))


_PREFIX = """
    select t.name, t.campaign_id, t.status, m.name as master, m.type
    from fx_training t {how} join fx_md_training m
      on starts_with(upper(t.name), upper(rtrim(m.name)))"""


def _masters(t: Tables) -> DataFrame:
    return t("fx_md_training").withColumnRenamed("name", "master")


@query("prefix_join", _PREFIX.format(how=""))
def prefix_inner(t: Tables) -> DataFrame:
    names = t("fx_training").drop("start_date")
    return prefix_join(names, "name", _masters(t), "master")


@query("prefix_join_outer", _PREFIX.format(how="left"))
def prefix_outer(t: Tables) -> DataFrame:
    names = t("fx_training").drop("start_date")
    return prefix_join(names, "name", _masters(t), "master", how="left")


@query(
    "change_predicate",
    """
    select id, coalesce(old_text, '') <> coalesce(new_text, '') as text_changed,
      coalesce(old_key, -1) <> coalesce(new_key, -1) as key_changed,
      coalesce(old_text, '') <> coalesce(new_text, '')
        or coalesce(old_key, -1) <> coalesce(new_key, -1) as row_changed
    from fx_null_pairs""",
)
def change_predicate(t: Tables) -> DataFrame:
    pairs = t("fx_null_pairs")
    old = F.struct(F.col("old_text").alias("text"), F.col("old_key").alias("key"))
    new = F.struct(F.col("new_text").alias("text"), F.col("new_key").alias("key"))
    return pairs.select("id", "old_text", "new_text", "old_key", "new_key", old.alias("o"),
                        new.alias("n")).select(
        "id",
        differs(F.col("old_text"), F.col("new_text"), "").alias("text_changed"),
        differs(F.col("old_key"), F.col("new_key"), -1).alias("key_changed"),
        any_differs("o", "n", {"text": "", "key": -1}).alias("row_changed"),
    )


@query(
    "missing_keys",
    """
    select user_id, sha256(lower(email)) as ehash from fx_users_today
    where user_id not in (select user_id from fx_dim_user where is_current)""",
)
def missing_keys(t: Tables) -> DataFrame:
    current = dim_user(t).filter("is_current")
    return hexed(missing_from(users_today(t), current, ["user_id"]))


@query(
    "insert_missing",
    """
    select user_id, sha256(lower(email)) as ehash, user_key from fx_dim_user where is_current
    union all
    select user_id, sha256(lower(email)), null from fx_users_today
    where user_id not in (select user_id from fx_dim_user where is_current)""",
)
def inserted(t: Tables) -> DataFrame:
    current = dim_user(t).filter("is_current").select("user_id", "ehash", "user_key")
    return hexed(insert_missing(current, users_today(t), ["user_id"]))


@query(
    "scd2_new_or_changed",
    """
    select s.user_id, sha256(lower(s.email)) as ehash
    from fx_users_today s left join fx_dim_user d on d.user_id = s.user_id and d.is_current
    where d.user_id is null
      or coalesce(sha256(lower(d.email)), '00') <> coalesce(sha256(lower(s.email)), '00')""",
)
def changed_rows(t: Tables) -> DataFrame:
    current = dim_user(t).filter("is_current")
    return hexed(new_or_changed(current, users_today(t), ["user_id"], USER_TRACKED))


@query(
    "template_candidates",
    """
    select distinct r.template_id, t.template_name as template
    from fx_recipients r left join fx_templates t on t.template_id = r.template_id
    where r.template_id is not null""",
)
def candidates(t: Tables) -> DataFrame:
    return template_candidates(_named_recipients(t))


def _named_recipients(t: Tables) -> DataFrame:
    names = t("fx_templates").selectExpr("template_id", "template_name as template")
    return t("fx_recipients").join(names, "template_id", "left")


@query(
    "dim_template_insert",
    f"""
    select r.template_id, min(t.template_name) as template_name, {_TS} as effective_from,
      cast(null as timestamp) as effective_to, true as is_current
    from fx_recipients r left join fx_templates t on t.template_id = r.template_id
    where r.template_id not in (select template_id from fx_templates where nation < 15)
    group by r.template_id""",
)
def template_insert(t: Tables) -> DataFrame:
    known = t("fx_templates").filter("nation < 15").withColumn("is_current", F.lit(True))
    return new_templates(known, _named_recipients(t), RUN_TS)


def _dim_units(t: Tables) -> DataFrame:
    return t("fx_units").withColumns(
        {"unit_key": F.xxhash64("unit_code"), "is_current": F.lit(True)}
    )


_TODAY = 20240101


@query(
    "bridge_snapshot",
    """
    with pairs as (
      select distinct d.user_key, h.unit as unit_code
      from ox_hr h join fx_units u on u.unit_code = h.unit
        join fx_dim_user d on lower(d.email) = h.email and d.is_current),
    today as (select b.*, p.user_key is not null as seen from fx_bridge_before b
      left join pairs p on p.user_key = b.user_key and p.unit_code = b.unit_code)
    select user_key, unit_code, start_date_key,
      case when is_current and not seen then 20240101
           when not is_current and seen and start_date_key = 20240101 then null
           else end_date_key end as end_date_key,
      case when is_current then seen
           else seen and start_date_key = 20240101 end as is_current,
      cast(1 as decimal(9,4)) as allocation_wt
    from today
    union all
    select user_key, unit_code, 20240101, null, true, cast(1 as decimal(9,4)) from pairs p
    where not exists (select 1 from fx_bridge_before b where b.user_key = p.user_key
      and b.unit_code = p.unit_code and (b.is_current or b.start_date_key = 20240101))""",
)
def bridge_snapshot(t: Tables) -> DataFrame:
    units = _dim_units(t)
    codes = units.select("unit_key", "unit_code")
    before = (
        t("fx_bridge_before")
        .join(codes, "unit_code")
        .withColumn("allocation_wt", F.lit(1).cast("decimal(9,4)"))
        .drop("unit_code")
    )
    users = dim_user(t)
    hr = active_hr_units(t("fx_hr_staff"), t("fx_hr_units"), RUN_TS)
    pairs = membership_pairs(hr, users, units)
    after = bridge_apply(before, pairs, users.filter("is_current"), _TODAY)
    return after.join(codes, "unit_key").drop("unit_key")


@query(
    "surrogate_keys",
    """
    select user_id, false as is_new, true as key_ok, cast(1 as bigint) as copies
    from fx_dim_user where is_current
    union all
    select user_id, true, true, 1 from fx_users_today
    where user_id not in (select user_id from fx_dim_user where is_current)""",
)
def surrogate_keys(t: Tables) -> DataFrame:
    """Old rows keep their key; new rows get a free one above all of them."""
    dim = dim_user(t)
    current = dim.filter("is_current").select("user_key", "user_id", "ehash")
    rows = insert_missing(current, users_today(t), ["user_id"])
    keyed = fill_keys(rows, "user_key", ["user_id"], highest_key(dim, "user_key"))
    before = current.select("user_id", F.col("user_key").alias("old_key"))
    top = highest_key(dim, "user_key")
    copies = F.count(F.lit(1)).over(Window.partitionBy("user_key"))
    ok = F.coalesce(F.col("user_key") == F.col("old_key"), F.col("user_key") > top)
    return keyed.join(before, "user_id", "left").select(
        "user_id", F.col("old_key").isNull().alias("is_new"), ok.alias("key_ok"),
        copies.alias("copies"),
    )


@query(
    "keyed_update",
    """
    select s.source, coalesce(f.run_date, s.run_date) as run_date,
      coalesce(f.finished, s.finished) as finished, s.max_fetches
    from fx_source_status s left join fx_finished f on f.source = s.source""",
)
def updated(t: Tables) -> DataFrame:
    return keyed_update(
        t("fx_source_status"), t("fx_finished"), ["source"], ["run_date", "finished"]
    )


