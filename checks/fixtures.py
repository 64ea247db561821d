"""Stand-ins for the mart's inputs, defined over the given tables.

The SQL runs unchanged in Spark and in DuckDB. ``{name}`` refers to a given
table or to another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
]

VIEWS = {
    # Feeds
    "fx_users": """
        select c_custkey as user_id, concat(c_name, '@Example.test') as email,
          case when c_custkey % 13 = 0 then null
               else cast((c_custkey * 7 % 1000) / 10.0 as decimal(5,2)) end as phish_prone_pct,
          c_nationkey as nation, c_mktsegment as segment, c_acctbal as balance
        from {customer}""",
    "fx_user_detail": """
        select user_id, cast(value as decimal(9,4)) as current_risk_score, ts as load_ts
        from {events}""",
    "fx_pst": """
        select o_custkey % 40 as campaign_id, o_orderkey as pst_id, o_orderstatus as status,
          o_orderpriority as name, cast(o_orderdate as date) as started_at,
          case when o_orderkey % 11 = 0 then null
               else cast(o_orderkey % 60 as int) end as duration_days
        from {orders}""",
    "fx_recipients": """
        select l_orderkey as pst_id, l_partkey as user_id, min(l_suppkey) as template_id,
          min(l_shipdate) as delivered_at,
          max(case when l_quantity > 10 then l_shipdate end) as opened_at,
          max(case when l_returnflag = 'R' and l_quantity > 25 then l_shipdate end) as clicked_at,
          max(case when l_returnflag = 'A' and l_quantity > 40 then l_shipdate end) as replied_at,
          max(case when l_linestatus = 'O' and l_quantity > 45 then l_shipdate end)
            as attachment_opened_at,
          max(case when l_linenumber = 6 and l_quantity > 20 then l_shipdate end)
            as macro_enabled_at,
          max(case when l_linenumber = 5 and l_quantity > 30 then l_shipdate end)
            as data_entered_at,
          max(case when l_linenumber = 7 then l_shipdate end) as qr_code_scanned_at,
          max(case when l_returnflag = 'N' and l_quantity > 30 then l_shipdate end) as reported_at
        from {lineitem} group by l_orderkey, l_partkey""",
    "fx_templates": """
        select s_suppkey as template_id, s_name as template_name, s_nationkey as nation
        from {supplier}""",
    "fx_training": """
        select p_partkey as campaign_id, p_name as name,
          case when p_size % 3 = 0 then 'Completed' else 'In Progress' end as status,
          cast('1999-12-10' as date) + cast(p_size as int) as start_date
        from {part}""",
    "fx_enrollments": """
        select o_orderkey as enrollment_id, o_orderkey % 50 as campaign_id,
          o_custkey as user_id, cast(o_orderdate as date) as enrollment_date,
          o_orderstatus as status
        from {orders}""",
    "fx_snapshots": """
        select o_custkey as user_id, cast(o_orderdate as date) as snapshot_date,
          max(cast((o_orderkey * 7 % 1000) / 10.0 as decimal(5,2))) as phish_prone_pct,
          max(cast((o_orderkey * 3 % 1000) / 10.0 as decimal(9,4))) as current_risk_score
        from {orders} group by o_custkey, cast(o_orderdate as date)""",
    # Master data
    "fx_md_training": """
        select * from (values ('Small', 'P'), ('red', 'T'), ('red w', 'P'), ('blue', 'T'))
          as t(name, type)""",
    "fx_md_training_plain": """
        select * from (values ('Small', 'P'), ('red', 'T'), ('blue', 'T')) as t(name, type)""",
    "fx_md_phishing": """
        select distinct o_custkey % 40 as campaign_id, (o_custkey % 40) % 4 <> 0 as active
        from {orders}""",
    "fx_mst_units": """
        select case when s_nationkey = 1 then concat('  ', lower(s_name), ' ') else s_name end
            as unit,
          case when s_nationkey = 4 then null when s_nationkey = 5 then '   '
               else concat(n_name, ' ') end as name
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "fx_mst_training": """
        select concat(p_name, ' ', cast(p_partkey as string)) as name, p_size > 25 as active,
          case when p_size < 10 then 'p' when p_size < 30 then 'T' end as type
        from {part}""",
    "fx_mst_phishing": """
        select o_orderkey as campaign_id, case when o_orderstatus <> 'P' then o_orderpriority end
            as name, o_totalprice > 100000 as active
        from {orders}""",
    "fx_edited": """
        select case when s_nationkey = 1 then '  ' else concat(' ', s_name) end as unit,
          case when s_nationkey < 3 then '' else concat(n_name, '  ') end as name
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    # HR
    "fx_hr_staff": """
        select concat(c_name, '@example.TEST') as email,
          case when c_custkey % 10 = 0 then null else c_nationkey end as unit_code,
          cast('1994-01-01' as date) as in_service,
          case when c_custkey % 17 = 0 then null
               when c_custkey % 5 = 0 then cast('2002-06-30' as date)
               else cast('9999-12-31' as date) end as out_service,
          case when c_mktsegment = 'BUILDING' then 'E' else 'I' end as kind
        from {customer}""",
    "fx_hr_units": """
        select n_nationkey as unit_id,
          case when n_nationkey = 3 then '  ' when n_nationkey = 7 then null else n_name end
            as unit_name
        from {nation}""",
    "fx_units": """
        select n_name as unit_code, r_name as unit_naam
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "fx_legacy_users": """
        select c_custkey as id, concat(c_name, '@Example.test') as email,
          case when c_nationkey in (2, 11) and c_mktsegment = 'FURNITURE' then null
               else cast((c_custkey * 7 % 1000) / 10.0 as decimal(9,4)) end
            as phish_prone_percentage,
          cast(c_acctbal as decimal(9,2)) as current_risk_score,
          cast((c_custkey * 3 % 1000) / 10.0 as decimal(9,4)) as percentage_response,
          case when c_nationkey = 8 and c_mktsegment = 'MACHINERY' then null
               else cast(c_custkey % 101 as decimal(9,4)) end as percentage_viewed,
          cast((c_custkey * 11 % 1000) / 10.0 as decimal(9,4)) as percentage_policies
        from {customer}""",
    # Memberships for the unit dashboards; some people moved once
    "fx_bridge": """
        select c_custkey as user_key, n_name as Unit_naam, 19950101 as start_date_key,
          case when c_mktsegment = 'BUILDING' then 19990701 end as end_date_key
        from {customer} join {nation} on c_nationkey = n_nationkey
        union all
        select c_custkey, n_name, 19990701, cast(null as int)
        from {customer} join {nation} on n_nationkey = (c_nationkey + 1) % 25
        where c_mktsegment = 'BUILDING'""",
    # Older states, for change tracking. MACHINERY people are new, FURNITURE people
    # are gone from the new snapshot, five nations had another e-mail.
    "fx_dim_user": """
        select 2 * c_custkey + 1 as user_key, c_custkey as user_id,
          case when c_acctbal < 0 then null
               when c_nationkey < 5 then concat(c_name, '_old@example.test')
               else concat(c_name, '@Example.test') end as email,
          cast('2022-01-01' as date) as valid_from, cast(null as date) as valid_to,
          true as is_current
        from {customer} where c_mktsegment <> 'MACHINERY'
        union all
        select 2 * c_custkey + 2, c_custkey, concat(c_name, '_first@example.test'),
          cast('2021-01-01' as date), cast('2022-01-01' as date), false
        from {customer} where c_mktsegment = 'AUTOMOBILE'""",
    "fx_users_today": """
        select c_custkey as user_id,
          case when c_acctbal > 9000 or c_acctbal < -500 then null
               else concat(c_name, '@Example.test') end as email
        from {customer} where c_mktsegment <> 'FURNITURE'""",
    "fx_dim_unit": """
        select s_suppkey + 1 as unit_key, s_name as unit_code,
          case when s_nationkey = 4 then null when s_nationkey < 8 then concat(n_name, ' old')
               else n_name end as unit_naam,
          cast('2022-01-01' as date) as valid_from, cast(null as date) as valid_to,
          true as is_current
        from {supplier} join {nation} on s_nationkey = n_nationkey where n_regionkey <> 2""",
    "fx_units_today": """
        select s_name as unit_code,
          case when s_nationkey = 4 then '' when s_nationkey = 9 then null else n_name end
            as unit_naam
        from {supplier} join {nation} on s_nationkey = n_nationkey where n_regionkey <> 3""",
    "fx_dim_campaign": """
        select campaign_id, 'phishing' as campaign_type, min(name) as name,
          case when campaign_id < 20 then 'X' else max(status) end as status,
          cast(min(year(started_at) * 10000 + month(started_at) * 100 + day(started_at)) as int)
            as start_date_key,
          cast('2002-01-01' as date) as valid_from, cast(null as date) as valid_to,
          true as is_current
        from {fx_pst} group by campaign_id
        union all
        select campaign_id, 'training', name, status,
          case when status = 'Completed' then null else cast(year(start_date) * 10000
            + month(start_date) * 100 + day(start_date) as int) end,
          cast('2002-01-01' as date), cast(null as date), true
        from {fx_training} where name not like '%ring'
        union all
        select campaign_id, 'policy', name, 'Closed', cast(null as int),
          cast('2001-01-01' as date), cast('2002-01-01' as date), false
        from {fx_training} where name like '%widget'""",
    "fx_fact_recipient": """
        select l_orderkey * 100000 + l_partkey as pst_recipient_key, l_partkey as user_key,
          cast(-1 as bigint) as campaign_key, cast(null as bigint) as template_key,
          l_orderkey as pst_id, 'kept' as result_status, 9 as flag_before,
          cast('2002-02-02' as date) as loaded
        from {lineitem} where l_linenumber < 4 group by l_orderkey, l_partkey""",
    "fx_fact_enrollment": """
        select o_orderkey + 1 as enrollment_key, cast(-1 as bigint) as user_key,
          cast(-1 as bigint) as campaign_key, o_orderkey as enrollment_id, 'old' as status,
          cast(null as int) as enrollment_date_key, 20020301 as completion_date_key,
          cast('2002-02-02' as date) as loaded
        from {orders} where o_orderpriority <> '2-HIGH'""",
    "fx_fact_snapshot": """
        select c_custkey as user_key, 20240101 as snapshot_date_key from {customer}
        where c_mktsegment = 'HOUSEHOLD'
        union all
        select c_custkey, 20231231 from {customer}""",
    "fx_bridge_before": """
        select user_key, unit_code, 20220101 as start_date_key, cast(null as int) as end_date_key,
          true as is_current
        from {fx_dim_user} join {customer} on c_custkey = user_id
          join {fx_units} on unit_code = concat('NATION_', cast((c_nationkey
            + case when c_acctbal > 5000 then 1 else 0 end) % 25 as string))
        where is_current and c_mktsegment <> 'HOUSEHOLD'
        union all
        select user_key, concat('NATION_', cast(c_nationkey as string)), 20240101, 20240101, false
        from {fx_dim_user} join {customer} on c_custkey = user_id
        where is_current and c_mktsegment = 'HOUSEHOLD' and c_acctbal > 3000""",
    "fx_history_units": """
        select cast('2023-12-01' as date) as date, n_name as unit, 1 as measure from {nation}
        union all
        select cast('2024-01-01' as date), n_name, 2 from {nation} where n_regionkey = 1""",
    # Monitoring
    "fx_status_log": """
        select cast(ts as date) as day, event_type as source, value > 100 as finished
        from {events}""",
    "fx_usage": """
        select user_id, cast(ts as date) as day, count(*) as calls,
          count(case when value > 20 then 1 end) as made
        from {events} group by user_id, cast(ts as date)""",
    "fx_source_status": """
        select c_custkey as source, cast('2024-01-01' as date) as run_date,
          c_acctbal > 0 as finished, c_nationkey as max_fetches
        from {customer}""",
    "fx_finished": """
        select user_id as source, max(cast(ts as date)) as run_date, true as finished
        from {events} where event_type = 'signup' group by user_id""",
    "fx_texts": """
        select event_id,
          case event_type
            when 'view' then cast(cast(value as decimal(9,2)) as string)
            when 'click' then concat(' ', cast(cast(value as decimal(9,2)) as string), ' ')
            when 'signup' then concat(cast(cast(value as decimal(9,2)) as string), 'x')
            when 'error' then '' end as number_text,
          case event_type
            when 'view' then concat(left(cast(ts as string), 10), 'T09:30:00.000Z')
            when 'click' then replace(left(cast(ts as string), 10), '-0', '-')
            when 'signup' then concat('2023-02-3', substring(cast(ts as string), 10, 1))
            when 'error' then replace(left(cast(ts as string), 10), '-', '/') end as date_text
        from {events}""",
    "fx_null_pairs": """
        select o_orderkey as id,
          case when o_orderstatus = 'P' then null when o_totalprice < 100000 then ''
               else o_orderpriority end as old_text,
          case when o_custkey % 3 = 0 then null when o_totalprice > 400000 then ''
               else o_orderpriority end as new_text,
          case when o_orderstatus = 'F' then null when o_totalprice < 200000 then -1
               else cast(o_custkey % 4 as int) end as old_key,
          case when o_orderpriority = '5-LOW' then null else cast(o_custkey % 4 as int) - 1 end
            as new_key
        from {orders}""",
    # Versions whose ends sometimes reach into the next version
    "fx_versions": """
        select o_custkey as user_id, cast(o_orderdate as date) as valid_from,
          case when o_orderstatus = 'P' then null
               when o_orderpriority = '1-URGENT' then cast(o_orderdate as date) - 1
               else cast(o_orderdate as date) + cast(o_orderkey % 40 as int) end as valid_to,
          o_totalprice > 450000 as is_current
        from {orders}""",
}

_NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """The given tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._known: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in VIEWS:
                sql = VIEWS[name]
                used = {n: self(n) for n in _NAME.findall(sql)}
                # The formatter reads braces only; the SQL has no others.
                self._known[name] = self.spark.sql(sql, **used)
            else:
                self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]


def with_views(sql: str, helpers: dict[str, str]) -> str:
    """Prefix DuckDB SQL with the views and helper queries it names."""
    defined = VIEWS | helpers
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[fo]x_\w+", text):
            if name in defined and name not in order:
                visit(defined[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    plain = {name: name for name in [*BASE, *defined]}
    parts = [f"{name} as ({defined[name].format(**plain).strip()})" for name in order]
    body = sql.strip()
    if body.startswith("with "):
        parts.append(body.removeprefix("with "))
        return "with " + ",\n".join(parts)
    return "with " + ",\n".join(parts) + "\n" + body if parts else body
