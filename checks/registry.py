"""Registration of queries with the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Tables, with_views

# Fixed parameters of the queries; the SQL repeats them.
RUN_TS = datetime(2024, 1, 1)
RETENTION_RUN = date(2003, 9, 5)
LEGACY_RUN = date(2000, 1, 15)
COMPLETED = "F"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# DuckDB queries that several oracles build on.
HELPERS = {
    "ox_phishing": """
        select p.campaign_id, min(p.name) as name, max(p.status) as status,
          min(p.started_at) as start_date,
          max(p.started_at + coalesce(p.duration_days, 0)) as campaign_end_date
        from fx_pst p join fx_md_phishing m on m.campaign_id = p.campaign_id and m.active
        group by p.campaign_id
        having max(p.started_at + coalesce(p.duration_days, 0)) >= date '2001-09-05'""",
    "ox_typed": """
        select t.campaign_id,
          case when upper(m.type) = 'P' then 'policy' else 'training' end as campaign_type,
          min(t.name) as name, max(t.status) as status, min(t.start_date) as start_date
        from fx_training t
          left join fx_md_training m on starts_with(upper(t.name), upper(rtrim(m.name)))
        group by 1, 2""",
    "ox_typed_plain": """
        select t.campaign_id,
          case when upper(m.type) = 'P' then 'policy' else 'training' end as campaign_type
        from fx_training t
          left join fx_md_training_plain m on starts_with(upper(t.name), upper(rtrim(m.name)))
        group by 1, 2""",
    "ox_campaigns": """
        select campaign_id, campaign_type, name, status,
          case when start_date between date '1996-01-01' and date '2000-12-31'
            then cast(year(start_date) * 10000 + month(start_date) * 100 + day(start_date)
              as integer) end as start_date_key
        from (select campaign_id, 'phishing' as campaign_type, name, status, start_date
              from ox_phishing
              union all
              select campaign_id, campaign_type, name, status, start_date from ox_typed)""",
    "ox_hr": """
        select lower(email) as email, email as email_as_sent,
          case when coalesce(rtrim(unit_name), '') = '' then 'Onbekend' else unit_name end as unit
        from fx_hr_staff left join fx_hr_units on unit_code = unit_id
        where kind = 'I' and in_service <= date '2024-01-01' and out_service > date '2024-01-01'""",
}


def query(name: str, sql: str | None = None):
    """Register a function of the fixture tables under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, HELPERS)
        return build

    return register


def hexed(df: DataFrame) -> DataFrame:
    """Binary columns as lower-case hex, the form the SQL gives."""
    return df.select(
        *[
            F.lower(F.hex(name)).alias(name) if kind == "binary" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
