"""Reports and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from awareness_mart.functions import date_key, flag, person_key
from awareness_mart.operators.calendar import calendar_over
from awareness_mart.plans import dashboards, history, reports
from awareness_mart.plans.campaigns import typed_training
from awareness_mart.plans.facts import presence_flags

from .fact_queries import _MEANS_SQL, _members
from .fixtures import Tables
from .registry import COMPLETED, HELPERS, query

_EVENTS = {
    "Total_clicked": "clicked_at",
    "Total_replied": "replied_at",
    "Total_attachments_opened": "attachment_opened_at",
    "Total_data_entered": "data_entered_at",
    "Total_macro_enabled": "macro_enabled_at",
    "Total_qr_code_scanned": "qr_code_scanned_at",
}
_COUNTS_SQL = ", ".join(f"count({event}) as {total}" for total, event in _EVENTS.items())
_ALL_SQL = " + ".join(f"count({event})" for event in _EVENTS.values())


def _results(t: Tables) -> tuple[DataFrame, DataFrame]:
    return presence_flags(t("fx_recipients")), t("fx_templates")


@query(
    "report_templates",
    f"""
    select template_name as Template_name, {_COUNTS_SQL}, {_ALL_SQL} as Total_all
    from fx_recipients join fx_templates using (template_id)
    group by template_name order by Total_all desc, Template_name""",
)
def report_templates(t: Tables) -> DataFrame:
    return reports.report_templates(*_results(t), key="template_id")


@query(
    "report_template_types",
    f"""
    select nation as Template_type, count(*) as Occurrences, {_ALL_SQL} as Total_reactions
    from fx_recipients join fx_templates using (template_id)
    group by nation order by Total_reactions desc, Template_type""",
)
def report_template_types(t: Tables) -> DataFrame:
    return reports.report_template_types(*_results(t), type_of=F.col("nation"), key="template_id")


@query("report_error_totals", f"select {_COUNTS_SQL} from fx_recipients")
def report_error_totals(t: Tables) -> DataFrame:
    return reports.report_error_totals(_results(t)[0])


@query("report_after_rename", f"select {_COUNTS_SQL} from fx_recipients")
def report_after_rename(t: Tables) -> DataFrame:
    """Every third person has a closed version, and each of their results a row for both."""
    fact = _results(t)[0].withColumn("user_key", 2 * F.col("user_id"))
    renamed = F.col("user_id") % 3 == 0
    again = fact.filter(renamed).withColumn("user_key", F.col("user_key") + 1)
    people = fact.select("user_id", "user_key").distinct()
    first = people.select("*", F.lit(1).alias("effective_from"), (~renamed).alias("is_current"))
    second = people.filter(renamed).select(
        "user_id",
        (F.col("user_key") + 1).alias("user_key"),
        F.lit(2).alias("effective_from"),
        F.lit(True).alias("is_current"),
    )
    results = reports.current_results(fact.union(again), first.union(second), ["pst_id"])
    return reports.report_error_totals(results)


@query(
    "report_top10",
    " union all ".join(
        f"select template_name as Template_name, '{total}' as Error, count({event}) as Total "
        "from fx_recipients join fx_templates using (template_id) group by template_name"
        for total, event in _EVENTS.items()
    )
    + " order by Total desc, Template_name, Error limit 10",
)
def report_top10(t: Tables) -> DataFrame:
    return reports.report_top10(*_results(t), key="template_id")


@query(
    "sorted_listing",
    """
    select pst_id, campaign_id, status, started_at from fx_pst
    order by status, started_at desc, pst_id, campaign_id""",
)
def sorted_listing(t: Tables) -> DataFrame:
    return reports.sorted_listing(
        t("fx_pst"),
        ["pst_id", "campaign_id", "status", "started_at"],
        [("status", False), ("started_at", True)],
    )


# Dashboards
def _facts(t: Tables) -> dashboards.Measures:
    snapshots = t("fx_snapshots").select(
        F.col("user_id").alias("user_key"),
        date_key(F.col("snapshot_date")).alias("snapshot_date_key"),
        "phish_prone_pct",
        "current_risk_score",
    )
    started = t("fx_pst").select("pst_id", date_key(F.col("started_at")).alias("started_date_key"))
    recipients = t("fx_recipients").join(started, "pst_id").select(
        F.col("user_id").alias("user_key"),
        "started_date_key",
        flag(F.col("delivered_at")).alias("delivered_count"),
        flag(F.col("reported_at")).alias("reported_count"),
    )
    types = typed_training(t("fx_training"), t("fx_md_training"))
    enrollments = (
        t("fx_enrollments")
        .join(types.select("campaign_id", "campaign_type"), "campaign_id")
        .select(
            F.col("user_id").alias("user_key"),
            date_key(F.col("enrollment_date")).alias("enrollment_date_key"),
            "campaign_type",
            "status",
        )
    )
    return dashboards.measures(snapshots, recipients, enrollments, COMPLETED)


def _dates(t: Tables) -> DataFrame:
    return calendar_over(t("orders").select(F.to_date("o_orderdate").alias("date")))


HELPERS["ox_measures"] = """
    select user_id as user_key, snapshot_date as day, phish_prone_pct as prone,
      current_risk_score as risk, 0 as delivered, 0 as reported, 0 as tr, 0 as tr_done,
      0 as po, 0 as po_done
    from fx_snapshots
    union all
    select r.user_id, p.started_at, null, null, count(r.delivered_at), count(r.reported_at),
      0, 0, 0, 0
    from fx_recipients r join fx_pst p on p.pst_id = r.pst_id
    group by r.user_id, p.started_at
    union all
    select e.user_id, e.enrollment_date, null, null, 0, 0,
      count(case when c.campaign_type = 'training' then 1 end),
      count(case when c.campaign_type = 'training' and e.status = 'F' then 1 end),
      count(case when c.campaign_type = 'policy' then 1 end),
      count(case when c.campaign_type = 'policy' and e.status = 'F' then 1 end)
    from fx_enrollments e join ox_typed c on c.campaign_id = e.campaign_id
    group by e.user_id, e.enrollment_date"""
HELPERS["ox_unit_measures"] = """
    select m.*, b.Unit_naam from ox_measures m join fx_bridge b on b.user_key = m.user_key
    where b.start_date_key <= year(day) * 10000 + month(day) * 100 + day(day)
      and (b.end_date_key is null
        or year(day) * 10000 + month(day) * 100 + day(day) < b.end_date_key)"""
_PERIODS = {
    "day": {"Year": "year(day)", "Month": "month(day)", "Day": "day(day)"},
    "week": {"Year": "isoyear(day)", "Week": "weekofyear(day)"},
    "month": {"Year": "year(day)", "Month": "month(day)"},
}


def _dashboard_sql(grain: str, unit: bool) -> str:
    period = _PERIODS[grain]
    by = ["Unit_naam"] if unit else []
    columns = [*by, *period]
    head = ", ".join([*by, *[f"cast({e} as integer) as {n}" for n, e in period.items()]])
    group = ", ".join(str(i + 1) for i in range(len(columns)))
    part = f"partition by {by[0]} " if unit else ""
    order = ", ".join(period)

    def running(done: str, whole: str) -> str:
        return (
            f"cast(sum({done}) over w as double) * 100 "
            f"/ nullif(cast(sum({whole}) over w as double), 0)"
        )

    return f"""
    with periods as (
      select {head}, sum(prone) as prone_sum, count(prone) as prone_n, sum(risk) as risk_sum,
        count(risk) as risk_n, sum(delivered) as delivered, sum(reported) as reported,
        sum(tr) as tr, sum(tr_done) as tr_done, sum(po) as po, sum(po_done) as po_done
      from {"ox_unit_measures" if unit else "ox_measures"} group by {group})
    select {", ".join(columns)},
      cast(prone_sum as double) / nullif(cast(prone_n as double), 0) as Avg_phish_prone,
      cast(risk_sum as double) / nullif(cast(risk_n as double), 0) as Avg_risk_score,
      {running("reported", "delivered")} as Pct_response_cum,
      {running("tr_done", "tr")} as pct_training_completed_cum,
      {running("po_done", "po")} as Pct_policy_read_cum
    from periods
    window w as ({part}order by {order} rows between unbounded preceding and current row)
    order by {", ".join(columns)}"""


def _register_dashboards() -> None:
    for grain in _PERIODS:

        @query(f"dashboard_{grain}", _dashboard_sql(grain, unit=False))
        def overall(t: Tables, grain: str = grain) -> DataFrame:
            return dashboards.dashboard(_facts(t), _dates(t), grain)

        @query(f"unit_dashboard_{grain}", _dashboard_sql(grain, unit=True))
        def per_unit(t: Tables, grain: str = grain) -> DataFrame:
            return dashboards.unit_dashboard(_facts(t), t("fx_bridge"), _dates(t), grain)


_register_dashboards()


# Monthly averages from the facts
_UNTIL = 19981231


def _share_sql(part: str, whole: str) -> str:
    return f"coalesce(({part} * 2000000 + {whole}) // nullif(2 * {whole}, 0), 0) * 0.0001"


HELPERS["ox_month"] = f"""
    with snap as (select * from fx_snapshots where snapshot_date <= date '1998-12-31'
      qualify row_number() over (partition by user_id order by snapshot_date desc) = 1),
    sums as (select user_key, sum(delivered)::bigint as delivered, sum(reported)::bigint as reported,
        sum(tr)::bigint as tr, sum(tr_done)::bigint as tr_done, sum(po)::bigint as po,
        sum(po_done)::bigint as po_done
      from ox_measures where day <= date '1998-12-31' group by user_key)
    select u.user_id as id, h.unit, s.phish_prone_pct as phish_prone_percentage,
      s.current_risk_score, {_share_sql("reported", "delivered")} as percentage_response,
      {_share_sql("tr_done", "tr")} as percentage_viewed,
      {_share_sql("po_done", "po")} as percentage_policies
    from fx_users u join ox_hr h on h.email = lower(u.email) join fx_units n on n.unit_code = h.unit
      left join snap s on s.user_id = u.user_id left join sums m on m.user_key = u.user_id"""


@query(
    "history_from_facts",
    f"""
    select unit, false as is_total, count(*) as users, {_MEANS_SQL} from ox_month group by unit
    union all
    select null, true, count(*), {_MEANS_SQL} from ox_month having count(*) > 0""",
)
def history_from_facts(t: Tables) -> DataFrame:
    """The monthly averages with measures taken from the facts as of the end of 1998."""
    people = t("fx_users").select(
        F.col("user_id").alias("user_key"),
        F.col("user_id").alias("id"),
        person_key(F.col("email")).alias("ehash"),
        F.lit(True).alias("is_current"),
    )
    _, hr, units = _members(t)
    return history.unit_rollup(history.person_measures(_facts(t), people, _UNTIL), hr, units)


@query(
    "running_pct",
    """
    with days as (select p.started_at as day, count(r.delivered_at) as delivered,
        count(r.reported_at) as reported
      from fx_recipients r join fx_pst p on p.pst_id = r.pst_id group by p.started_at)
    select day, delivered, reported,
      cast(sum(reported) over w as double) * 100
        / nullif(cast(sum(delivered) over w as double), 0) as pct
    from days window w as (order by day rows between unbounded preceding and current row)""",
)
def running_pct(t: Tables) -> DataFrame:
    started = t("fx_pst").select("pst_id", F.col("started_at").alias("day"))
    days = (
        t("fx_recipients")
        .join(started, "pst_id")
        .groupBy("day")
        .agg(F.count("delivered_at").alias("delivered"), F.count("reported_at").alias("reported"))
    )
    window = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("pct", dashboards.running_pct("reported", "delivered", window))
