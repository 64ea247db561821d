"""Reports and listings over a loaded mart, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..sources.store import MartStore
from . import dashboards, reports
from .monitoring import load_status

# Listings: table, columns, sort keys as (column, descending). Fixed values.
LISTINGS = {
    "units": ("mst_units", ["unit", "name"], [("unit", False)]),
    "targets": (
        "mst_targets",
        ["kpi", "target", "active", "active_from", "active_to"],
        [("kpi", False)],
    ),
    "phishing": ("mst_phishing", ["campaign_id", "name", "active"], [("name", False)]),
    "training": ("mst_training", ["name", "active", "type"], [("name", False)]),
    "log": ("log", ["timestamp", "source", "severity", "line"], [("timestamp", True)]),
    "status": (
        "source_status",
        ["source", "run_date", "max_fetches", "fetched_today", "finished"],
        [("source", False)],
    ),
}


def listing(store: MartStore, name: str) -> DataFrame:
    table, columns, order_by = LISTINGS[name]
    rows = load_status(store) if table == "source_status" else store.read(table)
    return reports.sorted_listing(rows, columns, order_by)


def phishing_report(store: MartStore, name: str, type_of: Column | None = None) -> DataFrame:
    """``templates``, ``template_types``, ``error_type`` or ``top_10``.

    The mart stores no template type; ``type_of`` derives it from a template row.
    """
    fact = reports.current_results(
        store.read("fact_recipient"), store.read("dim_user"), ["pst_id"]
    )
    templates = store.read("dim_template")
    if name == "templates":
        return reports.report_templates(fact, templates)
    if name == "template_types":
        if type_of is None:
            raise ValueError("template_types needs type_of")
        return reports.report_template_types(fact, templates, type_of)
    if name == "error_type":
        return reports.report_error_totals(fact)
    if name == "top_10":
        return reports.report_top10(fact, templates)
    raise ValueError(f"unknown report {name}")


def security_dashboard(
    store: MartStore, grain: str, completed: str, per_unit: bool = False
) -> DataFrame:
    """The dashboard by ``day``, ``week`` or ``month``, overall or per unit.

    ``completed`` is the enrolment status that counts as done.
    """
    types = store.read("dim_campaign").select("campaign_key", "campaign_type")
    enrollments = store.read("fact_enrollment").join(types, "campaign_key")
    people = store.read("dim_user")
    rows = dashboards.measures(
        reports.current_results(store.read("fact_snapshot"), people, ["snapshot_date_key"]),
        reports.current_results(store.read("fact_recipient"), people, ["pst_id"]),
        enrollments,
        completed,
    )
    dates = store.read("dim_date")
    if not per_unit:
        return dashboards.dashboard(rows, dates, grain)
    units = store.read("dim_unit").selectExpr("unit_key", "unit_naam as Unit_naam")
    membership = store.read("bridge_user_unit").join(units, "unit_key")
    return dashboards.unit_dashboard(rows, membership, dates, grain)
