"""The declared constraints of the mart's tables, and one audit of them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import MartStore

# Primary and unique keys.
KEYS: dict[str, list[list[str]]] = {
    "stg_users": [["user_id"]],
    "stg_user_detail": [["user_id", "load_ts"]],
    "stg_pst": [["pst_id"]],
    "stg_recipient": [["pst_id", "user_id"]],
    "stg_training": [["campaign_id"]],
    "stg_enrollment": [["enrollment_id"]],
    "stg_hr": [["ehash"]],
    "stg_md_units": [["unit_code"]],
    "stg_md_training": [["name"]],
    "stg_md_phishing": [["campaign_id"]],
    "dim_user": [["user_key"], ["user_id", "effective_from"]],
    "dim_campaign": [["campaign_key"], ["campaign_id", "campaign_type", "effective_from"]],
    "dim_template": [["template_key"], ["template_id", "effective_from"]],
    "dim_date": [["date_key"], ["date"]],
    "dim_unit": [["unit_key"], ["unit_code", "effective_from"]],
    "fact_recipient": [["pst_recipient_key"]],
    "fact_enrollment": [["enrollment_key"]],
    "fact_snapshot": [["snapshot_key"], ["user_key", "snapshot_date_key"]],
    "bridge_user_unit": [["user_key", "unit_key", "start_date_key"]],
    "mst_units": [["unit"]],
    "mst_training": [["name"]],
    "mst_phishing": [["campaign_id"]],
    "mst_targets": [["kpi"]],
    "log": [["timestamp"]],
    "source_status": [["source"]],
    "status_events": [],
    "usage_events": [],
    "load_counts": [["run_ts", "feed"]],
    "history_units": [["date", "unit"]],
    "history_total": [["date"]],
}

# Columns that are not NULL, besides those of the keys above.
REQUIRED: dict[str, list[str]] = {
    "stg_users": ["load_ts"],
    "stg_pst": ["campaign_id", "load_ts"],
    "stg_recipient": ["template_id", "load_ts"],
    "stg_training": ["load_ts"],
    "stg_enrollment": ["campaign_id", "user_id", "load_ts"],
    "stg_hr": ["load_ts"],
    "stg_md_units": ["unit_name", "load_ts"],
    "stg_md_training": ["active", "load_ts"],
    "stg_md_phishing": ["active", "load_ts"],
    "dim_user": ["is_current"],
    "dim_campaign": ["is_current"],
    "dim_template": ["template_name", "is_current"],
    "dim_date": ["year", "month", "day"],
    "dim_unit": ["unit_naam", "is_current"],
    "fact_recipient": ["user_key", "campaign_key", "pst_id", "load_ts"],
    "fact_enrollment": ["user_key", "campaign_key", "enrollment_id", "load_ts"],
    "fact_snapshot": ["load_ts"],
    "bridge_user_unit": ["is_current"],
    "mst_training": ["active"],
    "mst_phishing": ["active"],
    "mst_targets": ["active"],
    "source_status": ["finished"],
    "status_events": ["source", "run_date", "finished", "at"],
    "usage_events": ["source", "run_date", "calls", "at"],
}

# Foreign keys, column to (table, column).
REFERENCES: dict[str, dict[str, tuple[str, str]]] = {
    "dim_campaign": {"start_date_key": ("dim_date", "date_key")},
    "fact_recipient": {
        "user_key": ("dim_user", "user_key"),
        "campaign_key": ("dim_campaign", "campaign_key"),
        "template_key": ("dim_template", "template_key"),
        "started_date_key": ("dim_date", "date_key"),
    },
    "fact_enrollment": {
        "user_key": ("dim_user", "user_key"),
        "campaign_key": ("dim_campaign", "campaign_key"),
        "enrollment_date_key": ("dim_date", "date_key"),
        "completion_date_key": ("dim_date", "date_key"),
    },
    "fact_snapshot": {
        "user_key": ("dim_user", "user_key"),
        "snapshot_date_key": ("dim_date", "date_key"),
    },
    "bridge_user_unit": {
        "user_key": ("dim_user", "user_key"),
        "unit_key": ("dim_unit", "unit_key"),
    },
}

# Allowed values.
ALLOWED = {"dim_campaign": {"campaign_type": ["training", "phishing", "policy"]}}


def _value(rows: DataFrame, columns: list[str]) -> Column:
    """The values of a key as one text, NULL as a value of its own."""
    kinds = dict(rows.dtypes)
    texts = [F.hex(c) if kinds[c] == "binary" else F.col(c).cast("string") for c in columns]
    return F.concat_ws("\x1f", *[F.coalesce(t, F.lit("\x00")) for t in texts])


def _entries(table: str, rows: DataFrame, given: set[str]) -> DataFrame:
    """What one scan of a table tells: its key values, what its rows refer to, its faults."""
    entries = []

    def add(kind: str, problem: str, label: str, value: Column, when: Column | None = None) -> None:
        entry = F.struct(
            F.lit(kind).alias("kind"),
            F.lit(problem).alias("problem"),
            F.lit(label).alias("label"),
            value.alias("value"),
        )
        entries.append(entry if when is None else F.when(when, entry))

    keys = KEYS.get(table, [])
    for key in keys:
        names = ", ".join(key)
        add("key", f"{names} repeated", f"{table}.{names}", _value(rows, key))
    required = dict.fromkeys([c for key in keys for c in key] + REQUIRED.get(table, []))
    for column in required:
        problem = f"{column} missing"
        add("fault", problem, f"{table}: {problem}", F.lit(""), F.col(column).isNull())
    for column, values in ALLOWED.get(table, {}).items():
        problem = f"{column} not allowed"
        add("fault", problem, f"{table}: {problem}", F.lit(""), ~F.col(column).isin(values))
    for column, (parent, parent_key) in REFERENCES.get(table, {}).items():
        if parent in given:
            problem, label = f"{column} not in {parent}", f"{parent}.{parent_key}"
            add("reference", problem, label, _value(rows, [column]), F.col(column).isNotNull())
    told = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("entry"))
    return told.select(F.lit(table).alias("table_name"), "entry.*")


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, problem, n_rows) per violated constraint of the given tables.

    A repeated key counts all its rows. NULL refers to nothing. A reference is checked
    if both tables are given. Every table is scanned once: its keys, references and faults
    are summed per value in each task, and a value's references meet its key in one shuffle.
    """
    told = reduce(
        DataFrame.unionByName, [_entries(table, rows, set(tables)) for table, rows in tables.items()]
    )
    counted = told.groupBy("label", "value", "table_name", "problem", "kind").agg(
        F.count(F.lit(1)).alias("n")
    )
    # A value has at most one sum per constraint that names its key.
    met = counted.groupBy("label", "value").agg(
        F.max(F.col("kind") == "key").alias("known"),
        F.collect_list(F.struct("table_name", "problem", "kind", "n")).alias("sums"),
    )
    bad = (
        (F.col("kind") == "fault")
        | ((F.col("kind") == "key") & (F.col("n") > 1))
        | ((F.col("kind") == "reference") & ~F.col("known"))
    )
    found = met.select("known", F.inline("sums")).filter(bad)
    return found.groupBy("table_name", "problem").agg(F.sum("n").alias("n_rows"))


def audit_mart(store: MartStore) -> DataFrame:
    """The violated constraints of all tables of a store, as published."""
    return violations({table: store.read(table) for table in KEYS})
