"""Master data: staging with row hash, and replacing a master from edited rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, ntz, row_hash_delimited
from ..operators.changes import unique_or_fail
from .store import MartStore


def _active_digit():
    return F.when(F.col("active"), F.lit("1")).otherwise(F.lit("0"))


def stage_units(units: DataFrame, run_ts: datetime) -> DataFrame:
    """``units``: unit, name."""
    return units.select(
        F.col("unit").alias("unit_code"),
        F.col("name").alias("unit_name"),
        ntz(run_ts).alias("load_ts"),
        row_hash_delimited(F.col("unit"), F.col("name")).alias("hash_row"),
    )


def stage_training_names(names: DataFrame, run_ts: datetime) -> DataFrame:
    """``names``: name, active, type."""
    return names.select(
        "name",
        "active",
        "type",
        ntz(run_ts).alias("load_ts"),
        row_hash_delimited(F.col("name"), _active_digit(), F.col("type")).alias("hash_row"),
    )


def stage_phishing_campaigns(campaigns: DataFrame, run_ts: datetime) -> DataFrame:
    """``campaigns``: campaign_id, name, active."""
    return campaigns.select(
        "campaign_id",
        "name",
        "active",
        ntz(run_ts).alias("load_ts"),
        row_hash_delimited(F.col("campaign_id"), F.col("name"), _active_digit()).alias("hash_row"),
    )


# Key of each master, and what else must not be NULL. Fixed values.
MASTER_KEYS = {
    "mst_units": ("unit", []),
    "mst_training": ("name", ["active"]),
    "mst_phishing": ("campaign_id", ["active"]),
    "mst_targets": ("kpi", ["active"]),
}


def checked_master(rows: DataFrame, table: str) -> DataFrame:
    """The same rows; the job fails at a key that is NULL or repeated, or a required NULL."""
    key, required = MASTER_KEYS[table]
    rows = unique_or_fail(rows, [key])
    for column in required:
        missing = F.raise_error(F.lit(f"{table}.{column} is NULL")).cast("boolean")
        rows = rows.filter(F.when(F.col(column).isNotNull(), True).otherwise(missing))
    return rows


def edited_rows(rows: DataFrame) -> DataFrame:
    """Rows as typed in: text stripped, blank to NULL, all-blank rows left out."""
    cleaned = rows.select(
        *[
            blank_to_null(F.col(name)).alias(name) if kind == "string" else F.col(name)
            for name, kind in rows.dtypes
        ]
    )
    return cleaned.dropna("all")


def replace_master(store: MartStore, table: str, rows: DataFrame) -> None:
    """Replace a master table by edited rows. Readers see the old rows until all are written.

    A key that is NULL or occurs twice fails the write, and nothing is published.
    """
    store.write(table, checked_master(edited_rows(rows), table))
    store.publish()
