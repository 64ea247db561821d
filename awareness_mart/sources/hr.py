"""Extract from the HR system: who is employed in which unit."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import default_if_blank, first_of_month, ntz, person_key, row_hash_strict

UNKNOWN_UNIT = "Onbekend"  # fixed value


def employed_on(day: date) -> Column:
    """In service on ``day``. An open (NULL) end date does not count as employed."""
    return (F.col("in_service") <= F.lit(day)) & (F.col("out_service") > F.lit(day))


def active_hr_units(
    staff: DataFrame, units: DataFrame, run_ts: datetime, charset: str = "UTF-8"
) -> DataFrame:
    """Internal staff employed on the first of the run's month, with their unit name.

    ``staff``: email, unit_code, in_service, out_service, kind.
    ``units``: unit_id, unit_name.
    """
    named = (
        staff.filter(employed_on(first_of_month(run_ts)) & (F.col("kind") == "I"))
        .join(units, F.col("unit_code") == F.col("unit_id"), "left")
        .select("email", default_if_blank(F.col("unit_name"), UNKNOWN_UNIT).alias("unit"))
    )
    return named.select(
        person_key(F.col("email"), charset).alias("ehash"),
        "unit",
        ntz(run_ts).alias("load_ts"),
        row_hash_strict(F.col("email"), F.col("unit")).alias("hash_row"),
    )
