"""Date arithmetic. The run time is always passed in, never read from a clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_year(day: Column) -> Column:
    """Year that the ISO week of ``day`` belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def add_years(day: Column, years: int) -> Column:
    """Same day ``years`` later; 29 February falls back to the 28th."""
    return F.add_months(day, 12 * years)


def ntz(moment: datetime) -> Column:
    """Literal timestamp without zone, whatever the session zone is."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def first_of_month(run: date | datetime) -> date:
    return date(run.year, run.month, 1)


def last_of_previous_month(run: date | datetime) -> date:
    return date.fromordinal(first_of_month(run).toordinal() - 1)
