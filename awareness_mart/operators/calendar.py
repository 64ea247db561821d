"""Calendar rows and date keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key, iso_year

# Default range, fixed values.
FIRST_DAY = date(2015, 1, 1)
LAST_DAY = date(2035, 12, 31)


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame with one column ``date``. Weeks are ISO weeks."""
    day = F.col("date")
    return days.select(
        date_key(day).alias("date_key"),
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.quarter(day).alias("quarter"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        iso_year(day).alias("iso_year"),
    )


def calendar(spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY) -> DataFrame:
    """One row per day, both ends included."""
    if end < start:
        raise ValueError(f"calendar ends ({end}) before it starts ({start})")
    span = spark.range(1).select(F.sequence(F.lit(start), F.lit(end)).alias("days"))
    return describe_days(span.select(F.explode("days").alias("date")))


def calendar_over(days: DataFrame) -> DataFrame:
    """The calendar from the first to the last day in column ``date`` of ``days``."""
    span = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return describe_days(span.select(F.explode(F.sequence("first", "last")).alias("date")))


def with_date_key(df: DataFrame, day: str, dates: DataFrame, name: str) -> DataFrame:
    """Add the key of a day as ``name``: NULL for NULL and for days outside the calendar."""
    known = dates.select(F.col("date").alias("_day"), F.col("date_key").alias(name))
    return df.join(known, F.col(day).cast("date") == F.col("_day"), "left").drop("_day")


def require_day(dates: DataFrame, day: date) -> int:
    """Key of ``day``; an error when the calendar lacks it."""
    rows = dates.filter(F.col("date") == F.lit(day)).select("date_key").head(1)
    if not rows:
        raise ValueError(f"the calendar has no record for {day}")
    return rows[0].date_key
