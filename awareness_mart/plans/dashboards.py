"""Security dashboards per day, week or month, overall and per unit.

The definitions are choices, kept in this module: averages of the period's
snapshot rows, and percentages that run from the first period to the current
one. A period appears when any of the three facts has a row in it. A running
percentage without anything to divide by is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAINS = {
    "day": {"Year": "year", "Month": "month", "Day": "day"},
    "week": {"Year": "iso_year", "Week": "week"},
    "month": {"Year": "year", "Month": "month"},
}

# Percentages and scores are summed as whole ten-thousandths, their finest unit:
# exact like decimals, but in machine integers.
_UNIT = 10000


def _units(column: str) -> Column:
    return (F.col(column) * _UNIT).cast("long")


def _count(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


class Measures(NamedTuple):
    """The three facts as rows of user_key, date_key and their own measures."""

    snapshots: DataFrame
    recipients: DataFrame
    enrollments: DataFrame


def measures(
    snapshots: DataFrame, recipients: DataFrame, enrollments: DataFrame, completed: str
) -> Measures:
    """The measures of the three facts.

    ``enrollments`` carry their campaign type; ``completed`` is the status that
    counts as done. Rows without a date are left out: they belong to no period.
    """
    done = F.col("status") == completed
    training, policy = F.col("campaign_type") == "training", F.col("campaign_type") == "policy"
    return Measures(
        snapshots.select(
            "user_key",
            F.col("snapshot_date_key").alias("date_key"),
            _units("phish_prone_pct").alias("prone_sum"),
            _count(F.col("phish_prone_pct").isNotNull()).alias("prone_n"),
            _units("current_risk_score").alias("risk_sum"),
            _count(F.col("current_risk_score").isNotNull()).alias("risk_n"),
        ),
        recipients.filter(F.col("started_date_key").isNotNull()).select(
            "user_key",
            F.col("started_date_key").alias("date_key"),
            F.col("delivered_count").cast("long").alias("delivered"),
            F.col("reported_count").cast("long").alias("reported"),
        ),
        enrollments.filter(F.col("enrollment_date_key").isNotNull()).select(
            "user_key",
            F.col("enrollment_date_key").alias("date_key"),
            _count(training).alias("training_enrolled"),
            _count(training & done).alias("training_completed"),
            _count(policy).alias("policy_enrolled"),
            _count(policy & done).alias("policy_read"),
        ),
    )


def _sum_by(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sum everything that is not a key, a period or a unit."""
    keys = {"user_key", "date_key", *by}
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def running_pct(part: str, whole: str, window) -> Column:
    """100 * part / whole, both summed up to and including the current row."""
    done = F.sum(part).over(window).cast("double")
    return F.try_divide(done * 100, F.sum(whole).over(window).cast("double"))


def _with_periods(daily: DataFrame, dates: DataFrame, grain: str, by: list[str]) -> DataFrame:
    """Add up days to periods; ``daily`` has a row per fact and day (and unit)."""
    columns = GRAINS[grain]
    days = dates.select("date_key", *[F.col(c).alias(name) for name, c in columns.items()])
    return _sum_by(daily.join(days, "date_key"), [*by, *columns])


def _present(periods: DataFrame, grain: str, by: list[str]) -> DataFrame:
    columns = [*by, *GRAINS[grain]]
    window = (
        Window.partitionBy(*by)
        .orderBy(*GRAINS[grain])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def mean(total: str, rows: str) -> Column:
        exact = (F.col(total).cast("decimal(19,0)") * Decimal("0.0001")).cast("double")
        return F.try_divide(exact, F.col(rows).cast("double"))

    return periods.select(
        *columns,
        mean("prone_sum", "prone_n").alias("Avg_phish_prone"),
        mean("risk_sum", "risk_n").alias("Avg_risk_score"),
        running_pct("reported", "delivered", window).alias("Pct_response_cum"),
        running_pct("training_completed", "training_enrolled", window).alias(
            "pct_training_completed_cum"
        ),
        running_pct("policy_read", "policy_enrolled", window).alias("Pct_policy_read_cum"),
    ).orderBy(*columns)


def dashboard(facts: Measures, dates: DataFrame, grain: str) -> DataFrame:
    """The dashboard over everybody.

    Every fact is summed per day before anything else; the running window, which
    has no partition, then sees one row per period of the calendar.
    """
    daily = _stack(_sum_by(rows, ["date_key"]) for rows in facts)
    return _present(_with_periods(daily, dates, grain, []), grain, [])


def unit_dashboard(
    facts: Measures, membership: DataFrame, dates: DataFrame, grain: str
) -> DataFrame:
    """The dashboard per unit. ``membership``: user_key, Unit_naam, start_date_key, end_date_key.

    A row counts for the units its user belongs to on that day, from the start
    of the membership up to but not including its end.

    Each fact is summed per user and day before the one membership join, so a user
    brings one row per fact and day into it and one busy user cannot fill a task. The
    facts are stacked only then: a sum of a fact's own measures takes half the memory of
    one that carries those of all three.
    """
    unit = "Unit_naam"
    valid = (F.col("start_date_key") <= F.col("date_key")) & (
        F.col("end_date_key").isNull() | (F.col("date_key") < F.col("end_date_key"))
    )
    spans = membership.select("user_key", unit, "start_date_key", "end_date_key")
    person_days = _stack(_sum_by(rows, ["user_key", "date_key"]) for rows in facts)
    members = person_days.join(spans, "user_key").filter(valid)
    daily = _sum_by(members.drop("start_date_key", "end_date_key"), [unit, "date_key"])
    return _present(_with_periods(daily, dates, grain, [unit]), grain, [unit])
