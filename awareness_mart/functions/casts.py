"""Casts that turn anything unreadable into NULL instead of failing the feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast also reads Java forms such as '1.0d' or '0x1p3'; a feed value
# in one of those forms is not a number.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"(?i)^\s*[+-]?(nan|inf|infinity|({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})"
    rf"(e[+-]?{_DIGITS})?)\s*$"
)
_DAY = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"


def lenient_double(text: Column) -> Column:
    """Text to double; empty and unparsable values become NULL.

    Single underscores between digits group thousands and are accepted.
    """
    plain = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(text.rlike(_NUMBER), plain.try_cast("double"))


def lenient_date(text: Column) -> Column:
    """First ten characters as year-month-day; bad dates become NULL.

    Month and day may lack their leading zero. The time of day is dropped.
    """
    day = F.left(text, F.lit(10))
    return F.when(day.rlike(_DAY), day.try_cast("date"))
