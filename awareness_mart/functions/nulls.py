"""NULL rules used by the loads."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(column: Column) -> Column:
    """1 when a value is present, else 0."""
    return column.isNotNull().cast("int")


def differs(left: Column, right: Column, null_as: Any) -> Column:
    """True when two values differ, with NULL standing for ``null_as``.

    NULL and the sentinel are the same value here, so this is deliberately not
    a null-safe comparison.
    """
    sentinel = F.lit(null_as)
    return F.coalesce(left, sentinel) != F.coalesce(right, sentinel)


def any_differs(left: str, right: str, tracked: dict[str, Any]) -> Column:
    """``differs`` over several columns of two aliased frames."""
    tests = [differs(F.col(f"{left}.{c}"), F.col(f"{right}.{c}"), s) for c, s in tracked.items()]
    return reduce(lambda a, b: a | b, tests)


def exact(column: Column) -> Column:
    """Text keys as they are: case and trailing blanks count."""
    return column


def loose(column: Column) -> Column:
    """Text keys without trailing blanks and in lower case."""
    return F.lower(F.rtrim(column))


def blank_to_null(column: Column) -> Column:
    """Strip surrounding white space; nothing left means NULL."""
    return F.nullif(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""), F.lit(""))


def default_if_blank(column: Column, default: str) -> Column:
    """``default`` for NULL, empty and blank-only text; other values as they are."""
    return F.when(F.rtrim(F.coalesce(column, F.lit(""))) == "", F.lit(default)).otherwise(column)


def strict_mean(total: Column, present: Column, rows: Column, places: int = 2) -> Column:
    """Mean of a group that is NULL as soon as one member is NULL.

    ``total`` is an exact decimal sum, ``present`` counts the non-NULL members
    and ``rows`` counts all of them. Rounding happens on decimals.
    """
    mean = F.round(F.try_divide(total, rows.cast("decimal(20,0)")), places)
    return F.when(present == rows, mean.cast(f"decimal(18,{places})"))
