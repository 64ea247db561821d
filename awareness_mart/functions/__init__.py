"""Column expressions: lenient casts, hashes, NULL rules, dates."""

from .casts import lenient_date, lenient_double
from .dates import add_years, date_key, first_of_month, iso_year, last_of_previous_month, ntz
from .hashing import person_key, row_hash_delimited, row_hash_plain, row_hash_strict
from .nulls import (
    any_differs,
    blank_to_null,
    default_if_blank,
    differs,
    exact,
    flag,
    loose,
    strict_mean,
)

__all__ = [
    "add_years",
    "any_differs",
    "blank_to_null",
    "date_key",
    "default_if_blank",
    "differs",
    "exact",
    "first_of_month",
    "flag",
    "iso_year",
    "last_of_previous_month",
    "lenient_date",
    "lenient_double",
    "loose",
    "ntz",
    "person_key",
    "row_hash_delimited",
    "row_hash_plain",
    "row_hash_strict",
    "strict_mean",
]
