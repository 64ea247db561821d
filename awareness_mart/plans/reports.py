"""Reports on the phishing results, and sorted listings.

The reports were known by name, columns and sort order only; their definitions
are choices of this module, kept together so they can be replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error totals and the flags they add up. Delivered, opened and reported are no errors.
ERRORS = {
    "Total_clicked": "clicks_count",
    "Total_replied": "replies_count",
    "Total_attachments_opened": "attachments_opened",
    "Total_data_entered": "data_entered",
    "Total_macro_enabled": "macro_enabled",
    "Total_qr_code_scanned": "qr_code_scanned",
}


def current_results(fact: DataFrame, dim_user: DataFrame, per: list[str]) -> DataFrame:
    """Fact rows without those that a newer version of the same person repeats.

    A changed e-mail gives a person a new key and their results a second row. Of each
    person and ``per`` (a test, a day) the row of the newest version counts. Only people
    with a closed version can have several, so all other rows pass one anti join.
    """
    closed = dim_user.filter(~F.col("is_current")).select("user_id").distinct()
    versions = dim_user.join(closed, "user_id", "left_semi").select(
        "user_key",
        F.col("user_id").alias("_person"),
        F.struct("effective_from", "user_key").alias("_version"),
    )
    touched = fact.join(versions, "user_key")
    newest = touched.groupBy("_person", *per).agg(F.max("_version").alias("_version"))
    kept = touched.join(newest, ["_person", *per, "_version"], "left_semi")
    rest = fact.join(versions, "user_key", "left_anti")
    return rest.unionByName(kept.select(*fact.columns))


def _totals() -> list[Column]:
    return [F.sum(flag).cast("long").alias(total) for total, flag in ERRORS.items()]


def _total_all() -> Column:
    return sum((F.col(c) for c in ERRORS), F.lit(0).cast("long")).alias("Total_all")


def _by_template(fact: DataFrame, templates: DataFrame, key: str) -> DataFrame:
    """Totals per template name. Facts are summed per template key before the join."""
    sums = fact.groupBy(key).agg(*_totals())
    named = sums.join(templates.select(key, F.col("template_name").alias("Template_name")), key)
    return named.groupBy("Template_name").agg(*[F.sum(c).alias(c) for c in ERRORS])


def report_templates(fact: DataFrame, templates: DataFrame, key: str = "template_key") -> DataFrame:
    """Which templates catch people most."""
    totals = _by_template(fact, templates, key).select("Template_name", *ERRORS, _total_all())
    return totals.orderBy(F.desc("Total_all"), "Template_name")


def report_template_types(
    fact: DataFrame, templates: DataFrame, type_of: Column, key: str = "template_key"
) -> DataFrame:
    """Occurrences and errors per template type; ``type_of`` reads the type off a template row."""
    sums = fact.groupBy(key).agg(F.count(F.lit(1)).alias("Occurrences"), *_totals())
    typed = sums.join(templates.select(key, type_of.alias("Template_type")), key)
    return (
        typed.groupBy("Template_type")
        .agg(
            F.sum("Occurrences").alias("Occurrences"),
            F.sum(_total_all()).alias("Total_reactions"),
        )
        .orderBy(F.desc("Total_reactions"), "Template_type")
    )


def report_error_totals(fact: DataFrame) -> DataFrame:
    """One row with the total of every error."""
    return fact.agg(*_totals()).orderBy("Total_clicked")


def report_top10(
    fact: DataFrame, templates: DataFrame, key: str = "template_key", top: int = 10
) -> DataFrame:
    """The largest totals over templates and errors."""
    long = _by_template(fact, templates, key).unpivot(
        "Template_name", list(ERRORS), "Error", "Total"
    )
    return long.orderBy(F.desc("Total"), "Template_name", "Error").limit(top)


def sorted_listing(
    table: DataFrame, columns: Sequence[str], order_by: Sequence[tuple[str, bool]]
) -> DataFrame:
    """Chosen columns, sorted by (column, descending) pairs.

    The remaining columns break ties, so rows that share the sort key can still
    be spread over tasks and the order is always the same.
    """
    keys = [F.desc(c) if descending else F.asc(c) for c, descending in order_by]
    given = {c for c, _ in order_by}
    return table.select(*columns).orderBy(*keys, *[F.asc(c) for c in columns if c not in given])
