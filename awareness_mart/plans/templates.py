"""The insert-only template dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ntz
from ..operators.changes import missing_from


def template_candidates(recipients: DataFrame) -> DataFrame:
    """Distinct (template_id, template) pairs that carry an id."""
    return recipients.filter(F.col("template_id").isNotNull()).select(
        "template_id", "template"
    ).distinct()


def new_templates(dim_template: DataFrame, recipients: DataFrame, run_ts: datetime) -> DataFrame:
    """Rows to add: ids without a current row. Renames are ignored.

    An id that comes with two names gets one row, under the smaller name. The
    pairs are made distinct first, so the names compared are few.
    """
    named = (
        template_candidates(recipients)
        .groupBy("template_id")
        .agg(F.min("template").alias("template_name"))
    )
    return missing_from(named, dim_template.filter("is_current"), ["template_id"]).select(
        "template_id",
        "template_name",
        ntz(run_ts).alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
