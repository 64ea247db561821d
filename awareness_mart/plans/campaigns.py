"""The campaign source: retained phishing campaigns and typed training campaigns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import add_years
from ..operators.calendar import with_date_key
from ..operators.prefix import prefix_join

RETENTION_YEARS = 2  # fixed value


def campaign_summary(tests: DataFrame) -> DataFrame:
    """One row per phishing campaign over its tests. A missing duration counts as no days."""
    start = F.to_date("started_at")
    end = F.date_add(start, F.coalesce(F.col("duration_days"), F.lit(0)))
    return tests.groupBy("campaign_id").agg(
        F.min("name").alias("name"),
        F.max("status").alias("status"),
        F.min(start).alias("start_date"),
        F.max(end).alias("campaign_end_date"),
    )


def phishing_retained(tests: DataFrame, masters: DataFrame, run_date: date) -> DataFrame:
    """Campaigns whose master is active and whose end is at most two years back."""
    active = masters.filter("active").select("campaign_id")
    cutoff = add_years(F.lit(run_date), -RETENTION_YEARS)
    # The master filter goes below the aggregate: tests of inactive campaigns
    # need not be shuffled.
    kept = tests.join(active, "campaign_id", "left_semi")
    return campaign_summary(kept).filter(F.col("campaign_end_date") >= cutoff)


def typed_training(training: DataFrame, masters: DataFrame) -> DataFrame:
    """Training campaigns with their type, policy or training.

    A campaign whose name starts with no known prefix is a training. One that
    matches prefixes of both types gives two rows.
    """
    named = masters.select(F.col("name").alias("_master"), F.col("type").alias("_type"))
    kind = F.when(F.upper("_type") == "P", "policy").otherwise("training")
    return (
        prefix_join(training, "name", named, "_master", how="left")
        .withColumn("campaign_type", kind)
        .groupBy("campaign_id", "campaign_type")
        .agg(
            F.min("name").alias("name"),
            F.max("status").alias("status"),
            F.min("start_date").alias("start_date"),
        )
    )


def campaign_source(
    tests: DataFrame,
    md_phishing: DataFrame,
    training: DataFrame,
    md_training: DataFrame,
    dates: DataFrame,
    run_date: date,
) -> DataFrame:
    """Both kinds together, with the date key of their start."""
    columns = ["campaign_id", "campaign_type", "name", "status", "start_date"]
    phishing = phishing_retained(tests, md_phishing, run_date).withColumn(
        "campaign_type", F.lit("phishing")
    )
    both = phishing.select(*columns).unionByName(
        typed_training(training, md_training).select(*columns)
    )
    return with_date_key(both, "start_date", dates, "start_date_key").drop("start_date")


