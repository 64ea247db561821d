"""Fixture feeds in the nested form a feed is landed in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from awareness_mart.schemas import RECIPIENT_EVENTS
from awareness_mart.sources.store import scratch_dir, tidy

from .fixtures import Tables


def _moment(day: Column) -> Column:
    return F.concat(F.to_date(day).cast("string"), F.lit("T08:30:00.000Z"))


def users(t: Tables, *others: str) -> DataFrame:
    """People with a high balance lost their id, some of the others their e-mail."""
    return t("fx_users").select(
        *others,
        F.when(F.col("balance") <= 9000, F.col("user_id")).alias("id"),
        F.when(F.col("balance") >= -500, F.col("email")).alias("email"),
        F.coalesce(F.col("phish_prone_pct").cast("string"), F.lit("")).alias(
            "phish_prone_percentage"
        ),
        F.when(F.col("segment") == "BUILDING", "archived")
        .when(F.col("segment") != "MACHINERY", "active")
        .alias("status"),
    )


def all_users(t: Tables) -> DataFrame:
    return t("fx_users").select(
        F.col("user_id").alias("id"),
        "email",
        F.col("phish_prone_pct").cast("string").alias("phish_prone_percentage"),
        F.lit("active").alias("status"),
    )


def user_detail(t: Tables) -> DataFrame:
    return t("fx_user_detail").select(
        F.col("user_id").alias("id"), F.col("current_risk_score").cast("string")
    )


def tests(t: Tables) -> DataFrame:
    return t("fx_pst").select(
        F.when(F.col("campaign_id") != 7, F.col("campaign_id")).alias("campaign_id"),
        "pst_id",
        "status",
        "name",
        _moment(F.col("started_at")).alias("started_at"),
        F.col("duration_days").alias("duration"),
    )


def all_tests(t: Tables) -> DataFrame:
    return tests(t).withColumn("campaign_id", F.coalesce("campaign_id", F.lit(7)))


def recipients(t: Tables) -> DataFrame:
    """Recipients with a scanned QR code lost their template."""
    return _recipients(t, F.col("qr_code_scanned_at").isNull())


def all_recipients(t: Tables) -> DataFrame:
    return _recipients(t, F.lit(True))


def _recipients(t: Tables, has_template: Column) -> DataFrame:
    named = t("fx_recipients").join(
        t("fx_templates").select("template_id", "template_name"), "template_id", "left"
    )
    template = F.struct(F.col("template_id").alias("id"), F.col("template_name").alias("name"))
    return named.select(
        "pst_id",
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.when(has_template, template).alias("template"),
        *[
            _moment(F.col(event)).alias(event.replace("scanned_at", "scanned"))
            for event in RECIPIENT_EVENTS
        ],
    )


def training(t: Tables) -> DataFrame:
    return t("fx_training").select(
        "campaign_id", "name", "status", F.col("start_date").cast("string").alias("start_date")
    )


def enrollments(t: Tables) -> DataFrame:
    return t("fx_enrollments").select(
        "enrollment_id",
        F.struct(F.col("user_id").alias("id")).alias("user"),
        _moment(F.col("enrollment_date")).alias("enrollment_date"),
        "status",
        "campaign_id",
    )


# Landed records are text that repeats the same names and dates: compressed, as an HTTP client
# receives them. Files of so many records are what one task reads.
_FILES = {"compression": "gzip", "maxRecordsPerFile": 500_000}


def land_damaged(t: Tables, rows: DataFrame, damaged: Column) -> str:
    """Write a feed as JSON lines of which some are cut off in the middle."""
    path = scratch_dir(t.spark)
    line = F.to_json(F.struct(*rows.columns))
    cut = F.when(damaged, F.expr("left(line, length(line) - 3)")).otherwise(F.col("line"))
    with tidy(t.spark):
        rows.withColumn("line", line).select(cut.alias("value")).write.options(**_FILES).text(path)
    return path


def land(t: Tables, rows: DataFrame, by: str | None = None) -> str:
    """Write a feed as JSON to a new shared folder and return its path.

    With ``by`` the rows go to one directory per value; the rebalance hint
    splits a value that holds much more rows than the others over several files.
    """
    path = scratch_dir(t.spark)
    with tidy(t.spark):
        if by:
            rows.hint("rebalance", by).write.options(**_FILES).partitionBy(by).json(path)
        else:
            rows.write.options(**_FILES).json(path)
    return path
