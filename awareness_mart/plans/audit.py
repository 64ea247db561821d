"""Integrity checks for the constraints that parquet tables do not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicates(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of the child that the parent lacks, with their number of rows; NULL is allowed.

    Child rows are counted per key first, so the join sees every key once.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def domain(
    table: DataFrame, allowed: dict[str, Sequence] | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """Rows per problem: values outside the allowed ones, and missing required values."""
    checks = {
        f"{column} not allowed": F.coalesce(~F.col(column).isin(list(values)), F.lit(False))
        for column, values in (allowed or {}).items()
    }
    checks |= {f"{column} missing": F.col(column).isNull() for column in required}
    names = list(checks)
    counts = table.agg(*[F.count_if(checks[name]).alias(name) for name in names])
    pairs = [
        F.struct(F.lit(name).alias("problem"), F.col(f"`{name}`").alias("n_rows"))
        for name in names
    ]
    return counts.select(F.inline(F.array(*pairs)))


def scd2_shape(dim: DataFrame, key: list[str]) -> DataFrame:
    """Natural keys whose versions are not a proper history, with each problem's count.

    Problems: more than one current version, a version that ends before it
    starts, a version that reaches into the next one.

    Versions that start at the same moment are merged before the shuffle. The
    next start is looked up inside the day first, then over the days of the key,
    so no task holds more of one key than the moments of one day or the days of
    the calendar.
    """
    starts = dim.groupBy(*key, "effective_from").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if("is_current").alias("current_rows"),
        F.count_if(F.col("effective_to") < F.col("effective_from")).alias("backward"),
        F.count_if(F.col("effective_to").isNull()).alias("open_rows"),
        F.max("effective_to").alias("last_end"),
    )
    day = F.to_date("effective_from")
    by_day = Window.partitionBy(*key, "_day")
    inside = starts.withColumn("_day", day).withColumns(
        {"_next": F.lead("effective_from").over(by_day.orderBy("effective_from"))}
    )
    days = (
        starts.groupBy(*key, day.alias("_day"))
        .agg(F.min("effective_from").alias("_first"))
        .withColumn("_next_day", F.lead("_first").over(Window.partitionBy(*key).orderBy("_day")))
        .drop("_first")
    )
    following = F.coalesce(F.col("_next"), F.col("_next_day"))
    reaches = (F.col("copies") > 1) | (
        following.isNotNull() & ((F.col("open_rows") > 0) | (F.col("last_end") > following))
    )
    problems = (
        inside.join(days, [*key, "_day"])
        .groupBy(*key)
        .agg(
            F.sum("current_rows").alias("current_rows"),
            F.sum("backward").alias("ends_before_start"),
            F.count_if(reaches).alias("overlaps"),
        )
    )
    return problems.filter("current_rows > 1 or ends_before_start > 0 or overlaps > 0")


def stale_bridge_rows(bridge: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Current memberships of users whose dimension row is no longer current.

    A changed person key opens a new user row; the membership of the old one is
    never closed by the load.
    """
    live = dim_user.filter("is_current").select("user_key")
    return bridge.filter("is_current").join(live, "user_key", "left_anti")


def all_duplicates(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Number of repeated keys per table."""
    parts = [
        duplicates(rows, key)
        .agg(F.count(F.lit(1)).alias("repeated_keys"), F.sum("copies").alias("n_rows"))
        .select(
            F.lit(name).alias("table"),
            "repeated_keys",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        )
        for name, (rows, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
