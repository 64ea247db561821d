"""Surrogate keys for new rows, without a global sort or a counter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Slots are dealt to tasks by another hash; several a task even out what each gets.
SLOTS_PER_TASK = 16


def highest_key(table: DataFrame, surrogate: str) -> Column:
    """Largest key in use, 0 for an empty table, as a scalar subquery."""
    return table.select(F.coalesce(F.max(surrogate), F.lit(0)).cast("long")).scalar()


def assign_keys(
    rows: DataFrame, surrogate: str, natural_key: list[str], after: Column | int
) -> DataFrame:
    """Give every row a key above ``after``.

    Rows are spread over slots by a hash of their natural key, which must be
    unique, and numbered inside the slot in key order; slot ``i`` of ``n`` takes
    the numbers ``i + 1, i + 1 + n, ...``. The keys depend on the rows alone, so
    a task repeated after a lost executor gives the same ones. Like an identity
    column the numbers may have gaps.
    """
    slots = SLOTS_PER_TASK * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = F.lit(after).cast("long") if isinstance(after, int) else after
    slot = F.pmod(F.xxhash64(*natural_key), F.lit(slots).cast("long"))
    number = F.row_number().over(Window.partitionBy("_slot").orderBy(*natural_key)).cast("long")
    columns = [c for c in rows.columns if c != surrogate]
    keyed = rows.select(*columns, slot.alias("_slot")).withColumn("_number", number)
    key = start + 1 + F.col("_slot") + (F.col("_number") - 1) * slots
    return keyed.select(key.alias(surrogate), *columns)


def fill_keys(
    rows: DataFrame, surrogate: str, natural_key: list[str], after: Column | int
) -> DataFrame:
    """Key the rows that have none; existing keys stay as they are."""
    fresh = assign_keys(rows.filter(F.col(surrogate).isNull()), surrogate, natural_key, after)
    return rows.filter(F.col(surrogate).isNotNull()).unionByName(fresh)
