"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the highest ``order_col`` of each key.

    Rows of a key with the same ``order_col`` are ranked by their other columns, so
    the result is one of the rows and never depends on their order. As an aggregate
    this keeps one row per key and map task before the shuffle, so a key that holds a
    large part of the rows stays cheap.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    best = df.groupBy(*keys).agg(F.max(F.struct(order_col, *rest)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in (order_col, *rest)])
