"""Person-unit membership with validity in date keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact

PAIR = ["user_key", "unit_key"]


def membership_pairs(
    hr: DataFrame,
    users: DataFrame,
    units: DataFrame,
    normalize: Callable[[Column], Column] = exact,
) -> DataFrame:
    """(user_key, unit_key) of the HR rows, over the current users and units.

    ``normalize`` says which unit names count as equal.
    """
    current_users = users.filter("is_current").select("user_key", "ehash")
    current_units = units.filter("is_current").select("unit_key", "unit_code")
    # People share an e-mail in some extracts: each unit of one counts once before the joins.
    members = hr.select("ehash", "unit").distinct()
    return (
        members.join(current_units, normalize(F.col("unit")) == normalize(F.col("unit_code")))
        .join(current_users, "ehash")
        .select(*PAIR)
        .distinct()
    )


def bridge_apply(
    bridge: DataFrame, pairs: DataFrame, live_users: DataFrame, day_key: int
) -> DataFrame:
    """The bridge after today's snapshot of pairs.

    Current pairs missing from the snapshot are closed, but only for users whose
    dimension row is current. New pairs are opened with weight 1. A pair that was
    opened and closed earlier today is opened again in place, since its key is
    taken.
    """
    today = F.lit(day_key)
    open_today = F.col("is_current") | (F.col("start_date_key") == today)
    untouched = bridge.filter(~open_today)
    live = live_users.select("user_key", F.lit(True).alias("_live"))
    old = (
        bridge.filter(open_today)
        .join(live, "user_key", "left")
        .withColumn("_known", F.lit(True))
        .alias("b")
    )
    new = pairs.select(*PAIR).withColumn("_seen", F.lit(True)).alias("p")
    same = [F.col(f"b.{k}") == F.col(f"p.{k}") for k in PAIR]
    joined = old.join(new, same, "full_outer")

    fresh, seen = F.col("b._known").isNull(), F.col("p._seen").isNotNull()
    closing = F.col("b.is_current") & ~seen & F.col("b._live").isNotNull()
    reopened = ~F.col("b.is_current") & seen
    merged = joined.select(
        *[F.coalesce(F.col(f"b.{k}"), F.col(f"p.{k}")).alias(k) for k in PAIR],
        F.when(fresh, today).otherwise(F.col("b.start_date_key")).alias("start_date_key"),
        F.when(closing, today)
        .when(~fresh & ~reopened, F.col("b.end_date_key"))
        .alias("end_date_key"),
        F.when(closing, False)
        .when(fresh | reopened, True)
        .otherwise(F.col("b.is_current"))
        .alias("is_current"),
        F.when(fresh, F.lit(1)).otherwise(F.col("b.allocation_wt")).cast("decimal(9,4)")
        .alias("allocation_wt"),
    )
    return untouched.select(*merged.columns).unionByName(merged)
