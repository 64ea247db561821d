"""Queries about the loads themselves: readiness, quota use, row counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ntz
from ..operators.latest import latest_per_key
from ..sources.feeds import complete
from ..sources.store import MartStore


def readiness(status: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per day: have all required sources finished? A source without a row has not.

    ``status``: day, source, finished. One pass with a yes/no per source; no
    distinct count.
    """
    done = [
        F.coalesce(F.bool_or(F.when(F.col("source") == s, F.col("finished"))), F.lit(False))
        for s in required
    ]
    return status.groupBy("day").agg(reduce(lambda a, b: a & b, done).alias("ready"))


def all_ready(status: DataFrame, required: Sequence[str], day: date) -> bool:
    """Have the required sources of the status table finished on ``day``?"""
    per_day = readiness(status.withColumnRenamed("run_date", "day"), required)
    return bool(per_day.filter((F.col("day") == F.lit(day)) & F.col("ready")).head(1))


def load_status(store: MartStore) -> DataFrame:
    """The status table as the events say: the newest run per source, its calls of that day.

    Jobs only add events, so none can undo what another has reported; the table itself
    holds the sources and their limits.
    """
    newest = latest_per_key(store.read("status_events"), ["source"], "at").select(
        "source", F.col("run_date").alias("_date"), F.col("finished").alias("_finished")
    )
    used = store.read("usage_events").groupBy("source", "run_date").agg(F.sum("calls").alias("_calls"))
    used = latest_per_key(used, ["source"], "run_date").select(
        "source", F.col("run_date").alias("_day"), F.col("_calls").cast("int").alias("_calls")
    )
    table = store.read("source_status")
    run_date = F.greatest("run_date", "_date")
    fetched = F.when(F.col("_day") >= F.coalesce("run_date", "_day"), F.col("_calls"))
    news = {
        "finished": F.coalesce(F.when(F.col("_date") == run_date, F.col("_finished")), "finished"),
        "fetched_today": F.coalesce(fetched, "fetched_today"),
        "run_date": run_date,
    }
    joined = table.join(newest, "source", "left").join(used, "source", "left")
    return joined.select(*[news[c].alias(c) if c in news else F.col(c) for c in table.columns])


def usage_band(
    used: Column, limit: Column, warning_percentage: Column, error_percentage: Column
) -> Column:
    """ERR above the error share of the limit, WARN above the warning share, else INFO.

    A hundred times a count of 32 bits takes more than 32.
    """
    hundredfold, limit = used.cast("long") * 100, limit.cast("long")
    return (
        F.when(hundredfold > error_percentage * limit, "ERR")
        .when(hundredfold > warning_percentage * limit, "WARN")
        .otherwise("INFO")
    )


def quota_line(status: DataFrame, source: str, run_ts: datetime) -> DataFrame:
    """A line of the log: the calls of a source today, and the band of its limit they are in."""
    band = usage_band(
        F.col("fetched_today"),
        F.col("max_fetches"),
        F.col("warning_percentage"),
        F.col("error_percentage"),
    )
    used = F.concat_ws("", F.col("fetched_today"), F.lit(" of "), F.col("max_fetches"), F.lit(" calls"))
    return status.filter((F.col("source") == source) & F.col("max_fetches").isNotNull()).select(
        ntz(run_ts).alias("timestamp"), "source", band.alias("severity"), used.alias("line")
    )


def calls_today(stored: Column, stored_day: Column, run_date: date, made: Column) -> Column:
    """Calls made by this run on top of the stored count; an older count starts from 0."""
    return F.when(stored_day < F.lit(run_date), 0).otherwise(stored) + made


def load_audit(flat: dict[str, DataFrame], staged: dict[str, DataFrame]) -> DataFrame:
    """Rejected and staged rows per feed, from the flattened feeds and from what was staged."""
    counts = [
        flat[feed]
        .agg(F.count_if(~complete(feed)).alias("rejected"))
        .select(F.lit(feed).alias("feed"), F.lit(0).cast("long").alias("inserted"), "rejected")
        .unionByName(
            staged[feed]
            .agg(F.count(F.lit(1)).alias("inserted"))
            .select(F.lit(feed).alias("feed"), "inserted", F.lit(0).cast("long").alias("rejected"))
        )
        for feed in flat
    ]
    both = reduce(DataFrame.unionByName, counts)
    return both.groupBy("feed").agg(
        F.sum("inserted").alias("inserted"), F.sum("rejected").alias("rejected")
    )
