"""Change tracking between a stored table and a new snapshot.

Parquet tables take no in-place update, so every operator returns the rows of
the next version.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import any_differs, ntz


# Types whose values lie in the row itself.
_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")


def unique_or_fail(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; the job fails when a key occurs twice or is NULL, and says how often.

    As an aggregate with a partial step this meets many copies of one key as one
    row per map task, so they fail the job instead of filling a task. It uses
    the shuffle that a merge join on the same keys needs anyway. Of a single row any
    aggregate gives its values; that of fixed-width columns is the maximum, which takes
    half the memory of any_value.
    """
    rest = [(c, kind) for c, kind in df.dtypes if c not in keys]
    values = [(F.max(c) if kind.startswith(_FIXED) else F.any_value(c)).alias(c) for c, kind in rest]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *values)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    message = F.concat(
        F.when(whole, F.lit("source key occurs ")).otherwise(F.lit("source key is NULL ")),
        F.col("_copies"),
        F.lit(" times: "),
        F.to_json(F.struct(*keys)),
    )
    single = F.when((F.col("_copies") == 1) & whole, True).otherwise(F.raise_error(message).cast("boolean"))
    return counted.filter(single).select(*df.columns)


def _same_keys(left: str, right: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]


def new_or_changed(
    current: DataFrame, src: DataFrame, keys: list[str], tracked: dict[str, Any]
) -> DataFrame:
    """Source rows that have no current row or differ from it in a tracked column."""
    cur = current.select(*keys, *tracked, F.lit(True).alias("_known")).alias("c")
    joined = src.alias("s").join(cur, _same_keys("s", "c", keys), "left")
    test = F.col("c._known").isNull() | any_differs("c", "s", tracked)
    return joined.filter(test).select("s.*")


def missing_from(src: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return src.join(target.select(*keys), keys, "left_anti")


def scd2_changes(
    current: DataFrame,
    src: DataFrame,
    keys: list[str],
    tracked: dict[str, Any],
    run_ts: datetime,
    surrogate: str | None = None,
    close_missing: Column | None = None,
) -> DataFrame:
    """Compare the current rows of a dimension with a full snapshot.

    Returns every current row as it is after the load plus the versions opened
    by it; rows closed by this load have ``is_current`` false. ``tracked`` maps
    each compared column to the value that NULL stands for. Rows missing from
    the snapshot stay current unless ``close_missing``, a condition on the
    dimension row, says otherwise. Opened rows have a NULL surrogate key.
    """
    closable = F.lit(False) if close_missing is None else F.coalesce(close_missing, F.lit(False))
    cur = current.withColumns({"_known": F.lit(True), "_closable": closable}).alias("c")
    new = (
        unique_or_fail(src.select(*keys, *tracked), keys)
        .withColumn("_seen", F.lit(True))
        .alias("s")
    )
    joined = cur.join(new, _same_keys("c", "s", keys), "full_outer")

    known, seen = F.col("c._known").isNotNull(), F.col("s._seen").isNotNull()
    changed = known & seen & any_differs("c", "s", tracked)
    gone = known & ~seen & F.col("c._closable")
    keep, close, opened = F.lit("keep"), F.lit("close"), F.lit("open")
    steps = (
        F.when(~known, F.array(opened))
        .when(changed, F.array(close, opened))
        .when(gone, F.array(close))
        .otherwise(F.array(keep))
    )
    step = F.col("_step")
    is_new = step == "open"
    stamp = ntz(run_ts)
    columns = {k: F.coalesce(F.col(f"c.{k}"), F.col(f"s.{k}")) for k in keys}
    columns |= {t: F.when(is_new, F.col(f"s.{t}")).otherwise(F.col(f"c.{t}")) for t in tracked}
    columns |= {
        "effective_from": F.when(is_new, stamp).otherwise(F.col("c.effective_from")),
        "effective_to": F.when(step == "close", stamp).when(~is_new, F.col("c.effective_to")),
        "is_current": step != "close",
    }
    if surrogate:
        columns[surrogate] = F.when(~is_new, F.col(f"c.{surrogate}"))
    names = ([surrogate] if surrogate else []) + [*keys, *tracked]
    names += ["effective_from", "effective_to", "is_current"]
    return joined.withColumn("_step", F.explode(steps)).select(
        *[columns[name].alias(name) for name in names]
    )


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    keys: list[str],
    tracked: dict[str, Any],
    run_ts: datetime,
    surrogate: str | None = None,
    close_missing: Column | None = None,
) -> DataFrame:
    """The whole dimension after the load: closed history untouched, current rows compared."""
    after = scd2_changes(
        dim.filter("is_current"), src, keys, tracked, run_ts, surrogate, close_missing
    )
    return dim.filter("not is_current").select(*after.columns).unionByName(after)


def merge_once(
    target: DataFrame,
    src: DataFrame,
    keys: list[str],
    take_source: list[str],
    known: str,
    changed: str,
    packed: str | None = None,
    unpacked: dict[str, Column] | None = None,
) -> DataFrame:
    """The target's rows with ``take_source`` columns of the source, and the source's other rows.

    ``known`` names a column that tells the first from the second, ``changed`` one that says
    whether a known row differs from what it was. New rows have the source's columns, the
    others are NULL. One join, in which both sides are shuffled once; the source key must be
    unique and not NULL. ``unpacked`` columns follow the source as expressions of its column
    ``packed``; that column is added to the result, and where it is not NULL they still have
    to be made from it.
    """
    opened, carried = unpacked or {}, [packed] if packed else []
    given = [c for c in src.columns if c in target.columns and c not in opened]
    old = target.withColumn(known, F.lit(True)).alias("t")
    new = unique_or_fail(src.select(*given, *carried), keys).withColumn("_seen", F.lit(True)).alias("s")
    stored, seen = F.col(f"t.{known}").isNotNull(), F.col("s._seen").isNotNull()

    def value(name: str) -> Column:
        before = F.col(f"t.{name}")
        if name in keys:
            return F.coalesce(before, F.col(f"s.{name}"))
        if name in opened:
            return F.when(~seen, before)
        if name in take_source:
            return F.when(seen, F.col(f"s.{name}")).otherwise(before)
        return F.when(stored, before).otherwise(F.col(f"s.{name}")) if name in given else before

    differs = [~F.col(f"t.{c}").eqNullSafe(opened.get(c, F.col(f"s.{c}"))) for c in take_source]
    return old.join(new, _same_keys("t", "s", keys), "full_outer").select(
        *[value(c).alias(c) for c in target.columns],
        *carried,
        stored.alias(known),
        (stored & seen & reduce(lambda a, b: a | b, differs)).alias(changed),
    )


def insert_missing(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks; columns only the target has become NULL."""
    return target.unionByName(missing_from(src, target, keys), allowMissingColumns=True)


def upsert(
    target: DataFrame,
    src: DataFrame,
    keys: list[str],
    take_source: list[str],
    keep_target: list[str] | None = None,
    insert_defaults: dict[str, Column] | None = None,
    packed: str | None = None,
    unpacked: dict[str, Column] | None = None,
) -> DataFrame:
    """Update matching rows and insert the others; nothing is deleted.

    ``take_source`` columns follow the source. ``keep_target`` columns come from
    the source on insert and are never updated. ``insert_defaults`` gives the
    first value of columns the source does not have. Any other target column,
    such as a surrogate key, is kept and NULL on insert. The source key must be
    unique. ``unpacked`` columns follow the source too, as expressions of its column
    ``packed``, which takes their place until the rows are merged.
    """
    kept, defaults, opened = keep_target or [], insert_defaults or {}, unpacked or {}
    carried = [packed] if packed else []
    old = target.withColumn("_known", F.lit(True)).alias("t")
    new = (
        unique_or_fail(src.select(*keys, *take_source, *kept, *carried), keys)
        .withColumn("_seen", F.lit(True))
        .alias("s")
    )
    known, seen = F.col("t._known").isNotNull(), F.col("s._seen").isNotNull()

    def value(name: str) -> Column:
        before = F.col(f"t.{name}")
        if name in keys:
            return F.coalesce(before, F.col(f"s.{name}"))
        if name in take_source:
            return F.when(seen, F.col(f"s.{name}")).otherwise(before)
        if name in opened:
            return F.when(seen, opened[name]).otherwise(before)
        if name in kept:
            return F.when(known, before).otherwise(F.col(f"s.{name}"))
        if name in defaults:
            return F.when(known, before).otherwise(defaults[name])
        return before

    joined = old.join(new, _same_keys("t", "s", keys), "full_outer")
    return joined.select(*[value(c).alias(c) for c in target.columns])


def keyed_update(
    target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Set ``columns`` of the rows whose key is in the change set; insert nothing."""
    new = (
        unique_or_fail(changes.select(*keys, *columns), keys)
        .withColumn("_seen", F.lit(True))
        .alias("s")
    )
    joined = target.alias("t").join(new, _same_keys("t", "s", keys), "left")
    hit = F.col("s._seen").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in columns
            else F.col(f"t.{c}")
            for c in target.columns
        ]
    )
