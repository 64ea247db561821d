"""Monthly averages per unit and in total, and the older activity lists."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import add_years, exact, first_of_month, last_of_previous_month, strict_mean
from ..operators.latest import latest_per_key
from ..operators.prefix import prefix_join
from .dashboards import Measures

MEASURES = [
    "phish_prone_percentage",
    "current_risk_score",
    "percentage_response",
    "percentage_viewed",
    "percentage_policies",
]


def person_measures(facts: Measures, people: DataFrame, until: int) -> DataFrame:
    """(id, ehash, measures) of each person as they stood on the day with key ``until``.

    ``people``: user_key, id, ehash, a row per version of a person; the ehash of the newest,
    which has ``is_current``, counts. Percentage and score are those of the latest snapshot
    up to the day, NULL without one. The others are shares of what was asked up to the day:
    reported of delivered tests, completed of enrolled trainings, read of enrolled policies;
    0 for people who were asked nothing. Facts are summed per key before any join.
    """
    past = [rows.filter(F.col("date_key") <= until) for rows in facts]
    ids = people.select("user_key", "id")
    newest = latest_per_key(
        latest_per_key(past[0], ["user_key"], "date_key").join(ids, "user_key").drop("user_key"),
        ["id"],
        "date_key",
    )
    asked = None
    for rows in past[1:]:
        sums = [F.sum(c).alias(c) for c in rows.columns if c not in ("user_key", "date_key")]
        part = rows.groupBy("user_key").agg(*sums)
        asked = part if asked is None else asked.join(part, "user_key", "full_outer")
    own = [c for c in asked.columns if c != "user_key"]
    asked = asked.join(ids, "user_key").groupBy("id").agg(*[F.sum(c).alias(c) for c in own])

    def tenthousandths(units: Column) -> Column:
        return (units.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")

    def share(part: str, whole: str) -> Column:
        exact = F.expr(f"({part} * 2000000 + {whole}) div nullif(2 * {whole}, 0)")
        return tenthousandths(F.coalesce(exact, F.lit(0)))

    joined = (
        people.filter("is_current")
        .select("id", "ehash")
        .join(newest, "id", "left")
        .join(asked, "id", "left")
    )
    return joined.select(
        "id",
        "ehash",
        F.when(F.col("prone_n") > 0, tenthousandths(F.col("prone_sum"))).alias(MEASURES[0]),
        F.when(F.col("risk_n") > 0, tenthousandths(F.col("risk_sum"))).alias(MEASURES[1]),
        share("reported", "delivered").alias(MEASURES[2]),
        share("training_completed", "training_enrolled").alias(MEASURES[3]),
        share("policy_read", "policy_enrolled").alias(MEASURES[4]),
    )


def active_users(
    users: DataFrame,
    hr: DataFrame,
    units: DataFrame,
    normalize: Callable[[Column], Column] = exact,
) -> DataFrame:
    """Users the HR extract knows, in a listed unit, with the unit as it is listed.

    ``users``: id, ehash, measures. ``hr``: ehash, groep. ``units``: unit.
    ``normalize`` says which unit names count as equal.
    """
    same = normalize(F.col("groep")) == normalize(F.col("unit"))
    listed = hr.join(units.select("unit"), same).select("ehash", "unit")
    return users.join(listed, "ehash")


def _unit_sums(members: DataFrame) -> DataFrame:
    sums = [F.sum(F.col(m).cast("decimal(18,4)")).alias(f"{m}_sum") for m in MEASURES]
    present = [F.count(m).alias(f"{m}_n") for m in MEASURES]
    return members.groupBy("unit").agg(
        F.count(F.lit(1)).alias("users"), *sums, *present
    )


def _means() -> list:
    return [
        strict_mean(F.col(f"{m}_sum"), F.col(f"{m}_n"), F.col("users")).alias(m) for m in MEASURES
    ]


def unit_averages(users: DataFrame, hr: DataFrame, units: DataFrame) -> DataFrame:
    """Averages per unit, rounded to two places. One missing measure makes the mean NULL.

    Units without users give no row.
    """
    return _unit_sums(active_users(users, hr, units)).select("unit", "users", *_means())


def unit_rollup(users: DataFrame, hr: DataFrame, units: DataFrame) -> DataFrame:
    """The same averages per unit and, in one row marked ``is_total``, over all units.

    Members are summed per unit first, so the rollup only expands one row per unit.
    """
    per_unit = _unit_sums(active_users(users, hr, units))
    numbers = [c for c in per_unit.columns if c != "unit"]
    return (
        per_unit.rollup("unit")
        .agg(
            F.grouping("unit").cast("boolean").alias("is_total"),
            *[F.sum(c).alias(c) for c in numbers],
        )
        .filter(F.col("users").isNotNull())
        .select("unit", "is_total", "users", *_means())
    )


def _write_month(
    history: DataFrame, rows: DataFrame, keys: list[str], run_date: date
) -> DataFrame:
    """Insert or replace this month's rows; one aggregate, in which the newer row wins."""
    new = rows.withColumns({"date": F.lit(first_of_month(run_date)), "_run": F.lit(1)})
    both = history.withColumn("_run", F.lit(0)).unionByName(
        new.select(*keys, *MEASURES, "_run")
    )
    return latest_per_key(both, keys, "_run").select(*history.columns)


def merge_unit_history(history: DataFrame, rollup: DataFrame, run_date: date) -> DataFrame:
    """Write this month's unit averages into the history; other months stay."""
    return _write_month(history, rollup.filter("not is_total"), ["date", "unit"], run_date)


def merge_total_history(history: DataFrame, rollup: DataFrame, run_date: date) -> DataFrame:
    """Write this month's total into the history; other months stay."""
    return _write_month(history, rollup.filter("is_total"), ["date"], run_date)


def active_phishing(
    tests: DataFrame, masters: DataFrame, run_date: date, mode: str = "as_coded"
) -> DataFrame:
    """Tests of active campaigns, by age.

    ``as_coded`` keeps tests whose end plus two years lies before this month;
    ``as_commented`` keeps the others, which is what the rule was written for.
    Tests without a duration are in neither list.
    """
    if mode not in ("as_coded", "as_commented"):
        raise ValueError(f"unknown mode {mode}")
    until = F.date_add(add_years(F.to_date("started_at"), 2), F.col("duration_days"))
    old = until <= F.lit(last_of_previous_month(run_date))
    kept = tests.filter(old if mode == "as_coded" else ~old)
    active = masters.filter("active").select("campaign_id")
    return kept.join(active, "campaign_id", "left_semi").select("pst_id")


def active_training(training: DataFrame, masters: DataFrame, run_date: date) -> DataFrame:
    """Campaigns in progress, begun before the last day of last month, by matching type."""
    begun = training.filter(
        (F.col("status") == "In Progress")
        & (F.col("start_date") < F.lit(last_of_previous_month(run_date)))
    )
    named = masters.select(F.col("name").alias("_master"), "type")
    return prefix_join(
        begun.select("campaign_id", "name"), "name", named, "_master", upper=False
    ).select("campaign_id", "type")
