"""Hot keys: a third of all rows on one key."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from awareness_mart.operators.changes import missing_from, unique_or_fail
from awareness_mart.operators.latest import latest_per_key
from awareness_mart.plans import dashboards, facts
from awareness_mart.schemas import RECIPIENT_FLAGS
from awareness_mart.sources.feeds import children_of

ROWS = 300_000


@pytest.fixture
def small_skew_threshold(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot(name):
    """A third of the rows on key 1, the others spread."""
    return F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("long").alias(name)


def recipients(spark):
    events = [
        F.when(F.col("id") % (i + 2) == 0, F.lit("2024-01-01")).cast("timestamp_ntz").alias(e)
        for i, e in enumerate(RECIPIENT_FLAGS.values())
    ]
    stamp = F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts")
    ids = [hot("pst_id"), F.col("id").alias("user_id"), hot("template_id")]
    return spark.range(0, ROWS, 1, 4).select(*ids, *events, stamp)


def final_plan(df):
    collected = df.groupBy().agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    collected.collect()
    return collected._jdf.queryExecution().executedPlan().toString()


def test_hot_tests_and_templates_are_split(spark, small_skew_threshold):
    tests = spark.range(5000).select(
        F.col("id").alias("pst_id"),
        F.col("id").alias("campaign_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("started_at"),
        F.lit(1).alias("duration_days"),
    )
    current = F.lit(True).alias("is_current")
    users = spark.range(ROWS).select(
        F.col("id").alias("user_id"), F.col("id").alias("user_key"), current
    )
    campaigns = spark.range(5000).select(
        F.col("id").alias("campaign_id"),
        F.col("id").alias("campaign_key"),
        F.lit("phishing").alias("campaign_type"),
        current,
    )
    templates = spark.range(5000).select(
        F.col("id").alias("template_id"), F.col("id").alias("template_key"), current
    )
    dates = spark.createDataFrame([(20240101,)], "date_key int").withColumn(
        "date", F.lit("2024-01-01").cast("date")
    )
    described = facts.describe_tests(tests, campaigns, dates)
    rows = facts.recipient_rows(recipients(spark), described, users, templates)
    assert rows.count() == ROWS
    plan = final_plan(rows)
    assert plan.count("skew=true") >= 2  # the test and the template join


def test_hot_parents_are_split(spark, small_skew_threshold):
    child = spark.range(0, ROWS, 1, 4).select(
        hot("pst_id"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    parents = spark.range(5000).select(F.col("id").alias("pst_id"))
    kept = children_of(child, parents, "pst_id")
    assert kept.count() == ROWS
    assert "skew=true" in final_plan(kept)
    absent = missing_from(child, parents.filter("pst_id <> 1"), ["pst_id"])
    assert absent.count() == child.filter("pst_id = 1").count()
    assert "skew=true" in final_plan(absent)


def test_a_hot_user_is_reduced_before_the_shuffle(spark):
    events = spark.range(0, ROWS, 1, 4).select(
        hot("user_id"), F.col("id").alias("load_ts"), F.lit(1.0).alias("score")
    )
    latest = latest_per_key(events, ["user_id"], "load_ts")
    expected = {
        r.user_id: r.m for r in events.groupBy("user_id").agg(F.max("load_ts").alias("m")).collect()
    }
    assert {r.user_id: r.load_ts for r in latest.collect()} == expected


def test_a_busy_user_fills_no_task_of_the_unit_dashboard(spark):
    """Before the membership join a user has one row per day at most."""
    person = hot("user_key")
    day = (F.lit(20240101) + F.col("id") % 20).cast("int")
    recipients_ = spark.range(0, ROWS, 1, 4).select(
        person, day.alias("started_date_key"), F.lit(1).alias("delivered_count"),
        (F.col("id") % 2).cast("int").alias("reported_count"),
    )
    nobody = (
        "user_key long, snapshot_date_key int, phish_prone_pct decimal(5,2), "
        "current_risk_score decimal(9,4)"
    )
    snapshots = spark.createDataFrame([], nobody)
    enrollments = spark.createDataFrame(
        [], "user_key long, enrollment_date_key int, campaign_type string, status string"
    )
    rows = dashboards.measures(snapshots, recipients_, enrollments, "F")
    membership = spark.range(5000).selectExpr(
        "id as user_key", "concat('U', id % 3) as Unit_naam", "20240101 as start_date_key",
        "cast(null as int) as end_date_key",
    )
    dates = spark.range(20).selectExpr(
        "cast(20240101 + id as int) as date_key", "2024 as year", "1 as month",
        "cast(1 + id as int) as day", "1 as week", "2024 as iso_year",
    )
    result = dashboards.unit_dashboard(rows, membership, dates, "day")
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner, (user_key")
    assert "Aggregate [user_key" in plan[join:]
    found = {(r.Unit_naam, r.Day): r.Pct_response_cum for r in result.collect()}
    brute = recipients_.withColumn("unit", F.concat(F.lit("U"), F.col("user_key") % 3)).toPandas()
    for unit, part in brute.groupby("unit"):
        daily = part.groupby("started_date_key")[["delivered_count", "reported_count"]].sum()
        running = daily.cumsum()
        pct = 100 * running.reported_count / running.delivered_count
        for key, value in pct.items():
            assert found[(unit, key - 20240100)] == pytest.approx(value)


def test_many_copies_of_a_key_are_merged_before_the_shuffle(spark):
    copies = spark.range(0, ROWS, 1, 4).select(
        hot("id_"), F.lit("x").alias("v"), F.lit(1).alias("n")
    )
    checked = unique_or_fail(copies, ["id_"])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "partial_any_value" in plan[shuffle:] or "partial_first" in plan[shuffle:]
    with pytest.raises(PySparkException, match="source key occurs"):
        checked.collect()
    with pytest.raises(PySparkException, match=f"source key occurs {ROWS // 3} times"):
        unique_or_fail(copies.filter("id_ = 1 and n = 1").limit(ROWS // 3), ["id_"]).collect()
