"""What a row costs in the memory of a merge."""

import re
from datetime import date

from pyspark.sql import functions as F

from awareness_mart.operators.changes import unique_or_fail
from awareness_mart.plans import facts
from awareness_mart.schemas import RECIPIENT_FLAGS, TABLES
from awareness_mart.sources import feeds
from checks.registry import RUN_TS
from test_landing import recipients


def test_the_check_of_a_source_holds_one_buffer_per_fixed_width_column(spark):
    df = spark.range(5).selectExpr("id as k", "id * 2 as a", "if(id > 2, date'2024-01-01', null) as b", "string(id) as c")
    checked = unique_or_fail(df, ["k"])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    first = plan.count("partial_any_value") + plan.count("partial_first")
    assert first == 1 and plan.count("partial_max") == 2
    day = date(2024, 1, 1)
    assert sorted(map(tuple, checked.collect())) == [(i, 2 * i, day if i > 2 else None, str(i)) for i in range(5)]


def test_flags_are_one_column_until_the_recipients_are_merged(spark):
    current = F.lit(True).alias("is_current")
    people = spark.range(1000).select(F.col("id").alias("user_id"), F.col("id").alias("user_key"), current)
    tests = spark.range(20).selectExpr(
        "id as pst_id", "id as campaign_key", "20240101 as started_date_key", "60L as duration_seconds")
    templates = people.selectExpr("user_id as template_id", "user_key as template_key", "is_current")
    flat = feeds.flatten_recipients(recipients(spark), RUN_TS)
    rows = facts.packed_recipient_rows(flat, tests, people, templates)
    stored = spark.createDataFrame([], TABLES["fact_recipient"]).drop("bucket")
    merged = facts.merge_recipients(stored.unionByName(spark.range(1).select(
        *[F.lit(3).cast(f.dataType).alias(f.name) if f.name in ("pst_id", "user_key", *RECIPIENT_FLAGS)
          else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema])), rows)
    unpacked = facts.recipient_rows(flat, tests, people, templates)
    brute = facts.presence_flags(flat).select("pst_id", F.col("user_id").alias("user_key"), *RECIPIENT_FLAGS)
    for found in (merged, unpacked):
        assert found.count() == 1000
        assert found.select(brute.columns).exceptAll(brute).count() == 0
    same = [c for c in unpacked.columns if c != "load_ts"]  # that of the stored row stays
    assert merged.select(same).exceptAll(unpacked.select(same)).count() == 0
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") and "clicks_count" not in "".join(re.findall(r"partial_max\(\w+", plan))
    assert "partial_max(_flags" in plan
