"""Physical plans: what must not appear, and what must."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


EAGER = {
    "end_to_end_load", "full_refresh", "replace_master", "stage_users", "stage_user_detail",
    "stage_pst", "stage_recipients", "stage_training", "stage_enrollment",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_nested_loops_and_no_python(spark, no_broadcast, name):
    """Even without any broadcast every join stays a join by key, and no row goes to Python."""
    text = plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in text
    assert "CartesianProduct" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", ["prefix_join", "date_lookup", "fact_recipient"])
def test_small_sides_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name",
    ["surrogate_keys", "scd2_user", "merge_recipient", "bridge_snapshot", "sorted_listing"],
)
def test_fact_sized_rows_are_never_gathered_in_one_task(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    gathered = re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*?(\w+)", text)
    # Only the partial results of a global aggregate may meet in one task.
    assert set(gathered) <= {"HashAggregate", "ObjectHashAggregate"}


def test_running_window_sees_periods_only(spark):
    text = plan(entry.queries()["dashboard_day"](spark, SF))
    window = text.index("Window")
    assert "HashAggregate" in text[window:]


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    text = plan(entry.queries()["latest_per_key"](spark, SF))
    assert text.index("partial_max") > text.index("Exchange")


def test_scan_reads_only_what_is_needed(spark):
    text = plan(entry.queries()["report_error_totals"](spark, SF))
    assert "l_extendedprice" not in text and "l_shipdate" in text


def test_filters_reach_the_scan(spark):
    df = entry.queries()["scd2_unit"](spark, SF).filter(F.col("unit_key").isNotNull())
    assert "PushedFilters: [IsNotNull" in plan(df)


def test_one_shuffle_per_side_for_a_checked_merge(spark, no_broadcast):
    """The uniqueness check of the source shares the shuffle of the join."""
    text = plan(entry.queries()["scd2_user"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
