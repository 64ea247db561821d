"""Keys that are NULL or repeated, ties, overlapping jobs and people with two versions."""

import pytest
from pyspark.errors import PySparkException

from awareness_mart.operators.changes import unique_or_fail
from awareness_mart.operators.latest import latest_per_key
from awareness_mart.plans.facts import merged_parts
from awareness_mart.plans.reports import current_results
from awareness_mart.schemas import TABLES
from awareness_mart.sources.masters import replace_master
from awareness_mart.sources.store import MartStore


@pytest.mark.parametrize(
    "rows",
    [[("A", "x"), ("A", "y")], [("A", "x"), (None, "z")], [("A", "x"), ("  ", "z")]],
)
def test_masters_without_a_key_are_refused(spark, tmp_path, rows):
    store = MartStore(spark, str(tmp_path), TABLES)
    with pytest.raises(PySparkException, match="source key"):
        replace_master(store, "mst_units", spark.createDataFrame(rows, TABLES["mst_units"]))
    assert MartStore(spark, str(tmp_path), TABLES).read("mst_units").count() == 0


def test_a_required_null_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", None)], TABLES["mst_phishing"])
    with pytest.raises(PySparkException, match="active is NULL"):
        replace_master(MartStore(spark, str(tmp_path), TABLES), "mst_phishing", rows)


def test_a_null_source_key_fails(spark):
    with pytest.raises(PySparkException, match="NULL"):
        unique_or_fail(spark.createDataFrame([(None, 1)], "k int, v int"), ["k"]).collect()


def test_ties_do_not_depend_on_order(spark):
    rows = [(1, 7, "a"), (1, 7, "c"), (1, 7, "b"), (1, 6, "z")]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "k int, at int, v string").repartition(3)
        assert [tuple(r) for r in latest_per_key(table, ["k"], "at").collect()] == [(1, 7, "c")]


def test_a_job_does_not_overwrite_what_another_published(spark, tmp_path):
    table = spark.createDataFrame([("A", "x")], TABLES["mst_units"])
    first, second = (MartStore(spark, str(tmp_path), TABLES) for _ in range(2))
    for store in (first, second):
        store.write("mst_units", table)
    first.publish()
    with pytest.raises(ValueError, match="mst_units changed"):
        second.publish()
    third = MartStore(spark, str(tmp_path), TABLES)
    third.write("mst_training", spark.createDataFrame([], TABLES["mst_training"]))
    first.reload()
    first.write("mst_units", table)
    first.publish()
    third.publish()
    assert third.seq == 3


def test_results_count_once_per_person(spark):
    people = spark.createDataFrame(
        [(1, 10, 1, False), (2, 10, 2, True), (3, 11, 1, True), (4, 12, 1, False)],
        "user_key int, user_id int, effective_from int, is_current boolean",
    )
    fact = spark.createDataFrame(
        [(1, 500, 1), (2, 500, 0), (1, 501, 1), (3, 500, 1), (4, 500, 1), (9, 500, 1)],
        "user_key int, pst_id int, clicks int",
    )
    kept = {(r.user_key, r.pst_id) for r in current_results(fact, people, ["pst_id"]).collect()}
    assert kept == {(2, 500), (1, 501), (3, 500), (4, 500), (9, 500)}


def test_only_new_rows_lack_a_key(spark):
    fact = spark.createDataFrame([(7, 1, "a", "old"), (8, 2, "b", "old")], "sk int, k int, v string, ts string")
    rows = spark.createDataFrame([(1, "x", "new"), (3, "y", "new")], "k int, v string, ts string")
    updated, inserts = merged_parts(fact, rows, ["k"], ["v"])
    assert sorted(map(tuple, updated.collect())) == [(7, 1, "x", "old"), (8, 2, "b", "old")]
    assert list(map(tuple, inserts.collect())) == [(None, 3, "y", "new")]
