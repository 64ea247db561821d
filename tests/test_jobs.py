"""What the nightly jobs leave alone, refuse, report and keep aside."""

import contextlib
import io
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from awareness_mart.plans.fingerprint import fingerprints
from awareness_mart.plans.constraints import KEYS, audit_mart
from awareness_mart.plans.load import run_audit, run_hr, run_monthly, run_staging, stage_masters
from awareness_mart.plans.monitoring import load_status
from awareness_mart.plans.views import listing
from awareness_mart.schemas import FACT_BUCKETS, TABLES
from awareness_mart.sources.masters import replace_master
from awareness_mart.sources.store import MartStore
from test_load import Mart

DAY = datetime(2024, 3, 10, 2)


@pytest.fixture
def mart(spark, tmp_path):
    return Mart(spark, tmp_path)


def _files(mart, table):
    root = Path(mart.folder) / "mart" / table
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_only_changed_parts_are_replaced(mart):
    for n in range(10, 46):
        mart.feeds["users"].append({"id": n, "email": f"u{n}@x.test", "phish_prone_percentage": 1})
        mart.feeds["recipients"].append(
            {"pst_id": 1, "user": {"id": n}, "template": {"id": 71, "name": "T1"}}
        )
    mart.run(DAY)
    tables = ("fact_recipient", "fact_enrollment", "fact_snapshot")
    before = {t: _files(mart, t) for t in tables}
    mart.feeds["recipients"][-1]["clicked_at"] = "2024-03-10"
    store = mart.run(datetime(2024, 3, 11, 2))
    after = {t: _files(mart, t) for t in tables}
    changed = store.parts("fact_recipient").filter("clicks_count = 1 and user_key > 3")
    gone = {f for f in before["fact_recipient"] if f not in after["fact_recipient"]}
    new = {f for f in after["fact_recipient"] if f not in before["fact_recipient"]}
    parts = {f"bucket={r.bucket}" for r in changed.collect()}
    assert len(before["fact_recipient"]) > 10
    assert {Path(f).parent.name for f in gone} == {Path(f).parent.name for f in new} <= parts
    assert gone and all(after["fact_recipient"][f] == before["fact_recipient"][f]
                        for f in before["fact_recipient"] if f not in gone)
    assert after["fact_enrollment"] == before["fact_enrollment"]
    assert {Path(f).parent.name for f in set(after["fact_snapshot"]) - set(before["fact_snapshot"])} == {
        "snapshot_date_key=20240311"}
    assert store.read("fact_recipient").groupBy("user_key", "pst_id").count().filter("count > 1").count() == 0
    assert all(0 <= r.bucket < FACT_BUCKETS for r in store.parts("fact_recipient").collect())


def test_a_day_of_snapshots_is_found_by_its_folder(mart):
    store = mart.run(DAY)
    day = store.read("fact_snapshot").filter(F.col("snapshot_date_key") == 20240310)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        day.explain("formatted")
    assert "PartitionFilters: [isnotnull(snapshot_date_key" in plan.getvalue()
    assert day.count() == 3


def test_an_update_that_another_job_overtook_is_refused(mart, spark):
    """Also if the late store has seen the newer state in between, through a job."""
    first, late = mart.store(), mart.store()
    seen = [s.read("mst_units") for s in (first, late)]
    more = [spark.createDataFrame([(u, u)], TABLES["mst_units"]) for u in ("B", "C")]
    replace_master(first, "mst_units", seen[0].unionByName(more[0]))
    late.write("mst_units", seen[1].unionByName(more[1]))
    with pytest.raises(ValueError, match="mst_units changed"):
        stage_masters(late, DAY)
    late = mart.store()
    rows = late.read("mst_units")
    replace_master(first, "mst_units", first.read("mst_units").unionByName(more[1]))
    late.reload()
    with pytest.raises(ValueError, match="mst_units changed"):
        replace_master(late, "mst_units", rows)
    kept = {r.unit for r in mart.store().read("mst_units").collect()}
    assert kept == {"Intern", "Business", "B", "C"}


def test_two_open_stores_keep_both_flags(mart, spark):
    staff = spark.createDataFrame(
        [("u1@x.test", 0, date(2020, 1, 1), date(9999, 1, 1), "I")],
        "email string, unit_code int, in_service date, out_service date, kind string",
    )
    units = spark.createDataFrame([(0, "Intern")], "unit_id int, unit_name string")
    one, two = mart.store(), mart.store()
    for store in (one, two):
        load_status(store).collect()
    run_hr(one, staff, units, DAY)
    stage_masters(two, DAY)
    found = {r.source: (r.run_date, r.finished) for r in load_status(mart.store()).collect()}
    assert found["HR"] == found["Master"] == (DAY.date(), True)
    assert found["Other"] == (None, False)


def test_status_listing_follows_the_events(mart):
    stage_masters(mart.store(), DAY)
    found = {r.source: r.finished for r in listing(mart.store(), "status").collect()}
    assert found["Master"] and not found["HR"]


def test_staging_reports_counts_rejects_and_quota(spark, tmp_path, rows):
    store = MartStore(spark, str(tmp_path / "mart"), TABLES)
    limits = [("Vendor", None, 100, 0, 75, 90, False)]
    store.write("source_status", spark.createDataFrame(limits, TABLES["source_status"]))
    store.publish()
    lines = {
        "users": ['{"id": 1, "email": "a@x"}', '{"id": 2, "email"', '{"email": "c@x"}',
                  '{"id": 4, "email": "d@x", "status": "archived"}'],
        "user_detail": ['{"id": 1, "current_risk_score": "3"}', '{"id": 1, "current_risk_score": "5"}',
                        '{"id": 9, "current_risk_score": "1"}', "{}", "{}"],
        "tests": ['[{"pst_id": 1, "campaign_id": 5}, {"pst_id": 2}]'],
        "recipients": ['{"pst_id": 1, "user": {"id": 1}}'],
        "training": ['{"campaign_id": 7, "name": "x", "status": "Done"}'],
        "enrollments": [],
    }
    landed = {}
    for feed, text in lines.items():
        folder = tmp_path / feed
        folder.mkdir()
        (folder / "1.json").write_text("\n".join(text))
        landed[feed] = str(folder)

    def bands():
        return rows(store.read("log"), "severity", "line")

    run_staging(store, landed, DAY, calls=60)
    counts = rows(store.read("load_counts").drop("run_ts"))
    assert counts == [
        ("enrollments", 0, 0, 0), ("recipients", 0, 1, 0), ("tests", 1, 1, 0),
        ("training", 0, 0, 0), ("user_detail", 1, 2, 1), ("users", 1, 2, 0),
    ]
    assert rows(store.rejected("stg_users")) == [
        ("damaged", '{"id": 2, "email"'), ("lacks user_id", '{"email":"c@x"}')]
    assert rows(store.rejected("stg_recipient"), "reason") == [("lacks template_id",)]
    assert rows(store.read("stg_user_detail"), "user_id", "current_risk_score") == [(1, 5)]
    assert bands() == [("INFO", "60 of 100 calls")]
    run_staging(store, landed, datetime(2024, 3, 10, 5), calls=20)
    assert bands()[-1] == ("WARN", "80 of 100 calls")
    run_staging(store, landed, datetime(2024, 3, 10, 6), calls=11)
    assert ("ERR", "91 of 100 calls") in bands()
    run_staging(store, landed, datetime(2024, 3, 11, 5), calls=3)
    assert ("INFO", "3 of 100 calls") in bands()
    assert [r.fetched_today for r in load_status(store).collect()] == [3]
    assert store.read("load_counts").count() == 24


def test_history_comes_from_the_mart(mart):
    store = mart.run(DAY)
    run_monthly(store, DAY, "Passed")
    units = {r.unit: [float(x) for x in r[2:]] for r in store.read("history_units").collect()}
    assert units == {"Intern": [2.25, 15, 50, 50, 50], "Business": [4.5, 30, 0, 0, 0]}
    total = store.read("history_total").collect()
    assert [(r[0], *map(float, r[1:])) for r in total] == [(date(2024, 3, 1), 3, 20, 33.33, 33.33, 33.33)]
    # a new e-mail gives a person a second version; both versions' facts are the person's
    mart.feeds["users"][1]["email"] = "new@x.test"
    mart.staff[1] = "Business"
    store = mart.run(datetime(2024, 4, 2, 2))
    run_monthly(store, datetime(2024, 4, 2, 2), "Passed")
    found = {(r.date.month, r.unit): [float(x) for x in r[2:]] for r in store.read("history_units").collect()}
    assert found[3, "Intern"] == units["Intern"] and found[4, "Business"] == [3.0, 20, 0, 50, 50]


def test_fingerprints_see_one_wrong_value(mart):
    store = mart.run(DAY)
    before = {r.name: r.fingerprint for r in fingerprints(store).collect()}
    assert before["fact_recipient"] and before["dim_user"]
    wrong = [
        ("fact_recipient", "template_key", F.lit(-1)),
        ("fact_recipient", "started_date_key", F.lit(20240302)),
        ("fact_snapshot", "current_risk_score", F.col("current_risk_score") + 1),
        ("fact_enrollment", "status", F.lit("x")),
    ]
    for table, column, value in wrong:
        rows, key = store.parts(table), TABLES[table].names[0]
        one = rows.agg(F.min(key)).first()[0]
        store.replace_parts(table, rows.withColumn(column, F.when(F.col(key) == one, value).otherwise(F.col(column))))
        store.publish()
        after = {r.name: r.fingerprint for r in fingerprints(store).collect()}
        assert {n for n in after if after[n] != before[n]} == {table}, column
        before = after


def test_the_audit_is_a_job_with_a_scan_per_table(mart, rows):
    store = mart.run(DAY)
    assert run_audit(store, datetime(2024, 3, 10, 3)) == 0
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        audit_mart(store).explain()
    stored = [t for t in KEYS if store.versions(t)]
    assert plan.getvalue().count("FileScan parquet") == len(stored) > 20
    parts = store.parts("fact_recipient")
    store.replace_parts("fact_recipient", parts.withColumn("template_key", F.lit(-5)))
    store.publish()
    assert run_audit(store, datetime(2024, 3, 10, 4)) == 1
    assert rows(store.read("log").filter("source = 'DWH'"), "severity", "line") == [
        ("ERR", "fact_recipient: template_key not in dim_template: 2 rows"),
        ("INFO", "no constraint is violated"),
    ]
