"""The whole load over several days, on a small mart."""

import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from awareness_mart.plans import views
from awareness_mart.plans.audit import duplicates, orphans, scd2_shape
from awareness_mart.plans.constraints import KEYS, REFERENCES, REQUIRED, audit_mart
from awareness_mart.plans.load import run_history, run_hr, run_load, run_staging
from awareness_mart.plans.monitoring import load_status
from awareness_mart.schemas import TABLES
from awareness_mart.sources.store import MartStore

FOREVER = date(9999, 12, 31)


def base_feeds():
    def user(n, email=None):
        return {"id": n, "email": email or f"u{n}@x.test", "phish_prone_percentage": n * 1.5}

    def recipient(pst, n, **events):
        return {
            "pst_id": pst,
            "user": {"id": n},
            "template": {"id": 70 + pst, "name": f"T{pst}"},
            "delivered_at": "2024-03-02T08:00:00Z",
        } | events

    return {
        "users": [user(1), user(2), user(3)],
        "user_detail": [{"id": n, "current_risk_score": str(10 * n)} for n in (1, 2, 3, 9)],
        "tests": [
            {"campaign_id": 500, "pst_id": 1, "status": "Closed", "name": "March",
             "started_at": "2024-03-01", "duration": 3},
            {"campaign_id": 501, "pst_id": 2, "status": "Closed", "name": "Inactive",
             "started_at": "2024-03-01", "duration": 3},
        ],
        "recipients": [
            recipient(1, 1, clicked_at="2024-03-02"),
            recipient(1, 2, reported_at="2024-03-03"),
            recipient(1, 8),  # no such user
            recipient(2, 1),  # campaign not active
            recipient(9, 1),  # no such test
        ],
        "training": [
            {"campaign_id": 40, "name": "Safe Desk s1", "status": "In Progress",
             "start_date": "2024-02-01"},
            {"campaign_id": 41, "name": "Policy privacy", "status": "In Progress",
             "start_date": "2024-02-01"},
        ],
        "enrollments": {
            40: [{"enrollment_id": 900, "user": {"id": 1}, "enrollment_date": "2024-02-02",
                  "status": "Passed"},
                 {"enrollment_id": 901, "user": {"id": 2}, "enrollment_date": "2024-02-02",
                  "status": "Started"}],
            41: [{"enrollment_id": 902, "user": {"id": 1}, "enrollment_date": "2024-02-05",
                  "status": "Passed"}],
            42: [{"enrollment_id": 903, "user": {"id": 1}, "enrollment_date": "2024-02-05",
                  "status": "Passed"}],
        },
    }


class Mart:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.runs = spark, folder, 0
        self.feeds = base_feeds()
        self.staff = {n: ("Intern" if n < 3 else "Business") for n in (1, 2, 3)}
        store = self.store()
        store.write("mst_units", spark.createDataFrame(
            [("Intern", "Intern BV"), ("Business", "Business")], TABLES["mst_units"]))
        store.write("mst_training", spark.createDataFrame(
            [("Safe Desk", True, "T"), ("Policy", False, "P")], TABLES["mst_training"]))
        store.write("mst_phishing", spark.createDataFrame(
            [(500, "a", True), (501, "b", False)], TABLES["mst_phishing"]))
        store.write("source_status", spark.createDataFrame(
            [("Vendor", None, 2000, 0, 75, 90, False)]
            + [(n, *[None] * 5, False) for n in ("HR", "Master", "DWH", "Other")],
            TABLES["source_status"]))
        store.publish()

    def store(self):
        return MartStore(self.spark, str(self.folder / "mart"), TABLES)

    def land(self):
        self.runs += 1
        landed = {}
        for feed, records in self.feeds.items():
            root = self.folder / f"landed{self.runs}" / feed
            pages = records if isinstance(records, dict) else {None: records}
            for campaign, page in pages.items():
                folder = root / f"campaign_id={campaign}" if campaign else root
                folder.mkdir(parents=True)
                (folder / "1.json").write_text(json.dumps(page, indent=1))
            landed[feed] = str(root)
        return landed

    def run(self, when, **options):
        names = sorted(set(self.staff.values()))
        units = self.spark.createDataFrame(list(enumerate(names)), "unit_id int, unit_name string")
        staff = self.spark.createDataFrame(
            [
                (f"U{n}@x.test", names.index(u), date(2020, 1, 1), FOREVER, "I")
                for n, u in self.staff.items()
            ],
            "email string, unit_code int, in_service date, out_service date, kind string",
        )
        run_staging(self.store(), self.land(), when, multi_line=True)
        run_hr(self.store(), staff, units, when)
        run_load(
            self.store(), when, init_calendar=self.runs == 1, first_day=date(2024, 1, 1),
            last_day=date(2024, 12, 31), **options,
        )
        return self.store()

    def state(self):
        """Every table's rows without load times of staging, for comparison."""
        store = self.store()
        return {
            name: sorted(str(r) for r in store.read(name).collect())
            for name in TABLES
            if name.startswith(("dim_", "fact_", "bridge_"))
        }


@pytest.fixture
def mart(spark, tmp_path):
    return Mart(spark, tmp_path)


def test_first_load_and_reports(mart, rows):
    store = mart.run(datetime(2024, 3, 10, 2))
    assert rows(store.read("dim_user"), "user_id", "is_current") == [
        (1, True), (2, True), (3, True)]
    assert rows(store.read("dim_campaign"), "campaign_id", "campaign_type", "start_date_key") == [
        (40, "training", 20240201),
        (41, "policy", 20240201),  # the master's active flag does not matter here
        (500, "phishing", 20240301),
    ]
    fact = store.read("fact_recipient")
    assert rows(fact, "pst_id", "clicks_count", "reported_count", "duration_seconds") == [
        (1, 0, 1, 259200),
        (1, 1, 0, 259200),
    ]
    assert rows(store.read("fact_enrollment"), "enrollment_id", "enrollment_date_key") == [
        (900, 20240202),
        (901, 20240202),
        (902, 20240205),
    ]
    assert rows(store.read("fact_snapshot"), "snapshot_date_key", "current_risk_score") == [
        (20240310, 10), (20240310, 20), (20240310, 30)]
    assert store.read("stg_user_detail").count() == 3
    assert rows(load_status(store), "source", "run_date", "finished") == [
        ("DWH", date(2024, 3, 10), True),
        ("HR", date(2024, 3, 10), True),
        ("Master", date(2024, 3, 10), True),
        ("Other", None, False),
        ("Vendor", date(2024, 3, 10), True),
    ]

    templates = views.phishing_report(store, "templates")
    assert rows(templates, "Template_name", "Total_clicked", "Total_all") == [("T1", 1, 1)]
    assert views.phishing_report(store, "top_10").count() == 6
    assert views.phishing_report(store, "error_type").head().Total_clicked == 1
    types = views.phishing_report(store, "template_types", F.left("template_name", F.lit(1)))
    assert rows(types) == [("T", 2, 1)]
    with pytest.raises(ValueError):
        views.phishing_report(store, "template_types")
    with pytest.raises(ValueError):
        views.phishing_report(store, "no such report")

    day = views.security_dashboard(store, "day", "Passed").collect()
    assert [(r.Month, r.Day) for r in day] == [(2, 2), (2, 5), (3, 1), (3, 10)]
    last = day[-1]
    assert last.Avg_phish_prone == pytest.approx(3.0) and last.Avg_risk_score == 20.0
    assert last.Pct_response_cum == 50.0
    assert last.pct_training_completed_cum == 50.0 and last.Pct_policy_read_cum == 100.0
    assert day[0].Avg_phish_prone is None and day[0].Pct_response_cum is None
    week = views.security_dashboard(store, "week", "Passed").collect()
    assert [(r.Year, r.Week) for r in week] == [(2024, 5), (2024, 6), (2024, 9), (2024, 10)]
    month = views.security_dashboard(store, "month", "Passed").collect()
    assert [(r.Month, r.Pct_response_cum) for r in month] == [(2, None), (3, 50.0)]
    # memberships begin on the day of the load, so only the snapshot counts per unit
    unit = views.security_dashboard(store, "day", "Passed", per_unit=True).collect()
    assert [(r.Unit_naam, r.Day, r.Avg_risk_score) for r in unit] == [
        ("Business", 10, 30.0),
        ("Intern BV", 10, 15.0),
    ]
    assert [r.unit for r in views.listing(store, "units").collect()] == ["Business", "Intern"]
    for name in views.LISTINGS:
        views.listing(store, name).collect()

    assert audit_mart(store).collect() == []
    person = store.read("dim_user").filter("user_id = 2")
    store.write("dim_user", person.unionByName(person).withColumn("is_current", F.lit(None)))
    store.publish()
    found = rows(audit_mart(store), "table_name", "problem", "n_rows")
    assert found == [
        ("bridge_user_unit", "user_key not in dim_user", 2),
        ("dim_user", "is_current missing", 2),
        ("dim_user", "user_id, effective_from repeated", 2),
        ("dim_user", "user_key repeated", 2),
        ("fact_enrollment", "user_key not in dim_user", 2),
        ("fact_recipient", "user_key not in dim_user", 1),
        ("fact_snapshot", "user_key not in dim_user", 2),
    ]


def test_constraints_name_columns_that_exist():
    for table, keys in KEYS.items():
        assert {c for key in keys for c in key} <= set(TABLES[table].names)
        assert set(REQUIRED.get(table, [])) <= set(TABLES[table].names)
    for table, references in REFERENCES.items():
        assert set(references) <= set(TABLES[table].names)
        assert all(column in TABLES[parent].names for parent, column in references.values())
    assert set(KEYS) == set(TABLES)


def test_a_month_of_history_is_replaced_not_repeated(spark, tmp_path):
    store = MartStore(spark, str(tmp_path), TABLES)
    measures = TABLES["history_total"].names[1:]
    hr = spark.createDataFrame([("a", "Intern"), ("b", "Intern")], "ehash string, groep string")
    units = spark.createDataFrame([("Intern",), ("Empty",)], "unit string")
    for when, score in ((date(2024, 2, 3), 2.0), (date(2024, 3, 3), 4.0), (date(2024, 3, 9), 6.0)):
        people = spark.createDataFrame(
            [(1, "a", *[score] * 5), (2, "b", *[score + 1] * 5), (3, "c", *[99.0] * 5)],
            f"id long, ehash string, {', '.join(f'{m} double' for m in measures)}",
        )
        run_history(store, people, hr, units, datetime.combine(when, datetime.min.time()))
    for table, unit in (("history_units", ("Intern",)), ("history_total", ())):
        found = sorted(map(tuple, MartStore(spark, str(tmp_path), TABLES).read(table).collect()))
        assert [r[: 1 + len(unit)] for r in found] == [
            (date(2024, 2, 1), *unit), (date(2024, 3, 1), *unit)]
        assert [float(r[-1]) for r in found] == [2.5, 6.5]


def test_the_same_load_again_changes_nothing(mart):
    mart.run(datetime(2024, 3, 10, 2))
    before = mart.state()
    mart.run(datetime(2024, 3, 10, 9))
    assert mart.state() == before


def test_changes_over_days(mart, rows):
    mart.run(datetime(2024, 3, 10, 2))
    # next day: 2 moves, 3 leaves the source, 1 has a new e-mail, 4 is new
    users = mart.feeds["users"]
    users[0]["email"] = "renamed@x.test"
    users[2] = {"id": 4, "email": "u4@x.test", "phish_prone_percentage": None}
    mart.staff[2] = "Business"
    mart.feeds["training"][0]["name"] = "Safe Desk s2"
    mart.feeds["tests"].pop(0)  # the phishing campaign is gone
    mart.feeds["enrollments"][40][1]["status"] = "Passed"
    store = mart.run(datetime(2024, 3, 11, 2))

    people = rows(store.read("dim_user"), "user_id", "effective_from", "effective_to", "is_current")
    first, second = datetime(2024, 3, 10, 2), datetime(2024, 3, 11, 2)
    assert people == [
        (1, first, second, False),
        (1, second, None, True),
        (2, first, None, True),
        (3, first, None, True),  # gone from the source, stays current
        (4, second, None, True),
    ]
    campaigns = rows(store.read("dim_campaign"), "campaign_id", "is_current", "name")
    assert campaigns == [
        (40, False, "Safe Desk s1"),
        (40, True, "Safe Desk s2"),
        (41, True, "Policy privacy"),
        (500, False, "March"),  # phishing campaigns that vanish are closed
    ]
    keys = {r.user_key: r.user_id for r in store.read("dim_user").collect()}
    units = {r.unit_key: r.unit_code for r in store.read("dim_unit").collect()}
    bridge = sorted(
        (keys[r.user_key], units[r.unit_key], r.start_date_key, r.end_date_key, r.is_current)
        for r in store.read("bridge_user_unit").collect()
    )
    assert [r[:3] + r[4:] for r in bridge] == [
        # 1 has no HR row under the new e-mail; the membership of the old key stays open
        (1, "Intern", 20240310, True),
        (2, "Business", 20240311, True),
        (2, "Intern", 20240310, False),
        (3, "Business", 20240310, True),
    ]
    assert store.read("fact_recipient").count() == 2  # nothing is deleted
    enrollments = rows(store.read("fact_enrollment"), "enrollment_id", "status", "load_ts")
    assert enrollments == [
        (900, "Passed", first),
        (901, "Passed", first),
        (902, "Passed", first),
    ]
    snapshots = store.read("fact_snapshot").groupBy("snapshot_date_key").count()
    assert rows(snapshots) == [(20240310, 3), (20240311, 3)]
    for table in ("dim_user", "dim_unit", "dim_campaign", "dim_template"):
        surrogate = TABLES[table].names[0]
        assert duplicates(store.read(table), [surrogate]).count() == 0
    assert scd2_shape(store.read("dim_user"), ["user_id"]).count() == 0
    assert scd2_shape(store.read("dim_campaign"), ["campaign_id", "campaign_type"]).count() == 0
    for fact in ("fact_recipient", "fact_enrollment", "fact_snapshot"):
        users_ = store.read("dim_user")
        assert orphans(store.read(fact), "user_key", users_, "user_key").count() == 0


def test_a_renamed_template_keeps_its_name(mart, rows):
    mart.run(datetime(2024, 3, 10, 2))
    for record in mart.feeds["recipients"]:
        record["template"] = record["template"] | {"name": "Z"}
    mart.feeds["recipients"].append(
        {"pst_id": 1, "user": {"id": 3}, "template": {"id": 99, "name": "b"}}
    )
    mart.feeds["recipients"].append(
        {"pst_id": 2, "user": {"id": 3}, "template": {"id": 99, "name": "a"}}
    )
    store = mart.run(datetime(2024, 3, 11, 2))
    # one row per id, even when a new id comes with two names
    assert rows(store.read("dim_template"), "template_id", "template_name") == [
        (71, "T1"),
        (72, "T2"),
        (99, "a"),
    ]


def test_ambiguous_campaign_type_stops_the_load_and_publishes_nothing(mart, spark):
    store = mart.store()
    store.write("mst_training", spark.createDataFrame(
        [("Safe", True, "T"), ("Safe D", True, "P")], TABLES["mst_training"]))
    store.publish()
    with pytest.raises(PySparkException, match="source key occurs 2 times"):
        mart.run(datetime(2024, 3, 10, 2))
    assert mart.store().read("dim_user").count() == 0


def test_a_day_outside_the_calendar_stops_the_load(mart):
    with pytest.raises(ValueError, match="no record for 2025-01-01"):
        mart.run(datetime(2025, 1, 1))


def test_the_load_waits_for_its_sources(mart):
    with pytest.raises(ValueError, match="not all of Vendor, HR, Master, Other have finished"):
        mart.run(datetime(2024, 3, 10), required=["Vendor", "HR", "Master", "Other"])
    assert mart.store().read("dim_user").count() == 0
    with pytest.raises(ValueError, match="not all"):  # yesterday's flags do not count
        run_load(mart.store(), datetime(2024, 3, 11))
