"""Calendar, campaigns, legacy lists, dashboards, on rows written out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from awareness_mart.functions import loose
from awareness_mart.operators.calendar import calendar, require_day, with_date_key
from awareness_mart.plans import dashboards, history, reports
from awareness_mart.plans.campaigns import campaign_summary, phishing_retained, typed_training


def test_calendar(spark, rows):
    days = calendar(spark)
    assert days.count() == 7670
    assert rows(days.filter("date = '2025-12-29'")) == [
        (20251229, date(2025, 12, 29), 2025, 12, 29, 1, 4, False, 2026)
    ]
    assert calendar(spark, date(2024, 1, 6), date(2024, 1, 6)).head().is_weekend is True
    with pytest.raises(ValueError):
        calendar(spark, date(2024, 1, 2), date(2024, 1, 1))


def test_date_keys(spark, rows):
    days = calendar(spark, date(2024, 1, 1), date(2024, 1, 2))
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 2, 5)), (2, datetime(2025, 1, 1)), (3, None)],
        "id int, at timestamp_ntz",
    )
    assert rows(with_date_key(df, "at", days, "k"), "id", "k") == [
        (1, 20240102),
        (2, None),
        (3, None),
    ]
    assert require_day(days, date(2024, 1, 1)) == 20240101
    with pytest.raises(ValueError):
        require_day(days, date(2024, 1, 3))


TESTS = (
    "campaign_id long, pst_id long, status string, name string, started_at timestamp_ntz, "
    "duration_days int"
)


def test_campaigns(spark, rows):
    tests = spark.createDataFrame(
        [
            (1, 1, "Closed", "b", datetime(2022, 1, 1), 5),
            (1, 2, "Active", "a", datetime(2022, 1, 3), None),
            (2, 3, "Closed", "c", datetime(2021, 12, 30), 2),
            (3, 4, "Closed", "d", None, 4),
            (4, 5, "Closed", "e", datetime(2024, 1, 1), 1),
        ],
        TESTS,
    )
    assert rows(campaign_summary(tests))[0] == (
        1, "a", "Closed", date(2022, 1, 1), date(2022, 1, 6))
    masters = spark.createDataFrame(
        [(1, True), (2, True), (3, True), (4, False)], "campaign_id long, active boolean"
    )
    kept = phishing_retained(tests, masters, date(2024, 1, 1))
    # 2 ends exactly two years back; 3 has no start; 4 is not active
    assert rows(kept, "campaign_id") == [(1,), (2,)]
    assert rows(phishing_retained(tests, masters, date(2024, 1, 2)), "campaign_id") == [(1,)]


def test_training_types(spark, rows):
    training = spark.createDataFrame(
        [
            (1, "Safe Desk", "In Progress", date(2024, 1, 1)),
            (2, "safe x", "In Progress", None),
            (3, "Policy 2024", "In Progress", None),
            (4, "Other", "In Progress", None),
            (5, None, "In Progress", None),
        ],
        "campaign_id long, name string, status string, start_date date",
    )
    masters = spark.createDataFrame(
        [("Saf", "T"), ("Safe", "p"), ("policy ", "P"), ("Oth", None)],
        "name string, type string",
    )
    assert rows(typed_training(training, masters), "campaign_id", "campaign_type") == [
        (1, "policy"),
        (1, "training"),  # two prefixes of different type: two rows
        (2, "policy"),
        (2, "training"),
        (3, "policy"),
        (4, "training"),
        (5, "training"),
    ]


def test_legacy_lists(spark, rows):
    tests = spark.createDataFrame(
        [
            (1, 1, "x", "n", datetime(2021, 12, 30), 1),  # ends 2023-12-31 with two years added
            (1, 2, "x", "n", datetime(2021, 12, 30), 2),
            (1, 3, "x", "n", datetime(2020, 1, 1), None),
            (2, 4, "x", "n", datetime(2020, 1, 1), 1),
        ],
        TESTS,
    )
    masters = spark.createDataFrame([(1, True), (2, False)], "campaign_id long, active boolean")
    run = date(2024, 1, 15)
    assert rows(history.active_phishing(tests, masters, run)) == [(1,)]
    assert rows(history.active_phishing(tests, masters, run, "as_commented")) == [(2,)]
    with pytest.raises(ValueError):
        history.active_phishing(tests, masters, run, "other")
    training = spark.createDataFrame(
        [
            (1, "Policy A", "In Progress", date(2023, 12, 30)),
            (2, "Policy B", "In Progress", date(2023, 12, 31)),
            (3, "policy C", "In Progress", date(2023, 1, 1)),
            (4, "Policy D", "Closed", date(2023, 1, 1)),
        ],
        "campaign_id long, name string, status string, start_date date",
    )
    names = spark.createDataFrame([("Policy", "P")], "name string, type string")
    assert rows(history.active_training(training, names, run)) == [(1, "P")]


def test_history(spark, rows):
    measures = ", ".join(f"{m} decimal(9,4)" for m in history.MEASURES)
    one, two = Decimal(1), Decimal(2)
    users = spark.createDataFrame(
        [
            (1, b"a", one, one, one, one, one),
            (2, b"b", two, two, two, None, two),
            (3, b"c", two, two, two, two, two),
            (4, b"d", two, two, two, two, two),
        ],
        f"id long, ehash binary, {measures}",
    )
    hr = spark.createDataFrame(
        [(b"a", "A"), (b"b", "A"), (b"c", "B"), (b"d", "unlisted"), (b"z", "A")],
        "ehash binary, groep string",
    )
    units = spark.createDataFrame([("A",), ("B",), ("empty",)], "unit string")
    rollup = history.unit_rollup(users, hr, units)
    cols = ["unit", "users", "phish_prone_percentage", "percentage_viewed"]
    assert rows(rollup, *cols) == [
        ("A", 2, Decimal("1.50"), None),  # one missing measure makes the mean NULL
        ("B", 1, Decimal("2.00"), Decimal("2.00")),
        (None, 3, Decimal("1.67"), None),  # and reaches the total
    ]
    shouting = spark.createDataFrame([("a ",), ("b",)], "unit string")
    assert history.active_users(users, hr, shouting).count() == 0
    assert rows(history.active_users(users, hr, shouting, loose), "id", "unit") == [
        (1, "a "), (2, "a "), (3, "b")]
    nobody = history.unit_rollup(users.limit(0), hr, units)
    assert nobody.count() == 0

    schema = "date date, unit string, " + ", ".join(f"{m} decimal(18,2)" for m in history.MEASURES)
    before = spark.createDataFrame(
        [
            (date(2023, 12, 1), "A", *[Decimal(9)] * 5),
            (date(2024, 1, 1), "A", *[Decimal(9)] * 5),
            (date(2024, 1, 1), "gone", *[Decimal(9)] * 5),
        ],
        schema,
    )
    after = history.merge_unit_history(before, rollup, date(2024, 1, 20))
    assert rows(after, "date", "unit", "percentage_response", "percentage_viewed") == [
        (date(2023, 12, 1), "A", Decimal(9), Decimal(9)),
        (date(2024, 1, 1), "A", Decimal("1.50"), None),
        (date(2024, 1, 1), "B", Decimal(2), Decimal(2)),
        (date(2024, 1, 1), "gone", Decimal(9), Decimal(9)),
    ]
    total = before.filter("unit = 'A'").drop("unit")
    after = history.merge_total_history(total, rollup, date(2024, 1, 20))
    assert rows(after, "date", "percentage_response") == [
        (date(2023, 12, 1), Decimal(9)),
        (date(2024, 1, 1), Decimal("1.67")),
    ]


def test_unit_dashboard_follows_the_membership(spark, rows):
    days = calendar(spark, date(2024, 1, 1), date(2024, 1, 31))
    snapshots = spark.createDataFrame(
        [(1, 20240101, Decimal(10), None), (1, 20240102, Decimal(20), None),
         (1, 20240103, None, None), (2, 20240102, Decimal(40), None)],
        "user_key long, snapshot_date_key int, phish_prone_pct decimal(5,2), "
        "current_risk_score decimal(9,4)",
    )
    recipients = spark.createDataFrame(
        [(1, 20240101, 1, 0), (1, 20240102, 1, 1), (2, 20240102, 1, 0), (2, None, 1, 1),
         (2, 20250101, 1, 1)],
        "user_key long, started_date_key int, delivered_count int, reported_count int",
    )
    enrollments = spark.createDataFrame(
        [], "user_key long, enrollment_date_key int, campaign_type string, status string"
    )
    measures = dashboards.measures(snapshots, recipients, enrollments, "Passed")
    membership = spark.createDataFrame(
        [(1, "A", 20240101, 20240102), (1, "B", 20240102, None), (2, "B", 20240101, None)],
        "user_key long, Unit_naam string, start_date_key int, end_date_key int",
    )
    unit = dashboards.unit_dashboard(measures, membership, days, "day")
    found = [
        (r.Unit_naam, r.Day, r.Avg_phish_prone, r.Avg_risk_score, r.Pct_response_cum)
        for r in unit.collect()
    ]
    assert found == [
        ("A", 1, 10.0, None, 0.0),
        ("B", 2, 30.0, None, 50.0),
        ("B", 3, None, None, 50.0),
    ]
    overall = dashboards.dashboard(measures, days, "day").collect()
    assert [(r.Day, r.Pct_response_cum) for r in overall] == [
        (1, 0.0), (2, pytest.approx(100 / 3)), (3, pytest.approx(100 / 3))]


def test_sorted_listing(spark):
    table = spark.createDataFrame(
        [(1, "b", None), (2, None, "x"), (3, "a", "x"), (4, "a", "w")], "id int, v string, w string"
    )
    listed = reports.sorted_listing(table, ["id", "v"], [("v", False)])
    assert [tuple(r) for r in listed.collect()] == [(2, None), (3, "a"), (4, "a"), (1, "b")]
    listed = reports.sorted_listing(table, ["id", "v"], [("v", True)])
    assert [tuple(r) for r in listed.collect()] == [(1, "b"), (3, "a"), (4, "a"), (2, None)]


def test_top_10_breaks_ties_by_name_and_error(spark):
    flags = {
        "clicks_count": 1, "replies_count": 1, "attachments_opened": 0, "data_entered": 0,
        "macro_enabled": 0, "qr_code_scanned": 1,
    }
    fact = spark.range(1, 5).select(
        F.col("id").alias("template_key"), *[F.lit(v).alias(c) for c, v in flags.items()]
    )
    templates = spark.range(1, 5).selectExpr("id as template_key", "concat('T', id) template_name")
    top = [tuple(r) for r in reports.report_top10(fact, templates).collect()]
    errors = ["Total_clicked", "Total_qr_code_scanned", "Total_replied"]
    expected = [(f"T{n}", e, 1) for n in (1, 2, 3, 4) for e in errors][:10]
    assert top == expected


def test_unit_dashboard_joins_the_membership_once(spark):
    facts = dashboards.Measures(
        spark.createDataFrame([], "user_key long, date_key int, prone_sum long, prone_n long, risk_sum long, risk_n long"),
        spark.createDataFrame([], "user_key long, date_key int, delivered long, reported long"),
        spark.createDataFrame(
            [],
            "user_key long, date_key int, training_enrolled long, training_completed long, "
            "policy_enrolled long, policy_read long",
        ),
    )
    membership = spark.createDataFrame(
        [], "user_key long, Unit_naam string, start_date_key int, end_date_key int"
    )
    dates = spark.createDataFrame([], "date_key int, year int, month int, day int")
    result = dashboards.unit_dashboard(facts, membership, dates, "day")
    plan = result._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join Inner") == 2  # membership, calendar
