"""Schemas of the landed feeds and of the tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

LONG, INT, TEXT, BINARY = LongType(), IntegerType(), StringType(), BinaryType()
BOOL, DATE, TIME = BooleanType(), DateType(), TimestampNTZType()


def _schema(**columns: DataType) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# Event columns of a recipient, in the order they enter the row hash.
RECIPIENT_EVENTS = [
    "delivered_at",
    "opened_at",
    "clicked_at",
    "replied_at",
    "attachment_opened_at",
    "macro_enabled_at",
    "data_entered_at",
    "qr_code_scanned_at",
    "reported_at",
]

# Fact column for each event.
RECIPIENT_FLAGS = {
    "delivered_count": "delivered_at",
    "opens_count": "opened_at",
    "clicks_count": "clicked_at",
    "replies_count": "replied_at",
    "attachments_opened": "attachment_opened_at",
    "data_entered": "data_entered_at",
    "macro_enabled": "macro_enabled_at",
    "qr_code_scanned": "qr_code_scanned_at",
    "reported_count": "reported_at",
}

# Landed feeds: JSON, nested as delivered. Numbers that may also arrive as text
# or as an empty string are read as text and cast leniently.
FEEDS: dict[str, StructType] = {
    "users": _schema(id=LONG, email=TEXT, phish_prone_percentage=TEXT, status=TEXT),
    "user_detail": _schema(id=LONG, current_risk_score=TEXT),
    "tests": _schema(
        campaign_id=LONG, pst_id=LONG, status=TEXT, name=TEXT, started_at=TEXT, duration=INT
    ),
    "recipients": _schema(
        pst_id=LONG,
        user=_schema(id=LONG),
        template=_schema(id=LONG, name=TEXT),
        **{name.replace("scanned_at", "scanned"): TEXT for name in RECIPIENT_EVENTS},
    ),
    "training": _schema(campaign_id=LONG, name=TEXT, status=TEXT, start_date=TEXT),
    "enrollments": _schema(
        enrollment_id=LONG,
        user=_schema(id=LONG),
        enrollment_date=TEXT,
        status=TEXT,
        campaign_id=LONG,
    ),
}

_VALID = {"effective_from": TIME, "effective_to": TIME, "is_current": BOOL}
_STAMP = {"load_ts": TIME, "hash_row": BINARY}
_MEAN = DecimalType(18, 2)
_MEANS = {
    "phish_prone_percentage": _MEAN,
    "current_risk_score": _MEAN,
    "percentage_response": _MEAN,
    "percentage_viewed": _MEAN,
    "percentage_policies": _MEAN,
}

TABLES: dict[str, StructType] = {
    # Staging
    "stg_users": _schema(
        user_id=LONG, ehash=BINARY, phish_prone_pct=DecimalType(5, 2), **_STAMP
    ),
    "stg_user_detail": _schema(user_id=LONG, current_risk_score=DecimalType(9, 4), **_STAMP),
    "stg_pst": _schema(
        campaign_id=LONG,
        pst_id=LONG,
        status=TEXT,
        name=TEXT,
        started_at=TIME,
        duration_days=INT,
        **_STAMP,
    ),
    "stg_recipient": _schema(
        pst_id=LONG,
        user_id=LONG,
        template_id=LONG,
        template=TEXT,
        **dict.fromkeys(RECIPIENT_EVENTS, TIME),
        **_STAMP,
    ),
    "stg_training": _schema(campaign_id=LONG, name=TEXT, status=TEXT, start_date=DATE, **_STAMP),
    "stg_enrollment": _schema(
        enrollment_id=LONG,
        campaign_id=LONG,
        user_id=LONG,
        enrollment_date=TIME,
        status=TEXT,
        **_STAMP,
    ),
    "stg_hr": _schema(ehash=BINARY, unit=TEXT, **_STAMP),
    "stg_md_units": _schema(unit_code=TEXT, unit_name=TEXT, **_STAMP),
    "stg_md_training": _schema(name=TEXT, active=BOOL, type=TEXT, **_STAMP),
    "stg_md_phishing": _schema(campaign_id=LONG, name=TEXT, active=BOOL, **_STAMP),
    # Dimensions: the surrogate key comes first
    "dim_user": _schema(user_key=LONG, user_id=LONG, ehash=BINARY, **_VALID),
    "dim_campaign": _schema(
        campaign_key=LONG,
        campaign_id=LONG,
        campaign_type=TEXT,
        name=TEXT,
        status=TEXT,
        start_date_key=INT,
        **_VALID,
    ),
    "dim_template": _schema(template_key=LONG, template_id=LONG, template_name=TEXT, **_VALID),
    "dim_unit": _schema(unit_key=LONG, unit_code=TEXT, unit_naam=TEXT, **_VALID),
    "dim_date": _schema(
        date_key=INT,
        date=DATE,
        year=INT,
        month=INT,
        day=INT,
        week=INT,
        quarter=INT,
        is_weekend=BOOL,
        iso_year=INT,
    ),
    # Facts and bridge
    "fact_recipient": _schema(
        pst_recipient_key=LONG,
        user_key=LONG,
        campaign_key=LONG,
        template_key=LONG,
        pst_id=LONG,
        result_status=TEXT,
        **dict.fromkeys(RECIPIENT_FLAGS, INT),
        started_date_key=INT,
        duration_seconds=LONG,
        load_ts=TIME,
    ),
    "fact_enrollment": _schema(
        enrollment_key=LONG,
        user_key=LONG,
        campaign_key=LONG,
        enrollment_id=LONG,
        status=TEXT,
        enrollment_date_key=INT,
        completion_date_key=INT,
        load_ts=TIME,
    ),
    "fact_snapshot": _schema(
        snapshot_key=LONG,
        user_key=LONG,
        snapshot_date_key=INT,
        phish_prone_pct=DecimalType(5, 2),
        current_risk_score=DecimalType(9, 4),
        load_ts=TIME,
    ),
    "bridge_user_unit": _schema(
        user_key=LONG,
        unit_key=LONG,
        start_date_key=INT,
        end_date_key=INT,
        is_current=BOOL,
        allocation_wt=DecimalType(9, 4),
    ),
    # Master data, log and load status
    "mst_units": _schema(unit=TEXT, name=TEXT),
    "mst_training": _schema(name=TEXT, active=BOOL, type=TEXT),
    "mst_phishing": _schema(campaign_id=LONG, name=TEXT, active=BOOL),
    "mst_targets": _schema(
        kpi=TEXT, target=DecimalType(5, 2), active=BOOL, active_from=DATE, active_to=DATE
    ),
    "log": _schema(timestamp=TIME, source=TEXT, severity=TEXT, line=TEXT),
    "source_status": _schema(
        source=TEXT,
        run_date=DATE,
        max_fetches=INT,
        fetched_today=INT,
        warning_percentage=INT,
        error_percentage=INT,
        finished=BOOL,
    ),
    # What the jobs report, added to and never changed
    "status_events": _schema(source=TEXT, run_date=DATE, finished=BOOL, at=TIME),
    "usage_events": _schema(source=TEXT, run_date=DATE, calls=LONG, at=TIME),
    "load_counts": _schema(
        run_ts=TIME, feed=TEXT, inserted=LONG, rejected=LONG, repeated=LONG
    ),
    # Monthly history
    "history_units": _schema(date=DATE, unit=TEXT, **_MEANS),
    "history_total": _schema(date=DATE, **_MEANS),
}

# Tables that a load replaces in parts, and the column whose values are the parts. A bucket
# is a hash of the match key; another number of buckets needs the facts written anew.
PARTITIONED = {
    "fact_recipient": "bucket",
    "fact_enrollment": "bucket",
    "fact_snapshot": "snapshot_date_key",
}
FACT_BUCKETS = 64
