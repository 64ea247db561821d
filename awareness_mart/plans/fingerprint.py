"""What a mart holds, as one number per table that depends on contents and on no order or key.

Surrogate keys differ from mart to mart; rows are told by what the keys stand for: a fact by
the ids of its user version, campaign and template.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RECIPIENT_FLAGS
from ..sources.store import MartStore
from .monitoring import load_status

DIGITS = 15  # of the hash of a row, as many as fit a 64-bit number


def row_number_of(columns: list[Column]) -> Column:
    """The hash of a row's values, as text with - for NULL, as a number."""
    line = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, DIGITS), 16, 10).cast("decimal(38,0)")


def contents(store: MartStore) -> dict[str, DataFrame]:
    """The tables of the mart with natural keys in place of surrogate ones."""
    users, units = store.read("dim_user"), store.read("dim_unit")
    campaigns = store.read("dim_campaign")
    versions = users.select("user_key", "user_id", F.col("effective_from").alias("version"))
    kinds = campaigns.select("campaign_key", "campaign_id", "campaign_type")
    templates = store.read("dim_template").select("template_key", "template_id")
    span = ["effective_from", "effective_to", "is_current"]

    def told(table: str, *parents: DataFrame) -> DataFrame:
        """A fact with what its keys stand for; a key without parent becomes NULL."""
        return reduce(lambda t, p: t.join(p, p.columns[0], "left"), parents, store.read(table))

    return {
        "dim_user": users.select("user_id", F.lower(F.hex("ehash")).alias("ehash"), *span),
        "dim_unit": units.select("unit_code", "unit_naam", *span),
        "dim_campaign": campaigns.select(
            "campaign_id", "campaign_type", "name", "status", "start_date_key", *span
        ),
        "dim_template": store.read("dim_template").select("template_id", "template_name", *span),
        "dim_date": store.read("dim_date").select("date_key", "date"),
        "bridge_user_unit": told(
            "bridge_user_unit", versions, units.select("unit_key", "unit_code")
        ).select(
            "user_id", "version", "unit_code", "start_date_key", "end_date_key", "is_current", "allocation_wt"
        ),
        "fact_recipient": told("fact_recipient", versions, kinds, templates).select(
            "pst_id", "user_id", "version", "campaign_id", "campaign_type", "template_id",
            "result_status", *RECIPIENT_FLAGS, "started_date_key", "duration_seconds", "load_ts",
        ),
        "fact_enrollment": told("fact_enrollment", versions, kinds).select(
            "enrollment_id", "user_id", "version", "campaign_id", "campaign_type", "status",
            "enrollment_date_key", "completion_date_key", "load_ts",
        ),
        "fact_snapshot": told("fact_snapshot", versions).select(
            "user_id", "version", "snapshot_date_key", "phish_prone_pct", "current_risk_score", "load_ts"
        ),
        "source_status": load_status(store).select("source", "run_date", "finished"),
    }


def fingerprints(store: MartStore) -> DataFrame:
    """(name, fingerprint) per table: the sum of its rows' hashes, so equal rows count each time."""
    parts = [
        rows.agg(F.sum(row_number_of([F.col(c) for c in rows.columns])).alias("fingerprint")).select(
            F.lit(name).alias("name"),
            F.coalesce("fingerprint", F.lit(0)).cast("decimal(38,0)").alias("fingerprint"),
        )
        for name, rows in contents(store).items()
    ]
    return reduce(DataFrame.unionByName, parts)
