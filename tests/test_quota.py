"""Quota use of days with tens of millions of calls."""

from pyspark.sql import functions as F

from awareness_mart.plans.load import run_staging
from awareness_mart.plans.monitoring import usage_band
from awareness_mart.schemas import FEEDS, TABLES
from awareness_mart.sources.store import MartStore
from checks.registry import RUN_TS


def test_the_band_holds_for_calls_and_limits_up_to_32_bits(spark, rows):
    most = 2**31 - 1
    used = spark.createDataFrame(
        [(54_000_000, 2000), (54_000_000, 54_000_000), (most, most), (1_700_000_000, most), (1, most)],
        "used int, most int",
    )
    band = usage_band(F.col("used"), F.col("most"), F.lit(75), F.lit(90))
    assert rows(used.select("used", "most", band)) == [
        (1, most, "INFO"),
        (1_700_000_000, most, "WARN"),
        (most, most, "ERR"),
        (54_000_000, 2000, "ERR"),
        (54_000_000, 54_000_000, "ERR"),
    ]


def test_the_staging_job_logs_a_day_of_54_million_calls(spark, tmp_path, rows):
    landed = {}
    for feed, schema in FEEDS.items():
        landed[feed] = str(tmp_path / feed)
        spark.createDataFrame([], schema).write.json(landed[feed])
    store = MartStore(spark, str(tmp_path / "mart"), TABLES)
    limits = [("Vendor", None, 2000, 0, 75, 90, False)]
    store.write("source_status", spark.createDataFrame(limits, TABLES["source_status"]))
    store.publish()
    run_staging(store, landed, RUN_TS, calls=54_000_000)
    assert rows(store.read("log"), "severity", "line") == [("ERR", "54000000 of 2000 calls")]
