"""What a landed record costs in files and in the shuffle of the staging job."""

from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from awareness_mart.plans.load import run_staging
from awareness_mart.schemas import TABLES
from awareness_mart.sources import feeds
from awareness_mart.sources.store import MartStore
from checks import landing
from checks.registry import RUN_TS


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def recipients(spark, n=1000):
    events = [
        F.when(F.col("id") % (i + 2) == 0, F.lit("2024-01-01T08:30:00.000Z")).alias(e)
        for i, e in enumerate(feeds.FEEDS["recipients"].names[3:])
    ]
    return spark.range(n).select(
        (F.col("id") % 20).alias("pst_id"),
        F.struct(F.col("id").alias("id")).alias("user"),
        F.struct(F.lit(7).cast("long").alias("id"), F.lit("T").alias("name")).alias("template"),
        *events,
    )


def test_landed_feeds_are_compressed_and_read_back(spark):
    t, delivered = SimpleNamespace(spark=spark), recipients(spark, 5000)
    text = delivered.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    for path in (landing.land(t, delivered), landing.land_damaged(t, delivered, F.lit(False))):
        assert sum(p.stat().st_size for p in Path(path).glob("part-*")) < text / 5
        assert feeds.read_feed(spark, path, "recipients").exceptAll(delivered).count() == 0
        assert feeds.read_feed(spark, path, "recipients").count() == 5000


def test_the_row_hash_is_made_behind_the_join_with_parents(spark):
    flat = feeds.flatten_recipients(recipients(spark), RUN_TS)
    parents = spark.range(10).withColumnRenamed("id", "pst_id")
    join = lambda rows: feeds.children_of(rows, parents, "pst_id")
    staged = feeds.hashed_after(flat, "recipients", join)
    assert staged.columns == flat.columns
    assert staged.exceptAll(join(flat).select(flat.columns)).count() == 0
    assert staged.count() == 500
    plan = optimized(staged)
    assert plan.index("sha2") < plan.index("Join LeftSemi") and plan.count("sha2") == 1


def test_the_staging_job_hashes_behind_its_join(spark, tmp_path, monkeypatch):
    seen = {}
    keep = MartStore.write_checked

    def spy(self, table, rows, *rest):
        seen[table] = optimized(rows)
        return keep(self, table, rows, *rest)

    monkeypatch.setattr(MartStore, "write_checked", spy)
    t, tests = SimpleNamespace(spark=spark), [(5, 1), (5, 2), (None, 3)]
    landed = {f: landing.land(t, spark.createDataFrame([], feeds.FEEDS[f])) for f in feeds.FEEDS}
    landed["tests"] = landing.land(t, spark.createDataFrame(tests, "campaign_id long, pst_id long"))
    landed["recipients"] = landing.land(t, recipients(spark))
    store = MartStore(spark, str(tmp_path), TABLES)
    limits = [("Vendor", None, 100, 0, 75, 90, False)]
    store.write("source_status", spark.createDataFrame(limits, TABLES["source_status"]))
    store.publish()
    run_staging(store, landed, RUN_TS)
    plan = seen["stg_recipient"]
    assert plan.index("sha2") < plan.index("Join")
    flat = feeds.flatten_recipients(recipients(spark).filter("pst_id in (1, 2)"), RUN_TS)
    staged = store.read("stg_recipient")
    assert staged.count() == flat.count() == 100
    assert staged.select(flat.columns).exceptAll(flat).count() == 0
