"""What the load writes, and what it joins to find memberships."""

from pathlib import Path

from pyspark.sql import functions as F

from awareness_mart.operators.bridge import membership_pairs
from awareness_mart.schemas import TABLES
from awareness_mart.sources.store import MartStore, written


def test_the_files_of_the_mart_are_zstandard(spark, tmp_path, rows):
    store = MartStore(spark, str(tmp_path), TABLES)
    units = spark.createDataFrame([("A", "a"), ("B", "b")], TABLES["mst_units"])
    store.write("mst_units", units)
    enrolled = spark.range(4).select(
        *[F.col("id").cast(f.dataType).alias(f.name) if f.name.endswith(("_id", "_key"))
          else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["fact_enrollment"]],
        (F.col("id") % 2).cast("int").alias("bucket"),
    )
    store.replace_parts("fact_enrollment", enrolled)
    store.publish()
    names = [p.name for p in Path(tmp_path).rglob("*.parquet") if p.is_file()]
    names += [Path(f).name for f in written(units).inputFiles()]
    assert len(names) >= 4 and all(n.endswith(".zstd.parquet") for n in names)
    assert rows(store.read("mst_units")) == [("A", "a"), ("B", "b")]
    assert store.read("fact_enrollment").count() == 4


def test_copies_of_a_membership_are_merged_before_the_joins(spark, rows):
    """40 people and 40 HR rows of one e-mail bring 40 rows into the join, not 1,600."""
    ehash = F.unhex((10 + F.col("id") % 1).cast("string")).alias("ehash")
    hr = spark.range(40).select(ehash, F.when(F.col("id") > 0, "A").alias("unit"))
    users = spark.range(40).select(F.col("id").alias("user_key"), ehash, F.lit(True).alias("is_current"))
    units = spark.createDataFrame([(1, "A", True)], "unit_key long, unit_code string, is_current boolean")
    pairs = membership_pairs(hr, users, units)
    assert rows(pairs) == [(i, 1) for i in sorted(range(40), key=str)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [ehash" in plan[plan.index("Join") :]
