"""What a row costs in the memory of the unit dashboards."""

from pyspark.sql import functions as F

from awareness_mart.plans import dashboards


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_fact_is_summed_per_person_and_day_by_its_own_measures(spark):
    ids = spark.range(0, 400)
    day = (F.lit(20240101) + F.col("id") % 20).cast("int")
    person = (F.col("id") % 30).alias("user_key")
    rows = dashboards.measures(
        ids.select(person, day.alias("snapshot_date_key"), F.lit(5).cast("decimal(5,2)").alias("phish_prone_pct"),
                   F.lit(7).cast("decimal(9,4)").alias("current_risk_score")),
        ids.select(person, day.alias("started_date_key"), F.lit(1).alias("delivered_count"),
                   (F.col("id") % 2).cast("int").alias("reported_count")),
        ids.select(person, day.alias("enrollment_date_key"), F.lit("policy").alias("campaign_type"),
                   F.lit("F").alias("status")),
        "F",
    )
    units = ids.limit(30).selectExpr(
        "id as user_key", "'U' as Unit_naam", "20240101 as start_date_key", "cast(null as int) as end_date_key")
    dates = spark.range(20).selectExpr(
        "cast(20240101 + id as int) as date_key", "2024 as year", "1 as month", "cast(1 + id as int) as day",
        "1 as week", "2024 as iso_year")
    result = dashboards.unit_dashboard(rows, units, dates, "day")
    before_join = optimized(result).split("Join Inner, (user_key")[1]
    sums = [line for line in before_join.splitlines() if "Aggregate [user_key" in line]
    assert len(sums) == 3 and max(line.count("sum(") for line in sums) <= 4
    whole = dashboards.dashboard(rows, dates, "day")
    assert result.drop("Unit_naam").exceptAll(whole).count() == 0 and result.count() == 20
