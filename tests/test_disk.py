"""What the jobs write, shuffle and leave on disk."""

from datetime import date, datetime
from itertools import count
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from awareness_mart.operators.changes import merge_once
from awareness_mart.plans import facts
from awareness_mart.plans.fingerprint import fingerprints
from awareness_mart.plans.load import tidied
from awareness_mart.schemas import RECIPIENT_EVENTS, RECIPIENT_FLAGS, TABLES
from awareness_mart.sources import feeds
from awareness_mart.sources.store import MartStore, tidy, written
from checks.registry import RUN_TS
from test_landing import optimized
from test_load import Mart

DAY, NEXT = datetime(2024, 3, 10, 2), datetime(2024, 3, 11, 2)
SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture
def kept(tmp_path, monkeypatch):
    folder = tmp_path / "kept"
    folder.mkdir()
    names = count()
    monkeypatch.setattr("awareness_mart.sources.store.scratch_dir", lambda _: f"{folder}/{next(names)}")
    return folder


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())}


def test_the_jobs_leave_only_tables_on_disk(spark, tmp_path, kept):
    mart = Mart(spark, tmp_path)
    for when in (DAY, NEXT):
        mart.run(when)
        assert not list(kept.iterdir())
    assert mart.store().read("fact_recipient").count() > 0


def test_shuffle_files_go_with_their_query(spark, tmp_path, kept):
    before, was = shuffle_files(spark), spark.conf.get(SETTING, "false")
    with pytest.raises(ValueError), tidy(spark):
        spark.range(1000).groupBy(F.col("id") % 10).count().write.parquet(str(tmp_path / "out"))
        assert not {f for f in shuffle_files(spark) - before if f.startswith("shuffle_")}
        assert written(spark.range(3)).count() == 3 and len(list(kept.iterdir())) == 1
        raise ValueError
    assert not list(kept.iterdir()) and spark.conf.get(SETTING, "false") == was
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_an_inner_step_deletes_its_own_intermediates_only(spark, tmp_path, kept):
    store = MartStore(spark, str(tmp_path / "mart"), TABLES)
    left = []

    @tidied
    def step(store):
        written(spark.range(1))

    @tidied
    def job(store):
        mine = written(spark.range(2))
        step(store)
        left.append((mine.count(), len(list(kept.iterdir()))))

    job(store)
    assert left == [(2, 1)] and not list(kept.iterdir())


def test_superseded_versions_are_deleted_on_request(spark, tmp_path, rows):
    mart = Mart(spark, tmp_path)
    mart.run(DAY)
    store = mart.run(NEXT)
    tables = ("stg_users", "stg_recipient", "dim_user", "status_events", "fact_recipient")
    files = lambda t: {str(p) for p in (Path(store.root) / t).rglob("*.parquet") if p.is_file()}
    before = {t: rows(store.read(t).select([F.col(c).cast("string") for c in TABLES[t].names])) for t in tables}
    prints, had = rows(fingerprints(store)), {t: files(t) for t in tables}
    late = mart.store()
    late.pending["stg_users"] = False  # written and not yet published: the newest published stays
    late.remove_superseded()
    store = mart.store()
    for t in tables:
        found = store.read(t).select([F.col(c).cast("string") for c in TABLES[t].names])
        assert rows(found) == before[t] and files(t) <= had[t]
    assert len(list((Path(store.root) / "stg_users").glob("version=*"))) == 1
    assert files("status_events") == had["status_events"] and files("fact_recipient") == had["fact_recipient"]
    assert rows(fingerprints(store)) == prints


FACT = "sk long, k long, v string, n int, ts string, bucket int"


def merged(fact, rows):
    return merge_once(fact, rows, ["k"], ["v", "n"], "_known", "_changed")


def test_a_merge_shuffles_each_side_once(spark, rows):
    fact = spark.createDataFrame(
        [(1, 1, "a", 1, "old", 0), (2, 2, "b", 2, "old", 0), (3, 3, None, 3, "old", 1),
         (4, 4, "d", 4, "old", 1), (5, None, "e", 5, "old", 1), (6, 4, "f", 6, "old", 1)], FACT)
    new = spark.createDataFrame(
        [(1, "a", 1, "new"), (2, None, 2, "new"), (4, "d", 4, "new"), (9, "z", 9, "new")],
        "k long, v string, n int, ts string")
    after = merged(fact, new)
    assert after.columns == [*fact.columns, "_known", "_changed"]
    assert set(map(tuple, after.collect())) == {
        (1, 1, "a", 1, "old", 0, True, False),
        (2, 2, None, 2, "old", 0, True, True),
        (3, 3, None, 3, "old", 1, True, False),
        (4, 4, "d", 4, "old", 1, True, False),
        (5, None, "e", 5, "old", 1, True, False),
        (6, 4, "d", 4, "old", 1, True, True),
        (None, 9, "z", 9, "new", None, False, False),
    }
    plan = merged(fact, new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("Join") == 1
    updated, inserts = facts.merged_parts(fact, new, ["k"], ["v", "n"], "_changed")
    assert updated.count() == 6 and updated.columns == [*fact.columns, "_changed"]
    assert rows(inserts) == [(None, 9, "z", 9, "new", None)]
    for copies in ([(1, "a", 1, "x"), (1, "a", 1, "x")], [(None, "a", 1, "x")]):
        with pytest.raises(Exception, match="source key"):
            merged(fact, spark.createDataFrame(copies, new.schema)).collect()


def test_a_fact_without_rows_is_not_joined(spark, tmp_path):
    store = MartStore(spark, str(tmp_path), TABLES)
    source = spark.range(3).selectExpr("id as enrollment_id", "'s' as status")
    fresh = merge_once(store.parts("fact_enrollment"), source, ["enrollment_id"], ["status"], "_known", "_changed")
    assert "Join" not in optimized(fresh) and fresh.filter("not _known").count() == 3


def test_merged_flags_are_those_of_the_newest_delivery(spark):
    """Stored flags of any value stay where no recipient came; the others follow the bits."""
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES["fact_recipient"])
    fact = spark.range(2).select(*[
        F.lit(7).cast(f.dataType).alias(f.name) if f.name in RECIPIENT_FLAGS
        else F.col("id").cast(f.dataType).alias(f.name) if f.name in ("pst_id", "user_key", "pst_recipient_key")
        else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["fact_recipient"]])
    assert fact.schema.simpleString() == spark.createDataFrame([], layout).schema.simpleString()
    new = spark.createDataFrame([(1, 1, 0b101), (2, 2, 0)], f"pst_id long, user_key long, {facts.FLAGS} int")
    filled = new.selectExpr(
        "*", "1L as campaign_key", "2L as template_key", "20240101 as started_date_key",
        "60L as duration_seconds", "timestamp_ntz'2024-01-01 00:00:00' as load_ts")
    parts = facts.merged_parts(fact, filled, facts.RECIPIENT_KEYS, facts.RECIPIENT_UPDATES, "_changed")
    opened = [c.alias(name) for name, c in facts.opened_flags().items()]
    stored, fresh = [{r.pst_id: tuple(r)[1:] for r in p.select("pst_id", *opened).collect()} for p in parts]
    bits = tuple(int(i in (0, 2)) for i in range(len(RECIPIENT_FLAGS)))
    assert stored == {0: (7,) * 9, 1: bits} and fresh == {2: (0,) * 9}
    assert {r.pst_id: r._changed for r in parts[0].collect()} == {0: False, 1: True}


def test_events_pass_the_join_with_parents_as_days_since_the_first(spark):
    days = [date(1, 1, 1), date(9999, 12, 31), date(2024, 2, 29), None, date(2024, 3, 1), None, None, date(1969, 7, 20), None]
    shifted = [tuple(days[i:] + days[:i]) for i in range(9)] + [(None,) * 9, (days[2],) * 9]
    texts = spark.createDataFrame(
        [(i % 3, i, *[str(d) if d else "no day" for d in row]) for i, row in enumerate(shifted)],
        "pst_id long, id long, " + ", ".join(f"{e} string" for e in feeds.FEEDS["recipients"].names[3:]),
    )
    raw = texts.select(
        "pst_id", F.struct("id").alias("user"), F.struct(
            F.lit(7).cast("long").alias("id"), F.lit("T").alias("name")).alias("template"),
        *texts.columns[2:],
    )
    flat = feeds.flatten_recipients(raw, RUN_TS)
    parents = spark.range(2).withColumnRenamed("id", "pst_id")
    join = lambda rows: feeds.children_of(rows, parents, "pst_id")
    staged = feeds.hashed_after(flat, "recipients", join)
    assert staged.dtypes == flat.dtypes and staged.count() == 8
    assert staged.exceptAll(join(flat).select(flat.columns)).count() == 0
    assert {r.user_id: tuple(r[e] for e in RECIPIENT_EVENTS) for r in staged.collect()} == {
        i: tuple(d and datetime(d.year, d.month, d.day) for d in row) for i, row in enumerate(shifted) if i % 3 < 2
    }
    seen = []
    feeds.hashed_after(flat, "recipients", lambda rows: seen.append(rows.columns) or rows)
    assert not {*RECIPIENT_EVENTS} & {*seen[0]}
