"""Change tracking: dimensions, upserts, keys, bridge."""

from datetime import datetime, timedelta
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from awareness_mart.operators.bridge import bridge_apply
from awareness_mart.operators.changes import (
    insert_missing,
    keyed_update,
    new_or_changed,
    scd2_apply,
    unique_or_fail,
    upsert,
)
from awareness_mart.operators.keys import assign_keys, fill_keys, highest_key
from awareness_mart.operators.latest import latest_per_key
from awareness_mart.operators.prefix import prefix_join
from awareness_mart.plans.audit import (
    all_duplicates,
    domain,
    duplicates,
    orphans,
    scd2_shape,
    stale_bridge_rows,
)

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
DIM = (
    "k long, id long, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
    "is_current boolean"
)


def dim(spark, data):
    return spark.createDataFrame(data, DIM)


def src(spark, data):
    return spark.createDataFrame(data, "id long, v string")


def test_scd2_rules(spark, rows):
    before = dim(
        spark,
        [
            (1, 10, "same", T0, None, True),
            (2, 11, "old", T0, None, True),
            (3, 12, "gone", T0, None, True),
            (4, 13, None, T0, None, True),
            (5, 11, "older", T0 - timedelta(9), T0, False),
        ],
    )
    today = src(spark, [(10, "same"), (11, "new"), (13, ""), (14, None)])
    after = scd2_apply(before, today, ["id"], {"v": ""}, T1, "k")
    assert rows(after) == [
        (1, 10, "same", T0, None, True),
        (2, 11, "old", T0, T1, False),
        (3, 12, "gone", T0, None, True),  # gone from the source: stays current
        (4, 13, None, T0, None, True),  # NULL and '' are the same
        (5, 11, "older", T0 - timedelta(9), T0, False),
        (None, 11, "new", T1, None, True),
        (None, 14, None, T1, None, True),
    ]


def test_scd2_closes_missing_rows_on_request(spark, rows):
    before = dim(spark, [(1, 10, "a", T0, None, True), (2, 11, "b", T0, None, True)])
    after = scd2_apply(
        before, src(spark, []), ["id"], {"v": ""}, T1, "k", close_missing=F.col("v") == "a"
    )
    assert rows(after, "id", "effective_to", "is_current") == [(10, T1, False), (11, None, True)]


def test_scd2_reopens_a_closed_key(spark, rows):
    before = dim(spark, [(1, 10, "a", T0, T1, False)])
    after = scd2_apply(before, src(spark, [(10, "a")]), ["id"], {"v": ""}, T2, "k")
    assert rows(after, "id", "effective_from", "is_current") == [(10, T0, False), (10, T2, True)]


def test_scd2_refuses_repeated_source_keys(spark):
    twice = src(spark, [(10, "a"), (10, "b")])
    with pytest.raises(PySparkException, match="source key occurs 2 times"):
        scd2_apply(dim(spark, []), twice, ["id"], {"v": ""}, T1).collect()


snapshots = st.lists(
    st.dictionaries(st.integers(0, 5), st.sampled_from([None, "", "a", "b"]), max_size=6),
    min_size=1,
    max_size=3,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(snapshots)
def test_scd2_over_any_sequence(spark, sequence):
    """The current rows follow the snapshots, the history stays proper, repeats change nothing."""
    state, seen = dim(spark, []), {}
    for step, snapshot in enumerate(sequence):
        when = T0 + timedelta(step)
        today = src(spark, list(snapshot.items()))
        state = scd2_apply(state, today, ["id"], {"v": ""}, when, "k")
        state = spark.createDataFrame(state.collect(), DIM)
        for key, value in snapshot.items():
            if key not in seen or (seen[key] or "") != (value or ""):
                seen[key] = value
        again = scd2_apply(state, today, ["id"], {"v": ""}, when + timedelta(hours=1), "k")
        assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))
    current = {r.id: r.v for r in state.filter("is_current").collect()}
    assert current == seen
    assert scd2_shape(state, ["id"]).count() == 0


def test_new_or_changed(spark, rows):
    current = dim(spark, [(1, 10, "a", T0, None, True), (2, 11, None, T0, None, True)])
    today = src(spark, [(10, "b"), (11, ""), (12, "c")])
    assert rows(new_or_changed(current, today, ["id"], {"v": ""})) == [(10, "b"), (12, "c")]


def test_insert_missing(spark, rows):
    target = spark.createDataFrame([(1, 10, "a")], "k long, id long, v string")
    result = insert_missing(target, src(spark, [(10, "x"), (11, "y")]), ["id"])
    assert rows(result) == [(1, 10, "a"), (None, 11, "y")]


FACT = "k long, id long, v string, first long, status string"


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, 10, "a", 1, "s"), (2, 11, "b", 1, "s")], FACT)
    new = spark.createDataFrame([(11, None, 9), (12, "c", 9)], "id long, v string, first long")
    result = upsert(
        target, new, ["id"], ["v"], ["first"], {"status": F.lit(None).cast("string")}
    )
    assert rows(result) == [
        (1, 10, "a", 1, "s"),
        (2, 11, None, 1, "s"),  # updated to NULL, first value and status kept
        (None, 12, "c", 9, None),
    ]


def test_upsert_refuses_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, 10, "a", 1, "s")], FACT)
    new = spark.createDataFrame([(11, "x", 9), (11, "y", 9)], "id long, v string, first long")
    with pytest.raises(PySparkException, match="occurs 2 times"):
        upsert(target, new, ["id"], ["v"], ["first"]).collect()


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.dictionaries(st.integers(0, 9), st.integers(0, 3)),
    st.dictionaries(st.integers(0, 9), st.integers(0, 3)),
)
def test_upsert_is_a_dictionary_update(spark, target, source):
    schema = "id long, v long"
    result = upsert(
        spark.createDataFrame(list(target.items()), schema),
        spark.createDataFrame(list(source.items()), schema),
        ["id"],
        ["v"],
    )
    assert {r.id: r.v for r in result.collect()} == target | source


def test_keyed_update_inserts_nothing(spark, rows):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, v string, w long")
    changes = spark.createDataFrame([(2, None), (3, "z")], "id long, v string")
    result = keyed_update(target, changes, ["id"], ["v"])
    assert rows(result) == [(1, "a", 5), (2, None, 6)]


def test_unique_or_fail_passes_unique_rows(spark, rows):
    df = src(spark, [(1, "a"), (2, "a")])
    assert rows(unique_or_fail(df, ["id"])) == [(1, "a"), (2, "a")]


def test_surrogate_keys_are_unique_stable_and_above_the_old_ones(spark):
    new = spark.range(1000).select(F.lit(None).cast("long").alias("k"), "id")
    old = spark.createDataFrame([(500, 5000)], "k long, id long")
    keyed = fill_keys(old.unionByName(new), "k", ["id"], highest_key(old, "k"))
    first = {r.id: r.k for r in keyed.collect()}
    assert first[5000] == 500
    fresh = [k for i, k in first.items() if i != 5000]
    assert len(set(fresh)) == 1000 and min(fresh) > 500
    shuffled = old.unionByName(new.repartition(7).orderBy(F.rand(1)))
    again = fill_keys(shuffled, "k", ["id"], highest_key(old, "k"))
    assert {r.id: r.k for r in again.collect()} == first


def test_surrogate_keys_from_an_empty_table(spark):
    empty = spark.createDataFrame([], "k long, id long")
    rows_ = spark.range(3).select("id")
    keys = [r.k for r in assign_keys(rows_, "k", ["id"], highest_key(empty, "k")).collect()]
    assert len(set(keys)) == 3 and min(keys) >= 1


def test_latest_per_key_keeps_null_values(spark, rows):
    df = spark.createDataFrame(
        [(1, 5.0, 1), (1, None, 2), (2, 7.0, 1)], "id long, score double, at int"
    )
    assert rows(latest_per_key(df, ["id"], "at"), "id", "at", "score") == [
        (1, 2, None),
        (2, 1, 7.0),
    ]


def brute_prefix(names, prefixes, upper):
    def fold(text):
        return text.upper() if upper else text

    return [
        (n, p)
        for n in names
        for p in prefixes
        if n is not None and p is not None and fold(n).startswith(fold(p).rstrip(" "))
    ]


@pytest.mark.parametrize("upper", [True, False])
def test_prefix_join(spark, rows, upper):
    names = ["Safe Desk 3", "safe", "Policy x", "Pol", None, "a b", "ab", "", "Policy x"]
    prefixes = ["Safe Desk", "POLICY", "Pol  ", "a ", "", None, "zz"]
    left = spark.createDataFrame([(n,) for n in names], "name string")
    right = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    expected = brute_prefix(names, prefixes, upper)
    inner = prefix_join(left, "name", right, "prefix", upper=upper)
    assert rows(inner, "name", "prefix") == sorted(expected)
    outer = prefix_join(left, "name", right, "prefix", how="left", upper=upper)
    matched = {n for n, _ in expected}
    assert outer.count() == len(expected) + len([n for n in names if n not in matched])


BRIDGE = (
    "user_key long, unit_key long, start_date_key int, end_date_key int, is_current boolean, "
    "allocation_wt decimal(9,4)"
)


def bridge_step(spark, state, pairs, live, day):
    after = bridge_apply(
        spark.createDataFrame(state, BRIDGE),
        spark.createDataFrame(pairs, "user_key long, unit_key long"),
        spark.createDataFrame([(u,) for u in live], "user_key long"),
        day,
    )
    return [tuple(r) for r in after.collect()]


def test_bridge(spark):
    state = bridge_step(spark, [], [(1, 1), (2, 1), (3, 1)], [1, 2, 3], 20240101)
    assert sorted(r[:5] for r in state) == [
        (1, 1, 20240101, None, True),
        (2, 1, 20240101, None, True),
        (3, 1, 20240101, None, True),
    ]
    assert {float(r[5]) for r in state} == {1.0}
    # 1 stays, 2 moves, 3 has no current dimension row any more: its membership stays open
    state = bridge_step(spark, state, [(1, 1), (2, 2)], [1, 2], 20240102)
    assert sorted(r[:5] for r in state) == [
        (1, 1, 20240101, None, True),
        (2, 1, 20240101, 20240102, False),
        (2, 2, 20240102, None, True),
        (3, 1, 20240101, None, True),
    ]
    assert sorted(bridge_step(spark, state, [(1, 1), (2, 2)], [1, 2], 20240102)) == sorted(state)
    # back and forth on one day: the row opened today is reopened, not repeated
    state = bridge_step(spark, state, [(1, 1), (2, 1)], [1, 2], 20240102)
    state = bridge_step(spark, state, [(1, 1), (2, 2)], [1, 2], 20240102)
    keys = [r[:3] for r in state]
    assert len(keys) == len(set(keys))
    assert (2, 2, 20240102, None, True) in [r[:5] for r in state]
    assert (2, 1, 20240102, 20240102, False) in [r[:5] for r in state]


def test_audits(spark, rows):
    table = spark.createDataFrame(
        [(1, "a", 1), (1, "b", None), (2, "a", 9)], "id long, v string, ref long"
    )
    parents = spark.createDataFrame([(1,)], "id long")
    assert rows(duplicates(table, ["id"])) == [(1, 2)]
    assert rows(orphans(table, "ref", parents, "id")) == [(9, 1)]
    found = domain(table, {"v": ["a"]}, ["ref"])
    assert rows(found) == [("ref missing", 1), ("v not allowed", 1)]
    summary = all_duplicates({"t": (table, ["id"]), "u": (table, ["id", "v"])})
    assert rows(summary) == [("t", 1, 2), ("u", 0, 0)]


def test_scd2_shape_finds_problems(spark, rows):
    bad = dim(
        spark,
        [
            (1, 10, "a", T0, None, True),
            (2, 10, "b", T1, None, True),  # two current rows, the first reaches into the second
            (3, 11, "a", T1, T0, False),  # ends before it starts
            (4, 12, "a", T0, T1, False),
            (5, 12, "a", T1, None, True),  # fine
            (6, 13, "a", T0, T2, False),
            (7, 13, "a", T0 + timedelta(hours=1), T2, True),  # overlap inside one day
            (8, 14, "a", T0, None, False),
            (9, 14, "a", T0, None, True),  # same start twice
        ],
    )
    assert rows(scd2_shape(bad, ["id"])) == [
        (10, 2, 0, 1),
        (11, 0, 1, 0),
        (13, 1, 0, 1),
        (14, 1, 0, 1),
    ]


def test_stale_bridge_rows(spark, rows):
    bridge = spark.createDataFrame(
        [(1, 1, 1, None, True, None), (2, 1, 1, None, True, None)], BRIDGE
    )
    users = spark.createDataFrame([(1, True), (2, False)], "user_key long, is_current boolean")
    assert rows(stale_bridge_rows(bridge, users), "user_key") == [(2,)]


def test_row_order_does_not_matter(spark, rows):
    data = [(i, str(i % 3)) for i in range(50)]
    target = spark.createDataFrame([(None, i, "x", 1, None) for i in range(0, 50, 2)], FACT)
    results = [
        rows(upsert(target, src(spark, order), ["id"], ["v"]), "id", "v")
        for order in (data, data[::-1])
    ]
    assert reduce(lambda a, b: a if a == b else None, results) is not None
