import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from awareness_mart.llm import codes, negatives
from awareness_mart.llm.codes import vector_codes
from awareness_mart.llm.negatives import hard_negatives, packed_pairs
from awareness_mart.llm.vectors import exact_type, looked_up, scaled

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, moved int"


def _whole(rows, scale):
    for vec_id, vector, label, *_ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            yield vec_id, [math.floor(scale * x) for x in vector], label


def brute_codes(rows, entries=256, rounds=4):
    kept = sorted(_whole(rows, 1024), key=lambda r: (r[0] is None, r[0] or 0, _bytes(r[1])))
    if not kept:
        return []
    size = -(-max(len(v) for _, v, _ in kept) // 4) * 4
    w = size // 4
    vectors = [v + [0] * (size - len(v)) for _, v, _ in kept]
    books = [[v[p * w : (p + 1) * w] for v in vectors[:entries]] for p in range(4)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for v in vectors:
                part = v[p * w : (p + 1) * w]
                groups.setdefault(near(p, part)[1], []).append(part)
            for e, parts in groups.items():
                books[p][e] = [sum(x) // len(parts) for x in zip(*parts)]
    found = [[near(p, v[p * w : (p + 1) * w]) for p in range(4)] for v in vectors]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), error in zip(kept, errors):
        total[label] = total.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [
        (i, "".join(f"{e:02x}" for _, e in f), error, total[label], sha)
        for (i, _, label), f, error in zip(kept, found, errors)
    ]


def _bytes(vector):
    return np.array(vector, "<i4").tobytes()


def brute_negatives(rows, every=10):
    one = {}
    for i, v, label in _whole(rows, 256):
        if i is not None and label is not None:
            one[i] = min(one.get(i, (label, _bytes(v), v)), (label, _bytes(v), v))
    found = []
    for a, (label, _, x) in one.items():
        if a % every:
            continue
        scored = sorted(
            ((-sum(p * q for p, q in zip(x, y)), i, other == label) for i, (other, _, y) in one.items() if i != a)
        )
        for top, p, _ in [s for s in scored if s[2]][:5]:
            window = [s for s in scored if not s[2] and 80 * -top <= 100 * -s[0] <= 100 * -top]
            found += [(a, p, k + 1, i, -top, -s) for k, (s, i, _) in enumerate(window[:5])]
    return sorted(found)


def _rows(n, seed, size=8, labels=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [rng.choice([-1, 1]) * rng.random() for _ in range(size)]
        if i % 3 == 0:  # a third of all rows are one vector
            vector = [0.5, -0.25, 0.125, 1.0, -1.0, 0.3, 0.7, -0.9][:size]
        rows.append((i, vector, rng.choice([None, *range(labels)]), "x", 1))
    rows += [
        (n, None, 1, None, None),
        (n + 1, [None] * size, 1, None, None),
        (n + 2, [float("nan")] * size, 2, None, None),
        (n + 3, [math.inf] + [0.0] * (size - 1), 2, None, None),
        (n + 4, [0.1, 0.2], 0, None, None),
        (n + 5, [], 0, None, None),
        (None, [0.4] * size, 0, None, None),
        *rows[1:2],
        *rows[1:2],
        (10, [0.3] * size, 1, None, None),
        (-20, [0.9] * size, 2, None, None),
    ]
    return rows


@pytest.mark.parametrize("n", [0, 5, 400])
def test_codes_equal_brute_force(spark, n):
    rows = _rows(n, n)
    got = [tuple(r) for r in vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(brute_codes(rows), key=str)


def test_few_entries_many_owners(spark, monkeypatch):
    """Members move between many owners, and equal results come from any number of them."""
    monkeypatch.setattr(codes, "OWNED", 7)
    rows = _rows(300, 9)
    whole = scaled(spark.createDataFrame(rows, SCHEMA), 1024)
    books = codes.fitted(whole, n_entries=6)
    got = [tuple(r) for r in codes.encoded(whole, books).select("vec_id", "code", "error").collect()]
    wanted = [(i, c, e) for i, c, e, _, sha in brute_codes(rows, entries=6)]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert {books.sha256()} == {r[4] for r in brute_codes(rows, entries=6)}


def test_only_changed_members_migrate(spark, monkeypatch):
    """What an owner wrote and kept is not shuffled again."""
    moved = []
    owned = codes._owned
    monkeypatch.setattr(codes, "_owned", lambda m, c: moved.append(sum(r["count"] for r in c)) or owned(m, c))
    whole = scaled(spark.createDataFrame(_rows(600, 4), SCHEMA), 1024)
    n = whole.count()
    codes.fitted(whole, n_entries=16)
    assert moved[0] == 4 * n and all(0 < m < 2 * n for m in moved[1:])


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes(empty).count() == 0
    assert hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    nothing = spark.createDataFrame([(1, None, 1, "", 1)], SCHEMA)
    assert vector_codes(nothing).count() == hard_negatives(nothing, F.lit(True)).count() == 0


def test_large_components_stay_exact(spark):
    """Beyond 53 bits the sums are integers; beyond 63 bits, or 32 a component, the job stops."""
    assert exact_type(2**53 - 1) is np.float64 and exact_type(2**53) is np.int64
    rows = [(i, [40_000.0 + i / 8, -50_000.0, 3.0, i / 4], i % 2, "", 0) for i in range(40)]
    got = [tuple(r) for r in vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(brute_codes(rows), key=str)
    with pytest.raises(ValueError):
        exact_type(2**63)
    with pytest.raises(Exception, match="beyond 32 bits"):
        scaled(spark.createDataFrame([(1, [1e300], 1, "", 0)], SCHEMA), 256).collect()


@pytest.mark.parametrize("bytes_", [16 << 20, 200])
def test_negatives_equal_brute_force(spark, monkeypatch, bytes_):
    """One pass or many, with ties, a third of all rows equal, and blocks of few anchors."""
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", bytes_)
    for seed, n in ((1, 30), (2, 250)):
        rows = _rows(n, seed)
        given = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = hard_negatives(given, F.col("vec_id") % 10 == 0)
        assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_pairs_sort_as_stated():
    rng = random.Random(5)
    rows = [(rng.randrange(-3, 3), rng.randrange(-(2**60), 2**60) * rng.choice([0, 1]), rng.randrange(2), rng.randrange(-9, 9)) for _ in range(300)]
    keys = {}
    for kind in (0, 1):
        mine = [r for r in rows if r[2] == kind]
        a, s, _, i = (np.array(x, np.int64) for x in zip(*mine))
        keys.update(zip(packed_pairs(a, s, kind, i)["pair"].to_pylist(), mine))
    assert [keys[k] for k in sorted(keys)] == sorted(set(rows), key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_lookup_of_hot_and_rare_keys(spark):
    rows = [(i, i % 2 if i % 3 else None) for i in range(3000)] + [(10_000 + i, 100 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, key int")
    table = df.groupBy("key").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    got = {tuple(r) for r in looked_up(df, table, "key", "n", "s").collect()}
    total = {}
    for i, k in rows:
        total[k] = total.get(k, 0) + i
    assert got == {(i, k, total[k]) for i, k in rows}
