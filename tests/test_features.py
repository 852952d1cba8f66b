import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapflow.operators.asof import asof_join
from snapflow.operators.checks import check_unique, null_profile
from snapflow.operators.features import gold_features, neighbour_bikes
from snapflow.operators.labels import (
    feature_columns,
    label_ahead,
    label_table,
    labelled_gold,
    training_set,
)

START = datetime(2024, 3, 14)
SNAPSHOTS = "station_id bigint, ts timestamp, bikes bigint"


def slot(n):
    return START + timedelta(minutes=10 * n)


def test_neighbours_keep_their_places(spark):
    nearest = spark.createDataFrame(
        [(i, [j for j in range(1, 8) if j != i][:5]) for i in range(1, 7)] + [(7, [1, 2])],
        "station_id bigint, closest_stations array<bigint>",
    )
    rows = [(i, slot(0), 10 * i) for i in range(1, 9)] + [(1, slot(1), 5), (7, slot(1), None)]
    snapshots = spark.createDataFrame(rows, SNAPSHOTS)
    for parts in (1, 6):
        got = {
            (r[0], r[1]): tuple(r[2:])
            for r in neighbour_bikes(snapshots.repartition(parts), nearest).collect()
        }
        assert got[1, slot(0)] == (10, 20, 30, 40, 50, 60)
        assert got[3, slot(0)] == (30, 10, 20, 40, 50, 60)
        assert got[1, slot(1)] == (5, 0, 0, 0, 0, 0)
        assert got[7, slot(0)] == (70, 10, 20, None, None, None)
        assert got[7, slot(1)] == (None, 5, 0, None, None, None)
        assert len(got) == 9  # station 8 has no list and is left out


def test_gold_columns(spark):
    nearest = spark.createDataFrame([(1, [2]), (2, [1])], "station_id bigint, closest_stations array<bigint>")
    snapshots = spark.createDataFrame([(1, slot(3), 4), (2, slot(3), 6)], SNAPSHOTS)
    gold = gold_features(snapshots, nearest)
    assert gold.columns == [
        "station_id", "ts", "bikes", "weekday", "hour", "tenminute",
        *[f"close_bikes_{i}" for i in range(1, 6)],
    ]
    row = gold.filter("station_id = 1").first()
    assert (row.weekday, row.hour, row.tenminute, row.close_bikes_1) == (5, 0, 3.0, 6)
    assert {r.column_name: r.null_count for r in null_profile(gold).collect()}["close_bikes_2"] == 2


def brute_label(rows, tol):
    out = {}
    for s, t, _ in rows:
        later = [
            b
            for s2, t2, b in rows
            if s2 == s and b is not None and abs(int((t2 - t).total_seconds()) - 14400) <= tol
        ]
        out[s, t] = sum(later) / len(later) if later else None
    return out


@pytest.mark.parametrize("block_s", [3600, 86400, 7 * 86400])
def test_label_on_the_grid(spark, block_s):
    rng = random.Random(5)
    rows = [
        (s, slot(n), rng.choice([None, 1, 2, 3])) for s in (1, 2) for n in range(300) if rng.random() < 0.7
    ]
    df = spark.createDataFrame(rows, SNAPSHOTS)
    got = {(r.station_id, r.ts): r.label for r in label_ahead(df, block_s=block_s).collect()}
    assert got == brute_label(rows, 10)


@pytest.mark.parametrize("one_per_moment", [True, False])
def test_label_off_the_grid(spark, one_per_moment):
    rng = random.Random(6)
    rows = [(1, START + timedelta(seconds=rng.randrange(0, 90000)), rng.randrange(9)) for _ in range(400)]
    df = spark.createDataFrame(rows, SNAPSHOTS)
    found = label_ahead(df, tol_s=300, one_per_moment=one_per_moment)
    wanted = brute_label(rows, 300)
    got = [(r.station_id, r.ts, r.label) for r in found.collect()]
    assert len(got) == 400
    for s, t, label in got:
        assert label == pytest.approx(wanted[s, t])


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e300])
def test_an_odd_value_stays_in_its_own_labels(spark, odd):
    rows = [(1, START + timedelta(minutes=5 * i), odd if i == 100 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "station_id bigint, ts timestamp, bikes double")
    forms = [
        {r.ts: r.label for r in label_ahead(df, tol_s=300, one_per_moment=one).collect()}
        for one in (True, False)
    ]
    for t, label in forms[0].items():
        other = forms[1][t]
        assert label == other or (label != label and other != other) or label == pytest.approx(other)
    changed = [x for x in forms[1].values() if x is not None and not abs(x) < 1e6]
    assert len(changed) == 3


def test_label_frame_is_bounded_by_blocks(spark):
    df = spark.createDataFrame([(1, slot(0), 1)], SNAPSHOTS)
    plan = label_ahead(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(station_id" in plan and "_block" in plan.split("hashpartitioning(")[1]


def test_training_rows(spark):
    df = spark.createDataFrame(
        [(1, slot(n), n, None if n == 1 else 2) for n in range(30)],
        "station_id bigint, ts timestamp, bikes bigint, close_bikes_1 bigint",
    )
    rows = training_set(df, label_table(df))
    assert sorted(r.ts for r in rows.collect()) == [slot(n) for n in (0, 2, 3, 4, 5)]
    assert rows.filter(F.col("label") != F.col("bikes") + 24).count() == 0
    assert feature_columns(rows) == ["bikes", "close_bikes_1"]
    assert labelled_gold(df).count() == 6


def brute_asof(left, right):
    out = []
    for key, t, v in left:
        before = [(t2, w) for k2, t2, w in right if k2 == key and t2 <= t]
        out.append((key, t, v, max(before)[1] if before else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_s", [60, 3600, 10**7])
def test_asof_equals_brute_force(spark, block_s):
    rng = random.Random(7)

    def rows(n):
        # One key holds most of the rows; some moments are shared by both sides.
        return [
            (rng.choice([1, 1, 1, 2, 3]), START + timedelta(seconds=rng.randrange(0, 40000, 7)), i)
            for i in range(n)
        ]

    left, right = rows(300), rows(120) + [(9, START, 1)]
    ldf = spark.createDataFrame(left, "key bigint, ts timestamp, v bigint")
    rdf = spark.createDataFrame(right, "key bigint, ts timestamp, w bigint")
    got = asof_join(ldf, rdf, "key", "ts", block_s=block_s).collect()
    assert sorted(map(tuple, got), key=str) == brute_asof(left, right)


def test_asof_null_values_and_exclude(spark):
    left = spark.createDataFrame([(1, slot(2)), (2, slot(2))], "key bigint, ts timestamp")
    right = spark.createDataFrame(
        [(1, slot(0), 5, "a"), (1, slot(1), None, "b")], "key bigint, ts timestamp, w bigint, c string"
    )
    found = asof_join(left, right, "key", "ts", exclude=("ts",))
    assert found.columns == ["key", "w", "c"]
    # The newest row counts, even where its value is null.
    assert sorted(map(tuple, found.collect())) == [(1, None, "b"), (2, None, None)]


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert [tuple(r) for r in check_unique(df, ["a", "b"]).collect()] == [(1, 2, 2)]
