import math
import random

import pytest
from pyspark.sql import functions as F

from snapflow.functions.geo import distance_m
from snapflow.operators.checks import check_list_length, list_length
from snapflow.operators.nearest import (
    _located,
    _with_home,
    nearest_k,
    nearest_pairs,
    station_distances,
    with_closest,
)
from snapflow.operators.stations import station_catalogue, station_rows


def brute_force(places, k):
    """Nearest ids by chord length, then id."""

    def vector(lat, lng):
        la, lo = math.radians(lat), math.radians(lng)
        return math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)

    points = {i: vector(lat, lng) for i, lat, lng in places}
    found = {}
    for i, p in points.items():
        others = sorted(
            (sum((a - b) ** 2 for a, b in zip(p, q)), j) for j, q in points.items() if j != i
        )
        found[i] = [j for _, j in others[:k]]
    return found


def frame(spark, places):
    return spark.createDataFrame(places, "station_id bigint, lat double, lng double")


def city(seed, n):
    rng = random.Random(seed)
    return [(i, 47.5 + rng.gauss(0, 0.03), 19.05 + rng.gauss(0, 0.05)) for i in range(n)]


def crowd(seed, n):
    """A third of all stations within a metre of each other, the rest far and wide."""
    rng = random.Random(seed)
    places = []
    for i in range(n):
        if i % 3:
            places.append((i, rng.uniform(-90, 90), rng.uniform(-180, 180)))
        else:
            places.append((i, 47.5 + rng.random() * 1e-5, 19.0 + rng.random() * 1e-5))
    return places


def edges():
    """Around the date line and the pole."""
    rng = random.Random(3)
    line = [(i, rng.uniform(-1, 1), rng.choice([-180, 179]) + rng.random()) for i in range(60)]
    pole = [(100 + i, 89 + rng.random(), rng.uniform(-180, 180)) for i in range(60)]
    return line + pole


@pytest.mark.parametrize(
    "places,k",
    [
        (city(1, 200), 5),
        (crowd(2, 240), 5),
        (edges(), 4),
        (city(4, 6), 5),
        (city(5, 4), 5),
        (city(6, 1), 5),
        (city(7, 50), 1),
    ],
    ids=["city", "crowd", "edges", "six", "four", "one", "k1"],
)
def test_nearest_equals_brute_force(spark, places, k):
    got = {r.station_id: r.closest_stations for r in nearest_k(frame(spark, places), k).collect()}
    wanted = {i: found for i, found in brute_force(places, k).items() if found}
    assert got == wanted


def test_nearest_of_copies(spark):
    """A third of the stations share one place; each still has its nearest five."""
    places = city(8, 60) + [(1000 + i, 47.5, 19.0) for i in range(30)]
    got = {r.station_id: r.closest_stations for r in nearest_k(frame(spark, places)).collect()}
    assert got == brute_force(places, 5)
    assert got[1029] == [1000, 1001, 1002, 1003, 1004]
    assert got[1000] == [1001, 1002, 1003, 1004, 1005]


def test_nearest_does_not_depend_on_partitions(spark):
    df = frame(spark, city(9, 80) + [(500 + i, 47.5, 19.0) for i in range(9)])
    first, second = (
        sorted((r.station_id, r.rank, r.other_station_id, r.distance_meters) for r in rows)
        for rows in (
            nearest_pairs(df.repartition(1)).collect(),
            nearest_pairs(df.repartition(7)).collect(),
        )
    )
    assert first == second


def test_nearest_compares_no_cross_product(spark):
    plan = nearest_pairs(frame(spark, city(1, 50)))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_station_without_place_takes_no_part(spark):
    df = frame(spark, city(10, 7) + [(99, None, 19.0)])
    got = {r.station_id: r.closest_stations for r in nearest_k(df).collect()}
    assert 99 not in got and all(99 not in found for found in got.values())
    assert with_closest(df, nearest_k(df)).count() == 7


def test_distances(spark):
    df = frame(spark, city(11, 40))
    ordered = station_distances(df, 3)
    pairs = {(r[0], r[1]): r[2] for r in ordered.collect()}
    assert len(pairs) == 120
    unordered = {(r[0], r[1]): r[2] for r in station_distances(df, 3, ordered=False).collect()}
    assert set(unordered) == {(min(p), max(p)) for p in pairs}
    assert all(unordered[min(p), max(p)] == d for p, d in pairs.items())


def test_distance_of_equal_places_is_zero(spark):
    lat = F.col("id") / 100.0
    d = distance_m(F.lit(19.0), lat, F.lit(19.0), lat)
    assert spark.range(2000).select(F.max(d).alias("d")).first().d < 0.2
    known = distance_m(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0))
    assert abs(spark.range(1).select(known.alias("d")).first().d - 6371000 * math.pi / 2) < 1e-6


def test_catalogue_takes_the_latest_description(spark):
    df = spark.createDataFrame(
        [
            ("2024-03-14 01:00:00", 1, "0101-Old", 47.5, 19.0),
            ("2024-03-14 02:00:00", 1, "0101-New", 47.6, 19.0),
            ("2024-03-14 01:30:00", 1, "0101-Old", 47.5, 19.0),
            ("2024-03-14 01:00:00", 2, "Depot", 47.7, 19.1),
        ],
        "ts string, station_id bigint, station_name string, lat double, lng double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.station_id: (r.station_name, r.lat, r.district) for r in station_catalogue(df).collect()}
    assert got == {1: ("0101-New", 47.6, 1), 2: ("Depot", 47.7, None)}
    assert station_rows(df).count() == 3


def test_list_checks(spark):
    df = spark.createDataFrame([([1, 2],), ([1],), (None,)], "ids array<bigint>")
    assert tuple(check_list_length(df, "ids", 2).first()) == (2, 3)
    assert {(r.length, r.row_count) for r in list_length(df, "ids").collect()} == {
        (2, 1), (1, 1), (None, 1),
    }


def test_few_stations_lie_within_the_reach_of_a_search(spark):
    """The reach holds the k nearest, and not many more: what lies in it is shuffled."""
    k, places = 5, city(7, 1500)
    spots = _located(frame(spark, places))
    points = {r.station_id: (r.x, r.y, r.z) for r in spots.collect()}
    held = []
    for r in _with_home(spots, k).collect():
        p = points[r.station_id]
        near = [sum((a - b) ** 2 for a, b in zip(p, q)) for q in points.values()]
        held.append(sum(d <= r.reach2 for d in near) - 1)
    assert min(held) >= k
    assert sum(held) < 40 * len(held)
