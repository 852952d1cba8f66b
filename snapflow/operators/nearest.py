"""Nearest neighbours among stations, exactly, without comparing all pairs.

Places become points on the unit sphere, cut into cubes that halve in size level
by level. A station looks for its neighbours at the finest level where its own cube
holds more than `k` stations. The k-th neighbour can then be no farther than that
cube's farthest corner, nor than the k-th nearest of the stations that stand beside it in
the order of a curve; so the cubes of the same size within that reach hold all it
needs. Dense quarters are searched in small cubes and empty country in large ones.
A cube whose halves are crowded is home to the few stations of its empty halves only,
so however many stations a cube holds, few are compared with all of them.

Stations that share coordinates are one point of which only the lowest ids can be
listed by others; the rest of them are answered from that point's own list.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.geo import distance_m, unit_vector
from snapflow.sources.tables import settle

FINEST_LEVEL = 30  # cubes of about a centimetre

CUBE = ["level", "cx", "cy", "cz"]


def nearest_pairs(stations: DataFrame, k: int = 5) -> DataFrame:
    """Each station's `k` nearest others: rank and distance in whole metres.

    `stations` has one row per station_id with lat and lng. Equal distances rank by
    station_id. Stations without coordinates take no part.
    """
    points = stations.select("station_id", "lat", "lng").filter(
        F.col("lat").isNotNull() & F.col("lng").isNotNull()
    )
    listed = _lowest_ids_per_place(points, k + 1)
    return _search(listed, k).unionByName(_crowded_rest(points, listed, k))


def nearest_k(stations: DataFrame, k: int = 5) -> DataFrame:
    """Each station's list of its `k` nearest others, nearest first."""
    entry = F.struct("rank", "other_station_id")
    return (
        nearest_pairs(stations, k)
        .groupBy("station_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select("station_id", F.col("entries.other_station_id").alias("closest_stations"))
    )


def with_closest(stations: DataFrame, nearest: DataFrame) -> DataFrame:
    """Stations joined with their lists; a station without one is left out."""
    return stations.join(nearest, "station_id")


def station_distances(stations: DataFrame, k: int = 5, ordered: bool = True) -> DataFrame:
    """Distances between stations and their `k` nearest.

    Ordered, each station is given with each of its own neighbours. Otherwise a
    pair stands once, the lower id first, when either lists the other.
    """
    pairs = nearest_pairs(stations, k).select(
        "station_id", "other_station_id", "distance_meters"
    )
    if ordered:
        return pairs
    low = F.least("station_id", "other_station_id")
    high = F.greatest("station_id", "other_station_id")
    return (
        pairs.groupBy(low.alias("low"), high.alias("high"))
        .agg(F.min("distance_meters").alias("distance_meters"))
        .select(
            F.col("low").alias("station_id"),
            F.col("high").alias("other_station_id"),
            "distance_meters",
        )
    )


def _lowest_ids_per_place(points: DataFrame, n: int) -> DataFrame:
    """The `n` lowest ids at each place.

    Spark keeps only `n` rows per place before the shuffle, for a bounded rank.
    """
    by_place = Window.partitionBy("lat", "lng").orderBy("station_id")
    return points.withColumn("seat", F.row_number().over(by_place)).filter(F.col("seat") <= n)


def _search(listed: DataFrame, k: int) -> DataFrame:
    spots = settle(_located(listed), "spots")
    asking = settle(_with_home(spots, k), "searches")
    used = [row["level"] for row in asking.select("level").distinct().collect()]

    # Each station's search is work of its own, so it is spread over all tasks first;
    # the ranking then finds its rows where they are.
    probes = asking.repartition("station_id").withColumn("gap2", F.lit(0.0))
    for axis in "xyz":
        probes = (
            probes.withColumn(f"c{axis}", F.expr(f"explode(sequence(c{axis} - 2, c{axis} + 2))"))
            .withColumn("gap2", F.expr(f"gap2 + pow({_GAP.format(a=axis)}, 2)"))
            .filter("gap2 <= reach2")
        )
    offered = _laddered(spots, f"array({', '.join(map(str, used))})").selectExpr(
        *CUBE,
        "station_id AS other_station_id",
        *[f"{c} AS other_{c}" for c in ("lat", "lng", "x", "y", "z")],
    )
    chord2 = " + ".join(f"({a} - other_{a}) * ({a} - other_{a})" for a in "xyz")
    nearer = Window.partitionBy("station_id").orderBy("chord2", "other_station_id")
    metres = distance_m(F.col("lng"), F.col("lat"), F.col("other_lng"), F.col("other_lat"))
    return (
        probes.join(offered, CUBE)
        .filter("station_id <> other_station_id")
        .withColumn("chord2", F.expr(chord2))
        .filter("chord2 <= reach2")
        # What is ranked is shuffled: no more of it than its rank and the result need.
        .select(
            "station_id", "other_station_id", "chord2", metres.cast("int").alias("distance_meters")
        )
        .withColumn("rank", F.row_number().over(nearer))
        .filter(F.col("rank") <= k)
        .select("station_id", "other_station_id", "rank", "distance_meters")
    )


def _located(listed: DataFrame) -> DataFrame:
    """Stations with their point on the sphere and its cube of the finest level."""
    finest = 1 << FINEST_LEVEL
    vector = unit_vector(F.col("lng"), F.col("lat"))
    points = listed.select(
        "station_id", "lat", "lng", *[v.alias(a) for v, a in zip(vector, "xyz")]
    )
    return points.selectExpr(
        "*", *[f"least(floor(({a} + 1) / 2 * {finest}), {finest - 1}) AS q{a}" for a in "xyz"]
    )


def _laddered(spots: DataFrame, levels: str) -> DataFrame:
    """Each station once per level, with its cube there."""
    return spots.selectExpr("*", f"explode({levels}) AS level").selectExpr("*", *_CUBE_AT_LEVEL)


def _with_home(spots: DataFrame, k: int) -> DataFrame:
    """Stations with the cube to search from, and the squared reach of the search.

    With no more than `k` stations in all, the search starts from the whole.
    """
    reach2 = " + ".join(f"pow({_FAR.format(a=a)}, 2)" for a in "xyz")
    return (
        spots.join(_home_levels(spots, k), "station_id", "left")
        .withColumn("level", F.coalesce("level", F.lit(0)))
        .selectExpr("*", *_CUBE_AT_LEVEL)
        # The margin keeps rounding from hiding a cube or a station, also at the very reach.
        .withColumn(
            "reach2", F.expr(f"pow(sqrt(least({reach2}, near2)) * (1 + 1e-9) + 1e-14, 2)")
        )
        .drop("qx", "qy", "qz", "near2")
    )


def _home_levels(spots: DataFrame, k: int) -> DataFrame:
    """The finest level at which each station's cube holds more than `k` stations.

    In the order of a curve that runs through one half of every cube after the other, a
    cube's stations stand together; a cube holds a station and `k` more if `k` + 1 that
    follow one another, that station among them, do not leave it. So stations are put
    in that order, spread over all tasks by its ranges, and each looks `k` places to either
    side. Where two ranges meet, the last and first `k` are looked at once more, together.

    `near2` is the squared distance of the k-th nearest of those that it looks at, and so
    no less than that of its k-th neighbour; null where they are fewer.
    """
    order = ["curve", "curve_rest", "station_id"]
    ends = [f"{_spread(f'q{a} >> 9')} << {i}" for i, a in enumerate("zyx")]
    rest = [f"{_spread(f'q{a} & 511')} << {i}" for i, a in enumerate("zyx")]
    placed = spots.selectExpr(
        "station_id", "qx", "qy", "qz", "x", "y", "z",
        f"({ends[0]}) | ({ends[1]}) | ({ends[2]}) AS curve",
        f"({rest[0]}) | ({rest[1]}) | ({rest[2]}) AS curve_rest",
    )
    ranges = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = settle(_levels(ranges, k), "levels")
    # As many rows as there are ranges, times 2 k.
    edges = found.filter("edge").drop("level", "near2", "edge").coalesce(1).sortWithinPartitions(*order)
    both = found.unionByName(_levels(edges, k))
    return both.groupBy("station_id").agg(F.max("level").alias("level"), F.min("near2").alias("near2"))


def _spread(number: str) -> str:
    """The 21 bits of a number, two zeros after each."""
    for shift, mask in _SPREAD:
        number = f"(({number}) | (({number}) << {shift})) & {mask}L" if shift else f"({number}) & {mask}L"
    return f"({number})"


# How 21 bits are drawn apart, half by half.
_SPREAD = [
    (0, 0x1FFFFF),
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
]


def _levels(in_order: DataFrame, k: int) -> DataFrame:
    """Rows in the order of the curve with the level and the reach (near2) that their
    neighbours in the same task give, and whether they are among the first or last `k`
    there (edge)."""
    names = in_order.columns

    def out(rows, start: int, end: int, first: int, n: int | None):
        levels, near2 = _window_levels(rows, k), _window_reach(rows, k)[start:end]
        part = rows.slice(start, end - start)
        at = first + np.arange(start, end)
        edge = at < k
        if n is not None:
            edge |= at >= n - k
        return pa.RecordBatch.from_arrays(
            [
                *[part.column(c).combine_chunks() for c in names],
                pa.array(levels[start:end], pa.int32(), mask=levels[start:end] < 0),
                pa.array(near2, pa.float64(), mask=np.isinf(near2)),
                pa.array(edge),
            ],
            names=[*names, "level", "near2", "edge"],
        )

    def run(batches):
        rows, first, done = None, 0, 0  # rows held, the number of the first, and those given out
        for batch in filter(len, batches):
            table = pa.Table.from_batches([batch])
            rows = table if rows is None else pa.concat_tables([rows, table]).combine_chunks()
            # All but the last k have seen all that follow.
            ready = len(rows) - k
            if ready > done:
                yield out(rows, done, ready, first, None)
                keep = max(0, ready - k)
                rows, first, done = rows.slice(keep), first + keep, ready - keep
        if rows is not None:
            n = first + len(rows)
            yield out(rows, done, len(rows), first, n)

    kinds = ", ".join(f"{c} {kind}" for c, kind in in_order.dtypes)
    return in_order.mapInArrow(run, f"{kinds}, level int, near2 double, edge boolean")


def _window_levels(rows: pa.Table, k: int) -> np.ndarray:
    """Per row, the finest level of a cube that holds it and `k` more that stand beside it;
    -1 where there are none."""
    n = len(rows)
    levels = np.full(n, -1)
    if n > k:
        apart = np.zeros(n - k, np.int64)
        for axis in ("qx", "qy", "qz"):
            q = rows.column(axis).to_numpy()
            apart |= q[k:] ^ q[: n - k]
        shared = FINEST_LEVEL - np.frexp(apart.astype(float))[1]
        for i in range(k + 1):
            np.maximum(levels[i : i + n - k], shared, out=levels[i : i + n - k])
    return levels


def _window_reach(rows: pa.Table, k: int) -> np.ndarray:
    """Per row, the squared distance of the k-th nearest of those that stand up to `k`
    places beside it; infinite where they are fewer."""
    n = len(rows)
    near2 = np.full((n, 2 * k), np.inf)
    axes = [rows.column(a).to_numpy() for a in "xyz"]
    for i in range(1, min(k, n - 1) + 1):
        x, y, z = (a[i:] - a[: n - i] for a in axes)
        near2[: n - i, i - 1] = near2[i:, k + i - 1] = x * x + y * y + z * z
    return np.partition(near2, k - 1, axis=1)[:, k - 1]


_CUBE_AT_LEVEL = [
    f"cast(shiftright(q{a}, {FINEST_LEVEL} - level) as int) AS c{a}" for a in "xyz"
]
_WIDTH = "pow(2.0D, 1 - level)"
_LOW = "(c{a} * " + _WIDTH + " - 1)"

# Along an axis: from a station to the farther side of its own cube, and to the nearer
# side of another cube, 0 inside that cube's bounds.
_FAR = "greatest({a} - " + _LOW + ", " + _LOW + " + " + _WIDTH + " - {a})"
_GAP = "greatest(" + _LOW + " - {a}, {a} - " + _LOW + " - " + _WIDTH + ", 0.0D)"


def _crowded_rest(points: DataFrame, listed: DataFrame, k: int) -> DataFrame:
    """Neighbours of the stations that are not listed at their crowded place."""
    crowded = listed.groupBy("lat", "lng").agg(
        F.max("station_id").alias("last_listed"),
        F.count(F.lit(1)).alias("held"),
        F.array_sort(F.collect_list("station_id")).alias("ids"),
    ).filter(F.col("held") > k)
    return (
        points.join(crowded, ["lat", "lng"])
        .filter(F.col("station_id") > F.col("last_listed"))
        .select(
            "station_id",
            F.posexplode(F.slice("ids", 1, k)).alias("place", "other_station_id"),
        )
        .select(
            "station_id",
            "other_station_id",
            (F.col("place") + 1).alias("rank"),
            F.lit(0).alias("distance_meters"),
        )
    )
