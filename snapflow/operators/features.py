"""Features of a station at a time: its own bikes, its neighbours', the calendar."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.times import calendar_columns


def neighbour_bikes(snapshots: DataFrame, nearest: DataFrame, k: int = 5) -> DataFrame:
    """Each snapshot with the bikes at its nearest stations at the same time.

    `snapshots` has one row per station_id and ts; `nearest` has each station's
    list `closest_stations`, nearest first. A neighbour without a snapshot counts
    0 bikes; a place in the list that no neighbour fills is null; a station without
    a list is left out.

    Each snapshot is sent to the stations that list it, and to its own, and one
    aggregate by station and time puts the columns together, on a stream with a
    single stateful operator. In batch the snapshots are brought together by time
    first: a moment holds at most one row per station, so no moment is hot, and
    sending and aggregating then stay inside the task. `nearest` is as small as the
    set of stations; Spark broadcasts it if its measured size allows. A stream's snapshots
    never are: a batch without new data still passes on what its state holds, which the
    planner takes for nothing, and so for the smaller side. The left of an outer join is
    not broadcast; what nobody lists falls out with the rows whose `listed` is null.
    """
    if not snapshots.isStreaming:
        snapshots = snapshots.repartition("ts")
    routes = nearest.selectExpr(
        "station_id AS target",
        "array_size(closest_stations) AS listed",
        "posexplode(concat(array(station_id), slice(closest_stations, 1, "
        f"{k}))) AS (place, station_id)",
    )
    sent = snapshots.select("station_id", "ts", "bikes").join(
        routes, "station_id", "left" if snapshots.isStreaming else "inner"
    )
    places = range(1, k + 1)
    met = sent.groupBy(F.col("target").alias("station_id"), "ts").agg(
        F.expr("max(CASE WHEN place = 0 THEN bikes END) AS bikes"),
        F.expr("max(CASE WHEN place = 0 THEN listed END) AS listed"),
        *[F.expr(f"max(CASE WHEN place = {i} THEN bikes END) AS at_{i}") for i in places],
    )
    return met.filter("listed IS NOT NULL").selectExpr(
        "station_id",
        "ts",
        "bikes",
        *[
            f"CASE WHEN listed >= {i} THEN coalesce(at_{i}, 0L) END AS close_bikes_{i}"
            for i in places
        ],
    )


def gold_features(snapshots: DataFrame, nearest: DataFrame, k: int = 5) -> DataFrame:
    """The feature rows that models learn from, keyed by station_id and ts."""
    rows = calendar_columns(neighbour_bikes(snapshots, nearest, k))
    close = [f"close_bikes_{i}" for i in range(1, k + 1)]
    return rows.select("station_id", "ts", "bikes", "weekday", "hour", "tenminute", *close)
