"""The stations that occur in the snapshots."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATION_COLUMNS = ("station_id", "station_name", "lat", "lng")


def district(name: str) -> Column:
    """The number that a station's name starts with; null where there is none."""
    return F.substring(name, 1, 2).try_cast("int")


def station_rows(snapshots: DataFrame) -> DataFrame:
    """Each distinct description of a station; works on streams.

    A station that was renamed or moved has a row for each description. A stream
    keeps the distinct rows as state, which grows with the stations, not with time.
    """
    return (
        snapshots.select(*STATION_COLUMNS)
        .dropDuplicates()
        .withColumn("district", district("station_name"))
    )


def last_descriptions(snapshots: DataFrame) -> DataFrame:
    """Each station's latest description, with the time it was last `seen` (batch).

    Descriptions are few beside snapshots, so they are reduced first, by a hash
    aggregate whose only state is the time last seen.
    """
    seen = snapshots.groupBy(*STATION_COLUMNS).agg(F.max("ts").alias("seen"))
    return latest_of(seen)


def latest_of(seen: DataFrame) -> DataFrame:
    """One row per station: of several descriptions the one seen last."""
    return (
        seen.groupBy("station_id")
        .agg(F.max(F.struct("seen", "station_name", "lat", "lng")).alias("last"))
        .select("station_id", "last.*")
    )


def station_catalogue(snapshots: DataFrame) -> DataFrame:
    """One row per station with its latest description and its district (batch)."""
    return with_district(last_descriptions(snapshots))


def with_district(seen: DataFrame) -> DataFrame:
    return seen.select(*STATION_COLUMNS).withColumn("district", district("station_name"))
