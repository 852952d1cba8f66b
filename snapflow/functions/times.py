"""Column expressions over scrape times and ten-minute slots."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a snapshot file's name starts, such as 2024-03-14T01-30-02Z.
SCRAPE_TIME_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"
SCRAPE_TIME_CHARS = 19

SLOT_MINUTES = 10


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scrape_time(filename: str | Column) -> Column:
    """Scrape time at the start of a file name; null where the name has none."""
    text = F.substring(as_column(filename), 1, SCRAPE_TIME_CHARS)
    return F.try_to_timestamp(text, F.lit(SCRAPE_TIME_FORMAT))


def slot_start(ts: str | Column, minutes: int = SLOT_MINUTES) -> Column:
    """Start of the slot that `ts` lies in.

    Slots count from the epoch, so they meet the wall clock's in UTC and in any
    zone whose offset is a whole number of slots.
    """
    length = minutes * 60
    seconds = F.unix_timestamp(as_column(ts))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(length)))


def floor_to_slot(df: DataFrame, col: str, minutes: int = SLOT_MINUTES) -> DataFrame:
    """`df` with the timestamps of `col` moved back to their slot's start."""
    return df.withColumn(col, slot_start(col, minutes))


def with_scrape_time(df: DataFrame, col: str = "filename") -> DataFrame:
    """`df` with the scrape time of each row's file as `ts`."""
    return df.withColumn("ts", scrape_time(col))


def calendar_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    """`df` with weekday (Sunday is 1), hour, and minute / 10 as a double."""
    return df.select(
        "*",
        F.dayofweek(ts).alias("weekday"),
        F.hour(ts).alias("hour"),
        (F.minute(ts) / 10).alias("tenminute"),
    )


def slot_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    """`df` with the date, hour and first minute of the slot of `ts`."""
    return df.select(
        "*",
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        (F.minute(ts) - F.minute(ts) % SLOT_MINUTES).alias("minute"),
    )


def time_block(ts: str | Column, seconds: int) -> Column:
    """Number of the `seconds`-long block of time that `ts` lies in."""
    return F.floor(F.unix_timestamp(as_column(ts)) / F.lit(seconds))
