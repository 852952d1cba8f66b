from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapflow.functions.times import (
    calendar_columns,
    floor_to_slot,
    scrape_time,
    slot_columns,
    slot_start,
    with_scrape_time,
)

FLOORS = [
    (datetime(2023, 7, 2, 8, 0, 1), datetime(2023, 7, 2, 8, 0)),
    (datetime(2023, 7, 2, 8, 9, 59), datetime(2023, 7, 2, 8, 0)),
    (datetime(2023, 7, 2, 8, 10, 0), datetime(2023, 7, 2, 8, 10)),
    (datetime(2024, 2, 29, 22, 47, 13, 250000), datetime(2024, 2, 29, 22, 40)),
    (datetime(2024, 2, 29, 0, 59, 59, 999999), datetime(2024, 2, 29, 0, 50)),
    (datetime(2024, 12, 31, 23, 59, 59), datetime(2024, 12, 31, 23, 50)),
    (datetime(1969, 12, 31, 23, 55, 0), datetime(1969, 12, 31, 23, 50)),
]


@pytest.mark.parametrize("cast", ["timestamp", "timestamp_ntz"])
def test_slot_start(spark, cast):
    rows = [(str(a), str(b)) for a, b in FLOORS]
    df = spark.createDataFrame(rows, "a string, b string").select(
        F.col("a").cast(cast).alias("ts"), F.col("b").cast("timestamp").alias("wanted")
    )
    assert df.filter(slot_start("ts") != F.col("wanted")).count() == 0
    if cast == "timestamp":
        assert floor_to_slot(df, "ts").filter("ts <> wanted").count() == 0


def test_scrape_time_from_file_names(spark):
    names = ["2024-03-14T01-30-02Z.json", "2024-03-14T01-30-02", "notes.json", "", None]
    df = spark.createDataFrame([(n,) for n in names], "filename string")
    got = [r["ts"] for r in with_scrape_time(df).collect()]
    assert got == [datetime(2024, 3, 14, 1, 30, 2)] * 2 + [None] * 3
    assert df.filter(scrape_time("filename").isNull()).count() == 3


def test_calendar_and_slot_columns(spark):
    df = spark.sql("SELECT timestamp'2024-03-17 21:47:13' AS ts")
    row = calendar_columns(df).first()
    assert (row["weekday"], row["hour"], row["tenminute"]) == (1, 21, 4.7)
    row = slot_columns(df).first()
    assert (str(row["date"]), row["hour"], row["minute"]) == ("2024-03-17", 21, 40)
