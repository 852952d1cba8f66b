"""From snapshot documents to one row per station and ten-minute slot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.times import (
    scrape_time,
    slot_columns,
    slot_start,
)
from snapflow.schema import SNAPSHOT_COLUMNS

# Fixed value: scrapes before this moment may lie off the ten-minute grid.
FIRST_REGULAR_SCRAPE = "2024-03-12T12:00:00.000+00:00"

DEFAULT_DELAY = "30 minutes"


def flatten_places(docs: DataFrame) -> DataFrame:
    """One row per real station in each document; works on streams.

    A document holds one country with one city. Its places include bikes left in
    the street, which are no stations and go before the rest is spread out.
    """
    city = F.get(F.get("countries", F.lit(0))["cities"], F.lit(0))
    real = F.filter(city["places"], lambda place: place["spot"] & ~place["bike"])
    carried = [c for c in docs.columns if c != "countries"]
    return docs.select(*carried, F.explode(real).alias("place"))


def place_readings(
    places: DataFrame, since: str | None = None, scraped: str | None = None
) -> DataFrame:
    """Flattened places as readings, timed by their file's name to the minute.

    Rows whose file name holds no time are left out; `untimed_rows` counts them. With
    `scraped` that column has the time of the name already, which then was parsed once a
    document and not once a place.
    """
    time = scrape_time("filename") if scraped is None else F.col(scraped)
    readings = places.select(
        F.date_trunc("minute", time).alias("ts"),
        F.col("place.number").alias("station_id"),
        F.col("place.bikes").alias("bikes"),
        F.col("place.maintenance").alias("maintenance"),
        F.col("place.name").alias("station_name"),
        F.col("place.lat").alias("lat"),
        F.col("place.lng").alias("lng"),
    ).filter(F.col("ts").isNotNull())
    if since is None:
        return readings
    return readings.filter(F.col("ts") >= F.lit(since).cast("timestamp"))


def untimed_rows(docs: DataFrame) -> DataFrame:
    """Names of the files that hold no scrape time."""
    return docs.filter(scrape_time("filename").isNull()).select("filename")


def dedup_snapshots(
    readings: DataFrame, delay: str = DEFAULT_DELAY, since: str | None = None
) -> DataFrame:
    """One row per station and slot, `ts` being the start of the slot.

    The slot's earliest reading stays, whatever the order of the input; readings of one
    moment are told apart by a hash of their values. A stream passes a slot on once the
    watermark, which runs on slot starts and trails by `delay`, has reached it; so its
    rows are those of the batch, but for the newest slots, which wait.
    """
    if since is not None:
        readings = readings.filter(F.col("ts") >= F.lit(since).cast("timestamp"))
    slots = readings.select(slot_start("ts").alias("slot"), *SNAPSHOT_COLUMNS)
    if readings.isStreaming:
        slots = slots.withWatermark("slot", delay)
    values = [c for c in SNAPSHOT_COLUMNS if c not in ("ts", "station_id")]
    return _first_in_slot(slots, values).select(*SNAPSHOT_COLUMNS)


def _first_in_slot(readings: DataFrame, values: list[str]) -> DataFrame:
    """The earliest reading of each station in each slot.

    The order is one number, the time since the slot began and then a hash of the
    values. With numbers to pick by it, Spark aggregates in a hash map, before and
    after the shuffle; all of them come from one reading, as they share the order.
    Text does not fit that map. In batch its hash is picked in its place, and the few
    distinct texts of a station are joined to it; a stream picks the values as one struct.
    """
    texts = [name for name, kind in readings.dtypes if name in values and kind == "string"]
    hashed = ", ".join(f"xxhash64({c})" if c in texts else c for c in values)
    order = (
        "(unix_micros(ts) - unix_micros(slot)) * 8589934592"
        f" + pmod(xxhash64({hashed}), 8589934592)"
    )
    ordered = readings.withColumn("_order", F.expr(order))
    keys = ["station_id", F.col("slot").alias("ts")]
    if texts and readings.isStreaming:
        first = ordered.groupBy("station_id", "slot").agg(
            F.min_by(F.struct(*values), "_order").alias("_first")
        )
        return first.select(*keys, *[f"_first.{c}" for c in values])
    coded = ordered.withColumns({c: F.xxhash64(c) for c in texts})
    first = coded.groupBy("station_id", "slot").agg(
        *[F.min_by(c, "_order").alias(c) for c in values]
    )
    for c in texts:
        known = readings.select("station_id", c).distinct()
        known = known.select("station_id", F.xxhash64(c).alias("_code"), F.col(c).alias("_text"))
        same = first["station_id"].eqNullSafe(known["station_id"]) & (first[c] == known["_code"])
        others = [first[x].alias(x) for x in first.columns if x != c]
        first = first.join(known, same).select(*others, F.col("_text").alias(c))
    return first.select(*keys, *values)


def slot_counts(readings: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """The first reading of each station in each slot, with the slot's columns.

    Batch and stream give equal rows, save that a stream holds back the slots that
    its watermark has not passed.
    """
    slots = readings.select(
        slot_start("ts").alias("slot"), "ts", "station_id", "bikes", "maintenance"
    )
    if readings.isStreaming:
        slots = slots.withWatermark("slot", delay)
    return slot_columns(_first_in_slot(slots, ["bikes", "maintenance"]))


def first_scrape_per_slot(docs: DataFrame, ts: str = "ts") -> DataFrame:
    """The rows of the first scrape in each slot (batch), with the slot's columns.

    All rows of that scrape stay. The first scrape is found by a minimum per slot,
    which is combined before the shuffle, so a slot with very many rows is never
    sorted in one task.
    """
    slot = slot_start(ts)
    first = docs.groupBy(slot.alias("slot")).agg(F.min(ts).alias("first_ts"))
    same_scrape = (slot == F.col("slot")) & (F.col(ts) == F.col("first_ts"))
    return slot_columns(docs.join(first, same_scrape, "left_semi"), ts)
