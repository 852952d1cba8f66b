"""Positions in time order per key, found block by block.

A window over a key would put the key's whole history into one task. Here rows are
numbered inside blocks of time, and only the blocks' row counts, a line per key and
block, are added up over the key.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.times import time_block

DAY_S = 86400


def time_position(
    df: DataFrame, key: str = "station_id", ts: str = "ts", block_s: int = DAY_S
) -> DataFrame:
    """`df` with each row's `position` in its key's time order, from 1, and the
    key's number of rows, `total`. Rows are expected to have one moment each."""
    blocked = df.withColumn("_block", time_block(ts, block_s))
    counts = blocked.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        key,
        "_block",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(key)).alias("total"),
    )
    inside = Window.partitionBy(key, "_block").orderBy(ts)
    return (
        blocked.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [key, "_block"])
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .select(*df.columns, "position", "total")
    )
