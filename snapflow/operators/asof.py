"""Point-in-time lookup: each row with the latest earlier row of another table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.times import time_block

HOUR_S = 3600


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str = "ts",
    exclude: tuple[str, ...] = (),
    block_s: int = HOUR_S,
) -> DataFrame:
    """All rows of `left` with the columns of the newest row of `right` that has the
    same key and is not later (batch). Columns are null where there is none.

    The search has two levels. Inside a block of time, both sides are put in order
    and the last row of `right` is carried along. Across blocks, only the last row
    of each block is carried, a line per key and block. So a key with very many
    rows is split over its blocks; `block_s` sets how finely.
    """
    found_columns = [c for c in right.columns if c not in (key, ts)]
    found = F.struct(F.lit(True).alias("_any"), *found_columns)

    lefts = left.select(
        F.col(key),
        F.col(ts),
        F.lit(1).alias("_side"),
        F.struct(*[c for c in left.columns if c not in (key, ts)], F.lit(0).alias("_")).alias("_row"),
    ).withColumn("_block", time_block(ts, block_s))
    rights = right.select(
        F.col(key), F.col(ts), F.lit(0).alias("_side"), found.alias("_found")
    ).withColumn("_block", time_block(ts, block_s))

    so_far = (
        Window.partitionBy(key, "_block")
        .orderBy(ts, "_side", "_found")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = (
        lefts.unionByName(rights, allowMissingColumns=True)
        .withColumn("_here", F.last("_found", ignorenulls=True).over(so_far))
        .filter(F.col("_side") == 1)
    )

    last_of_block = rights.groupBy(key, "_block").agg(
        F.max(F.struct(ts, "_found")).alias("_last")
    )
    blocks = last_of_block.unionByName(
        lefts.select(key, "_block").distinct(), allowMissingColumns=True
    )
    # Any row of `right` in a block stands before later blocks, never before its own.
    earlier = Window.partitionBy(key).orderBy("_block").rangeBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        blocks.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .groupBy(key, "_block")
        .agg(F.max("_carried").alias("_carried"))
        .filter(F.col("_carried").isNotNull())
    )
    joined = inside.join(carried, [key, "_block"], "left").withColumn(
        "_match", F.coalesce("_here", F.col("_carried._found"))
    )
    kept_left = [
        F.col(c) if c in (key, ts) else F.col(f"_row.{c}").alias(c)
        for c in left.columns
        if c not in exclude
    ]
    kept_right = [F.col(f"_match.{c}").alias(c) for c in found_columns if c not in exclude]
    return joined.select(*kept_left, *kept_right)
