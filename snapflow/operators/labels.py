"""Labels: the value that a key has some hours later."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOURS_AHEAD = 4
TOLERANCE_S = 10
DAY_S = 86400


def label_ahead(
    df: DataFrame,
    key: str = "station_id",
    ts: str = "ts",
    value: str = "bikes",
    hours: int = HOURS_AHEAD,
    tol_s: int = TOLERANCE_S,
    block_s: int = DAY_S,
    name: str = "label",
    one_per_moment: bool = True,
) -> DataFrame:
    """`df` with the mean of `value` of the same key `hours` later (batch).

    Rows within `tol_s` seconds of that moment count; where there are none the
    label is null. The window runs over one key and one block of time, and rows
    that a former block looks ahead to are handed to it as well. So no task sorts
    a key's whole history: a window holds at most the moments of one block.

    Where a key may have many rows in the same second, say `one_per_moment=False`:
    they are then added up first, and the label is joined back to the rows.
    """
    low, high = hours * 3600 - tol_s, hours * 3600 + tol_s
    if low <= 0:
        raise ValueError("the tolerance must be shorter than the time ahead")
    timed = df.withColumn("_second", F.unix_timestamp(ts))
    if one_per_moment:
        spread = _spread_ahead(timed, low, high, block_s)
        ahead = Window.partitionBy(key, "_block").orderBy("_second").rangeBetween(low, high)
        return _own_block(spread.withColumn(name, F.avg(value).over(ahead))).drop("_second")
    sums = timed.groupBy(key, "_second").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    # A frame holds at most a sum per second of twice the tolerance.
    ahead = Window.partitionBy(key, "_block").orderBy("_second").rangeBetween(low, high)
    spread = _spread_ahead(sums, low, high, block_s)
    mean = F.try_divide(F.sum("_sum").over(ahead), F.sum("_count").over(ahead))
    labels = _own_block(spread.withColumn(name, mean))
    return timed.join(labels.select(key, "_second", name), [key, "_second"], "left").select(
        *df.columns, name
    )


def _spread_ahead(timed: DataFrame, low: int, high: int, block_s: int) -> DataFrame:
    """Rows in their own block of time and in those that look ahead to them."""
    own = f"floor(_second / {block_s})"
    ahead_of = f"sequence(floor((_second - {high}) / {block_s}), floor((_second - {low}) / {block_s}))"
    return timed.withColumn("_own", F.expr(own)).withColumn(
        "_block", F.expr(f"explode(array_union(array(_own), {ahead_of}))")
    )


def _own_block(spread: DataFrame) -> DataFrame:
    return spread.filter("_block = _own").drop("_own", "_block")


def label_stream(
    gold: DataFrame,
    hours: int = HOURS_AHEAD,
    tol_s: int = TOLERANCE_S,
    delay: str = "0 seconds",
    block_s: int = DAY_S,
) -> DataFrame:
    """The label of each row of a stream of gold rows: station_id, ts, label.

    The stream is joined with itself, each row with those of its station `hours` later,
    and passed on once the watermark, which trails the newest row by `delay`, has gone by
    the last of them; null where none has come. The newest rows wait. Rows are held for
    that time only, so the state does not grow with history.

    A row is in one block of time, and is sent to the blocks that look ahead to it, so that
    it is compared with a station's rows of a block, not with all that a micro-batch holds.
    """
    low, high = hours * 3600 - tol_s, hours * 3600 + tol_s
    own = f"floor(unix_timestamp(ts) / {block_s}) AS block"
    first, last = (f"floor((unix_timestamp(ts) - {s}) / {block_s})" for s in (high, low))
    now = gold.selectExpr("station_id", "ts", own).withWatermark("ts", delay)
    later = gold.selectExpr(
        "station_id AS seen_at", "ts AS seen", "bikes AS seen_bikes",
        f"explode(sequence({first}, {last})) AS seen_block",
    ).withWatermark("seen", delay)
    in_time = (
        f"station_id = seen_at AND block = seen_block AND seen >= ts + INTERVAL {low} SECONDS"
        f" AND seen <= ts + INTERVAL {high} SECONDS"
    )
    met = now.join(later, F.expr(in_time), "leftOuter")
    return met.groupBy("station_id", "ts").agg(F.avg("seen_bikes").alias("label"))


def label_table(gold: DataFrame, hours: int = HOURS_AHEAD) -> DataFrame:
    """The label of each gold row, by station_id and ts; null where unknown."""
    return label_ahead(gold.select("station_id", "ts", "bikes"), hours=hours).drop("bikes")


def labelled_gold(gold: DataFrame, hours: int = HOURS_AHEAD) -> DataFrame:
    """Gold rows whose future is known, with it as `future_bikes`."""
    return label_ahead(gold, hours=hours, name="future_bikes").filter(
        F.col("future_bikes").isNotNull()
    )


def training_set(features: DataFrame, label: DataFrame) -> DataFrame:
    """Features joined with their labels, rows with any null left out."""
    return features.join(label, ["station_id", "ts"]).na.drop(how="any")


def feature_columns(df: DataFrame, exclude=("station_id", "ts", "label", "date")) -> list[str]:
    """The columns to learn from: all but key, time, label and partition."""
    return [c for c in df.columns if c not in exclude]
