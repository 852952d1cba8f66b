"""Splits of training rows: by time, by hash, and into forward folds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.operators.blocks import DAY_S, time_position


def temporal_split(
    df: DataFrame,
    key: str = "station_id",
    ts: str = "ts",
    share: float = 0.8,
    block_s: int = DAY_S,
) -> DataFrame:
    """`df` with `is_train`: true for the earliest `share` of each key's rows."""
    taken = F.floor(F.col("total") * F.lit(float(share)))
    return (
        time_position(df, key, ts, block_s)
        .withColumn("is_train", F.col("position") <= taken)
        .drop("position", "total")
    )


def hash_split(df: DataFrame, keys: list[str], share: float = 0.9, seed: int = 42) -> DataFrame:
    """`df` with `is_train`, drawn by a hash of the keys, so that a row always falls
    on the same side, in whatever order, number of partitions or time zone it is read."""
    kinds = dict(df.dtypes)
    parts = [
        (F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k)).cast("string") for k in keys
    ]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_train", draw < F.lit(int(round(share * 2**32))))


def forward_folds(
    df: DataFrame,
    key: str = "station_id",
    ts: str = "ts",
    folds: int = 5,
    block_s: int = DAY_S,
) -> DataFrame:
    """`df` with `chunk`, from 0 to `folds`, in time order of each key.

    Fold f learns from the chunks before f and is tested on chunk f, so a model
    never sees rows later than those it is tested on.
    """
    chunk = F.floor((F.col("position") - 1) * (folds + 1) / F.col("total"))
    return (
        time_position(df, key, ts, block_s)
        .withColumn("chunk", chunk.cast("int"))
        .drop("position", "total")
    )
