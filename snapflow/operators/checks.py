"""Checks on keys, list lengths and nulls; each returns the facts as rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def check_list_length(df: DataFrame, col: str, length: int) -> DataFrame:
    """Number of rows whose list is not `length` long, and of all rows."""
    wrong = F.array_size(col) != length
    return df.agg(
        F.count_if(F.coalesce(wrong, F.lit(True))).alias("wrong_rows"),
        F.count(F.lit(1)).alias("row_count"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many of its values are null."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "null_count")


def list_length(df: DataFrame, col: str) -> DataFrame:
    """The lengths that the lists of `col` have, and how often each occurs."""
    return df.groupBy(F.array_size(col).alias("length")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
