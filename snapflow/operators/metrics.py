"""Quality of predictions, as one aggregate."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, keys: list[str], y: str, p: str) -> DataFrame:
    """r2, mse and rmse of prediction `p` for truth `y`, per key, in one pass.

    r2 is null where the truth does not vary. Rows where either is null do not count.
    """
    both = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    error = F.col(y).cast("double") - F.col(p).cast("double")
    sums = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("_spread"),
    )
    return sums.select(
        *keys,
        "row_count",
        r2_of("mse", "_spread").alias("r2"),
        "mse",
        F.sqrt("mse").alias("rmse"),
    )


def r2_of(mse: str, spread: str) -> Column:
    return F.when(F.col(spread) > 0, 1 - F.col(mse) / F.col(spread))


def log_runs(
    metrics: DataFrame,
    run_name: str,
    keys: list[str],
    parameters: dict[str, float] | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Metrics as rows of the runs table: run, keys, name and value of each, and the
    run's parameters and time where they are given."""
    named = [c for c in metrics.columns if c not in keys]
    doubles = metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in named])
    told = []
    if parameters is not None:
        pairs = [F.lit(x) for k, v in parameters.items() for x in (k, float(v))]
        told.append(F.create_map(*pairs).cast("map<string, double>").alias("parameters"))
    if at is not None:
        told.append(F.lit(at).alias("run_at"))
    return doubles.unpivot(keys, named, "metric", "value").select(
        F.lit(run_name).alias("run_name"), *keys, "metric", "value", *told
    )
