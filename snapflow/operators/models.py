"""Tables of models: versions, the current champion, and its predictions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.operators.labels import HOURS_AHEAD
from snapflow.operators.linear import linear_value

CHAMPION = "Champion"


def register_models(fitted: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Newly fitted models as rows of the models table, each with its station's next
    version. Versions are numbers, so 10 comes after 9."""
    if known is None:
        return fitted.withColumn("version", F.lit(1))
    latest = known.groupBy("station_id").agg(F.max("version").alias("_latest"))
    return (
        fitted.join(latest, "station_id", "left")
        .withColumn("version", F.coalesce("_latest", F.lit(0)) + 1)
        .drop("_latest")
    )


def champions(models: DataFrame) -> DataFrame:
    """The newest version of each station's model, under the champion's alias."""
    payload = [c for c in models.columns if c not in ("station_id", "version", "alias")]
    return (
        models.groupBy("station_id")
        .agg(F.max_by(F.struct("version", *payload), "version").alias("newest"))
        .select(
            "station_id",
            "newest.version",
            F.lit(CHAMPION).alias("alias"),
            *[f"newest.{c}" for c in payload],
        )
    )


def predict(
    features: DataFrame, models: DataFrame, xs: list[str], hours: int = HOURS_AHEAD
) -> DataFrame:
    """Each feature row's forecast by its station's model, as the model gives it and
    rounded to whole bikes, with the time it holds for.

    Rows with a null feature, and stations without a model, are left out.
    """
    scored = (
        features.na.drop(how="any", subset=xs)
        .join(models.select("station_id", "coefficients"), "station_id")
        .withColumn("prediction", linear_value(xs))
    )
    return with_validity(scored.select("station_id", "ts", "prediction"), hours)


def with_validity(scored: DataFrame, hours: int = HOURS_AHEAD) -> DataFrame:
    return scored.select(
        "*",
        F.round("prediction").cast("int").alias("prediction_bikes"),
        (F.col("ts") + F.make_interval(hours=F.lit(hours))).alias("prediction_valid"),
    )


def newest_predictions(predictions: DataFrame) -> DataFrame:
    """The predictions made at the newest time of all (batch)."""
    newest = predictions.agg(F.max("ts").alias("ts"))
    return predictions.join(newest, "ts", "left_semi").select(*predictions.columns)
