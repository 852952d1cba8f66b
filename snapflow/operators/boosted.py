"""Boosted trees over the rows of all stations, by Spark's own distributed trees.

One model learns from every station. `station_level`, a station's mean label among
the training rows, stands for the station: trees split categories in the order of
their means anyway, and a number puts no bound on how many stations there are.
"""

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.operators.metrics import regression_metrics
from snapflow.sources.tables import settle, shared_folder

# The tuned parameters, but for the depth: Spark's trees stop at 30.
TUNED_TREES = 140
TUNED_DEPTH = 30
TUNED_MIN_LEAF = 14
DEEPEST = 30
#: A leaf holds this share of the rows at least, so that a tree's size, and with it the
#: driver's memory, does not grow with the data.
MIN_LEAF_SHARE = 1e-5


@dataclass
class BoostedModel:
    model: GBTRegressionModel
    levels: DataFrame
    overall: float
    assembler: VectorAssembler
    key: str

    def predict(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`. A station that was not learnt gets the mean of
        those that were."""
        ready = _with_level(df, self.levels, self.overall, self.key)
        assembled = self.assembler.transform(ready)
        return self.model.transform(assembled).drop("station_level", "features")


    def save(self, folder: str | None = None) -> str:
        """Write the model to a folder that all executors share; its path."""
        spark = self.levels.sparkSession
        folder = folder or shared_folder(spark, "boosted")
        self.model.write().overwrite().save(f"{folder}/trees")
        self.levels.write.mode("overwrite").parquet(f"{folder}/levels")
        facts = [(self.overall, self.key, self.assembler.getInputCols())]
        kinds = "overall double, key string, inputs array<string>"
        spark.createDataFrame(facts, kinds).write.mode("overwrite").parquet(f"{folder}/facts")
        return folder


def load_boosted(spark: SparkSession, folder: str) -> BoostedModel:
    """A model that `save` has written, in this job or another."""
    facts = spark.read.parquet(f"{folder}/facts").first()
    return BoostedModel(
        GBTRegressionModel.load(f"{folder}/trees"),
        spark.read.parquet(f"{folder}/levels"),
        facts["overall"],
        VectorAssembler(inputCols=list(facts["inputs"]), outputCol="features"),
        facts["key"],
    )


def evaluate_and_refit_boosted(
    split: DataFrame, xs: list[str], y: str = "label", key: str = "station_id", **parameters
) -> tuple[DataFrame, BoostedModel]:
    """Quality per station of a model of the training rows (`is_train`) on the others,
    and the model of all rows. Without training rows there is no quality."""
    train, test = split.filter("is_train"), split.filter("not is_train")
    if train.isEmpty():
        unknown = test.limit(0).withColumn("prediction", F.lit(None).cast("double"))
        quality = regression_metrics(unknown, [key], y, "prediction")
    else:
        first = fit_boosted(train, xs, y, key, **parameters)
        quality = settle(boosted_station_metrics(first, test, y), "quality")
    return quality, fit_boosted(split, xs, y, key, **parameters)


def register_boosted(
    spark: SparkSession,
    model: BoostedModel,
    metrics: DataFrame,
    name: str,
    known: DataFrame | None = None,
    **parameters,
) -> DataFrame:
    """The saved model as a row of the table of boosted models: name, version, path,
    parameters, and mean r2 and rmse over the stations of `metrics`."""
    latest = None
    if known is not None:
        latest = known.filter(F.col("name") == name).agg(F.max("version")).first()[0]
    given = {k: float(v) for k, v in parameters.items()}
    row = [(name, (latest or 0) + 1, model.save(), given)]
    kinds = "name string, version int, path string, parameters map<string, double>"
    means = metrics.agg(F.avg("r2").alias("r2"), F.avg("rmse").alias("rmse"))
    return spark.createDataFrame(row, kinds).join(means)


def boosted_champion(spark: SparkSession, models: DataFrame, name: str) -> BoostedModel:
    """The newest version of a named model, loaded."""
    newest = models.filter(F.col("name") == name).orderBy(F.desc("version")).first()
    if newest is None:
        raise ValueError(f"no model named {name}")
    return load_boosted(spark, newest["path"])


def _with_level(df: DataFrame, levels: DataFrame, overall: float, key: str) -> DataFrame:
    level = F.coalesce("station_level", F.lit(overall))
    return df.join(levels, key, "left").withColumn("station_level", level)


@dataclass
class Prepared:
    """Training rows made ready once, for any number of fits."""

    rows: DataFrame
    levels: DataFrame
    overall: float
    assembler: VectorAssembler
    key: str
    y: str

    def fit(
        self,
        trees: int = TUNED_TREES,
        max_depth: int = TUNED_DEPTH,
        min_leaf: int = TUNED_MIN_LEAF,
        seed: int = 42,
    ) -> BoostedModel:
        """Boosted trees. A depth beyond Spark's bound is refused.

        Deep trees keep state between rounds; Spark cuts its lineage by checkpoints in
        the session's checkpoint folder, where one is set.
        """
        if not 0 <= max_depth <= DEEPEST:
            raise ValueError(f"depth {max_depth}: trees go no deeper than {DEEPEST}")
        learner = GBTRegressor(
            featuresCol="features",
            labelCol=self.y,
            maxIter=trees,
            maxDepth=max_depth,
            minInstancesPerNode=min_leaf,
            minWeightFractionPerNode=MIN_LEAF_SHARE,
            stepSize=0.1,
            seed=seed,
            checkpointInterval=10,
            cacheNodeIds=True,
        )
        return BoostedModel(
            learner.fit(self.rows), self.levels, self.overall, self.assembler, self.key
        )


def prepare(
    train: DataFrame, xs: list[str], y: str = "label", key: str = "station_id"
) -> Prepared:
    """`train`, whose columns `xs` and `y` hold no nulls, ready to be fitted on."""
    levels = settle(train.groupBy(key).agg(F.avg(y).alias("station_level")), "levels")
    overall = train.agg(F.avg(y)).first()[0]
    if overall is None:
        raise ValueError("no rows to learn from")
    assembler = VectorAssembler(inputCols=[*xs, "station_level"], outputCol="features")
    ready = assembler.transform(_with_level(train, levels, overall, key))
    rows = ready.select(F.col(y).cast("double").alias(y), "features")
    return Prepared(rows, levels, overall, assembler, key, y)


def fit_boosted(
    train: DataFrame,
    xs: list[str],
    y: str = "label",
    key: str = "station_id",
    **parameters,
) -> BoostedModel:
    """Fit boosted trees on `train`; `parameters` are those of `Prepared.fit`."""
    return prepare(train, xs, y, key).fit(**parameters)


def boosted_metrics(model: BoostedModel, test: DataFrame, y: str = "label") -> DataFrame:
    """r2, mse and rmse of a model over all rows of `test`, as one row."""
    return regression_metrics(model.predict(test), [], y, "prediction")


def boosted_station_metrics(
    model: BoostedModel, test: DataFrame, y: str = "label"
) -> DataFrame:
    """r2, mse and rmse per station."""
    return regression_metrics(model.predict(test), [model.key], y, "prediction")
