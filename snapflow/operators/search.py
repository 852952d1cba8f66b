"""Search for the best parameters, scored on forward folds."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.operators.linear import (
    moments,
    moments_before,
    squared_error,
    with_solution,
)
from snapflow.operators.metrics import r2_of

# The space that is searched, up to the deepest of Spark's trees, and the number of trials.
MAX_DEPTH = (5, 30)
TREES = (10, 150)
MIN_LEAF = (1, 20)
TRIALS = 20
PARALLEL_TRIALS = 4


def ridge_fold_scores(
    chunked: DataFrame, key: str, xs: list[str], y: str, penalties: list[float]
) -> DataFrame:
    """r2 and rmse of each penalty in each forward fold of each key.

    `chunked` has `chunk` from `forward_folds`. It is read once, whatever the
    number of folds and penalties: a fold's training sums are the sums of earlier
    chunks, and its errors follow from the sums of its own.
    """
    width = len(xs)
    chunks = moments(chunked, [key], xs, y, ("chunk",))
    choices = F.array(*[F.lit(float(p)) for p in penalties])
    fitted = with_solution(
        moments_before(chunks, key, width).withColumn("penalty", F.explode(choices)),
        F.col("penalty"),
    ).select(key, "chunk", "penalty", "coefficients")
    return (
        chunks.join(fitted, [key, "chunk"])
        .withColumn("mse", squared_error(width) / F.col("n"))
        .select(
            key,
            "penalty",
            F.col("chunk").alias("fold"),
            r2_of("mse", "spread").alias("r2"),
            F.sqrt("mse").alias("rmse"),
        )
    )


def mean_scores(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Scores averaged over folds."""
    return scores.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("r2").alias("r2"), F.avg("rmse").alias("rmse")
    )


def best_candidate(means: DataFrame, keys: list[str], candidate: str) -> DataFrame:
    """The candidate of the lowest mean rmse, per key; the lower candidate of equals."""
    return (
        means.groupBy(*keys)
        .agg(F.min(F.struct("rmse", candidate)).alias("best"))
        .select(*keys, f"best.{candidate}", "best.rmse")
    )


def random_candidates(spark: SparkSession, trials: int = TRIALS, seed: int = 42) -> DataFrame:
    """Parameters of boosted trees, drawn evenly from the space."""

    def draw(name: str, bounds: tuple[int, int]):
        low, high = bounds
        size = F.lit(high - low + 1)
        drawn = F.pmod(F.xxhash64(F.col("trial"), F.lit(name), F.lit(seed)), size)
        return (drawn + low).cast("int").alias(name)

    return spark.range(trials).withColumnRenamed("id", "trial").select(
        "trial", draw("max_depth", MAX_DEPTH), draw("trees", TREES), draw("min_leaf", MIN_LEAF)
    )


def search_boosted(
    chunked: DataFrame,
    xs: list[str],
    y: str,
    candidates: DataFrame,
    parallel: int = PARALLEL_TRIALS,
    seed: int = 42,
) -> DataFrame:
    """r2 and rmse of each candidate for boosted trees in each forward fold: trial, fold,
    r2, rmse. `mean_scores` and `log_runs` take them further.

    Trials are few, and each is a set of Spark jobs over all rows; `parallel` of
    them run at once. Folds follow `chunk`.
    """
    from snapflow.operators.boosted import boosted_metrics, prepare

    spark = chunked.sparkSession
    rows = chunked.persist()
    trials = candidates.collect()
    kept = [rows]
    try:
        last = rows.agg(F.max("chunk")).first()[0] or 0
        folds = {}
        for fold in range(1, last + 1):
            # A fold's rows are made ready once, for all trials.
            ready = prepare(rows.filter(F.col("chunk") < fold), xs, y)
            ready.rows = ready.rows.persist()
            kept.append(ready.rows)
            folds[fold] = ready

        def score(trial, fold: int) -> tuple:
            model = folds[fold].fit(
                trees=trial["trees"],
                max_depth=trial["max_depth"],
                min_leaf=trial["min_leaf"],
                seed=seed,
            )
            found = boosted_metrics(model, rows.filter(F.col("chunk") == fold), y).first()
            return (trial["trial"], fold, found["r2"], found["rmse"])

        work = [(t, f) for t in trials for f in folds]
        with ThreadPoolExecutor(parallel) as pool:
            results = list(pool.map(lambda job: score(*job), work))
    finally:
        for df in kept:
            df.unpersist()
    return spark.createDataFrame(results, "trial bigint, fold int, r2 double, rmse double")
