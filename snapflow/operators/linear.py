"""Linear models per key, fitted from sums that Spark aggregates.

A least-squares fit needs only the sums of products of its columns. These are
combined before the shuffle, so a key that holds most of the rows costs its shuffle
one row per task, and no key's history is ever brought together. The sums of parts
of the data add up to the sums of the whole, which gives a hold-out test, a refit on
all rows and every fold of a search from one pass.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.operators.metrics import r2_of
from snapflow.sources.tables import settle


def moments(
    df: DataFrame, keys: list[str], xs: list[str], y: str, parts: tuple[str, ...] = ()
) -> DataFrame:
    """Per key and part of it: the number of rows, and sums of x, y, x·x, x·y and y·y.

    Sums are taken about the key's overall means `ox` and `oy`, so that large values cost
    no precision, and parts of a key add up. Spark's mergeable variances and covariances
    give each part's spread about its own mean in one pass; then a handful of parts per
    key is moved to the common mean. `spread` is the part's variance of y.
    """
    xd = [F.col(x).cast("double") for x in xs]
    yd = F.col(y).cast("double")
    width = range(len(xs))
    found = {f"x{i}y": F.covar_pop(xd[i], yd) for i in width}
    found |= {f"x{i}x{i}": F.var_pop(xd[i]) for i in width}
    found |= {f"x{i}x{j}": F.covar_pop(xd[i], xd[j]) for i in width for j in width if i < j}
    found |= {f"m{i}": F.avg(xd[i]) for i in width}
    summed = df.groupBy(*keys, *parts).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(yd).alias("my"),
        F.var_pop(yd).alias("spread"),
        *[s.alias(name) for name, s in found.items()],
    )
    whole = Window.partitionBy(*keys)

    def overall(mean: str) -> Column:
        return F.sum(F.col("n") * F.col(mean)).over(whole) / F.sum("n").over(whole)

    if parts:
        summed = summed.withColumns({f"o{i}": overall(f"m{i}") for i in width} | {"oy": overall("my")})
    else:
        summed = summed.withColumns({f"o{i}": F.col(f"m{i}") for i in width} | {"oy": F.col("my")})
    dx = [F.col(f"m{i}") - F.col(f"o{i}") for i in width]
    dy = F.col("my") - F.col("oy")

    def about(name: str, d: Column, e: Column) -> Column:
        return F.col("n") * (F.col(name) + d * e)

    return summed.select(
        *keys,
        *parts,
        "n",
        F.array(*[F.col("n") * d for d in dx]).alias("sx"),
        (F.col("n") * dy).alias("sy"),
        F.array(
            *[about(f"x{min(i, j)}x{max(i, j)}", dx[i], dx[j]) for i in width for j in width]
        ).alias("sxx"),
        F.array(*[about(f"x{i}y", dx[i], dy) for i in width]).alias("sxy"),
        about("spread", dy, dy).alias("syy"),
        "spread",
        F.array(*[f"o{i}" for i in width]).alias("ox"),
        "oy",
    )


def add_moments(parts: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Moments of the whole of each key, from those of its parts."""
    sums = _flatten(parts, width).groupBy(*keys, "ox", "oy").agg(
        *[F.sum(c).alias(c) for c in _sum_names(width)]
    )
    return sums.select(*_packed(keys, width))


def _flat_names(width: int) -> dict[str, int]:
    return {"sx": width, "sxx": width * width, "sxy": width}


def _flatten(parts: DataFrame, width: int) -> DataFrame:
    other = [c for c in parts.columns if c not in _flat_names(width)]
    items = [
        F.get(name, F.lit(i)).alias(f"{name}_{i}")
        for name, size in _flat_names(width).items()
        for i in range(size)
    ]
    return parts.select(*other, *items)


def _sum_names(width: int) -> list[str]:
    items = [f"{n}_{i}" for n, size in _flat_names(width).items() for i in range(size)]
    return ["n", "sy", "syy", *items]


def _packed(keys: list[str], width: int, prefix: str = "") -> list[Column]:
    arrays = [
        F.array(*[f"{prefix}{name}_{i}" for i in range(size)]).alias(name)
        for name, size in _flat_names(width).items()
    ]
    singles = [F.col(f"{prefix}{name}").alias(name) for name in ("n", "sy", "syy")]
    return [*[F.col(k) for k in keys], *singles, *arrays, F.col("ox"), F.col("oy")]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve(
    n: pd.Series,
    sx: pd.Series,
    sy: pd.Series,
    sxx: pd.Series,
    sxy: pd.Series,
    ox: pd.Series,
    oy: pd.Series,
    ridge: pd.Series,
) -> pd.Series:
    """Intercept and coefficients from moments, for a batch of models at once.

    `ridge` is added to the diagonal of the centred sums of products. Columns that
    do not vary, or follow from others, get the solution of least norm.
    """
    if len(n) == 0:
        return pd.Series([], dtype=object)
    count = n.to_numpy(dtype=float)[:, None]
    origin = np.stack(ox.to_list())
    mean_x = np.stack(sx.to_list()) / count
    width = mean_x.shape[1]
    mean_y = sy.to_numpy(dtype=float)[:, None] / count
    spread = np.stack(sxx.to_list()).reshape(-1, width, width)
    spread = spread - count[:, :, None] * mean_x[:, :, None] * mean_x[:, None, :]
    shared = np.stack(sxy.to_list()) - count * mean_x * mean_y
    spread = spread + ridge.to_numpy(dtype=float)[:, None, None] * np.eye(width)
    scale = np.sqrt(np.clip(np.einsum("mii->mi", spread), 0.0, None))
    # Below this the spread is rounding of the mean.
    rounding = 1e-14 * np.sqrt(count) * (np.abs(origin) + np.abs(mean_x))
    scale = np.where(scale > rounding, scale, np.inf)
    unit = spread / scale[:, :, None] / scale[:, None, :]
    slopes = np.einsum(
        "mij,mj->mi", np.linalg.pinv(unit, rcond=1e-10, hermitian=True), shared / scale
    )
    slopes = slopes / scale
    intercept = mean_y[:, 0] - np.einsum("mi,mi->m", slopes, mean_x)
    intercept = intercept + oy.to_numpy(dtype=float) - np.einsum("mi,mi->m", slopes, origin)
    return pd.Series(list(np.column_stack([intercept, slopes])))


def with_solution(sums: DataFrame, ridge: Column | float = 0.0) -> DataFrame:
    """`sums` with the `coefficients` of the fit, the intercept first."""
    penalty = F.lit(float(ridge)) if isinstance(ridge, (int, float)) else ridge
    return sums.withColumn(
        "coefficients",
        solve("n", "sx", "sy", "sxx", "sxy", "ox", "oy", penalty.cast("double")),
    )


def squared_error(width: int, coefficients: str = "coefficients") -> Column:
    """Sum of squared errors of a model on the rows behind a row's moments."""
    b = [F.get(coefficients, F.lit(i)) for i in range(width + 1)]
    sx = [F.get("sx", F.lit(i)) for i in range(width)]
    sxy = [F.get("sxy", F.lit(i)) for i in range(width)]
    # The model's value at the origin of the sums, less the origin of y.
    at = b[0] - F.col("oy")
    for i in range(width):
        at = at + b[i + 1] * F.get("ox", F.lit(i))
    total = F.col("syy") + at * at * F.col("n") - 2 * at * F.col("sy")
    for i in range(width):
        total = total + 2 * b[i + 1] * (at * sx[i] - sxy[i])
        for j in range(width):
            total = total + b[i + 1] * b[j + 1] * F.get("sxx", F.lit(i * width + j))
    return F.greatest(total, F.lit(0.0))


def fit_linear(
    df: DataFrame, keys: list[str], xs: list[str], y: str = "label", ridge: float = 0.0
) -> DataFrame:
    """One linear model per key: its row count and coefficients, intercept first."""
    return with_solution(moments(df, keys, xs, y), ridge).select(
        *keys, F.col("n").alias("row_count"), "coefficients"
    )


def fit_line(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """The line through one feature per key, by Spark's own regression aggregates.

    Slope, intercept and r2 are null where x does not vary.
    """
    varies = F.regr_sxx(y, x) > 0
    return df.groupBy(key).agg(
        F.regr_count(y, x).alias("row_count"),
        F.when(varies, F.regr_slope(y, x)).alias("slope"),
        F.when(varies, F.regr_intercept(y, x)).alias("intercept"),
        F.when(varies, F.regr_r2(y, x)).alias("r2"),
    )


def linear_value(xs: list[str], coefficients: str = "coefficients") -> Column:
    """The model's prediction for a row that holds its coefficients."""
    value = F.get(coefficients, F.lit(0))
    for i, x in enumerate(xs):
        value = value + F.get(coefficients, F.lit(i + 1)) * F.col(x).cast("double")
    return value


def fit_and_evaluate(
    split: DataFrame, key: str, xs: list[str], y: str = "label", ridge: float = 0.0
) -> DataFrame:
    """Per key: quality of a model fitted on the training rows, measured on the
    others, and the coefficients of the model fitted on all rows.

    `split` has the boolean `is_train`. The data is read once, and its sums, a row per key,
    are written before three branches read them. A key without test
    rows has null metrics; a key without training rows is measured against nothing.
    """
    width = len(xs)
    parts = moments(split, [key], xs, y, ("is_train",))
    flat = _flatten(parts, width)
    names = _sum_names(width)

    def side(flag: bool, prefix: str) -> list[Column]:
        here = F.col("is_train") == flag
        return [F.sum(F.when(here, F.col(c))).alias(f"{prefix}{c}") for c in names]

    tested_spread = F.max(F.when(~F.col("is_train"), F.col("spread"))).alias("spread")
    sides = flat.groupBy(key, "ox", "oy").agg(
        *side(True, "train_"),
        *side(False, "test_"),
        *[F.sum(c).alias(c) for c in names],
        tested_spread,
    )
    sides = settle(sides, "moments")
    trained = with_solution(
        sides.filter(F.col("train_n") > 0).select(*_packed([key], width, "train_")), ridge
    ).select(key, F.col("coefficients").alias("train_coefficients"))
    tested = sides.filter(F.col("test_n") > 0).select(*_packed([key], width, "test_"), "spread")
    whole = with_solution(sides.select(*_packed([key], width)), ridge).select(
        key, F.col("n").alias("row_count"), "coefficients"
    )
    quality = (
        tested.join(trained, key)
        .withColumn("mse", squared_error(width, "train_coefficients") / F.col("n"))
        .select(
            key,
            r2_of("mse", "spread").alias("r2"),
            "mse",
            F.sqrt("mse").alias("rmse"),
        )
    )
    return whole.join(quality, key, "left").select(
        key, "row_count", "r2", "mse", "rmse", "coefficients"
    )


def moments_before(chunks: DataFrame, key: str, width: int) -> DataFrame:
    """Moments of all chunks of a key that stand before each chunk.

    `chunks` has the moments per key, its parts the chunks: a handful of rows per key.
    """
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    flat = _flatten(chunks, width)
    summed = flat.select(
        key, "chunk", "ox", "oy", *[F.sum(c).over(earlier).alias(c) for c in _sum_names(width)]
    )
    return summed.filter(F.col("n") > 0).select(*_packed([key, "chunk"], width))
