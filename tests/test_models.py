import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.operators.boosted import (
    boosted_champion,
    boosted_metrics,
    boosted_station_metrics,
    evaluate_and_refit_boosted,
    fit_boosted,
    register_boosted,
)
from snapflow.operators.linear import (
    add_moments,
    fit_and_evaluate,
    fit_line,
    fit_linear,
    moments,
    with_solution,
)
from snapflow.operators.metrics import log_runs, regression_metrics
from snapflow.operators.models import champions, newest_predictions, predict, register_models
from snapflow.operators.search import (
    best_candidate,
    mean_scores,
    random_candidates,
    ridge_fold_scores,
    search_boosted,
)
from snapflow.operators.splits import forward_folds, hash_split, temporal_split

START = datetime(2024, 3, 14)
ROWS = "station_id bigint, ts timestamp, a bigint, b double, c double, label double"


@pytest.fixture(scope="module")
def data():
    """Station 1 holds most rows; c follows from a; station 3 never varies."""
    rng = random.Random(11)
    rows = []
    for station, n in ((1, 400), (2, 37), (3, 12)):
        for i in range(n):
            a, b = rng.randrange(20), rng.gauss(0, 1)
            y = 3 + station * a - 2 * b + rng.gauss(0, 0.5)
            if station == 3:
                a, b, y = 4, 1.0, 7.0
            rows.append((station, START + timedelta(minutes=10 * i), a, b, 2.0 * a, y))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, ROWS).repartition(5)


def station_rows(data, station):
    return sorted((r for r in data if r[0] == station), key=lambda r: r[1])


def lstsq(rows, columns):
    x = np.array([[1.0] + [float(r[c]) for c in columns] for r in rows])
    y = np.array([r[5] for r in rows])
    return np.linalg.lstsq(x, y, rcond=None)[0]


def test_temporal_split(df, data):
    got = temporal_split(df, block_s=7200)
    assert got.columns == [*df.columns, "is_train"]
    for station in (1, 2, 3):
        rows = station_rows(data, station)
        kept = {r.ts for r in got.filter((F.col("station_id") == station) & F.col("is_train")).collect()}
        assert kept == {r[1] for r in rows[: int(0.8 * len(rows))]}


def test_forward_folds(df, data):
    got = {(r.station_id, r.ts): r.chunk for r in forward_folds(df, folds=5, block_s=7200).collect()}
    for station in (1, 2, 3):
        rows = station_rows(data, station)
        wanted = [i * 6 // len(rows) for i in range(len(rows))]
        assert [got[station, r[1]] for r in rows] == wanted
    assert set(got.values()) == {0, 1, 2, 3, 4, 5}


def test_hash_split_is_stable(df):
    first, second = (
        {(r.station_id, r.ts) for r in hash_split(d, ["station_id", "ts"]).filter("is_train").collect()}
        for d in (df, df.repartition(2).orderBy("label"))
    )
    assert first == second
    assert 0.85 < len(first) / 449 < 0.95
    other = hash_split(df, ["station_id", "ts"], seed=7).filter("is_train").collect()
    assert {(r.station_id, r.ts) for r in other} != first


def test_fit_linear_equals_least_squares(df, data):
    got = {r.station_id: r for r in fit_linear(df, ["station_id"], ["a", "b"]).collect()}
    for station in (1, 2):
        wanted = lstsq(station_rows(data, station), (2, 3))
        assert got[station].coefficients == pytest.approx(list(wanted), rel=1e-8)
    assert got[3].coefficients == [7.0, 0.0, 0.0]
    assert got[1].row_count == 400


def test_fit_linear_with_dependent_columns(df, data):
    row = fit_linear(df, ["station_id"], ["a", "b", "c"]).filter("station_id = 1").first()
    plain = lstsq(station_rows(data, 1), (2, 3))
    i, a, b, c = row.coefficients
    assert (i, a + 2 * c, b) == pytest.approx(tuple(plain), rel=1e-6)


def test_fit_line(df, data):
    got = {r.station_id: r for r in fit_line(df, "station_id", "a", "label").collect()}
    intercept, slope = lstsq(station_rows(data, 2), (2,))
    assert (got[2].slope, got[2].intercept) == pytest.approx((slope, intercept))
    assert got[3].slope is None and got[3].r2 is None


def test_moments_of_parts_add_up(df):
    parts = moments(
        df.withColumn("h", F.hour("ts")), ["station_id"], ["a", "b"], "label", ("h",)
    )
    whole = with_solution(add_moments(parts, ["station_id"], 2))
    got = {r.station_id: r.coefficients for r in whole.collect()}
    for r in fit_linear(df, ["station_id"], ["a", "b"]).collect():
        assert got[r.station_id] == pytest.approx(r.coefficients)


@pytest.mark.parametrize("shift", [0.0, 1e6, 1e9])
def test_large_values_cost_no_precision(spark, shift):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x = rng.gauss(0, 1)
        rows.append((1, START + timedelta(minutes=i), shift + x, shift + 2 * x + rng.gauss(0, 0.3)))
    frame = spark.createDataFrame(rows, "station_id bigint, ts timestamp, x double, y double")
    line = fit_line(frame, "station_id", "x", "y").first()
    fitted = fit_linear(frame, ["station_id"], ["x"], "y").first()
    assert fitted.coefficients[1] == pytest.approx(line.slope, rel=1e-7)
    found = fit_and_evaluate(temporal_split(frame), "station_id", ["x"], "y").first()
    assert 0.05 < found.mse < 0.15 and 0.9 < found.r2 < 1
    chunked = forward_folds(frame)
    scores = ridge_fold_scores(chunked, "station_id", ["x"], "y", [0.0]).collect()
    assert len(scores) == 5 and all(0.9 < r.r2 < 1 for r in scores)


def test_fit_and_evaluate(df, data):
    split = temporal_split(df)
    got = {r.station_id: r for r in fit_and_evaluate(split, "station_id", ["a", "b"]).collect()}
    for station in (1, 2):
        rows = station_rows(data, station)
        cut = int(0.8 * len(rows))
        coef = lstsq(rows[:cut], (2, 3))
        y = np.array([r[5] for r in rows[cut:]])
        p = np.array([coef[0] + coef[1] * r[2] + coef[2] * r[3] for r in rows[cut:]])
        mse = float(((y - p) ** 2).mean())
        assert got[station].mse == pytest.approx(mse)
        assert got[station].rmse == pytest.approx(mse**0.5)
        assert got[station].r2 == pytest.approx(1 - mse / y.var())
        assert got[station].coefficients == pytest.approx(list(lstsq(rows, (2, 3))), rel=1e-8)
    assert got[3].r2 is None and got[3].mse == pytest.approx(0, abs=1e-9)


def test_metrics_match_a_direct_count(spark):
    rows = [(1, 1.0, 2.0), (1, 3.0, 3.0), (1, 5.0, 4.0), (2, 2.0, 2.0), (2, None, 9.0)]
    got = regression_metrics(spark.createDataFrame(rows, "k int, y double, p double"), ["k"], "y", "p")
    found = {r.k: r for r in got.collect()}
    assert found[1].mse == pytest.approx(2 / 3) and found[1].r2 == pytest.approx(0.75)
    assert found[2].row_count == 1 and found[2].r2 is None
    logged = log_runs(got, "first", ["k"])
    assert logged.count() == 8 and logged.filter("metric = 'mse' and k = 2").first().value == 0


def test_ridge_search(df, data):
    chunked = forward_folds(df, folds=5)
    scores = ridge_fold_scores(chunked, "station_id", ["a", "b"], "label", [0.0, 1e6])
    got = {(r.station_id, r.penalty, r.fold): r for r in scores.collect()}
    rows = station_rows(data, 2)
    chunk = [i * 6 // len(rows) for i in range(len(rows))]
    for fold in range(1, 6):
        coef = lstsq([r for r, c in zip(rows, chunk) if c < fold], (2, 3))
        test = [r for r, c in zip(rows, chunk) if c == fold]
        y = np.array([r[5] for r in test])
        p = np.array([coef[0] + coef[1] * r[2] + coef[2] * r[3] for r in test])
        assert got[2, 0.0, fold].rmse == pytest.approx(float(((y - p) ** 2).mean() ** 0.5), rel=1e-6)
    best = best_candidate(mean_scores(scores, ["station_id", "penalty"]), ["station_id"], "penalty")
    assert {r.station_id: r.penalty for r in best.collect()} == {1: 0.0, 2: 0.0, 3: 0.0}


def test_candidates_lie_in_the_space(spark):
    rows = random_candidates(spark, trials=300).collect()
    assert {r.max_depth for r in rows} == set(range(5, 31))
    assert all(10 <= r.trees <= 150 and 1 <= r.min_leaf <= 20 for r in rows)
    assert rows == random_candidates(spark, trials=300).collect()


def test_predict_and_newest(spark):
    features = spark.createDataFrame(
        [(1, START, 2, 3), (1, START + timedelta(minutes=10), 4, 0), (2, START, None, 1), (3, START, 1, 1)],
        "station_id bigint, ts timestamp, a bigint, b bigint",
    )
    models = spark.createDataFrame(
        [(1, [1.0, 0.75, 2.0]), (2, [0.0, 1.0, 1.0])], "station_id bigint, coefficients array<double>"
    )
    got = predict(features, models, ["a", "b"])
    rows = sorted(got.collect())
    assert [(r.prediction, r.prediction_bikes) for r in rows] == [(8.5, 9), (4.0, 4)]
    assert rows[0].prediction_valid == START + timedelta(hours=4)
    assert [r.prediction for r in newest_predictions(got).collect()] == [4.0]


def test_versions_are_numbers(spark):
    known = spark.createDataFrame(
        [(1, v, [float(v)]) for v in (9, 10, 2)], "station_id bigint, version int, coefficients array<double>"
    )
    fitted = spark.createDataFrame([(1, [5.0]), (2, [6.0])], "station_id bigint, coefficients array<double>")
    assert champions(known).first().version == 10
    new = register_models(fitted, known)
    assert {(r.station_id, r.version) for r in new.collect()} == {(1, 11), (2, 1)}
    found = {r.station_id: r for r in champions(known.unionByName(new)).collect()}
    assert (found[1].version, found[1].coefficients, found[1].alias) == (11, [5.0], "Champion")
    assert register_models(fitted).filter("version <> 1").count() == 0


def test_boosted_trees_learn(df):
    split = temporal_split(df).persist()
    train, test = split.filter("is_train"), split.filter("not is_train")
    model = fit_boosted(train, ["a", "b"], trees=15, max_depth=4, min_leaf=2)
    assert boosted_metrics(model, test).first().r2 > 0.8
    assert boosted_station_metrics(model, test).count() == 3
    stranger = test.limit(1).withColumn("station_id", F.lit(77).cast("bigint"))
    assert model.predict(stranger).first().prediction is not None
    split.unpersist()


def test_boosted_search(df):
    trials = df.sparkSession.createDataFrame(
        [(0, 1, 1, 1), (1, 4, 5, 2)], "trial bigint, max_depth int, trees int, min_leaf int"
    )
    scores = search_boosted(forward_folds(df, folds=2), ["a", "b"], "label", trials)
    assert {(r.trial, r.fold) for r in scores.collect()} == {(t, f) for t in (0, 1) for f in (1, 2)}
    found = mean_scores(scores, ["trial"])
    rows = {r.trial: r for r in found.collect()}
    assert rows[1].folds == 2 and rows[1].rmse < rows[0].rmse
    assert best_candidate(found, [], "trial").first().trial == 1


def test_boosted_models_are_saved_versioned_and_reloaded(spark, df):
    split = temporal_split(df)
    tuned = {"trees": 5, "max_depth": 4, "min_leaf": 2}
    quality, model = evaluate_and_refit_boosted(split, ["a", "b"], **tuned)
    assert quality.count() == 3
    first = register_boosted(spark, model, quality, "m", **tuned)
    second = register_boosted(spark, fit_boosted(df, ["a"], trees=1), quality, "m", first, trees=1)
    known = first.unionByName(second)
    assert [(r.version, r.parameters["trees"]) for r in known.orderBy("version").collect()] == [(1, 5.0), (2, 1.0)]
    again = boosted_champion(spark, known.filter("version = 1"), "m")
    keys = ["station_id", "ts"]
    before, after = ({tuple(r[k] for k in keys): r.prediction for r in m.predict(df).collect()} for m in (model, again))
    assert before == after and len(before) == df.count()
    assert boosted_champion(spark, known, "m").assembler.getInputCols() == ["a", "station_level"]
    with pytest.raises(ValueError):
        fit_boosted(df, ["a"], max_depth=31)
    with pytest.raises(ValueError):
        boosted_champion(spark, known, "other")


def test_runs_with_parameters_and_time(spark):
    found = spark.createDataFrame([(1, 0.5)], "k int, r2 double")
    row = log_runs(found, "run", ["k"], {"trees": 3}, START).first()
    assert (row.metric, row.value, row.parameters, row.run_at) == ("r2", 0.5, {"trees": 3.0}, START)
