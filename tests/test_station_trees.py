import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.operators.search import best_candidate, mean_scores
from snapflow.operators.splits import forward_folds, temporal_split
from snapflow.operators.station_trees import (
    HELD_OUT,
    REFIT,
    UNIT,
    Trees,
    boosted,
    evaluate_and_refit_trees,
    fit_station_trees,
    predict_station_trees,
    register_station_trees,
    search_station_trees,
    station_trees_champion,
)

START = datetime(2024, 3, 14)
SCHEMA = "fit int, station_id long, ts timestamp, a int, b double, label double"


def made(seed, stations=3, n=60, fits=(0,)):
    rng = random.Random(seed)
    rows = []
    for s in range(stations):
        for i in range(n + 7 * s):
            a, b = rng.randint(0, 9), round(rng.random(), 2)
            label = 10.0 * (a > 4) + 5 * (b > 0.5) * (s + 1) + rng.randint(0, 2)
            rows += [(f, s, START + timedelta(minutes=10 * i), a, b, label) for f in fits]
    return rows


def brute(rows, p):
    """Predictions by trees that are grown row by row, as the textbook has it."""
    out = {}
    for s in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == s]
        y = [math.floor(r[5] / UNIT + 0.5) for r in mine]
        start = math.floor(sum(y) / len(y) + 0.5)
        rest = [v - start for v in y]
        for _ in range(p.trees):
            steps = [0] * len(mine)

            def grow(index, depth):
                if depth == p.max_depth or len(index) < 2 * p.min_leaf:
                    return False
                best = None
                for f in (3, 4):
                    for cut in sorted({mine[i][f] for i in index}):
                        left = [i for i in index if mine[i][f] <= cut]
                        n, m = len(index), len(left)
                        if m < p.min_leaf or n - m < p.min_leaf:
                            continue
                        total, part = sum(rest[i] for i in index), sum(rest[i] for i in left)
                        apart = float(part) * n - float(total) * m
                        gain = apart * apart / (float(n) * m * (n - m))
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, f, cut)
                if best is None:
                    return False
                for side in (True, False):
                    some = [i for i in index if (mine[i][best[1]] <= best[2]) == side]
                    step = math.floor(p.rate * sum(rest[i] for i in some) / len(some) + 0.5)
                    if not grow(some, depth + 1):
                        for i in some:
                            steps[i] = step
                return True

            if not grow(list(range(len(mine))), 0):
                break
            rest = [r - t for r, t in zip(rest, steps)]
        for r, v, left in zip(mine, y, rest):
            out[r[1], r[2]] = (v - left) * UNIT
    return out


@pytest.mark.parametrize("local_rows", [1000, 0, 65])
def test_trees_are_those_of_the_textbook(spark, local_rows):
    rows = made(1)
    p = Trees(0, trees=3, max_depth=3, min_leaf=4)
    frame = spark.createDataFrame(rows, SCHEMA)
    model = fit_station_trees(frame, ["a", "b"], [p], bins=100, local_rows=local_rows)
    got = {(r.station_id, r.ts): r.prediction for r in predict_station_trees(frame, model).collect()}
    assert got == brute(rows, p)


def test_fits_grow_together_as_alone(spark):
    rows = made(2, fits=(0, 1))
    tuned = [Trees(0, 3, 2, 5), Trees(1, 2, 6, 2, 0.3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for local_rows in (1000, 0):
        whole = fit_station_trees(frame, ["a", "b"], tuned, local_rows=local_rows)
        for p in tuned:
            alone = fit_station_trees(frame, ["a", "b"], [p])
            assert sorted(map(tuple, whole.of(p.fit).nodes.collect())) == sorted(map(tuple, alone.nodes.collect()))


def test_rows_that_can_not_be_used(spark):
    rows = made(3, stations=1, n=30)
    odd = [
        (0, None, START, 1, 0.5, 1.0), (0, 5, START, None, 0.5, 1.0), (0, 5, START, 1, float("nan"), 1.0),
        (0, 6, START, 1, 0.5, None), (9, 0, START, 1, 0.5, 1e6), (None, 0, START, 1, 0.5, 1e6),
    ]
    p = Trees(0, 2, 2, 3)
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    model = fit_station_trees(frame, ["a", "b"], [p])
    assert [tuple(r) for r in model.base.select("fit", "station_id", "row_count").collect()] == [(0, 0, 30)]
    told = predict_station_trees(frame, model)
    assert told.columns == [*frame.columns, "prediction"] and told.count() == 30
    empty = fit_station_trees(frame.limit(0), ["a", "b"], [p])
    assert empty.nodes.count() == 0 and predict_station_trees(frame, empty).count() == 0
    for wrong in ({"max_depth": 0}, {"max_depth": 61}):
        with pytest.raises(ValueError):
            fit_station_trees(frame, ["a", "b"], [Trees(0, **wrong)])
    with pytest.raises(ValueError):
        fit_station_trees(frame, ["a", "b"], [p], bins=1)


def test_stations_without_a_split_keep_their_mean(spark):
    rows = [(0, s, START + timedelta(minutes=i), i, 0.5, float(s)) for s in (1, 2) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for local_rows in (1000, 0):
        model = fit_station_trees(frame, ["a", "b"], [Trees(0, 5, 5, 2)], local_rows=local_rows)
        assert model.nodes.count() == 0
        assert {(r.station_id, r.prediction) for r in predict_station_trees(frame, model).collect()} == {
            (1, 1.0),
            (2, 2.0),
        }


def test_rows_of_a_hot_station_are_spread(spark, monkeypatch):
    from snapflow.operators import station_trees

    rows = made(4, stations=2, n=80)
    frame = spark.createDataFrame(rows, SCHEMA)
    model = fit_station_trees(frame, ["a", "b"], [Trees(0, 3, 3, 3)])
    before = sorted(map(tuple, predict_station_trees(frame, model).collect()))
    monkeypatch.setattr(station_trees, "SEAT_ROWS", 16)
    assert sorted(map(tuple, predict_station_trees(frame, model).collect())) == before


def test_hold_out_versions_and_reload(spark):
    split = temporal_split(spark.createDataFrame(made(5, n=100), SCHEMA).drop("fit"))
    quality, model = evaluate_and_refit_trees(split, ["a", "b"], tuned=Trees(0, 30, 4, 5))
    assert quality.filter("r2 > 0.5").count() == 3
    assert {r.fit for r in model.base.collect()} == {HELD_OUT, REFIT}
    first = register_station_trees(spark, model, quality, "m")
    known = first.unionByName(register_station_trees(spark, model.of(REFIT), quality, "m", first))
    assert sorted(r.version for r in known.collect()) == [1, 2]
    again = station_trees_champion(spark, known, "m")
    asked = split.withColumn("fit", F.lit(REFIT))
    before, after = (
        sorted((r.station_id, r.ts, r.prediction) for r in predict_station_trees(asked, m).collect())
        for m in (model, again)
    )
    assert before == after and len(before) == split.count()
    assert again.nodes.filter("fit = 0").count() == 0
    with pytest.raises(ValueError):
        station_trees_champion(spark, known, "other")


def test_more_trees_fit_what_they_learn_better(spark):
    rows = made(6, n=50, fits=tuple(range(4)))
    tuned = [Trees(f, trees, 3, 4) for f, trees in enumerate((1, 4, 16, 64))]
    frame = spark.createDataFrame(rows, SCHEMA)
    told = predict_station_trees(frame, fit_station_trees(frame, ["a", "b"], tuned))
    errors = told.groupBy("fit", "station_id").agg(F.avg((F.col("label") - F.col("prediction")) ** 2).alias("e"))
    found = {(r.station_id, r.fit): r.e for r in errors.collect()}
    for s in range(3):
        series = [found[s, f] for f in range(4)]
        assert series == sorted(series, reverse=True) and series[-1] < series[0] / 4


def test_search_scores_every_trial_and_fold(spark):
    frame = spark.createDataFrame(made(7, n=90), SCHEMA).drop("fit")
    trials = spark.createDataFrame(
        [(0, 1, 1, 1), (1, 4, 40, 3)], "trial bigint, max_depth int, trees int, min_leaf int"
    )
    chunked = forward_folds(frame, folds=2)
    scores = search_station_trees(chunked, ["a", "b"], trials)
    rows = {(r.trial, r.fold): r for r in scores.collect()}
    assert set(rows) == {(t, f) for t in (0, 1) for f in (1, 2)}
    assert best_candidate(mean_scores(scores, ["trial"]), [], "trial").first().trial == 1
    # a fold alone gives the same
    fold = chunked.filter("chunk = 0").withColumn("fit", F.lit(0))
    model = fit_station_trees(fold, ["a", "b"], [Trees(0, 40, 4, 3)])
    told = predict_station_trees(chunked.filter("chunk = 1").withColumn("fit", F.lit(0)), model)
    errors = [(r.label - r.prediction) ** 2 for r in told.collect()]
    assert np.isclose(rows[1, 1].rmse, np.sqrt(np.mean(errors)), rtol=1e-12)


def test_stations_grow_together_as_each_alone():
    """Stations and fits of unlike parameters in one call, and one that has no split."""
    rng = np.random.default_rng(5)
    tuned = [Trees(f, trees, depth, leaf) for f, (trees, depth, leaf) in enumerate([(9, 30, 1), (4, 2, 3), (6, 5, 8)])]
    sizes = [40, 25, 31]
    x = [rng.integers(0, 12, (n, 3)) for n in sizes] + [np.zeros((10, 3), np.int64)]
    rest = [rng.integers(-1 << 22, 1 << 22, len(a)) for a in x]
    tuned.append(Trees(3))
    of = np.repeat(np.arange(4), [len(a) for a in x])
    calls = []
    sort, np.sort = np.sort, lambda *a, **k: calls.append(1) or sort(*a, **k)
    try:
        together = boosted(np.concatenate(x), np.concatenate(rest), of, tuned, 64)
        few = len(calls)
        alone = [boosted(a, r, np.zeros(len(r), np.int64), [p], 64) for a, r, p in zip(x, rest, tuned)]
    finally:
        np.sort = sort
    assert set(together[0]) == {0, 1, 2} and len(alone[3][0]) == 0
    for station in range(3):
        mine = [sorted(zip(*(z[m].tolist() for z in found[1:]))) for found, m in (
            (together, together[0] == station), (alone[station], slice(None)),
        )]
        assert mine[0] == mine[1] and len(mine[0]) > 4
    # A level of all stations is one step: no more steps than the deepest station has.
    assert few < len(calls) - few


def broadcast_rows(node):
    """Rows that a plan which has been run has broadcast, in each of its broadcasts."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return broadcast_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return broadcast_rows(node.plan())
    below = node.children()
    found = [n for i in range(below.size()) for n in broadcast_rows(below.apply(i))]
    if kind == "BroadcastExchangeExec":
        found.append(node.metrics().apply("numOutputRows").value())
    return found


def test_tables_of_all_fits_and_stations_are_not_broadcast(spark, monkeypatch):
    from snapflow.operators import station_trees

    rows = made(8, stations=12, n=20, fits=(0, 1))
    frame = spark.createDataFrame(rows, SCHEMA)
    plans, settle = {}, station_trees.settle

    def seen(df, purpose="step"):
        plans[purpose] = df._jdf.queryExecution().toString()
        return settle(df, purpose)

    monkeypatch.setattr(station_trees, "settle", seen)
    model = fit_station_trees(frame, ["a", "b"], [Trees(0, 3, 3, 3), Trees(1, 2, 2, 5)])
    assert not any("Broadcast" in plans[purpose] for purpose in ("tree-bins", "nodes"))
    for size in (1 << 18, 100):
        monkeypatch.setattr(station_trees, "SEAT_ROWS", size)
        told = predict_station_trees(frame, model)
        assert len(told.collect()) == len(rows)
        # Two fits, and of the stations those that take more than one seat.
        sent = broadcast_rows(told._jdf.queryExecution().executedPlan())
        wide = sum(20 + 7 * s > size for s in range(12)) * 2
        assert max(sent, default=0) <= max(2, wide) < 24


def test_models_that_are_not_asked_and_stations_not_learned(spark):
    frame = spark.createDataFrame(made(9, stations=3, fits=(0, 1)), SCHEMA)
    model = fit_station_trees(frame.filter("station_id > 0"), ["a", "b"], [Trees(0, 3, 3, 3), Trees(1, 2, 2, 5)])
    asked = frame.filter("fit = 1 and station_id < 2")
    odd = spark.createDataFrame([(1, None, START, 1, 0.5, 1.0), (None, 1, START, 1, 0.5, 1.0)], SCHEMA)
    told = predict_station_trees(asked.unionByName(odd), model).collect()
    assert len(told) == 67 and {(r.fit, r.station_id) for r in told} == {(1, 1)}
    whole = predict_station_trees(frame, model).filter("fit = 1 and station_id = 1").collect()
    assert sorted(map(tuple, told)) == sorted(map(tuple, whole))
