import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, positives=5, negatives=3):
    fine = []
    for i, v, label in rows:
        if i is None or v is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, label, tuple(math.floor(scale * float(np.float32(x))) for x in v))
        if row not in fine:
            fine.append(row)
    found, asked = [], {}
    for i, label, v in fine:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    for i, (label, v) in asked.items():
        scored = sorted(
            {(-max(-hn.LONGEST, min(hn.LONGEST, sum(a * b for a, b in zip(v, w)))), j, other == label)
             for j, other, w in fine if j != i}
        )
        for p, j, _ in [x for x in scored if x[2]][:positives]:
            fits = [x for x in scored if not x[2] and 50 * -p <= 100 * -x[0] <= 95 * -p]
            for rank, (n, other, _) in enumerate(fits[:negatives], 1):
                found.append((i, j, rank, other, -p, -n))
    return sorted(found)


def mined(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, scale=256.0)
    assert out.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    return sorted(tuple(r) for r in out.collect())


def some_rows(seed, n, dims, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    return [
        (i, [float(np.float32(x)) for x in rng.normal(size=dims) * spread + 0.3], int(rng.integers(labels)))
        for i in range(n)
    ]


def test_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "CHUNK_ROWS", 64)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 2)
    rows = some_rows(1, 400, 6)
    expected = brute(rows)
    assert len(expected) > 50
    assert mined(spark, rows) == expected


def test_ties_repeats_and_one_common_vector(spark):
    rows = some_rows(2, 120, 2, spread=0.02)
    rows += rows[:30] + [(1000 + i, [0.25, 0.25], i % 3) for i in range(80)]
    rows += [(50, [0.5, 0.5], 2), (7, [0.3, 0.3], 1)]
    assert mined(spark, rows) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = some_rows(3, 60, 4)
    rows += [
        (None, [1.0, 1.0, 1.0, 1.0], 0),
        (200, None, 0),
        (250, [1.0, None, 1.0, 1.0], 0),
        (300, [1.0, float("nan"), 1.0, 1.0], 1),
        (350, [1.0, float("inf"), 1.0, 1.0], 1),
        (400, [1.0, 1.0, 1.0, 1.0], None),
        (450, [], 1),
        (500, [0.9, 0.9], 1),
        (501, [0.9] * 3000, 0),
        (502, [1e30, 1.0], 0),
    ]
    assert mined(spark, rows) == brute(rows)


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_clashing_columns(spark):
    rows = some_rows(4, 60, 4)
    df = spark.createDataFrame(
        [(*r, 1, 2, 3, 4, 5) for r in rows],
        SCHEMA + ", id int, limits int, part int, block int, anchor_id int",
    )
    out = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, scale=256.0)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)


@pytest.mark.parametrize("percent,up", [(50, True), (95, False)])
def test_shares_are_exact(spark, percent, up):
    values = [0, 1, 2, 19, 20, 21, 99, 100, 101, hn.LONGEST]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in rows.select(hn.share(F.col("v"), percent, up)).collect()]
    assert got == [-(-percent * v // 100) if up else percent * v // 100 for v in values]


def test_best_keeps_the_first_of_each_bin():
    best = hn.Best(2, 2)
    take = lambda *r: best.take(*map(np.array, zip(*r)))
    take((0, 5, 9), (0, 5, 3), (1, -7, 1))
    take((0, 5, 9), (0, 6, 2), (1, -8, 2), (1, -9, 3))
    assert list(zip(best.bin, best.score, best.id)) == [(0, 6, 2), (0, 5, 3), (1, -7, 1), (1, -8, 2)]
