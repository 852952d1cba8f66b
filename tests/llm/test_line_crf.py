import itertools
import random
import zlib

import numpy as np

from snapflow.llm.line_crf import (
    WIDTH,
    forward_backward,
    learn_quality,
    line_features,
    score_quality,
    text_features,
)


def test_marginals_equal_all_labellings():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 0, 1, 5, 2])
    good, moves = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    marginal, pairs = forward_backward(good, moves, sizes)
    expected, counts, at = [], np.zeros((2, 2)), 0
    for n in sizes:
        own = good[at : at + n]
        total, ones, moved = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product([0, 1], repeat=int(n)):
            weight = np.exp(sum(own[i] for i in range(n) if y[i]) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            total += weight
            ones += weight * np.array(y)
            for a, b in zip(y, y[1:]):
                moved[a, b] += weight
        expected += list(ones / total) if n else []
        counts += moved / total
        at += n
    assert np.allclose(marginal, expected)
    assert np.allclose(pairs, counts)


def make(rng, good):
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmn')}" for _ in range(400)]
    lines = [" ".join(rng.choices(words, k=rng.randint(5, 20))) + "." for _ in range(rng.randint(1, 8))]
    if not good:
        lines = [line.upper().replace(" ", "!! ") for line in lines]
    return "\n".join(lines)


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(1)
    rows = [(k, make(rng, k % 4 > 0), "x") for k in range(240)]
    labels = [(k, int(k % 4 > 0)) for k in range(240)]
    # Labels of the held-out fold are wrong: they must not be read.
    labels = [(k, y if zlib.crc32(str(k).encode()) % 3 != 1 else 1 - y) for k, y in labels]
    labels += [(3, None), (None, 1), (4, 7)]
    rows += [(900, None, "x"), (901, "", "x"), (902, " \n\n", "x"), (None, make(rng, True), "x"), (5, rows[5][1], "x")]
    rows += [(903, "word another\n" * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    chain = learn_quality(docs, marks)
    got = score_quality(docs, chain).collect()
    assert len(got) == len(rows)
    for r in got:
        key = r["doc_id"]
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (key is not None and zlib.crc32(str(key).encode()) % 3 == 1)
        if key in (900, 901, 902):
            assert r["score"] == 0
        elif key is not None and key < 240:
            assert r["predicted"] == int(key % 4 > 0)
    blank = learn_quality(docs, marks.limit(0))
    assert {r["score"] for r in score_quality(docs.filter("doc_id < 9"), blank).collect()} == {0.5}
    assert score_quality(docs.limit(0), chain).collect() == []


def test_features():
    features, lengths = text_features("One two.\n\nOne two.\n" + "x" * 10_000)
    assert features.shape == (3, WIDTH) and lengths.tolist() == [8, 8, 10_000]
    assert np.isfinite(features).all() and len(line_features("a")) < WIDTH
