import re

import numpy as np
import pytest

from snapflow.llm import odd_sketch
from snapflow.llm.odd_sketch import (
    Groups,
    Sets,
    close_pairs,
    estimate,
    most_bits,
    near_duplicates,
    shingle_set,
    sketch,
)

SCHEMA = "doc_id long, text string"


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def brute(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if s and 100 * both >= percent * len(s | sets[j]) and sets[j]:
                root[find(i)] = find(j)
    rows = []
    for i, (key, _) in enumerate(docs):
        keys = [k for j, (k, _) in enumerate(docs) if find(j) == find(i) and k is not None]
        least = (min(keys) if keys else None) if sets[i] else key
        rows.append((key, len(sets[i]), least, key == least))
    return sorted(rows, key=repr)


def found(spark, docs, parts=3):
    out = near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(parts))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed, families=12, members=8, length=120):
    """Families of texts with growing numbers of changed words, chains among them."""
    rng = np.random.default_rng(seed)
    docs = []
    for f in range(families):
        base = [f"w{x}" for x in rng.integers(0, 500, length)]
        for m in range(members):
            text = list(base)
            for at in rng.integers(0, length, rng.integers(0, 1 + f)):
                text[at] = f"x{rng.integers(10**6)}"
            docs.append(" ".join(text))
            if m % 3 == 0:  # a chain: each a little further away
                base[int(rng.integers(length))] = f"y{rng.integers(10**6)}"
    order = rng.permutation(len(docs))
    return [(int(i) + 10, docs[i]) for i in order]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, seed):
    docs = corpus(seed)
    assert found(spark, docs) == brute(docs)


def test_crowded_places_are_dealt_into_cells(spark, monkeypatch):
    monkeypatch.setattr(odd_sketch, "CELL", 8)
    monkeypatch.setattr(odd_sketch, "CELL_SHINGLES", 500)
    docs = corpus(3, families=9, members=25)
    assert found(spark, docs) == brute(docs)


def test_a_family_just_below_is_not_linked(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(150):
        text = list(base)
        for at in rng.choice(20, 4, replace=False):  # pairs have some 0.7 in common
            text[at * 10] = f"x{i}"
        docs.append((i, " ".join(text)))
    expected = brute(docs)
    assert found(spark, docs) == expected
    assert sum(kept for *_, kept in expected) > 100


def test_pairs_of_a_family_below_the_limit_are_not_written():
    """Sketches alone refute a family of 0.69: no row of its 44,850 pairs is written."""
    base = [f"w{i}" for i in range(400)]
    sets = []
    for i in range(300):
        text = list(base)
        for at in range(15):
            text[at * 26 + 5] = f"x{i}"
        sets.append(shingle_set(" ".join(text)))
    one = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    assert 0.66 < one < 0.72
    marks = np.frombuffer(b"".join(map(sketch, sets)), np.uint64).reshape(300, -1)
    sizes = np.array([len(s) for s in sets])
    cell = np.zeros(300, np.int64)
    pairs = close_pairs(cell, marks, sizes, np.full(300, -1), 85, Groups(np.arange(300)))
    assert sum(len(a) for a, _ in pairs) < 300


def test_nulls_empties_repeats_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (None, None), (None, "a b c d e f"),
        (5, "A b c d E f"), (5, "a b c d e f"), (5, "quite another text than that one"),
        (4, "quite another text than that one"), (None, "alone here"), (6, "few"), (7, "FEW"),
        (8, long), (9, long + " end"), (9, long + " end"), (10, "x y z"), (None, "Ünï cödé É"),
        (11, "Ünï cödé é"),
    ]
    assert found(spark, docs) == brute(docs)


def test_empty_table_clashing_columns_and_wrong_limit(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame(
        [(1, "a b c d e f", 1, 2, 3, 4, 5, 6), (2, "a b c d e f", 1, 2, 3, 4, 5, 6)],
        SCHEMA + ", id int, node int, size int, places int, root int, kept int",
    )
    rows = sorted(tuple(r) for r in near_duplicates(docs).collect())
    assert rows == [(1, 2, 1, True), (2, 2, 1, False)]
    with pytest.raises(ValueError):
        near_duplicates(docs, percent=50)


def test_estimates_and_their_limit():
    rng = np.random.default_rng(5)
    most, apart = most_bits(85), 0
    for size in (20, 200, 4000):
        for _ in range(60):
            whole = rng.integers(0, 1 << 63, size).astype(np.uint64)
            # a random set of similarity 0.85 or a little more
            cut = int(size * 0.15)
            one, other = np.sort(whole[: size - cut // 2]), np.sort(whole[cut - cut // 2 :])
            marks = [np.frombuffer(sketch(s), np.uint64) for s in (one, other)]
            bits = int(np.bitwise_count(marks[0] ^ marks[1]).sum())
            assert bits <= most
            real = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
            apart += (float(estimate(bits)) - real) / 180
    assert abs(apart) < 0.01
    assert estimate(np.array([0]))[0] == 1


def test_pairs_of_a_cell():
    marks = np.array([[0], [1], [3], [0]], np.uint64)

    def pairs(sides, roots):
        found = close_pairs(np.array([1, 1, 1, 2]), marks, np.full(4, 9), np.array(sides), 85, Groups(np.array(roots)))
        return sorted((int(i), int(j)) for a, b in found for i, j in zip(a, b))

    assert pairs([-1] * 4, range(4)) == [(0, 1), (0, 2), (1, 2)]
    assert pairs([0, 0, 1, 0], range(4)) == [(0, 2), (1, 2)]
    assert pairs([-1] * 4, [5, 5, 6, 7]) == [(0, 2), (1, 2)]


def test_what_is_connected_meanwhile_is_not_compared_again():
    n = 3000
    marks, groups, seen = np.zeros((n, 1), np.uint64), Groups(np.arange(n)), 0
    cell = np.zeros(n, np.int64)
    for a, b in close_pairs(cell, marks, np.full(n, 9), np.full(n, -1), 85, groups):
        seen += len(a)
        for i, j in zip(a.tolist(), b.tolist()):
            groups.join(i, j)
    assert seen < 2 * n and set(groups.labels().tolist()) == {0}


def test_sets_decide():
    sets = [np.arange(100, dtype=np.uint64) + np.uint64(k) for k in (0, 8, 9, 17, 400)]
    a, b = np.triu_indices(5, 1)
    groups = Groups(np.arange(5))
    Sets(sets).join_similar(a, b, groups, 85)  # 92 of 108 in common: 0.852
    assert groups.labels().tolist() == [0, 0, 0, 0, 4]
    Sets(sets).join_similar(a, b, groups := Groups(np.array([1, 5, 2, 2, 9])), 86)
    assert groups.labels().tolist() == [0, 1, 1, 1, 4]
