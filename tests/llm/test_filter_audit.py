from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapflow.llm.filter_audit import (
    filter_audit,
    order_sums,
    shapley_matrix,
    text_failures,
)

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(120))


def brute(docs, labels):
    masks = []
    for i, t, _ in docs:
        copy = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in docs)
        masks.append(text_failures(t) | copy << 4)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = {}
    for part in {lang or "" for *_, lang in docs}:
        mine = [(d[0], m) for d, m in zip(docs, masks) if (d[2] or "") == part]
        total = dict.fromkeys(range(5), 0)
        made = {}
        for order in permutations(range(5)):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1] >> f & 1]
                left = [x for x in left if not x[1] >> f & 1]
                total[f] += len(gone)
                made["".join("ABCDE"[i] for i in order), step] = (
                    f,
                    len(left),
                    len(gone),
                    sum(m >> f & 1 for _, m in mine) - len(gone),
                    sum(m == 1 << f for _, m in mine),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                )
        for at, (f, *counts) in made.items():
            rows[part, *at] = (*counts, total[f])
    return rows


def found(spark, docs, labels):
    rows = filter_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    return {tuple(r)[:3]: tuple(r)[3:] for r in rows.collect()}


CASES = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (3, LONG, "de"),
    (3, LONG, "de"),
    (4, None, None),
    (5, "", "en"),
    (6, "", ""),
    (7, "A B C # " * 60, "en"),
    (8, LONG.upper(), "de"),
    (9, LONG + " $", "fr"),
    (None, LONG, "fr"),
    (None, "short", "fr"),
    (10, "short", "fr"),
    (11, "long " * 20000, "xx"),
]
MARKED = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 0, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def test_every_step_as_by_brute_force(spark):
    assert found(spark, CASES, MARKED) == brute(CASES, MARKED)


def test_empty_tables_and_extra_columns(spark):
    assert found(spark, [], []) == {}
    docs = spark.createDataFrame(
        [(1, LONG, "en", 5, "x", "y", 3)],
        DOCS + ", mask int, digest string, part string, id int",
    )
    rows = filter_audit(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 600 and {r["kept"] for r in rows} == {1}


def test_failures_of_a_text():
    assert text_failures(None) == text_failures("") == 1
    assert text_failures(LONG) == 0
    assert text_failures("a " * 100) == 2
    assert text_failures("Éé" * 5 + "A") == 1  # one of eleven characters is A-Z
    assert text_failures(LONG + "|") == 8


@pytest.mark.parametrize("n", [2, 3, 5])
def test_constrained_least_squares_give_shapley_values(n):
    matrix = shapley_matrix(n)
    for i in range(n):
        for s in range(1 << n):
            k = s.bit_count()
            if s >> i & 1:
                share = Fraction(factorial(k - 1) * factorial(n - k), factorial(n))
            else:
                share = -Fraction(factorial(k) * factorial(n - k - 1), factorial(n))
            assert matrix[i][s] == (share if s else 0)
    assert all(sum(row[s] for row in order_sums(n)) == 0 for s in range(1, (1 << n) - 1))


@settings(deadline=None, max_examples=100)
@given(st.text())
def test_failures_follow_their_definition(text):
    import re

    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    expected = (
        (len(found) < 100)
        + 2 * (100 * len(set(found)) < 80 * len(found))
        + 4 * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        + 8 * bool(re.search(r"[#$%&*|]", text))
    )
    assert text_failures(text) == expected
