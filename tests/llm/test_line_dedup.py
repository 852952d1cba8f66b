import random

import pytest

from snapflow.llm.common import normal_line
from snapflow.llm.line_dedup import (
    MIN_WORDS,
    half_keys,
    line_dedup,
    near,
    neighbour_keys,
    without_repeats,
)


def edits(a, b):
    """Word edit distance, by the textbook table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """Texts by id, without lines that have an equal or near one earlier."""
    earlier, out = [], {}
    for key in sorted(docs, key=lambda k: (k is not None, k or 0)):
        kept = []
        for line in (docs[key] or "").split("\n"):
            found = normal_line(line.encode()).decode().split(" ")
            long = len(found) >= MIN_WORDS
            near_one = long and any(len(x) >= MIN_WORDS and edits(found, x) <= 1 for x in earlier)
            if found == [""] or not (found in earlier or near_one):
                kept.append(line)
            earlier.append(found)
        out[key] = None if docs[key] is None else "\n".join(kept)
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefg") * 2 for _ in range(rng.randint(3, 40))) for _ in range(8)]
    docs = {}
    for key in range(n):
        text = []
        for _ in range(rng.randint(0, 6)):
            found = rng.choice(lines).split()
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(found))
                how = rng.choice(["put", "out", "other", "none"])
                if how == "put":
                    found.insert(at, rng.choice(["x", "Y"]))
                elif how == "out" and len(found) > 1:
                    del found[at]
                elif how == "other":
                    found[at] = rng.choice(["x", "é"])
            text.append(rng.choice([" ", "  "]).join(found))
        docs[key] = "\n".join(text)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = random_docs(seed, 60) | {1000: None, 1001: "", 1002: "one two three four five\n\n"}
    rows = [(k, t, "src", 7) for k, t in docs.items()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, nos int")
    got = {r["doc_id"]: r for r in line_dedup(frame).collect()}
    expected = brute(docs)
    assert {k: r["text"] for k, r in got.items()} == expected
    for key, text in docs.items():
        n = 0 if text is None else text.count("\n") + 1
        assert got[key]["n_lines"] == n
        left = 0 if not expected[key] and got[key]["n_dropped"] == n else None
        if left is None and text is not None:
            assert n - got[key]["n_dropped"] == expected[key].count("\n") + 1


def test_keys_find_all_near_lines():
    rng = random.Random(3)
    for _ in range(3000):
        a = [rng.choice("abc") for _ in range(rng.randint(5, 30))]
        b = list(a)
        at = rng.randrange(len(b))
        how = rng.randint(0, 2)
        if how == 0:
            b[at] = "z"
        elif how == 1:
            b.insert(rng.randint(0, len(b)), "z")
        else:
            del b[at]
        x, y = [[w.encode() for w in s] for s in (a, b)]
        if len(b) >= MIN_WORDS:
            assert set(half_keys(x)) & set(half_keys(y))
            assert set(neighbour_keys(x)[0].tolist()) & set(neighbour_keys(y)[0].tolist())
        assert near(" ".join(a), " ".join(b)) == (edits(a, b) <= 1)


def test_near_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a, b = ([rng.choice("ab") for _ in range(rng.randint(1, 6))] for _ in range(2))
        assert near(" ".join(a), " ".join(b)) == (edits(a, b) <= 1)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "one two three four five\nsix seven eight nine ten"
    rows = [(2, text), (2, text), (None, text), (None, "a"), (5, "one two three four 5\nshort")]
    rows += [(6, "Short"), (7, "\nlonger")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"], r["n_dropped"]) for r in line_dedup(frame).collect())
    assert got == [
        ("2", "", 2), ("2", "", 2), ("5", "short", 1), ("6", "", 1), ("7", "\nlonger", 0),
        ("None", "a", 0), ("None", text, 0),
    ]
    assert line_dedup(frame.limit(0)).collect() == []


def test_one_very_long_line(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:1500] + ["new"] + words[1500:]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_dropped"] for r in line_dedup(frame).collect()} == {1: 0, 2: 1}


def test_rows_that_share_an_id_alone_are_told_apart(spark):
    a, z = "one two three four five", "quite other words stand in this line"
    for texts in ([(1, a), (5, a), (5, z)], [(None, a), (None, z), (None, a)], [(3, a + "\n" + z), (3, z)]):
        frame = spark.createDataFrame(texts, "doc_id long, text string")
        rows = line_dedup(frame).collect()
        assert len(rows) == len(texts)
        lines = [line for r in rows for line in r["text"].split("\n") if line]
        assert set(lines) == {line for _, t in texts for line in t.split("\n")}


INTERNAL = "id code row no mark halves first nos n_lines n_dropped key how line to_id text_ near".split()


def test_columns_of_internal_names_come_through(spark):
    texts = [(1, "one two three four five\nsix"), (2, "one two three four 5\n" + "w " * 12), (3, "six")]
    frame = spark.createDataFrame(
        [(*r, *range(len(INTERNAL))) for r in texts],
        "doc_id long, text string, " + ", ".join(f"{c} int" for c in INTERNAL),
    )
    out = without_repeats(frame)
    assert out.columns == frame.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert {k: r["text"] for k, r in rows.items()} == {1: texts[0][1], 2: "w " * 12}
    assert all(tuple(r)[2:] == tuple(range(len(INTERNAL))) for r in rows.values())
