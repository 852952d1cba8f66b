import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from snapflow.llm.components import components
from snapflow.llm.simhash import (
    chain_places,
    fingerprint,
    fingerprint_edges,
    forest,
    keep_one,
    linked,
    simhash,
)


def brute_print(text):
    found = [w for w in re_words(text)]
    if not found:
        return 0
    grams = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def re_words(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def brute_links(prints):
    return [
        (a, b) for i, a in enumerate(prints) for b in prints[:i] if bin(a ^ b).count("1") <= 4
    ]


def clustered(seed, n):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    made = {0, 1}
    for _ in range(n):
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            value ^= 1 << rng.randrange(64)
        made.add(value)
    return sorted(made)


def test_fingerprint_equals_its_definition():
    for text in ["", None, " \t", "One two", "a b c d e f A B", "É\xa0x y\x0bz w v", "x " * 50]:
        assert fingerprint(text) == brute_print(text)


def test_chains_meet_all_links_and_prune_nothing_linked():
    rng = random.Random(5)
    sets = chain_places()
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            b ^= 1 << bit
        close = bin(a ^ b).count("1") <= 4
        assert bool(linked(np.uint64(a), np.array([b], np.uint64))[0]) == close
        if close:
            assert any(all((a ^ b) >> 8 * i & 255 == 0 for i in equal) for equal in sets)


def test_forest_connects_as_all_pairs_do():
    values = clustered(1, 150)
    got = roots(values, forest(np.array(values, np.uint64)))
    assert got == roots(values, brute_links(values))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_edges_connect_as_all_pairs_do_also_in_crowded_places(spark):
    values = clustered(2, 250)
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    expected = roots(values, brute_links(values))
    for place in (4096, 3):
        edges = fingerprint_edges(frame, place).collect()
        back = [(a % (1 << 64), b % (1 << 64)) for a, b in edges]
        assert all(bin(a ^ b).count("1") <= 4 for a, b in back)
        assert roots(values, back) == expected


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    frame = spark.createDataFrame([*edges, (None, 3), (5, None)], "a long, b long")
    nodes = {n for e in edges for n in e}
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert got == roots(nodes, edges)
    assert components(frame.limit(0)).collect() == []


def test_components_of_texts(spark):
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(99)) for _ in range(120)) for _ in range(5)]
    docs = []
    for key in range(60):
        found = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            found[rng.randrange(len(found))] = "new"
        docs.append((key, " ".join(found), key))
    docs += [(60, None, 0), (61, "", 0), (62, " \n", 0), (None, docs[0][1], 0), (5, docs[5][1], 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, fp long")
    prints = {k: brute_print(t) for k, t, _ in docs}
    whole = roots(set(prints.values()), brute_links(sorted(set(prints.values()))))
    least = {}
    for k, t, _ in docs:
        if k is not None:
            root = whole[brute_print(t)]
            least[root] = min(least.get(root, k), k)
    got = simhash(frame).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == least[whole[prints[r["doc_id"]]]]
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert simhash(frame.limit(0)).collect() == []
    assert keep_one(frame.filter(F.col("doc_id").isNull())).count() == 1


def test_keep_one_never_takes_one_row_for_another(spark):
    texts = ["one and only text of this kind here", "quite other words are in this one", "a third, unlike both of them"]
    cases = [
        [(1, texts[0], 1), (1, texts[1], 2), (2, texts[0], 3)],
        [(None, t, 1) for t in texts],
        [(None, texts[0], 1), (None, texts[0], 1), (None, texts[0], 2)],
        [(5, texts[0], 7), (5, texts[0], 7), (5, texts[2], 7)],
    ]
    expected = [2, 3, 1, 2]
    for rows, n in zip(cases, expected):
        frame = spark.createDataFrame(rows, "doc_id long, text string, extra int")
        kept = [tuple(r) for r in keep_one(frame).collect()]
        assert len(kept) == n == len({t for _, t, _ in kept})
        assert set(kept) <= set(rows)
        again = keep_one(frame.repartition(3, "extra")).collect()
        assert sorted(map(str, again)) == sorted(str(r) for r in keep_one(frame).collect())


INTERNAL = "id mark fp root component_id row head_id head n place least node".split()


def test_columns_of_internal_names_come_through(spark):
    texts = [(1, "some words that are here"), (2, "some words that are here"), (3, None)]
    frame = spark.createDataFrame(
        [(*r, *range(len(INTERNAL))) for r in texts],
        "doc_id long, text string, " + ", ".join(f"{c} int" for c in INTERNAL),
    )
    out = keep_one(frame)
    assert out.columns == frame.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert set(rows) == {1, 3}
    assert all(tuple(r)[2:] == tuple(range(len(INTERNAL))) for r in rows.values())
