import random

from snapflow.llm.decontaminate import clean_documents, decontaminate, item_words, search_documents, windows


def brute(docs, items):
    strings = {}
    for item, text in items:
        for w in windows(item_words(text)):
            strings.setdefault(w, set()).add(item)
    out = {}
    for key, text in docs:
        found, hit, owners = item_words(text), set(), set()
        for n in {len(w) for w in strings}:
            for i in range(len(found) - n + 1):
                if (w := tuple(found[i : i + n])) in strings:
                    hit |= set(range(i, i + n))
                    owners |= strings[w]
        ids = sorted(str(x) for x in owners - {None})
        out[key] = (len(found), len(hit), len(ids), ids, len(hit) > 0 and 20 * len(hit) >= len(found))
    return out


def test_words():
    assert item_words("A-b c_D9 É\xa0x|") == [b"a", b"b", b"c", b"d9", "É\xa0x".encode()]
    assert item_words(None) == item_words(" .,") == []


def test_equals_brute_force_in_one_part_and_in_many(spark):
    rng = random.Random(1)
    letters = "abc"
    items = [(i, " ".join(rng.choices(letters, k=rng.choice([1, 3, 8, 13, 14, 30])))) for i in range(8)]
    items += [(3, "a b a b a b a b a b a b a c"), (None, "c c c c c c c c c c c c c"), (50, None), (51, "..")]
    docs = []
    for key in range(60):
        found = rng.choices(letters + "xyz", k=rng.randint(0, 80))
        if rng.random() < 0.6:
            at = rng.randint(0, len(found))
            found[at:at] = (rng.choice(items)[1] or "").split()
        docs.append((key, rng.choice([" ", ", ", "-"]).join(found)))
    docs += [(100, None), (101, ""), (None, "b")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, spans int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    for chars in (10**6, 60):
        got = decontaminate(frame, bench, part_chars=chars).collect()
        assert len(got) == len(docs)
        for r in got:
            mine = (r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"])
            assert mine == expected[r["doc_id"]]
    kept = clean_documents(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in expected.items() if not v[4]}


def test_empty_tables_and_repeats(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three"), (1, "one two three")], "doc_id long, text string")
    assert [r["contaminated"] for r in decontaminate(docs, bench).collect()] == [True, True]
    assert [r["n_hit"] for r in decontaminate(docs, bench.limit(0)).collect()] == [0, 0]
    assert search_documents(docs.limit(0), bench).collect() == []


def test_long_text(spark):
    words = " ".join(f"w{i}" for i in range(30_000))
    item = " ".join(f"w{i}" for i in range(29_000, 29_020))
    docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    (r,) = decontaminate(docs, bench).collect()
    assert (r["n_hit"], r["contaminated"]) == (20, False)
