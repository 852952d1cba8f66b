import random
import zlib

from snapflow.llm.language import (
    LanguageModel,
    normalise,
    predict_language,
    training_samples,
)

SYLLABLES = {"aa": "ba da ga lo mi".split(), "bb": "kri stu vex pli zor".split()}


def text_in(lang, rng, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n)) + "."


def phrases(text, sample):
    """Greedy longest matches, by search."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(1)
    samples = {k: normalise(" ".join(text_in(k, rng) for _ in range(5))) for k in SYLLABLES}
    model = LanguageModel(samples)
    texts = [normalise(text_in(rng.choice("ab") * 2, rng, rng.randint(1, 60))) for _ in range(20)]
    texts += ["é q", "zzzz"]
    costs = model.costs(texts)
    for text, row in zip(texts, costs):
        for lang, bits, cost in zip(model.languages, model.bits, row):
            assert round(cost * len(text) / bits, 6) == phrases(text, samples[lang])


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(2)
    rows = []
    for key in range(300):
        lang = rng.choice(["aa", "bb"])
        rows.append((key, text_in(lang, rng), lang, 0.5))
    rows += [(1000, None, "aa", 0.1), (1001, "", None, 0.1), (1002, "12 3!", "bb", 0.1)]
    rows += [(None, text_in("aa", rng), None, 0.0), (7, rows[7][1], rows[7][2], 0.0)]
    rows += [(1003, "badaga " * 20_000, "bb", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    samples = training_samples(docs)
    assert set(samples) == {"aa", "bb"}
    got = predict_language(docs, samples).collect()
    assert len(got) == len(rows)
    truth = {k: lang for k, _, lang, _ in rows if k is not None and k < 1000}
    for r in got:
        key = r["doc_id"]
        assert r["held_out"] == (key is None or zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if key in (1000, 1001, 1002):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif key in truth:
            assert r["lang_pred"] == truth[key]
    none = docs.limit(0)
    assert training_samples(none) == {}
    assert {r["lang_pred"] for r in predict_language(docs, {}).collect()} == {"und"}
    assert predict_language(none, samples).collect() == []


def test_no_label_of_the_held_out_fold_is_read(spark):
    rng = random.Random(3)
    rows = [
        (k, text_in("aa", rng), "trap" if zlib.crc32(str(k).encode()) % 5 == 0 else "aa")
        for k in range(50)
    ]
    assert set(training_samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"))) == {"aa"}


def test_repeats_count_each_time():
    rng = random.Random(9)
    model = LanguageModel({lang: normalise(text_in(lang, rng, 300)) for lang in SYLLABLES})
    most, few = text_in("aa", rng, 30), text_in("bb", rng, 60)
    assert model.predict([few + " " + most, few + " " + most * 6])[0] == ["bb", "aa"]
