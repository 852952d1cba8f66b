import random

import corpus_pipeline as pipeline
from snapflow.llm.line_dedup import line_dedup
from snapflow.sources.tables import settle


def write(spark, folder, docs, items):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, t, "en", "s", len(t or "")) for k, t in docs]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def test_stages_catch_what_is_planted_and_leave_the_rest(spark, tmp_path):
    rng = random.Random(1)
    clean = [(k, "\n".join(sentence(rng, 30) for _ in range(5))) for k in range(60)]
    item = sentence(rng, 40)
    near = clean[3][1].split(" ")
    near[20] = "changed"
    docs = clean + [
        (100, clean[0][1]),  # a copy
        (101, " ".join(near)),  # a near copy
        (102, sentence(rng, 20) + "\n" + item),  # a benchmark passage
        (103, "too short"),
        (104, "again and again it says " * 20),
        (105, None),
        (106, ""),
        (107, sentence(rng, 30) + "\n" + clean[7][1].split("\n")[2]),  # a repeated passage
    ]
    write(spark, str(tmp_path), docs, [(1, item), (2, None)])
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    alive, columns = {}, frame.columns
    for name, stage in pipeline.STAGES[:-1]:
        frame = settle(stage(spark, frame, str(tmp_path)), name)
        assert frame.columns == columns
        rows = {r["doc_id"]: r for r in frame.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        alive[name] = rows
    kept = {k for k, _ in clean}
    assert set(alive["quality_rules"]) == kept | {100, 101, 102, 107}
    assert set(alive["line_dedup"]) == kept | {102, 107}
    assert alive["line_dedup"][107]["text"] == docs[-1][1].split("\n")[0]
    assert set(alive["simhash_dedup"]) == kept | {102, 107}
    assert set(alive["decontamination"]) == kept | {107}
    assert {k: alive["decontamination"][k]["text"] for k in kept} == dict(clean)
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in packed} == kept | {107}


def test_near_dedup_stage_on_its_own_input(spark, tmp_path):
    rng = random.Random(2)
    base = sentence(rng, 400)
    docs = [(9, base), (4, base), (7, base + " end"), (1, sentence(rng, 400))]
    write(spark, str(tmp_path), docs, [(1, "x")])
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, frame, "").collect()) == [1, 4]


def test_no_documents(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert pipeline.run(spark, str(tmp_path)).collect() == []
    assert line_dedup(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect() == []
