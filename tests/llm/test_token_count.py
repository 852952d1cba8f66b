import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapflow.llm.token_count import (
    TOKENIZER,
    PrefixTokenizer,
    cut_within,
    prefix_counts,
    token_counts,
)

TEXTS = [
    "", "a  b", "a   b", "  a", "a ", "a\n b", "a \n b", "it's '' 's'll", "<|endoftext|>",
    "x<|endoftext|> y", "!!<|endoft", "汉字 テスト", "é x", "\x1c a\x1cb", "don't  stop\t\n\n",
    "1234 56a7 ___ -- --", "😀😀 👨‍👩‍👧", "\xa0 \xa0x y", "a\0b \0",
]


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path(TOKENIZER)
    library = Tokenizer.from_file(path)
    return PrefixTokenizer(path), lambda t: len(library.encode(t, add_special_tokens=False).ids)


def test_counts_are_the_librarys_at_every_prefix(both):
    own, library = both
    rng = random.Random(1)
    made = ["".join(rng.choices(" '\n\tabsdtlmrev1!?é<|>", k=rng.randint(1, 30))) for _ in range(400)]
    for text in TEXTS + made:
        index = own.index(text)
        expected = [library(text[:n]) for n in range(len(text) + 1)]
        assert [index.count_at(n) for n in range(len(text) + 1)] == expected
        assert own.count(text) == expected[-1]
        for budget in (0, 1, 4):
            cut = max(n for n, c in enumerate(expected) if c <= budget)
            assert index.cut(budget) == cut
            if expected[-1] > budget:
                assert cut_within(own, text, budget) == cut


def test_long_runs(both):
    own, library = both
    for text in ("a" * 3000, " " * 2000, "ab " * 5000, "\n" * 500 + "x"):
        assert own.count(text) == library(text)


def test_rows(spark, both):
    _, library = both
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(900, None, ""), (None, "hi", ""), (0, "", "")]
    rows += [(901, "word of words " * 400, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(
        (str(k), len((t or "").encode()), library(t or ""), library(t or "") > 512) for k, t, _ in rows
    )
    long = next(r for r in got if r["doc_id"] == 901)
    text = rows[-1][1]
    assert library(text[: long["cut_chars"]]) <= 512 < library(text[: long["cut_chars"] + 8])
    assert token_counts(docs.limit(0)).collect() == []
    table = {r["doc_id"]: r["counts"] for r in prefix_counts(docs).collect()}
    assert table[1] == [library("a  b"[:n]) for n in range(5)]
