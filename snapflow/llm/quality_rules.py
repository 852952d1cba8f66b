"""Quality rules: base counts of a text, and lines that many documents of a host share.

Each line is normalised and hashed. Per host, the distinct documents (by their text) that
hold a line are counted; a line above the host's limit is boilerplate and goes. A document
that fails the base rules, or of which little is left, is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, hash64, map_slices, normal_line, words
from snapflow.sources.tables import settle

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Limits. A line goes if over `line_docs` documents of its host have it, and over
    `line_percent` of them. A document goes if fewer than `min_words` words are left, or
    under `left_percent` of its own."""

    min_words: int = 10
    repeat_percent: int = 20
    line_docs: int = 20
    line_percent: int = 5
    left_percent: int = 30


def repeated_words(found: list[bytes]) -> int:
    """Words in windows of five that occur twice or more in the text."""
    if len(found) <= WINDOW:
        return 0
    marks = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    rolled = np.zeros(len(found) - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + marks[i : i + len(rolled)]
        rolled ^= rolled >> np.uint64(29)
    _, which, counts = np.unique(rolled, return_inverse=True, return_counts=True)
    if len(counts) == len(rolled):
        return 0
    starts = np.zeros(len(found) + 1, np.int64)
    again = np.flatnonzero(counts[which] > 1)
    starts[again] += 1
    starts[again + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(starts)))


def base_counts(text: str | None, rules: Rules) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    found = words(text)
    seen, repeats = set(), 0
    for line in text.encode("utf-8").split(b"\n"):
        if line in seen:
            repeats += bool(line.split())
        seen.add(line)
    n, again = len(found), repeated_words(found)
    return (
        n,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeats,
        again,
        n < rules.min_words or 100 * again > rules.repeat_percent * n,
    )


COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean"
)


def line_facts(docs: DataFrame, key: str, text: str, host: str, rules: Rules) -> DataFrame:
    """Base counts, the text's hash, and per line with a word its hash, words and place."""

    def make():
        def act(keys, hosts, texts):
            rows = []
            for k, h, t in zip(keys, hosts, texts):
                raw = (t or "").encode("utf-8")
                lines = [
                    (i, hash64(normal), normal.count(b" ") + 1)
                    for i, line in enumerate(raw.split(b"\n"))
                    if (normal := normal_line(line))
                ]
                places, marks, sizes = columns_of(lines, 3)
                rows.append((k, h, *base_counts(t, rules), hash64(raw), places, marks, sizes))
            return columns_of(rows, 12)

        return act

    kinds = {c: docs.schema[c].dataType.simpleString() for c in (key, host)}
    out = (
        f"id {kinds[key]}, host {kinds[host]}, {COUNTS}, text_hash long, "
        "places array<int>, marks array<long>, sizes array<int>"
    )
    rows = docs.select(F.col(key).alias("id"), F.col(host).alias("host"), text)
    return map_slices(rows, out, make)


def frequent_lines(facts: DataFrame, rules: Rules) -> DataFrame:
    """Lines above the limits of their host, from the output of `line_facts`."""
    holders = facts.select("host", "text_hash", F.explode("marks").alias("mark"))
    counted = holders.groupBy("host", "mark").agg(F.count_distinct("text_hash").alias("n"))
    sizes = facts.groupBy("host").agg(F.count_distinct("text_hash").alias("docs"))
    often = counted.filter(F.col("n") > rules.line_docs)
    return (
        often.join(sizes, often.host.eqNullSafe(sizes.host))
        .filter(100 * F.col("n") > rules.line_percent * F.col("docs"))
        .select(often.host, "mark", "n")
    )


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
    carry_host: bool = False,
) -> DataFrame:
    """Counts and verdict per row of `docs`.

    Returns `key`, the base counts, text_hash (xxhash64 of the text), words_left, dropped_lines (places of lines above the
    limits, ascending) and kept. Null and empty texts have no words and fail; null is a
    host like any other; rows that repeat each get the result, and count once towards
    the frequency of their lines. With `carry_host` the host comes along as host_of_row.
    Other columns of `docs` are not read.
    """
    facts = settle(line_facts(docs, key, text, host, rules), "line-facts")
    often = frequent_lines(facts, rules).groupBy("host").agg(F.collect_set("mark").alias("often"))
    often = often.withColumnRenamed("host", "often_host")
    joined = facts.join(often, F.col("host").eqNullSafe(F.col("often_host")), "left")
    line = F.arrays_zip("places", "marks", "sizes")
    gone = F.filter(line, lambda x: F.array_contains(F.col("often"), x["marks"]))
    judged = joined.withColumn("gone", F.coalesce(gone, F.array().cast(gone_type()))).withColumn(
        "words_left",
        F.col("n_words") - F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["sizes"]),
    )
    depleted = (F.col("words_left") < rules.min_words) | (
        100 * F.col("words_left") < rules.left_percent * F.col("n_words")
    )
    return judged.select(
        F.col("id").alias(key),
        *[c.split()[0] for c in COUNTS.split(", ")],
        "text_hash",
        "words_left",
        F.col("gone.places").alias("dropped_lines"),
        (~F.col("base_failed") & ~depleted).alias("kept"),
        *([F.col("host").alias("host_of_row")] if carry_host else []),
    )


def gone_type() -> str:
    return "array<struct<places:int,marks:bigint,sizes:int>>"


def apply_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """The rows of `docs` that are kept, their texts without the lines above the limits.

    The columns are those of `docs`, whatever their names. Rows go by their id, host and
    text, so that rows that share an id alone are judged by their own text and host.
    """
    verdict = quality_rules(docs, key, text, host, rules, carry_host=True).filter("kept")
    verdict = verdict.select(
        F.col(key).alias("kept_id"), "host_of_row", "text_hash", F.col("dropped_lines").alias("gone")
    ).dropDuplicates(["kept_id", "host_of_row", "text_hash"])
    rows = docs.select(
        F.col(key).alias("id"),
        F.col(host).alias("host"),
        F.col(text).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"),
        F.struct(*docs.columns).alias("row"),
    )
    joined = rows.join(
        verdict,
        F.col("id").eqNullSafe(F.col("kept_id"))
        & F.col("host").eqNullSafe(F.col("host_of_row"))
        & (F.col("hash") == F.col("text_hash")),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    cleaned = F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(lines, "\n"))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )
