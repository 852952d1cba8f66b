"""Filter interaction audit: what each filter removes, alone, after others, and fairly shared.

Every document has a mask of the filters that it fails. A coalition of filters removes the
documents that fail at least one of its members; all removals are tabulated per part. What
a filter removes at a step is the difference of two coalitions. A filter's fair share, its
Shapley value, is the solution of a least squares problem over all coalitions, weighted by
the Shapley kernel and held to add up to what all filters remove. It is solved in rationals.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import map_slices
from snapflow.sources.tables import settle

FILTERS = "ABCDE"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 100, 80, 10


def text_failures(text: str | None) -> int:
    """The mask of A to D: too few words, too few distinct, too many capitals, marks."""
    raw = (text or "").encode("utf-8")
    found = raw.split()
    capitals = len(raw) - len(raw.translate(None, UPPER))
    marks = len(raw) - len(raw.translate(None, MARKS))
    return (
        (len(found) < MIN_WORDS)
        | (100 * len(set(found)) < MIN_DISTINCT_PERCENT * len(found)) << 1
        | (100 * capitals > MOST_UPPER_PERCENT * len(text or "")) << 2
        | (marks > 0) << 3
    )


def solved(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """The right-hand sides of an augmented square system, solved by elimination."""
    n = len(rows)
    rows = [list(r) for r in rows]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i] != 0)
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i] != 0:
                by = rows[r][i]
                rows[r] = [x - by * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def shapley_matrix(n: int) -> list[list[Fraction]]:
    """Row i holds the share of each coalition's removals in the value of filter i.

    The normal equations of: minimise, over values x, the sum over coalitions S that are
    neither empty nor whole of w(|S|) * (v(S) - sum of x in S)^2, where the x add up to
    v(whole); with the multiplier of that constraint as the last unknown. The right-hand
    side is linear in v, so that the system is solved once, for a unit of each coalition.
    """
    whole = (1 << n) - 1
    weight = {k: Fraction(n - 1, comb(n, k) * k * (n - k)) for k in range(1, n)}
    inner = [s for s in range(1, whole)]
    rows = []
    for i in range(n):
        left = [
            sum((weight[s.bit_count()] for s in inner if s >> i & 1 and s >> j & 1), Fraction(0))
            for j in range(n)
        ]
        right = [
            weight[s.bit_count()] if s in range(1, whole) and s >> i & 1 else Fraction(0)
            for s in range(whole + 1)
        ]
        rows.append([*left, Fraction(1), *right])
    total = [Fraction(s == whole) for s in range(whole + 1)]
    rows.append([*[Fraction(1)] * n, Fraction(0), *total])
    return solved(rows)[:n]


def order_sums(n: int) -> list[list[int]]:
    """`shapley_matrix` times the number of orders: whole numbers."""
    scaled = [[x * factorial(n) for x in row] for row in shapley_matrix(n)]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("shares over all orders are whole numbers")
    return [[int(x) for x in row] for row in scaled]


def failures(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """Per row: id, part, and the mask of all five filters.

    Copies are found by the digests of their texts. Both sides of the join were written,
    so that the adaptive planner may split a text that very many rows have.
    """

    def make():
        def act(ids, parts, texts):
            digests = [hashlib.sha256((t or "").encode("utf-8")).digest() for t in texts]
            return ids, parts, [text_failures(t) for t in texts], digests

        return act

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text
    )
    out = f"id {kind}, part string, own int, digest binary"
    facts = settle(map_slices(rows, out, make), "failures")
    first = facts.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Where all ids of a text are equal, none is a copy of a smaller one.
    first = settle(first.filter("first < last").drop("last"), "first-copies")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int")
    return facts.join(first, "digest", "left").select(
        "id", "part", (F.col("own") + 16 * copy).alias("mask")
    )


def coalition_table(
    judged: DataFrame, labels: DataFrame, key: str, good: Column, toxic: Column, n: int
) -> DataFrame:
    """Per part and coalition: documents, those removed, and the good and toxic of them."""
    known = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.coalesce(good, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(toxic, F.lit(False)).cast("int")).alias("toxic"),
    )
    masks = judged.join(settle(known, "known-labels"), "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0

    def removed(count: str) -> Column:
        return F.sum(F.when(hit, F.col(count)).otherwise(0))

    coalitions = F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("coalition")
    return masks.select("*", coalitions).groupBy("part", "coalition").agg(
        F.sum("n").alias("docs"),
        removed("n").alias("removed"),
        removed("good").alias("good"),
        removed("toxic").alias("toxic"),
    )


def interactions(table: DataFrame, filters: str) -> DataFrame:
    """A row per part, order of the filters and step, from `coalition_table`."""
    n = len(filters)
    whole = (1 << n) - 1
    by_coalition = F.map_from_entries(
        F.collect_list(F.struct("coalition", F.struct("removed", "good", "toxic")))
    )
    parts = table.groupBy("part").agg(F.max("docs").alias("docs"), by_coalition.alias("at"))
    shares = [
        " + ".join(f"{x} * element_at(at, {s}).removed" for s, x in enumerate(row) if x)
        for row in order_sums(n)
    ]
    orders = ",".join("".join(order) for order in permutations(filters))
    bits = {f: 1 << i for i, f in enumerate(filters)}
    gone = " + ".join(
        f"if(instr(left(filter_order, step - 1), '{f}') > 0, {bit}, 0)" for f, bit in bits.items()
    )
    rows = (
        parts.selectExpr("part", "docs", "at", f"array({', '.join(shares)}) AS shares")
        .selectExpr("*", f"explode(split('{orders}', ',')) AS filter_order")
        .selectExpr("*", f"explode(sequence(1, {n})) AS step")
        .selectExpr("*", f"instr('{filters}', substring(filter_order, step, 1)) - 1 AS filter")
        .selectExpr("*", f"{gone} AS before", "shiftleft(1, filter) AS bit")
        .selectExpr("*", "before + bit AS after")
    )

    def at(coalition, count: str) -> Column:
        return F.element_at("at", coalition)[count]

    removed = at(F.col("after"), "removed") - at(F.col("before"), "removed")
    others = F.lit(whole) - F.col("bit")
    counts = {
        "kept": F.col("docs") - at(F.col("after"), "removed"),
        "removed": removed,
        "redundant": at(F.col("bit"), "removed") - removed,
        "unique_fails": at(F.lit(whole), "removed") - at(others, "removed"),
        "good_lost": at(F.col("after"), "good") - at(F.col("before"), "good"),
        "toxic_lost": at(F.col("after"), "toxic") - at(F.col("before"), "toxic"),
        "shapley": F.get("shares", F.col("filter")),
    }
    return rows.select(
        "part", "filter_order", "step", *[c.cast("long").alias(name) for name, c in counts.items()]
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """How the five filters interact: a row per part, order of the filters, and step.

    Filters, by what fails them: A, under 100 words; B, under 80 % of the words distinct;
    C, over 10 % of the characters capitals A-Z; D, any of #$%&*|; E, the text is that of
    a smaller id, wherever that one stands. Counts are those of the part: kept after the
    step, removed by it, redundant (it fails them, but they went before), unique_fails
    (only its filter fails them), good_lost and toxic_lost of those removed, and shapley
    (what its filter removes, added up over all orders).

    A null text is empty: no words, so it fails A alone, and E if an earlier one is empty.
    Null parts are the part of the empty string. Rows that repeat each count; a null id
    is neither smaller nor larger than others, and has no label. Of several labels of an
    id, one good (quality 1) or toxic (1) is enough. Without documents there are no rows.
    """
    judged = failures(docs, key, text, part)
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    table = coalition_table(judged, labels, key, good, toxic, len(FILTERS))
    return interactions(settle(table, "coalitions"), FILTERS)
