"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

The test strings are the windows of the benchmark items. They are searched by length. A
shift table says, for a block of two words, how far the search may jump; where it may
not, the block picks a bucket of strings that end with it, and comparison word by word
confirms an occurrence. Texts are searched where they lie; only the test strings travel.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, lower_ascii, map_slices
from snapflow.sources.tables import settle

WINDOW = 13
BLOCK = 2
#: Characters of benchmark text that a task holds at once; a larger benchmark is searched
#: in parts, one after the other.
PART_CHARS = 4_000_000

#: All that is no word character: ASCII but digits and a to z.
_GAPS = bytes(set(range(0x80)) - set(b"0123456789abcdefghijklmnopqrstuvwxyz"))
_BLANK = bytes.maketrans(_GAPS, b" " * len(_GAPS))


def item_words(text: str | None) -> list[bytes]:
    """Words of a text after lower-casing A-Z: digits, letters and all beyond ASCII."""
    return lower_ascii(text).translate(_BLANK).split()


def windows(found: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """The windows of an item; an item of fewer words is one window, of none it has none."""
    if not found:
        return []
    return [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]


class WuManber:
    """Strings of one length, in words."""

    def __init__(self, size: int, strings: dict[tuple, set]):
        self.size, self.block = size, min(BLOCK, size)
        self.farthest = size - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list] = defaultdict(list)
        for string, items in strings.items():
            for end in range(self.block, size + 1):
                block = string[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.farthest), size - end)
            self.bucket[string[size - self.block :]].append((string, items))

    def search(self, found: list[bytes]) -> list[tuple[int, set]]:
        """Starts of occurrences, with the items that own the string."""
        hits, size, block = [], self.size, self.block
        shift, farthest = self.shift.get, self.farthest
        end, last = size, len(found)
        while end <= last:
            tail = tuple(found[end - block : end])
            step = shift(tail, farthest)
            if step:
                end += step
                continue
            start = end - size
            head = found[start]
            for string, items in self.bucket[tail]:
                if string[0] == head and string == tuple(found[start:end]):
                    hits.append((start, items))
            end += 1
        return hits


def searchers(items: list[tuple], size: int = WINDOW) -> list[WuManber]:
    """Search tables for (item_id, text) rows, one for each length of string."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        for window in windows(item_words(text), size):
            by_length[len(window)][window].add(item)
    return [WuManber(n, strings) for n, strings in sorted(by_length.items())]


def find(text: str | None, tables: list[WuManber]) -> tuple[int, list[tuple[int, int]], set]:
    """Words of the text, the spans of words that are hit (disjoint), and the items."""
    found = item_words(text)
    spans, items = [], set()
    for table in tables:
        for start, owners in table.search(found):
            spans.append((start, start + table.size))
            items |= owners
    return len(found), union(spans), items


def union(spans: list) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, end in sorted(map(tuple, spans)):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def benchmark_parts(
    benchmark: DataFrame, item: str, text: str, most: int = PART_CHARS
) -> Iterator[list[tuple]]:
    """The benchmark's rows in parts of about `most` characters, fetched one by one."""
    rows = benchmark.filter(F.col(text).isNotNull()).select(
        F.col(item).cast("string").alias("item"), F.col(text).alias("text")
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-chars // most) or 1
    if parts == 1:
        return iter([[tuple(r) for r in rows.collect()]])
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return ([tuple(r) for r in rows.filter(part == i).collect()] for i in range(parts))


def search_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    part_chars: int = PART_CHARS,
    carry: list[str] = (),
) -> DataFrame:
    """Where test strings occur in each text.

    Returns `key`, others (a struct of the columns that `carry` names), n_words, spans (array of [start, end) in words, disjoint, ascending)
    and items (ids as strings, sorted). Null texts have no words. Rows that repeat each
    have their result; benchmark rows that share an id count as one item; those without
    an id are searched, and hit, but not listed. With an empty benchmark nothing is hit.
    Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    others = F.struct(*carry) if carry else F.lit(None).cast("string")
    state = "n_words long, spans array<array<int>>, items array<string>"
    rows = docs.select(
        F.col(key).alias("id"),
        others.alias("others"),
        F.col(text).alias("text"),
        F.array().cast("array<array<int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    broadcast = docs.sparkSession.sparkContext.broadcast
    kept_kind = rows.schema["others"].dataType.simpleString()
    part = None
    for following in benchmark_parts(benchmark, item, item_text, part_chars):
        if part is not None:
            search = _Search(broadcast(part), size, keep_text=True)
            kept = map_slices(rows, f"id {kind}, others {kept_kind}, text string, {state}", search)
            rows = settle(kept.drop("n_words"), "searched")
        part = following
    search = _Search(broadcast(part), size, keep_text=False)
    return map_slices(rows, f"id {kind}, others {kept_kind}, {state}", search).withColumnRenamed("id", key)


class _Search:
    def __init__(self, items, size: int, keep_text: bool):
        self.items, self.size, self.keep_text = items, size, keep_text

    def __call__(self):
        tables = searchers(self.items.value, self.size)

        def act(ids, others, texts, spans, items):
            rows = []
            for i, o, t, s, owned in zip(ids, others, texts, spans, items):
                n, new, more = find(t, tables)
                listed = sorted({*owned, *more} - {None})
                both = [list(x) for x in union([*s, *new])]
                rows.append((i, o, *([t] if self.keep_text else []), n, both, listed))
            return columns_of(rows, 5 + self.keep_text)

        return act


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """Per row of `docs`: n_words, n_hit, n_items, items and contaminated.

    A word inside any occurrence is hit; a text is contaminated if at least a twentieth
    of its words is. `names` and odd rows: see `search_documents`.
    """
    found = search_documents(docs, benchmark, **names)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn(
            "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
        )
    )



def clean_documents(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns."""
    found = decontaminate(docs, benchmark, carry=docs.columns, **names)
    return found.filter(~F.col("contaminated")).select(
        *[F.col("others")[c].alias(c) for c in docs.columns]
    )
