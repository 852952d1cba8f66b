"""Line dedup: exact and near-equal lines over all documents; the earliest is kept.

Two lines are near if one word put in, left out or replaced makes them equal. All that a
line becomes by one deletion is its neighbourhood, emitted as hashed keys. A key keeps
the place of the deletion if a replacement is meant, so that lines with equal keys are
near one another, and the earliest of them stands for all; no pairs are made. Since a
long line has many neighbours, they are made only for lines that share one half with
another line, as near lines must.

A row is known by its id and the hash of its text, so that rows that share an id alone are
told apart.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import SLICE_ROWS, columns_of, hash64, map_slices, normal_line
from snapflow.sources.tables import settle

#: Shorter lines have no near ones, only equal ones.
MIN_WORDS = 5
#: What tells a document: its id and the hash of its text.
ROW = ["id", "code"]


def half_sizes(n: int) -> list[int]:
    """Sizes of the ends by which a line of n words meets lines of n - 1 to n + 1.

    Of two near lines the common beginning and end make up the shorter one, but for a
    word, so one of them has at least half its words. Sizes 2^k and 3 * 2^k are used;
    a line takes the largest for its own length and for the length below.
    """

    def size(length: int) -> int:
        steps = [2 << k for k in range(40)] + [3 << k for k in range(40)]
        steps.sort()
        return steps[max(0, bisect_right(steps, (length - 1) // 2) - 1)]

    return sorted({size(n), size(n - 1)})


_HALVES: dict[int, list[int]] = {}


def half_keys(found: list[bytes]) -> list[int]:
    n = len(found)
    if n not in _HALVES:
        _HALVES[n] = half_sizes(n)
    keys = []
    for size in _HALVES[n]:
        keys.append(hash64(b"%d<" % size + b" ".join(found[:size])))
        keys.append(hash64(b"%d>" % size + b" ".join(found[-size:])))
    return keys


REPLACED, WHOLE, LONGER = 0, 1, 2

_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def _mixed(x: np.ndarray, what: int) -> np.ndarray:
    x = x ^ np.uint64(what)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def neighbour_keys(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed keys of a line and all its deletions, and the kind of each.

    REPLACED lines of one key are alike but for the word at one place. The WHOLE line of
    a key has one word less than each LONGER line of that key. A line's hash is the sum of
    its words' hashes, each times a power of its place; taking out a word moves those
    behind it one place forward.
    """
    n = len(found)
    words = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in found), np.uint64, n)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)])
    shorter = sums[:-1] + (sums[-1] - sums[1:]) * _BACK
    places = np.arange(n, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    keys = [_mixed(shorter + places, 0x3D), np.unique(_mixed(shorter, 0x2B)), _mixed(sums[-1:], 0x2B)]
    kinds = np.repeat([REPLACED, LONGER, WHOLE], [len(k) for k in keys])
    return np.concatenate(keys).view(np.int64), kinds.astype(np.int32)


def near(a: str, b: str) -> bool:
    """Whether at most one word put in, left out or replaced makes the lines equal."""
    x, y = sorted((a.split(" "), b.split(" ")), key=len)
    if len(y) - len(x) > 1:
        return False
    at = next((i for i, (s, t) in enumerate(zip(x, y)) if s != t), len(x))
    return x[at + (len(x) == len(y)) :] == y[at + 1 :]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The documents' id, code and text."""
    code = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).alias("id"), code.alias("code"), F.col(text).alias("text"))


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    """Rows of `a` and `b` that agree; nulls are equal."""
    return F.expr("true") if not names else a[names[0]].eqNullSafe(b[names[0]]) & _same(a, b, names[1:])


def _lines(rows: DataFrame) -> DataFrame:
    """Every line with a word: document, place, hash, and keys of the halves of long ones."""

    def make():
        def act(ids, codes, texts):
            made = []
            for i, c, t in zip(ids, codes, texts):
                for no, line in enumerate((t or "").encode("utf-8").split(b"\n")):
                    normal = normal_line(line)
                    if normal:
                        found = normal.split(b" ")
                        halves = half_keys(found) if len(found) >= MIN_WORDS else []
                        made.append((i, c, no, hash64(normal), halves))
            return columns_of(made, 5)

        return act

    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, f"id {kind}, code long, no int, mark long, halves array<long>", make)


def _candidates(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct lines with the first place of each; those that share a half with another."""
    distinct = settle(
        lines.groupBy("mark", "halves").agg(
            F.min(F.struct(*ROW, "no")).alias("first"), F.count("*").alias("n")
        ),
        "distinct-lines",
    )
    keyed = distinct.select("mark", F.explode("halves").alias("half"))
    shared = (
        keyed.groupBy("half")
        .agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
        .filter("low < high")
        .select("half")
    )
    marks = keyed.join(shared, "half", "left_semi").select("mark").distinct()
    return distinct, distinct.join(marks, "mark", "left_semi")


def _texts(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The normalised lines at `places` (id, code, no)."""
    wanted = places.groupBy(*ROW).agg(F.collect_set("no").alias("nos"))
    # Texts are shuffled whatever the size of the other side, which grows as they do.
    joined = rows.hint("merge").join(wanted, _same(rows, wanted, ROW))
    joined = joined.select(rows["id"], rows["code"], "text", "nos")

    def make():
        def act(ids, codes, texts, nos):
            found = []
            for i, c, t, some in zip(ids, codes, texts, nos):
                lines = (t or "").encode("utf-8").split(b"\n")
                found += [(i, c, no, normal_line(lines[no]).decode("utf-8")) for no in some]
            return columns_of(found, 4)

        return act

    kind = rows.schema["id"].dataType.simpleString()
    # Rows that repeat have repeated lines.
    return map_slices(joined, f"id {kind}, code long, no int, line string", make).distinct()


def _links(lines: DataFrame) -> DataFrame:
    """For lines (id, code, no, line): near lines that are earlier (as to_id, to_code, to_no)."""
    kind = lines.schema["id"].dataType.simpleString()
    names = ["id", "code", "no"]

    def keys(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                found = [neighbour_keys(t.encode("utf-8").split(b" ")) for t in batch.column(3).to_pylist()]
                if found:
                    rows = pa.array(np.repeat(np.arange(len(found)), [len(k) for k, _ in found]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([k for k, _ in found])),
                            pa.array(np.concatenate([h for _, h in found])),
                            *[batch.column(i).take(rows) for i in range(3)],
                        ],
                        names=["key", "how", *names],
                    )

    keyed = lines.select(*names, "line").mapInArrow(keys, f"key long, how int, id {kind}, code long, no int")
    in_order = keyed.repartition("key").sortWithinPartitions("key", "how", *names)

    def several(batches):
        for batch in filter(len, batches):
            key = batch.column(0).to_numpy()
            new = np.concatenate([[True], key[1:] != key[:-1]])
            last = np.concatenate([new[1:], [True]])
            # Keys at the rim may go on in another batch.
            alone = new & last & (key != key[0]) & (key != key[-1])
            yield batch.filter(pa.array(~alone))

    shared = in_order.mapInArrow(several, keyed.schema)

    def make_links():
        # Rows of a key stand together, and one line of it is all that is kept.
        key, head, alike, longer = None, None, False, False

        def act(keys, hows, ids, codes, nos):
            nonlocal key, head, alike, longer
            rows = []
            for k, how, *here in zip(keys, hows, ids, codes, nos):
                if k != key:
                    key, head, alike, longer = k, here, how != LONGER, False
                elif how == REPLACED:
                    rows.append((*here, *head))
                elif alike and how == LONGER:
                    if _earlier(head, here):
                        rows.append((*here, *head))
                    elif not longer:
                        rows.append((*head, *here))
                    longer = True
            return columns_of(rows, 6)

        return act

    out = f"id {kind}, code long, no int, to_id {kind}, to_code long, to_no int"
    return map_slices(shared, out, make_links).distinct()


def _earlier(a: list, b: list) -> bool:
    """By id, a null first, code and place."""
    if a[0] is None or b[0] is None:
        return (a[0] is not None, *a[1:]) < (b[0] is not None, *b[1:])
    return a < b


def _verified(links: DataFrame, lines: DataFrame) -> DataFrame:
    """Places of lines that are near an earlier one, word by word."""
    names = [*ROW, "no"]
    here = lines.select(*names, "line")
    there = lines.select(*[F.col(c).alias(f"to_{c}") for c in names], F.col("line").alias("to_line"))
    pairs = links.join(here, _same(links, here, names)).select(
        *[links[c] for c in links.columns], "line"
    )
    to = [f"to_{c}" for c in names]
    pairs = pairs.join(there, _same(pairs, there, to)).select(
        *[pairs[c] for c in names], "line", "to_line"
    )
    kind = lines.schema["id"].dataType.simpleString()

    def make():
        def act(ids, codes, nos, ours, theirs):
            rows = [r[:3] for r in zip(ids, codes, nos, ours, theirs) if near(r[3], r[4])]
            return columns_of(rows, 3)

        return act

    return map_slices(pairs, f"id {kind}, code long, no int", make).distinct()


def _dropped(rows: DataFrame) -> DataFrame:
    """Per document with any, the places (from 0) of its lines to drop: id, code, nos."""
    names = [*ROW, "no"]
    lines = settle(_lines(rows), "lines")
    distinct, candidates = _candidates(lines)
    places = settle(candidates.select("first.*"), "candidates")
    texts = settle(_texts(rows, places), "candidate-lines")
    near_places = _verified(_links(texts), texts)
    first = distinct.filter("n > 1").select("mark", "first.*", F.lit(False).alias("near"))
    starts = distinct.select("mark", "first.*")
    late = starts.join(near_places, _same(starts, near_places, names)).select(
        "mark", *[starts[c] for c in names], F.lit(True).alias("near")
    )
    judged = first.unionByName(late).groupBy("mark").agg(
        F.max("near").alias("near"), F.min(F.struct(*names)).alias("first")
    )
    # Written first, so that both sides are shuffled for the join alone, and the adaptive
    # planner may split a line that very many documents hold.
    gone = lines.join(settle(judged, "judged-lines"), "mark").filter(
        F.col("near") | ~F.struct(*names).eqNullSafe(F.col("first"))
    )
    return gone.groupBy(*ROW).agg(F.array_sort(F.collect_set("no")).alias("nos"))


def _judged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of `docs` as a struct `row`, with the text, its lines and those to drop."""
    gone = settle(_dropped(_rows(docs, key, text)), "dropped-lines")
    rows = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("code"),
        F.col(text).alias("text"),
        F.struct(*docs.columns).alias("row"),
    )
    joined = rows.hint("merge").join(gone, _same(rows, gone, ROW), "left")
    parts = F.split("text", "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains("nos", i))
    return joined.select(
        "row",
        F.when(F.col("nos").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("nos"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts without the lines that have an equal or near one earlier, by id (nulls
    first), hash of the text, and place, be that one kept or not.

    Returns `key`, text, n_lines and n_dropped. Lines without a word stay; those of fewer
    than MIN_WORDS words go only if an equal one stands earlier. Null texts stay null,
    with no lines; an empty text has one line. Rows that share id and text count as one
    document: its lines are no repeats of themselves. A text that loses all its lines is
    empty. Other columns of `docs` are not read.
    """
    found = _judged(docs.select(key, text), key, text)
    return found.select(F.col("row")[key].alias(key), F.col("text").alias(text), "n_lines", "n_dropped")


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 10
) -> DataFrame:
    """The rows of `docs`, all their columns, with texts as `line_dedup` leaves them.

    A row that lost lines goes if fewer than `min_words` words are left.
    """
    n_words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    found = _judged(docs, key, text).filter((F.col("n_dropped") == 0) | (n_words >= min_words))
    return found.select(
        *[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    )
