"""Hard negatives by slot-decomposed selection.

An anchor's positives are the rows of its label with the highest scores. Each has a window
of scores for its negatives, whose upper limit is a share of its own score. The windows of
an anchor overlap; their upper limits split the scores into disjoint slots. Of each slot
only the first k rows are kept, in every task and again where tasks meet. The first k at or
below a positive's limit are then found by merging its slot and those below, and those
under the window's lower limit fall off the end.

Rows are packed into chunks, and anchors into blocks of a bounded size. Every chunk meets
every block, in cells that are spread over the tasks; a cell is one product of matrices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.sources.tables import settle

#: The most rows of a chunk and anchors of a block, and the most numbers in either.
CHUNK_ROWS, BLOCK_ROWS, CHUNK_NUMBERS = 4096, 1024, 1 << 20
#: Blocks of which a task holds what it has found so far.
HELD_BLOCKS = 8
#: Products of whole numbers up to here are exact as floating-point numbers.
EXACT = 2.0**53
LONGEST = (1 << 63) - 1

PACKED = "part long, ids binary, labels binary, kind string, width int, numbers binary, limits binary"


def packed(ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray) -> tuple:
    """A chunk: its numbers in the smallest type that holds them."""
    most = np.abs(numbers).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return (
        ids.astype("<i8").tobytes(),
        labels.astype("<i8").tobytes(),
        kind,
        numbers.shape[1],
        numbers.astype(kind).tobytes(),
    )


def unpacked(row: dict, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = np.frombuffer(row[side + "numbers"], row[side + "kind"]).astype(np.float64)
    ids = np.frombuffer(row[side + "ids"], "<i8")
    labels = np.frombuffer(row[side + "labels"], "<i8")
    return ids, labels, numbers.reshape(len(ids), row[side + "width"])


def _whole_rows(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a vector of finite numbers; sizes; all numbers, scaled and floored."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        flat = np.floor(flat * scale)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(sizes)
    fine = bad[ends] == bad[ends - sizes]
    return fine & vectors.is_valid().to_numpy(zero_copy_only=False), sizes, flat


def _cuts(sizes: np.ndarray, most_rows: int) -> list[np.ndarray]:
    """Rows, shortest vectors first, in groups that fill up to a chunk."""
    order = np.argsort(sizes, kind="stable")
    groups, start = [], 0
    while start < len(order):
        # A row more makes the chunk longer and, at most, as wide as that row.
        n = np.arange(1, min(most_rows, len(order) - start) + 1)
        fit = n * np.maximum(sizes[order[start : start + len(n)]], 1) <= CHUNK_NUMBERS
        end = start + max(1, int(np.count_nonzero(fit)))
        groups.append(order[start:end])
        start = end
    return groups


def _distinct(ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray) -> list[int] | slice:
    """Which rows of a chunk stay when rows that repeat count once."""
    if len(np.unique(ids)) == len(ids):
        return slice(None)
    seen: dict[tuple, int] = {}
    for i in range(len(ids)):
        seen.setdefault((ids[i], labels[i], numbers[i].tobytes()), i)
    return list(seen.values())


def pack(rows: DataFrame, most_rows: int, scale: float) -> DataFrame:
    """Chunks of `rows` (id, label, vector, limits), numbered by task (part).

    Rows whose vector is null or holds a null or a number that is not finite are left out.
    """

    def chunk(held: list[pa.RecordBatch], part: int) -> list[tuple]:
        table = pa.Table.from_batches(held).combine_chunks()
        vectors = table.column("vector").chunk(0)
        fine, sizes, flat = _whole_rows(vectors, scale)
        ids = table.column("id").to_numpy()
        labels = table.column("label").to_numpy()
        limits = table.column("limits").chunk(0)
        starts = np.cumsum(sizes) - sizes
        chosen, out = np.flatnonzero(fine), []
        for group in _cuts(sizes[chosen], most_rows):
            some = chosen[group]
            own = sizes[some]
            numbers = np.zeros((len(some), int(own.max(initial=0))))
            at = np.repeat(np.arange(len(some)), own)
            column = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            numbers[at, column] = flat[np.repeat(starts[some], own) + column]
            keep = _distinct(ids[some], labels[some], numbers)
            some, numbers = some[keep], numbers[keep]
            wanted = limits.take(pa.array(some)).flatten().to_numpy().astype("<i8").tobytes()
            out.append((part, *packed(ids[some], labels[some], numbers), wanted or None))
        return out

    def run(batches):
        part, held, n, size = TaskContext.get().partitionId(), [], 0, 0
        for whole in filter(len, batches):
            for at in range(0, whole.num_rows, most_rows):
                batch = whole.slice(at, most_rows)
                held.append(batch)
                n += batch.num_rows
                size += len(batch.column("vector").flatten())
                if n >= most_rows or size >= CHUNK_NUMBERS:
                    yield _batch(chunk(held, part))
                    held, n, size = [], 0, 0
        if held:
            yield _batch(chunk(held, part))

    return rows.mapInArrow(run, PACKED)


_ARROW = pa.schema(
    [("part", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()),
     ("width", pa.int32()), ("numbers", pa.binary()), ("limits", pa.binary())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
    )


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; vectors of unlike length are filled up with zeros.

    Large numbers, whose sums a floating-point number may not hold, are multiplied as
    Python's whole numbers. What no long holds becomes the largest one of its sign.
    """
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    most = np.sqrt(EXACT / max(1, width))
    large = np.abs(rows).max(axis=1, initial=0) > most
    large_too = np.abs(anchors).max(axis=1, initial=0) > most
    with np.errstate(over="ignore", invalid="ignore"):
        found = rows @ anchors.T
    found[large] = 0
    found[:, large_too] = 0
    found = found.astype(np.int64)
    theirs = [[int(x) for x in a] for a in anchors] if large.any() or large_too.any() else []
    for i in np.flatnonzero(large | large_too.any()):
        own = [int(x) for x in rows[i]]
        for j in range(len(theirs)) if large[i] else np.flatnonzero(large_too):
            exact = sum(x * y for x, y in zip(own, theirs[j]))
            found[i, j] = max(-LONGEST, min(LONGEST, exact))
    return found


class Best:
    """The first `k` distinct (score, id) of each of a block's bins, highest scores first."""

    def __init__(self, bins: int, k: int):
        self.k = k
        self.bin = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        #: The score from which on a row may yet count.
        self.least = np.full(bins, -LONGEST - 1, np.int64)

    def take(self, bins: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        new = scores >= self.least[bins]
        bins = np.concatenate([self.bin, bins[new]])
        scores = np.concatenate([self.score, scores[new]])
        ids = np.concatenate([self.id, ids[new]])
        # -1 - score turns the order about for every long.
        order = np.lexsort((ids, -1 - scores, bins))
        bins, scores, ids = bins[order], scores[order], ids[order]
        same = np.zeros(len(bins), bool)
        same[1:] = (bins[1:] == bins[:-1]) & (scores[1:] == scores[:-1]) & (ids[1:] == ids[:-1])
        bins, scores, ids = bins[~same], scores[~same], ids[~same]
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        rank = np.arange(len(bins)) - np.repeat(first, np.diff(np.append(first, len(bins))))
        kept = rank < self.k
        self.bin, self.score, self.id = bins[kept], scores[kept], ids[kept]
        last = rank == self.k - 1
        self.least[bins[last]] = scores[last]


def _positive_rows(best: Best, scores, ids, labels, anchors, own, _):
    fits = (labels[:, None] == own[None, :]) & (ids[:, None] != anchors[None, :])
    if len(ids) > best.k:
        # Rows below the k-th of the chunk need not be sorted.
        fitting = np.where(fits, scores, -LONGEST - 1)
        kth = np.partition(fitting, len(ids) - best.k, axis=0)[len(ids) - best.k]
        fits &= scores >= np.maximum(kth, best.least)[None, :]
    row, at = np.nonzero(fits)
    best.take(at, scores[row, at], ids[row])


def _negative_rows(best: Best, scores, ids, labels, anchors, own, limits):
    """`limits` has, per anchor, the least score that is wanted, and falling upper limits."""
    lowest, uppers = limits[:, 0], limits[:, 1:]
    fits = (scores >= lowest[None, :]) & (scores <= uppers[:, 0][None, :])
    fits &= (labels[:, None] != own[None, :]) & (ids[:, None] != anchors[None, :])
    row, at = np.nonzero(fits)
    found = scores[row, at]
    slot = np.count_nonzero(uppers[at] >= found[:, None], axis=1) - 1
    best.take(at * uppers.shape[1] + slot, found, ids[row])


def up_to(n: int) -> Column:
    """The numbers from 0 to n - 1."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _cells(chunks: DataFrame, blocks: DataFrame, take, k: int, slots: int) -> DataFrame:
    """The best rows that each task has found: anchor_id, slot, score, id.

    Each chunk goes to every block, at one of several seats of that block, so that few
    blocks are spread over many tasks as well.
    """
    spark = chunks.sparkSession
    n_blocks = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    seats = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // n_blocks))
    sent = chunks.select(
        *[c for c in chunks.columns if c not in ("part", "limits")],
        F.pmod(F.xxhash64("part", "ids"), F.lit(seats)).alias("seat"),
        F.explode(up_to(n_blocks)).alias("block"),
    )
    asked = blocks.select(
        F.col("part").alias("block"),
        F.explode(up_to(seats)).alias("seat"),
        *[F.col(c).alias(f"a_{c}") for c in blocks.columns if c != "part"],
    )
    met = sent.join(asked.hint("merge"), ["block", "seat"])

    def run(batches):
        # By the block's anchors; the oldest goes out when there are too many.
        held: dict[bytes, tuple[np.ndarray, Best]] = {}

        def out(anchors: np.ndarray, best: Best) -> pa.RecordBatch:
            columns = [anchors[best.bin // slots], best.bin % slots, best.score, best.id]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "slot", "score", "id"]
            )

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                anchors, own, theirs = unpacked(row, "a_")
                if row["a_ids"] not in held:
                    if len(held) == HELD_BLOCKS:
                        yield out(*held.pop(next(iter(held))))
                    held[row["a_ids"]] = (anchors, Best(len(anchors) * slots, k))
                ids, labels, numbers = unpacked(row)
                limits = np.frombuffer(row["a_limits"] or b"", "<i8").reshape(len(anchors), -1)
                best = held[row["a_ids"]][1]
                take(best, products(numbers, theirs), ids, labels, anchors, own, limits)
        for anchors, best in held.values():
            yield out(anchors, best)

    found = met.mapInArrow(run, "anchor_id long, slot long, score long, id long")
    # A bin has at most k rows from each task that its block has a seat in.
    entry = F.struct((-1 - F.col("score")).alias("order"), "id", "score")
    return found.groupBy("anchor_id", "slot").agg(
        F.slice(F.array_sort(F.collect_set(entry)), 1, k).alias("best")
    )


def share(score: Column, percent: int, up: bool) -> Column:
    """A share of a score of 0 or more, as a whole number, rounded up or down.

    Hundreds and the rest are taken apart, so that no product is too large for a long.
    """
    rest = score % 100
    part = rest * percent + (99 if up else 0)
    return F.call_function("div", score - rest, F.lit(100)) * percent + F.call_function(
        "div", part, F.lit(100)
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 1.0,
) -> DataFrame:
    """Per anchor and positive, the hardest negatives: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    Scores are inner products of the components times `scale`, rounded down; ties go to
    the smaller id. An anchor's positives are its first other rows of the same label; a
    positive's negatives, ranked from 1, are the first rows of other labels that score
    between `low_percent` and `high_percent` of its score. A positive of a score below 0
    has no such rows.

    Rows whose key, label or vector is null, or that hold a component that is null or not
    finite, take no part. Empty vectors score 0, and of two vectors the shorter one is
    filled up with zeros. Rows that repeat count once; rows of the anchor's own id are
    neither its positives nor its negatives; of several anchors of one id the one of the
    least label, then vector, asks. Scores beyond a long count as the largest long. Other
    columns of `rows` are not read.
    """
    given = rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.lit(None).cast("array<long>").alias("limits"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).filter("id is not null and label is not null and vector is not null")
    chunks = settle(pack(given.drop("asks"), CHUNK_ROWS, scale), "chunks")
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    asking = given.filter(F.col("asks") & whole).groupBy("id")
    asking = asking.agg(F.min(F.struct("label", "vector", "limits")).alias("a")).select("id", "a.*")
    asking = settle(asking, "anchors")
    n_blocks = max(1, -(-asking.count() // BLOCK_ROWS))

    def blocks(anchors: DataFrame) -> DataFrame:
        return settle(pack(anchors.repartition(n_blocks, "id"), BLOCK_ROWS, scale), "anchor-blocks")

    near = _cells(chunks, blocks(asking), _positive_rows, positives, 1)
    near = settle(near.select("anchor_id", F.col("best").alias("positives")), "positives")
    above = F.filter("positives", lambda x: x["score"] >= 0)
    uppers = F.transform(above, lambda x: share(x["score"], high_percent, False))
    lowest = share(F.element_at(above, -1)["score"], low_percent, True)
    # Upper limits fall; where there are fewer, the last is repeated.
    limits = F.concat(
        F.array(lowest),
        uppers,
        F.array_repeat(F.element_at(uppers, -1), F.lit(positives) - F.size(uppers)),
    )
    limited = near.filter(F.size(above) > 0).select(F.col("anchor_id").alias("id"), limits.alias("limits"))
    asking = asking.drop("limits").join(limited, "id").select("id", "label", "vector", "limits")
    far = _cells(chunks, blocks(asking), _negative_rows, negatives, positives)
    by_anchor = far.groupBy("anchor_id").agg(F.collect_list(F.struct("slot", "best")).alias("slots"))

    pairs = near.select("anchor_id", F.posexplode("positives").alias("place", "positive"))
    pairs = pairs.filter("positive.score >= 0").join(by_anchor, "anchor_id")
    below = F.filter("slots", lambda x: x["slot"] >= F.col("place"))
    merged = F.array_sort(F.flatten(F.transform(below, lambda x: x["best"])))
    low = share(F.col("positive.score"), low_percent, True)
    chosen = F.filter(F.slice(merged, 1, negatives), lambda x: x["score"] >= low)
    return pairs.select("anchor_id", "positive", F.posexplode(chosen).alias("rank", "negative")).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("negative.id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("negative.score").alias("negative_score"),
    )
