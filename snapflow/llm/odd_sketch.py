"""MinHash near-dedup with odd sketches.

A text's set of five-word shingles is hashed to MinHash values in bands; texts that share
a band's value meet in a place. There their odd sketches are compared: MinHash samples
folded into a bitmap by parity, so that the bits in which two sketches differ tell how
many samples differ, most precisely where few do. Texts that are connected by pairs whose
estimate allows the wanted similarity meet once more, with their sets, which decide.

Texts with equal sets are one node. All pairs that meet are compared within a task, but
written is only whom each is connected with, so a group costs rows as it has members.
Where very many meet, they are dealt into cells; if those leave several components, the
cells are compared with one another.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, hash64, lower_ascii, map_slices
from snapflow.llm.components import components
from snapflow.sources.tables import settle

SHINGLE = 5
SIMILAR = 85
#: A pair of similarity s shares no band with a probability of (1 - s^ROWS)^BANDS, which
#: is 4e-8 at 0.85.
ROWS, BANDS = 6, 36
#: MinHash samples of a sketch, and its bits.
SAMPLES, BITS = 1024, 1024
#: Standard deviations by which an estimate may be too low: one in 3 million pairs.
DEVIATIONS = 5.0
#: Members and shingles of a cell; where more meet, they are dealt into several.
CELL, CELL_SHINGLES = 4096, 1 << 21
#: Rows of small cells, and pairs, that are looked at together.
PIECE, PAIRS = 2048, 1 << 17

_FACTORS = np.random.default_rng(42).integers(0, 1 << 31, ROWS * BANDS + SAMPLES, np.uint32) * 2 + 1


def shingle_set(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles, in order; fewer words than five are one shingle.

    The words' hashes are mixed in the order of the words.
    """
    found = lower_ascii(text).split()
    if not found:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, 42) for w in set(found)}
    marks = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE, len(found))
    mixed = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + marks[i : i + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes(), 42)


def least_values(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """MinHash values: the least of the shingles, times each factor."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 2048):
        np.minimum(least, np.multiply.outer(factors, high[at : at + 2048]).min(axis=1), out=least)
    return least


def band_keys(shingles: np.ndarray) -> list[int]:
    """A key for each band; texts without words have none."""
    if not len(shingles):
        return []
    least = least_values(shingles, _FACTORS[: ROWS * BANDS])
    return [hash64(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]


def sketch(shingles: np.ndarray) -> bytes:
    """MinHash samples by parity: a sample turns the bit that it and its number hash to."""
    x = least_values(shingles, _FACTORS[ROWS * BANDS :])
    x ^= np.arange(SAMPLES, dtype=np.uint32) * np.uint32(0x9E3779B9)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return np.packbits(np.bincount(x % BITS, minlength=BITS) % 2 == 1).tobytes()


def estimate(differing: np.ndarray) -> np.ndarray:
    """The similarity of two sets whose sketches differ in so many bits."""
    share = np.minimum(2 * np.asarray(differing) / BITS, 1 - 1e-9)
    return 1 + BITS / (4 * SAMPLES) * np.log1p(-share)


def most_bits(percent: int) -> int:
    """The bits in which sketches of sets of that similarity differ at most, by DEVIATIONS.

    The samples that differ are binomial; each turns a bit of either sketch, of which
    some fall together.
    """
    share = 1 - percent / 100
    differ = SAMPLES * share
    left = exp(-4 * differ / BITS)
    by_samples = 2 * left * sqrt(differ * (1 - share))
    by_folding = BITS / 4 * (1 - left**2) - 2 * differ * left**2
    return int(BITS / 2 * (1 - left) + DEVIATIONS * sqrt(by_samples**2 + max(0, by_folding))) + 1


class Groups:
    """Rows that are connected, by union-find."""

    def __init__(self, roots: np.ndarray):
        first: dict = {}
        self.up = [first.setdefault(r, i) for i, r in enumerate(roots.tolist())]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)

    def labels(self) -> np.ndarray:
        """The first row of each row's group."""
        return np.fromiter(map(self.find, range(len(self.up))), np.int64, len(self.up))


def close_pairs(
    cells: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, sides: np.ndarray, percent: int, groups: Groups
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell that may be similar and are not connected, in portions;
    what is connected meanwhile is left out.

    Rows of a cell stand together; all are compared, by growing distance. Rows of equal
    sides, but for side -1, are not.
    """
    most, found, held = most_bits(percent), [], 0
    here, gap, labels = np.arange(len(cells)), 0, groups.labels()
    while len(here):
        gap += 1
        here = here[here + gap < len(cells)]
        here = here[cells[here] == cells[here + gap]]
        there = here + gap
        low, high = np.minimum(sizes[here], sizes[there]), np.maximum(sizes[here], sizes[there])
        fits = (100 * low >= percent * high) & ((sides[here] < 0) | (sides[here] != sides[there]))
        fits &= labels[here] != labels[there]
        a, b = here[fits], there[fits]
        near = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int64) <= most
        found.append((a[near], b[near]))
        held += np.count_nonzero(near)
        # Few pairs at first, so that groups are known soon.
        if held >= min(PAIRS, 256 * gap):
            yield tuple(np.concatenate(x) for x in zip(*found))
            found, held, labels = [], 0, groups.labels()
    if held:
        yield tuple(np.concatenate(x) for x in zip(*found))


class Sets:
    """The shingles of rows, numbered, to be compared many times."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        self.ids = np.split(ids, np.cumsum(self.sizes)[:-1])
        self.held = np.zeros(int(ids.max(initial=-1)) + 1, bool)

    def join_similar(self, a: np.ndarray, b: np.ndarray, groups: Groups, percent: int) -> None:
        """Connect the pairs that are similar."""
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        rows, starts = np.unique(a, return_index=True)
        for i, others in zip(rows.tolist(), np.split(b, starts[1:])):
            self.held[self.ids[i]] = True
            for j in others.tolist():
                if groups.find(i) != groups.find(j):
                    both = int(np.count_nonzero(self.held[self.ids[j]]))
                    if 100 * both >= percent * (self.sizes[i] + self.sizes[j] - both):
                        groups.join(i, j)
            self.held[self.ids[i]] = False


def _edges(met: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect, in each cell, what may be similar by its sketches, or
    with `shingles` is similar by its sets; not all are similar pairs themselves, but
    connected by such. Rows of equal `root` are connected already."""
    columns = ["cell", "side", "node", "size", "sketch", "root"]
    exact = "shingles" in met.columns
    chosen = met.select(*columns, *(["shingles"] if exact else []))
    in_order = chosen.repartition("cell").sortWithinPartitions("cell", "node")

    def edges(rows: pa.Table) -> pa.RecordBatch:
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64)
        roots = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        groups, sets = Groups(roots), None
        before = groups.labels()
        portions = close_pairs(
            rows.column("cell").to_numpy(),
            sketches.reshape(-1, BITS // 64),
            rows.column("size").to_numpy(),
            rows.column("side").to_numpy(),
            percent,
            groups,
        )
        for a, b in portions:
            if exact:
                if sets is None:
                    sets = Sets([np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()])
                sets.join_similar(a, b, groups, percent)
            else:
                for i, j in zip(a.tolist(), b.tolist()):
                    groups.join(i, j)
        after = groups.labels()
        moved = np.flatnonzero(after != before)
        nodes = rows.column("node").combine_chunks()
        sides = [nodes.take(pa.array(x)) for x in (after[moved], moved)]
        return pa.RecordBatch.from_arrays(sides, names=["a", "b"])

    def run(batches):
        rest = None
        for batch in filter(len, batches):
            whole = pa.Table.from_batches([batch])
            rest = whole if rest is None else pa.concat_tables([rest, whole]).combine_chunks()
            starts = np.flatnonzero(np.diff(rest.column("cell").to_numpy())) + 1
            done = 0
            for start in starts:
                if start - done >= PIECE or exact:
                    yield edges(rest.slice(done, start - done))
                    done = start
            rest = rest.slice(done)
        if rest is not None and len(rest):
            yield edges(rest)

    found = in_order.mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _connections(met: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect what belongs together in each place of `met` (place,
    node, n, n_shingles): n nodes, of so many shingles in all, meet there."""
    parts = F.greatest(F.ceil(F.col("n") / CELL), F.ceil(F.col("n_shingles") / CELL_SHINGLES))
    held = met.withColumn("parts", parts.cast("long"))
    part = F.pmod(F.xxhash64("node", "place"), F.col("parts"))
    dealt = held.select(
        F.xxhash64("place", part).alias("cell"),
        F.lit(-1).cast("long").alias("side"),
        "node",
        F.col("node").alias("root"),
    )
    edges = settle(_edges(dealt.join(marks, "node"), percent), "edges")
    large = held.filter("parts > 1")
    if large.isEmpty():
        return edges
    roots = settle(components(edges), "roots").withColumnRenamed("node", "in_group")
    rooted = large.join(roots, F.col("node") == F.col("in_group"), "left").select(
        *held.columns, F.coalesce("root", "node").alias("root")
    )
    several = rooted.groupBy("place").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.filter("low < high").select("place")
    left = settle(rooted.join(several, "place", "left_semi"), "open-places")
    if left.isEmpty():
        return edges
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    two = F.xxhash64("place", F.least("side", "other"), F.greatest("side", "other"))
    each = left.withColumn("side", part).withColumn("other", others).filter("side != other")
    each = each.select(two.alias("cell"), "side", "node", "root")
    return edges.unionByName(settle(_edges(each.join(marks, "node"), percent), "edges"))


def _places(distinct: DataFrame) -> DataFrame:
    """The rows (place, node, n) of places that n nodes share, of at least two; few bytes
    of each are read there, so that only their number counts (n_shingles 0)."""
    keyed = distinct.select(F.explode("places").alias("place"), "node")
    counts = keyed.groupBy("place").agg(F.count("*").alias("n")).filter("n > 1")
    return keyed.join(counts, "place").withColumn("n_shingles", F.lit(0).cast("long"))


def _sets(docs: DataFrame, distinct: DataFrame, places: DataFrame) -> DataFrame:
    """Of the nodes in `places`: size, sketch and shingles."""
    nodes = settle(places.select("node").distinct(), "near-nodes")
    wanted = distinct.join(nodes, "node", "left_semi").select(F.col("least").alias("wanted")).distinct()
    # Texts are shuffled whatever the size of the other side, which grows as they do.
    rows = docs.hint("merge").join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")

    def make():
        def act(texts):
            found = [s for s in map(shingle_set, texts) if len(s)]
            rows = [(digest(s), len(s), sketch(s), s.tobytes()) for s in found]
            return columns_of(rows, 4)

        return act

    out = "node binary, size int, sketch binary, shingles binary"
    found = map_slices(rows.select("text"), out, make)
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _links(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect all similar nodes."""
    sketches = sets.select("node", "size", "sketch")
    maybe = settle(components(_connections(places, sketches, percent)), "maybe-similar")
    sized = maybe.join(sets.select("node", "size"), "node")
    counts = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("n_shingles"))
    met = settle(sized.select("node", "root").join(counts, "root"), "groups")
    met = met.withColumnRenamed("root", "place")
    return _connections(met, sets.select("node", "size", "sketch", "shingles"), percent)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILAR
) -> DataFrame:
    """The group of each row: `key`, n_shingles, component_id, kept.

    Two texts are linked if the sets of their five-word shingles (A-Z lower-cased, words
    between white space) have a Jaccard similarity of `percent` or more. Fewer words than
    five are one shingle. component_id is the least key that is reachable over links,
    itself included; null keys are passed over, and where all are null it is null. kept
    says whether the row has that key, as rows that repeat do all.

    Texts without words, also null ones, have no shingles and are linked with nothing:
    their component is their own key. A pair is missed if it shares no band (4e-8 at 0.85
    by calculation, more below) or its sketches mislead (3e-7). Other columns of `docs`
    are not read.
    """
    if not 80 <= percent <= 100:
        raise ValueError("bands and sketches are made for similarities of 80 to 100 percent")

    def make():
        def act(keys, texts):
            found = [shingle_set(t) for t in texts]
            return keys, [digest(s) for s in found], [len(s) for s in found], [band_keys(s) for s in found]

        return act

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    out = f"id {kind}, node binary, size long, places array<long>"
    prints = settle(map_slices(rows, out, make), "signatures")
    distinct = prints.filter("size > 0").groupBy("node", "places").agg(F.min("id").alias("least"))
    distinct = settle(distinct, "distinct-signatures")
    places = settle(_places(distinct), "places")
    links = None
    if not places.isEmpty():
        sets = settle(_sets(rows, distinct, places), "shingle-sets")
        links = _links(places, sets, percent)
    rooted = distinct.select("node", "least", F.col("node").alias("root"))
    if links is not None:
        roots = components(links).withColumnRenamed("node", "in_group").withColumnRenamed("root", "group_root")
        rooted = rooted.join(roots, F.col("node") == F.col("in_group"), "left").select(
            "node", "least", F.coalesce("group_root", "root").alias("root")
        )
    rooted = settle(rooted, "rooted")
    heads = rooted.groupBy("root").agg(F.min("least").alias("head"))
    by_node = settle(rooted.join(heads, "root").select("node", "head"), "heads")
    joined = prints.select("id", "node", "size").join(by_node, "node", "left")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("head"))
    return joined.select(
        F.col("id").alias(key),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
