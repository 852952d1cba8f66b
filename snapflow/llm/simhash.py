"""SimHash near-dedup, with candidates by pigeonring filtering.

A fingerprint is a ring of eight segments. If two differ in at most 4 bits, then from
some segment on every chain of l consecutive segments differs in at most l / 2 bits. So a
chain of seven has at least four equal segments, the first among them: fingerprints meet
under the values of such four. There, chains of growing length prune the candidates
before all bits are compared. Within a meeting place no pairs are written, only the edges
of a spanning forest; components join the places.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, lower_ascii, map_slices, signed
from snapflow.llm.components import components
from snapflow.sources.tables import settle

SHINGLE = 4
BITS, SEGMENTS, WIDTH, DISTANCE = 64, 8, 8, 4
CHAIN = 7
#: Fingerprints that meet in one place and are held together; where more meet, they part
#: once more by half segments, after which a place has at most 2^16.
PLACE = 4096


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64 bits, as an unsigned number; 0 for a text without words."""
    found = lower_ascii(text).split()
    if not found:
        return 0
    h = xxhash.xxh64_intdigest
    shingles = [h(b" ".join(found[i : i + size]), 42) for i in range(max(1, len(found) - size + 1))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), 8192):
        rows = np.array(shingles[at : at + 8192], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def chain_places(segments: int = SEGMENTS, chain: int = CHAIN) -> list[tuple[int, ...]]:
    """The segments that are equal in chains within budget, smallest sets only."""
    found = set()
    for start in range(segments):
        for equal in combinations(range(chain), (chain + 1) // 2):
            if all(2 * sum(i < n for i in equal) >= n for n in range(1, chain + 1)):
                found.add(tuple(sorted((start + i) % segments for i in equal)))
    return sorted(found)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def linked(one: np.uint64, others: np.ndarray) -> np.ndarray:
    """Which of `others` differ from `one` in at most DISTANCE bits."""
    parts = _ONES[(others ^ one).view(np.uint8).reshape(-1, SEGMENTS)].astype(np.int16)
    twice = np.concatenate([parts, parts], axis=1)
    alive = np.ones((len(others), SEGMENTS), bool)
    total = np.zeros((len(others), SEGMENTS), np.int16)
    for length in range(1, CHAIN + 1):
        total += twice[:, length - 1 : length - 1 + SEGMENTS]
        alive &= 2 * total <= length
        if length == 3 and not alive.any():
            return np.zeros(len(others), bool)
    passed = alive.any(axis=1)
    passed[passed] = parts[passed].sum(axis=1) <= DISTANCE
    return passed


def forest(values: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect linked values: each value is reached once, from another."""
    edges, waiting = [], np.unique(values)
    while len(waiting) > 1:
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            one = reached.pop()
            near = linked(one, waiting)
            for other in waiting[near]:
                edges.append((int(one), int(other)))
                reached.append(other)
            waiting = waiting[~near]
    return edges


def _forests(keyed: DataFrame, most: int | None) -> DataFrame:
    """Edges (a, b) in each place of `keyed` (place, fp); from larger places the rows
    (place, fp) themselves are handed on as (a null, b the fingerprint, place)."""
    in_order = keyed.repartition("place").sortWithinPartitions("place")

    def run(batches):
        place, held, over = None, [], False

        def out(rows):
            a, b, p = columns_of(rows, 3)
            kind = pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(a, kind), pa.array(b, kind), pa.array(p, kind)], names=["a", "b", "place"]
            )

        def close():
            if over or len(held) < 2:
                return []
            values = np.array(held, np.int64).view(np.uint64)
            return [(signed(x), signed(y), None) for x, y in forest(values)]

        for batch in filter(len, batches):
            places = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy()
            starts = np.flatnonzero(np.diff(places, prepend=places[:1] - 1))
            ends = np.append(starts[1:], len(places))
            # Of places with one fingerprint only those at the rim may go on elsewhere.
            some = (ends - starts > 1) | (starts == 0) | (ends == len(places))
            rows = []
            for start, end in zip(starts[some], ends[some]):
                if places[start] != place:
                    rows += close()
                    place, held, over = places[start], [], False
                held += prints[start:end].tolist()
                if over or (most is not None and len(held) > most):
                    rows += [(None, fp, int(place)) for fp in held]
                    held, over = [], True
            if rows:
                yield out(rows)
        if rows := close():
            yield out(rows)

    return in_order.mapInArrow(run, "a long, b long, place long")


def fingerprint_edges(prints: DataFrame, place: int = PLACE) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (`fp`) within DISTANCE."""
    sets = chain_places()
    masks = [sum(0xFF << (WIDTH * i) for i in equal) for equal in sets]
    at = F.array(
        *[F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed(m))), F.lit(k)) for k, m in enumerate(masks)]
    )
    keyed = prints.select(F.explode(at).alias("place"), "fp")
    found = settle(_forests(keyed, place), "forests")
    edges = found.filter("a is not null").select("a", "b")
    crowded = found.filter("a is null").select(F.col("b").alias("fp"), "place")
    if crowded.isEmpty():
        return edges
    # In a place four segments are equal, and so are four of the eight halves of the rest.
    halves = [
        [
            signed(sum(0xF << (4 * i) for i in some))
            for some in combinations([i for i in range(16) if i // 2 not in equal], 4)
        ]
        for equal in sets
    ]
    choices = F.array(*[F.array(*map(F.lit, row)) for row in halves])
    mask = F.explode(F.element_at(choices, F.array_position(at, F.col("place")).cast("int")))
    finer = crowded.select("fp", "place", mask.alias("mask")).select(
        F.xxhash64("place", F.col("fp").bitwiseAND(F.col("mask")), "mask").alias("place"), "fp"
    )
    return edges.unionByName(_forests(finer, None).select("a", "b"))


def _judged(rows: DataFrame) -> DataFrame:
    """Of rows (id, mark, text): id, mark, fp, component_id and root."""

    def make():
        return lambda keys, marks, texts: (keys, marks, [signed(fingerprint(t)) for t in texts])

    kind = rows.schema["id"].dataType.simpleString()
    prints = settle(map_slices(rows, f"id {kind}, mark long, fp long", make), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    roots = components(fingerprint_edges(distinct.select("fp")))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = joined.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.select("fp", "root").join(least, "root")
    return prints.join(by_print, "fp").select("id", "mark", "fp", "component_id", "root")


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of each row: `key`, fingerprint (16 hex digits),
    component_id, and root (of the component, as a fingerprint).

    component_id is the least id that is reachable over links, itself included; null ids
    are passed over, and where all are null it is null. Texts without words, also null
    ones, have the fingerprint 0 and are linked like any other. Rows that repeat each
    have a result. Other columns of `docs` are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.lit(0).cast("long").alias("mark"), F.col(text).alias("text"))
    return _judged(rows).select(
        F.col("id").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.lpad(F.lower(F.hex("root")), 16, "0").alias("root"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each component.

    It is a row of the least id; nulls come last, and of several rows that share the id
    the one whose columns have the least hash. Rows go by id and hash, so that one that
    shares an id alone is never taken for another; of rows that are wholly equal one
    stays. All columns, whatever their names, are those of `docs`.
    """
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(F.lit("row"), *hashed).alias("mark"),
        F.col(text).alias("text"),
        F.struct(*docs.columns).alias("row"),
    )
    judged = settle(_judged(rows.drop("row")), "components")
    counted = judged.groupBy("root", "id", "mark").agg(F.count("*").alias("n"))
    order = F.struct(F.isnull("id").alias("unnamed"), "id", "mark", "n")
    heads = counted.groupBy("root").agg(F.min(order).alias("head"))
    heads = settle(heads.select(F.col("head.id").alias("head_id"), "head.mark", "head.n", "root"), "heads")
    same = rows["id"].eqNullSafe(heads["head_id"]) & (rows["mark"] == heads["mark"])
    kept = rows.join(heads, same).select("row", "n", "root")
    if not heads.filter("n > 1").isEmpty():
        once = kept.filter("n > 1").dropDuplicates(["root"])
        kept = kept.filter("n = 1").unionByName(once)
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
