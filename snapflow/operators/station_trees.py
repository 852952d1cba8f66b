"""Boosted trees of every station, grown together.

The trees of all stations and of all fits (hold-out and refit, or the trials and folds of
a search) grow at the same time. Values are cut into bins once per fit and station, and
residuals are whole numbers of UNIT, so that sums are exact and in no order.

A station of at most `local_rows` rows, a bounded group, has its trees grown in one place
from those rows, together with those of other stations; one job does so for all such
stations. Larger stations grow from sums
keyed by fit, station, node, feature and bin, which are combined before the shuffle, so
that a station may hold any share of the rows: a step splits the open nodes of every
station by one level, and a station whose tree is complete begins its next tree in the
same step. Both ways choose the same splits, to the last bit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from snapflow.operators.metrics import regression_metrics
from snapflow.sources.tables import remove_folder, settle, shared_folder

# The tuned parameters.
TREES = 140
MAX_DEPTH = 34
MIN_LEAF = 14
RATE = 0.1

#: Values are learned to a millionth or so.
UNIT = 2.0**-20
#: Bins of a feature; a station with no more distinct values has one for each.
BINS = 64
#: Depths that the numbers of nodes have room for.
DEEPEST = 60
#: Rows of a station up to which its trees grow in one place.
LOCAL_ROWS = 20_000
#: Rows, of one station or many, whose trees grow together, and so those of a task.
TOGETHER_ROWS = 1 << 14
#: Rows times trees that are predicted at a time.
TOGETHER_CELLS = 1 << 20
#: Rows that are predicted together.
SEAT_ROWS = 1 << 18

NODE = "fit int, tree int, node bigint, feature int, bin int, gain double, "
NODE += "n bigint, left_n bigint, left_step bigint, right_step bigint"
NODE_NAMES = [part.split()[0] for part in NODE.split(", ")]


@dataclass(frozen=True)
class Trees:
    """Parameters of one fit. A depth of 1 is a single split."""

    fit: int = 0
    trees: int = TREES
    max_depth: int = MAX_DEPTH
    min_leaf: int = MIN_LEAF
    rate: float = RATE


@dataclass
class StationTrees:
    """What was learned, as tables.

    `base` has a row per fit and station: the rows learned from, and the mean that its
    trees start from. `nodes` has a row per node that was split: rows at or below `cut` go
    to node 2n, the others to 2n + 1, and change by the side's step if that is a leaf.
    Starts and steps are in UNIT.
    """

    base: DataFrame
    nodes: DataFrame
    xs: list[str]
    key: str

    def of(self, fit: int) -> StationTrees:
        """The models of one fit."""
        keep = F.col("fit") == fit
        return StationTrees(self.base.filter(keep), self.nodes.filter(keep), self.xs, self.key)

    def save(self, folder: str) -> str:
        """Write the models to a folder that all executors share; its path."""
        spark = self.base.sparkSession
        self.base.write.mode("overwrite").parquet(f"{folder}/base")
        self.nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
        facts = spark.createDataFrame([(self.xs, self.key)], "xs array<string>, key string")
        facts.write.mode("overwrite").parquet(f"{folder}/facts")
        return folder


def load_station_trees(spark: SparkSession, folder: str) -> StationTrees:
    """Models that `save` has written, in this job or another."""
    facts = spark.read.parquet(f"{folder}/facts").first()
    base, nodes = (spark.read.parquet(f"{folder}/{name}") for name in ("base", "nodes"))
    return StationTrees(base, nodes, list(facts["xs"]), facts["key"])


def fit_station_trees(
    rows: DataFrame,
    xs: list[str],
    parameters: list[Trees],
    y: str = "label",
    key: str = "station_id",
    bins: int = BINS,
    local_rows: int = LOCAL_ROWS,
) -> StationTrees:
    """Boosted trees per station (`key`) and `fit` of `rows`.

    `rows` has the column fit, of which `parameters` has one line each; rows of other fits
    are left out, and so are those without the key, a feature or `y`. A node is split
    where the squared residuals fall most; of equal splits the lower feature and cut wins.
    """
    if any(not 0 < p.max_depth <= DEEPEST for p in parameters):
        raise ValueError(f"depths are from 1 to {DEEPEST}")
    if not 1 < bins <= 1 << 15:
        raise ValueError("there are from 2 to 32768 bins")
    spark = rows.sparkSession
    given = settle(_given(rows, xs, y, key, parameters), "tree-rows")
    base = settle(_base(given, len(xs), bins), "tree-base")
    ready = settle(_binned(given, base), "tree-bins")
    found = _grown_locally(ready.filter(F.col("row_count") <= local_rows), parameters, bins)
    large = ready.filter(F.col("row_count") > local_rows)
    if not base.filter(F.col("row_count") > local_rows).isEmpty():
        found = found.unionByName(_grown_by_sums(spark, large, parameters))
    cut = F.get(F.get("cuts", F.col("feature")), F.col("bin"))
    # A station's cuts take little room in a file and much in memory: never a broadcast.
    nodes = found.join(base.drop("row_count").hint("merge"), ["fit", "key"]).select(
        *["fit", F.col("key").alias(key), "tree", "node", "feature", cut.alias("cut"), "gain"],
        *["n", "left_n", "left_step", "right_step"],
    )
    known = base.select("fit", F.col("key").alias(key), "row_count", "start")
    return StationTrees(known, settle(nodes, "nodes"), list(xs), key)


def _values(xs: list[str]) -> Column:
    return F.array(*[F.col(x).cast("double") for x in xs])


def _whole(values: str) -> Column:
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x))


def _given(rows: DataFrame, xs: list[str], y: str, key: str, parameters: list[Trees]) -> DataFrame:
    named = rows.select(
        F.col("fit").cast("int").alias("fit"),
        F.col(key).alias("key"),
        F.floor(F.col(y).cast("double") / UNIT + 0.5).cast("bigint").alias("y"),
        _values(xs).alias("v"),
    )
    known = F.col("fit").isin([p.fit for p in parameters])
    return named.filter(known & F.col("key").isNotNull() & F.col("y").isNotNull() & _whole("v"))


def _base(given: DataFrame, width: int, bins: int) -> DataFrame:
    """Per fit and station the mean to start from, and each feature's cuts.

    A row's bin is the number of cuts below its value. Cuts are values that occur, from
    sketches of bounded size that are combined before the shuffle.
    """
    shares = [i / bins for i in range(1, bins)]
    cuts = [
        F.array_sort(F.array_distinct(F.percentile_approx(F.get("v", F.lit(i)), shares, 10000)))
        for i in range(width)
    ]
    return given.groupBy("fit", "key").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.floor(F.avg("y") + 0.5).cast("bigint").alias("start"),
        F.array(*cuts).alias("cuts"),
    )


def _binned(given: DataFrame, base: DataFrame) -> DataFrame:
    """Rows with their bins (x) and what is left of y when the mean is taken off."""
    bins = F.expr("transform(cuts, (c, i) -> cast(size(filter(c, e -> e < v[i])) as smallint))")
    rest = (F.col("y") - F.col("start")).alias("rest")
    joined = given.join(base.hint("merge"), ["fit", "key"])
    return joined.select("fit", "key", "row_count", bins.alias("x"), rest)


# Stations of bounded size


def best_splits(
    x: np.ndarray, rest: np.ndarray, at: np.ndarray, nodes: int, bins: int, min_leaf: np.ndarray
) -> tuple[np.ndarray, ...]:
    """The best split of each of `nodes` nodes, of which `at` names each row's.

    Returns feature, bin and gain (0 where there is none), and the rows and sums of the
    node and of the left side. Rows are sorted by node, feature and bin, so that the work
    goes with the rows, however many nodes and bins there are.
    """
    width, count = x.shape[1], len(rest)
    low = max(1, int(count - 1).bit_length())
    cells = (at[:, None] * width + np.arange(width)) * bins + x
    cells = np.sort(((cells << low) | np.arange(count)[:, None]).ravel())
    rows, cells = cells & ((1 << low) - 1), cells >> low
    # In whole numbers, in no order.
    so_far = np.cumsum(rest[rows])
    n = np.bincount(at, minlength=nodes)
    # Each node has its rows once per feature, feature by feature.
    first = np.concatenate([[0], np.cumsum(n * width)[:-1]])
    s = so_far[first + n - 1] - np.where(first > 0, so_far[first - 1], 0)
    last = np.flatnonzero(np.append(cells[1:] != cells[:-1], True))
    cell = cells[last]
    node = cell // (bins * width)
    start = first[node] + cell // bins % width * n[node]
    left_n = last + 1 - start
    fits = (left_n >= min_leaf[node]) & (n[node] - left_n >= min_leaf[node])
    last, cell, node, start, left_n = (z[fits] for z in (last, cell, node, start, left_n))
    left_s = so_far[last] - np.where(start > 0, so_far[start - 1], 0)
    all_n = n[node].astype(float)
    apart = left_s.astype(float) * all_n - s[node].astype(float) * left_n
    gain = apart * apart / (all_n * left_n * (n[node] - left_n))
    best = np.zeros((5, nodes), np.int64)
    most = np.zeros(nodes)
    if len(node):
        begins = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        most[node[begins]] = np.maximum.reduceat(gain, begins)
        # Of equal ones the first, which has the lower feature and bin.
        top = np.flatnonzero(gain == most[node])
        top = top[np.append(True, node[top][1:] != node[top][:-1])]
        chosen = (cell[top] // bins % width, cell[top] % bins, left_n[top], left_s[top])
        for i, z in enumerate(chosen):
            best[i, node[top]] = z
    return best[0], best[1], most, n, s, best[2], best[3]


def boosted(
    x: np.ndarray, rest: np.ndarray, of: np.ndarray, tuned: list[Trees], bins: int
) -> list[np.ndarray]:
    """All trees of some stations, `of` naming each row's and `tuned` having a line for
    each, tree by tree and level by level: arrays of the station and then of the columns
    of NODE, less fit."""
    found, rest = [], rest.copy()
    trees, max_depth, min_leaf = (
        np.array([getattr(p, c) for p in tuned], np.int64) for c in ("trees", "max_depth", "min_leaf")
    )
    rate = np.array([p.rate for p in tuned])
    alive, tree = np.arange(len(rest)), 0
    while len(alive := alive[trees[of[alive]] > tree]):
        node = np.ones(len(x), np.int64)
        step = np.zeros(len(x), np.int64)
        rows, depth = alive, 0
        # Rows of a node have one number, `at`; `station` and `name` are of that number.
        station, at = np.unique(of[rows], return_inverse=True)
        name = np.ones(len(station), np.int64)
        while len(rows):
            feature, cut, gain, n, s, left_n, left_s = best_splits(
                x[rows], rest[rows], at, len(name), bins, min_leaf[station]
            )
            split = gain > 0
            right_n, right_s = n - left_n, s - left_s
            with np.errstate(divide="ignore", invalid="ignore"):
                left_step, right_step = (
                    np.floor(np.where(split, rate[station] * side_s / side_n, 0) + 0.5).astype(np.int64)
                    for side_s, side_n in ((left_s, left_n), (right_s, right_n))
                )
            each = [station, np.full(len(name), tree), name, feature, cut, gain, n, left_n, left_step, right_step]
            found.append([z[split] for z in each])
            rows, at = rows[split[at]], at[split[at]]
            left = x[rows, feature[at]] <= cut[at]
            node[rows] = 2 * node[rows] + ~left
            step[rows] = np.where(left, left_step[at], right_step[at])
            depth += 1
            more = np.where(left, left_n[at], right_n[at]) >= 2 * min_leaf[station[at]]
            more &= max_depth[station[at]] > depth
            rows, at, left = rows[more], at[more], left[more]
            sides, at_side = np.unique(2 * at + ~left, return_inverse=True)
            station, name, at = station[sides >> 1], 2 * name[sides >> 1] + (sides & 1), at_side
        rest -= step
        # A station whose root is not split has all its trees.
        alive = alive[node[alive] > 1]
        tree += 1
    return [np.concatenate(z) for z in zip(*found)] if found else []


def _grown_locally(ready: DataFrame, parameters: list[Trees], bins: int) -> DataFrame:
    """The nodes of stations, the rows of each of which fit into one task; there the trees
    of many stations grow at a time."""
    kind = ready.schema["key"].dataType.simpleString()
    tuned = {p.fit: p for p in parameters}
    # As many tasks as the work needs: its rows are few bytes, but are gone over for each tree.
    count = ready.count()
    tasks = max(ready.sparkSession.sparkContext.defaultParallelism, -(-count // TOGETHER_ROWS))
    in_order = ready.select("fit", "key", "x", "rest").repartition(tasks, "fit", "key")
    in_order = in_order.sortWithinPartitions("fit", "key")

    def grown(held, fits, keys):
        table = pa.Table.from_batches([batch for batch, _ in held])
        of = np.concatenate([numbers for _, numbers in held])
        x = np.concatenate([c.flatten().to_numpy() for c in table.column("x").chunks])
        rest = table.column("rest").to_numpy()
        nodes = boosted(x.reshape(len(rest), -1).astype(np.int64), rest, of, [tuned[f] for f in fits], bins)
        if not nodes:
            return
        station, *columns = nodes
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), *[pa.int64()] * 4]
        arrays = [pa.array(np.array(fits)[station], pa.int32())]
        arrays += [pa.array(c, pa.int64() if c.dtype == np.int64 else t).cast(t) for c, t in zip(columns, kinds)]
        arrays.append(pa.array(keys, table.schema.field("key").type).take(pa.array(station)))
        yield pa.RecordBatch.from_arrays(arrays, names=[*NODE_NAMES, "key"])

    def run(batches):
        # Batches and the number of each row's station; the fits and keys of those stations.
        held, fits, keys, size = [], [], [], 0
        for batch in filter(len, batches):
            start, numbers = 0, []
            for i, here in enumerate(zip(batch.column("fit").to_pylist(), batch.column("key").to_pylist())):
                if not fits or here != (fits[-1], keys[-1]):
                    if size + i - start >= TOGETHER_ROWS:
                        if i > start:
                            held.append((batch.slice(start, i - start), numbers))
                        yield from grown(held, fits, keys)
                        held, fits, keys, size, start, numbers = [], [], [], 0, i, []
                    fits.append(here[0])
                    keys.append(here[1])
                numbers.append(len(fits) - 1)
            held.append((batch.slice(start), numbers))
            size += len(numbers)
        if held:
            yield from grown(held, fits, keys)

    return in_order.mapInArrow(run, f"{NODE}, key {kind}")


# Stations of any size


def _grown_by_sums(spark: SparkSession, ready: DataFrame, parameters: list[Trees]) -> DataFrame:
    """The nodes of stations, level by level."""
    folder = shared_folder(spark, "station-trees")
    state, step = ready.selectExpr(
        *["fit", "key", "x", "rest", "0 as tree", "1L as node", "0L as step", "true as open"]
    ), 0
    while True:
        seen = Observation()
        splits = _splits(state, parameters)
        splits.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/nodes/level={step}")
        if seen.get["n"] == 0:
            break
        made = spark.read.schema(splits.schema).parquet(f"{folder}/nodes/level={step}")
        step += 1
        moved = _advanced(state, made)
        moved.write.parquet(f"{folder}/state/{step}")
        state = spark.read.schema(moved.schema).parquet(f"{folder}/state/{step}")
        if step > 1:
            remove_folder(spark, f"{folder}/state/{step - 1}")
    found = spark.read.schema(splits.schema).parquet(f"{folder}/nodes")
    return found.filter("feature IS NOT NULL").select(*NODE_NAMES, "key")


def _by_fit(parameters: list[Trees], name: str) -> Column:
    """A parameter of a row's fit."""
    values = {getattr(p, name) for p in parameters}
    if len(values) == 1:
        return F.lit(values.pop())
    pairs = [F.lit(x) for p in parameters for x in (p.fit, getattr(p, name))]
    return F.element_at(F.create_map(*pairs), F.col("fit"))


def _splits(state: DataFrame, parameters: list[Trees]) -> DataFrame:
    """A row per open node, with its best split; feature is null where there is none."""
    node = ["fit", "key", "tree", "node"]
    cells = state.filter("open").selectExpr(*node, "rest", "posexplode(x) as (feature, bin)")
    sums = cells.groupBy(*node, "feature", "bin").agg(
        F.count(F.lit(1)).alias("cell_n"), F.sum("rest").alias("cell_s")
    )
    # A node has at most a row per feature and bin; what follows needs them together.
    sums = sums.repartition(*node)
    feature = Window.partitionBy(*node, "feature")
    so_far = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    apart = "(cast(left_s as double) * n - cast(s as double) * left_n)"
    tuned = {c: _by_fit(parameters, c) for c in ("trees", "max_depth", "min_leaf", "rate")}
    sides = (
        sums.withColumns(
            {
                "n": F.sum("cell_n").over(feature),
                "s": F.sum("cell_s").over(feature),
                "left_n": F.sum("cell_n").over(so_far),
                "left_s": F.sum("cell_s").over(so_far),
            }
        )
        .withColumns(tuned)
        .withColumn("fits", F.expr("tree < trees and left_n >= min_leaf and n - left_n >= min_leaf"))
        .withColumn(
            "gain",
            F.expr(f"case when fits then {apart} * {apart} / (cast(n as double) * left_n * (n - left_n)) end"),
        )
    )
    order = "struct(gain, -feature as f, -bin as b, left_n, left_s)"
    best = sides.groupBy(*node, *tuned).agg(
        F.max("n").alias("n"),
        F.max("s").alias("s"),
        F.max(F.expr(f"case when gain > 0 then {order} end")).alias("best"),
    )
    opens = "best is not null and {n} >= 2 * min_leaf and length(bin(node)) < max_depth"
    step = "cast(floor(rate * {s} / {n} + 0.5) as bigint)"
    return best.selectExpr(
        *node,
        "-best.f as feature",
        "cast(-best.b as int) as bin",
        "best.gain as gain",
        "n",
        "best.left_n as left_n",
        step.format(s="best.left_s", n="best.left_n") + " as left_step",
        step.format(s="(s - best.left_s)", n="(n - best.left_n)") + " as right_step",
        opens.format(n="best.left_n") + " as left_open",
        opens.format(n="(n - best.left_n)") + " as right_open",
        "tree + 1 >= trees or (node = 1 and best is null) as over",
    )


def _advanced(state: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows in the nodes that their splits lead to; of complete trees, in the next one.

    A station is done when its last tree is complete, or its root has no split; its rows
    then go.
    """
    split = splits.filter("feature is not null").selectExpr(
        "fit", "key", "node as at", "feature", "bin", "left_step", "right_step", "left_open", "right_open"
    )
    flags = splits.groupBy("fit", "key").agg(
        F.max(F.expr("left_open or right_open")).alias("more"), F.max("over").alias("over")
    )
    way = "case when feature is null then 0 when x[feature] <= bin then 1 else 2 end as way"
    joined = (
        state.withColumn("at", F.when(F.col("open"), F.col("node")))
        .join(split, ["fit", "key", "at"], "left")
        .join(flags, ["fit", "key"])
        .filter("more or not over")
        .selectExpr("*", way)
        .selectExpr(
            *["fit", "key", "x", "rest", "tree", "more"],
            "case way when 0 then node when 1 then 2 * node else 2 * node + 1 end as node",
            "case way when 0 then step when 1 then left_step else right_step end as step",
            "case way when 0 then false when 1 then left_open else right_open end as open",
        )
    )
    return joined.selectExpr(
        *["fit", "key", "x"],
        "case when more then rest else rest - step end as rest",
        "case when more then tree else tree + 1 end as tree",
        "case when more then node else 1 end as node",
        "case when more then step else 0 end as step",
        "case when more then open else true end as open",
    )


# Predictions


def predict_station_trees(rows: DataFrame, model: StationTrees) -> DataFrame:
    """`rows`, which have the column fit, with the prediction of their fit and station.

    Rows without the key or a feature, or whose station was not learned, are left out. A
    station's rows are spread over as many seats as their number needs, to each of which
    its mean and nodes are sent; there all trees are applied to many rows at a time. All
    meet in one shuffle. Only stations of more than one seat, a line each, are joined, as a
    table of all fits and stations would be too much for one place, and so for a broadcast.
    """
    asked = rows.select(
        F.col("fit").cast("int").alias("fit"),
        F.col(model.key).alias("key"),
        _values(model.xs).alias("v"),
        F.struct(*rows.columns).alias("row"),
    ).filter(_whole("v") & F.col("fit").isNotNull() & F.col("key").isNotNull())
    counts = settle(asked.groupBy("fit", "key").agg(F.count(F.lit(1)).alias("asked")), "asked")
    seats = F.ceil(F.col("asked") / SEAT_ROWS).alias("seats")
    wide = settle(counts.filter(F.col("asked") > SEAT_ROWS).select("fit", "key", seats), "seats")
    fits = F.broadcast(counts.select("fit").distinct())

    def sent(table: DataFrame, side: int, *columns: Column) -> DataFrame:
        """Rows of the model, at each seat of their fit and station."""
        named = table.withColumnRenamed(model.key, "key").join(fits, "fit", "left_semi")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("seats", F.lit(1)) - 1))
        return named.join(wide, ["fit", "key"], "left").select(
            "fit", "key", every.alias("seat"), F.lit(side).alias("side"), *columns, no_row
        )

    none = {c: F.lit(None).cast(kind).alias(c) for c, kind in (("tree", "int"), ("node", "bigint"), ("start", "bigint"))}
    no_row = F.lit(None).cast(asked.schema["row"].dataType).alias("row")
    no_v = F.lit(None).cast("array<double>").alias("v")
    facts = F.array(*[F.col(c).cast("double") for c in ("feature", "cut", "left_step", "right_step")])
    means = sent(model.base, 0, none["tree"], none["node"], no_v, F.col("start"))
    nodes = sent(model.nodes, 1, F.col("tree"), F.col("node"), facts.alias("v"), none["start"])
    seat = F.pmod(F.xxhash64("v"), F.coalesce("seats", F.lit(1))).alias("seat")
    seated = asked.join(wide, ["fit", "key"], "left").select(
        "fit", "key", seat, F.lit(2).alias("side"), none["tree"], none["node"], "v", none["start"], "row"
    )
    together = seated.unionByName(nodes).unionByName(means).repartition("fit", "key", "seat")
    in_order = together.sortWithinPartitions("fit", "key", "seat", "side", "tree", "node")

    def run(batches):
        station, mean, trees, seen = None, None, [], None

        for batch in filter(len, batches):
            sides = batch.column("side").to_numpy()
            places = list(zip(*(batch.column(c).to_pylist() for c in ("fit", "key", "seat"))))
            new = [i for i in range(1, len(places)) if places[i] != places[i - 1] or sides[i] != sides[i - 1]]
            tree, node, start = (batch.column(c).fill_null(0).to_numpy() for c in ("tree", "node", "start"))
            values, ends = batch.column("v").values.to_numpy(), batch.column("v").offsets.to_numpy()
            told, learned = np.zeros(len(places)), np.zeros(len(places), bool)
            for i, j in zip([0, *new], [*new, len(places)]):
                if places[i] != station:
                    station, mean, trees, seen = places[i], None, [], None
                if sides[i] == 0:
                    mean = start[i]
                if sides[i] == 0 or mean is None:
                    continue
                v = values[ends[i] : ends[j]].reshape(j - i, -1)
                if sides[i] == 1:
                    trees.append((tree[i:j], node[i:j], v))
                    continue
                if seen is None:
                    seen = _joined(trees)
                told[i:j], learned[i:j] = mean + applied(v, seen), True
            if learned.any():
                rows_told = batch.column("row").filter(pa.array(learned))
                yield pa.RecordBatch.from_arrays(
                    [rows_told, pa.array(told[learned] * UNIT, pa.float64())], names=["row", "prediction"]
                )

    out = in_order.mapInArrow(run, f"row {seated.schema['row'].dataType.simpleString()}, prediction double")
    return out.select("row.*", "prediction")


def _joined(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """The nodes of all trees, by tree and node: their facts, the places of their left and
    right children (-1 for a leaf), and the places of the roots."""
    if not parts:
        return np.zeros((0, 4)), np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    tree, node, facts = (np.concatenate(x) for x in zip(*parts))
    names, number = np.unique(node, return_inverse=True)
    own = tree.astype(np.int64) * len(names) + number
    below = np.flatnonzero(node > 1)
    above = tree[below].astype(np.int64) * len(names) + np.searchsorted(names, node[below] >> 1)
    children = np.full((len(node), 2), -1)
    children[np.searchsorted(own, above), node[below] & 1] = below
    return facts, children, np.flatnonzero(node == 1)


def applied(v: np.ndarray, trees: tuple[np.ndarray, ...]) -> np.ndarray:
    """The sum of the steps that trees, as `_joined` has them, give to rows `v`: whole
    numbers, in no order. All trees are applied at a time."""
    facts, children, roots = trees
    total = np.zeros(len(v))
    some = max(1, TOGETHER_CELLS // max(1, len(roots)))
    for first in range(0, len(v), some):
        count = min(some, len(v) - first)
        rows, at = np.repeat(np.arange(first, first + count), len(roots)), np.tile(roots, count)
        while len(rows):
            left = v[rows, facts[at, 0].astype(np.int64)] <= facts[at, 1]
            step = np.where(left, facts[at, 2], facts[at, 3])
            at = children[at, 1 - left.astype(np.int64)]
            leaf = at < 0
            total += np.bincount(rows[leaf], step[leaf], minlength=len(v))
            rows, at = rows[~leaf], at[~leaf]
    return total


# Hold-out, versions and search

HELD_OUT, REFIT = 0, 1


def evaluate_and_refit_trees(
    split: DataFrame, xs: list[str], y: str = "label", key: str = "station_id", tuned: Trees = Trees(), **how
) -> tuple[DataFrame, StationTrees]:
    """Quality per station of a model of the training rows (`is_train`) on the others, and
    the models of both: HELD_OUT and REFIT, on all rows, grown together."""
    fits = F.when(F.col("is_train"), F.array(F.lit(HELD_OUT), F.lit(REFIT))).otherwise(F.array(F.lit(REFIT)))
    rows = split.select("*", F.explode(fits).alias("fit"))
    parameters = [
        Trees(f, tuned.trees, tuned.max_depth, tuned.min_leaf, tuned.rate) for f in (HELD_OUT, REFIT)
    ]
    model = fit_station_trees(rows, xs, parameters, y, key, **how)
    test = split.filter("not is_train").withColumn("fit", F.lit(HELD_OUT))
    return regression_metrics(predict_station_trees(test, model), [key], y, "prediction"), model


def register_station_trees(
    spark: SparkSession, model: StationTrees, metrics: DataFrame, name: str, known: DataFrame | None = None
) -> DataFrame:
    """The saved models as a row of the table of boosted models: name, version, path, and
    mean r2 and rmse over the stations of `metrics`."""
    latest = None
    if known is not None:
        latest = known.filter(F.col("name") == name).agg(F.max("version")).first()[0]
    path = model.save(shared_folder(spark, "boosted"))
    row = spark.createDataFrame([(name, (latest or 0) + 1, path)], "name string, version int, path string")
    return row.join(metrics.agg(F.avg("r2").alias("r2"), F.avg("rmse").alias("rmse")))


def station_trees_champion(spark: SparkSession, models: DataFrame, name: str) -> StationTrees:
    """The newest version of the named models, loaded."""
    newest = models.filter(F.col("name") == name).orderBy(F.desc("version")).first()
    if newest is None:
        raise ValueError(f"no model named {name}")
    return load_station_trees(spark, newest["path"])


def search_station_trees(
    chunked: DataFrame, xs: list[str], candidates: DataFrame, y: str = "label", key: str = "station_id", **how
) -> DataFrame:
    """r2 and rmse of each candidate in each forward fold, over the rows of all stations:
    trial, fold, row_count, r2, mse, rmse.

    `chunked` has `chunk` from `forward_folds`; `candidates` has trial, max_depth, trees
    and min_leaf, a line for each of a few trials. All trials and folds grow together.
    """
    last = chunked.agg(F.max("chunk")).first()[0] or 0
    width = last + 1
    parameters = [
        Trees(r["trial"] * width + fold, r["trees"], r["max_depth"], r["min_leaf"])
        for r in candidates.collect()
        for fold in range(1, width)
    ]
    trials = F.array(*[F.lit(t).cast("bigint") for t in sorted({p.fit // width for p in parameters})])
    spread = chunked.select("*", F.explode(trials).alias("trial"))
    folds = F.sequence(F.col("chunk") + 1, F.lit(last))
    learning = spread.filter(F.col("chunk") < last).select("*", F.explode(folds).alias("fold"))
    fit = (F.col("trial") * width + F.col("fold")).cast("int").alias("fit")
    model = fit_station_trees(learning.select("*", fit), xs, parameters, y, key, **how)
    tested = spread.filter("chunk > 0").withColumn("fold", F.col("chunk")).select("*", fit)
    told = predict_station_trees(tested, model)
    return regression_metrics(told, ["trial", "fold"], y, "prediction")
