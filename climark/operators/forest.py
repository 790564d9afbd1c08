"""Random forests of unlimited depth for several targets over one feature vector.

Features are cut into at most ``BINS`` value ranges (bounds from a sample of
``SAMPLE`` rows).  Every target has its own trees; a tree's bag gives each row a
Poisson(1) weight that follows from a hash of the row and the tree's number.

A tree grows in two phases.  While a node holds more than ``local_rows`` rows, its
histograms (rows, weight and sum of the target by feature and range) are taken in one
pass over the training rows for up to ``OPEN_NODES`` nodes of all trees together, added
up by node and split there.  Smaller nodes are grown to the end by one task each, which
gets the node's rows through a shuffle and keeps histograms of the larger child
as the difference of its parent's and its sibling's.  So no task holds more than
``local_rows`` rows of a bag, and the number of passes follows the size of the data and
not the depth of the trees.

The fitted forest is a table of nodes.  Prediction broadcasts it in slices of at most
``SLICE_NODES`` nodes (whole subtrees of the second phase, plus the nodes above
them); a row adds what its path meets in each slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climark.schemas import TARGETS
from climark.session import scratch_path

BINS = 32
SAMPLE = 10_000
LOCAL_ROWS = 50_000
OPEN_NODES = 300
SLICE_NODES = 1_000_000
_CHUNK = 2_048                 # rows whose ranges are counted at once
_ROWS = 1 << 26                # rows and weight of a chunk are counted as rows * _ROWS + weight
_POISSON = np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])
NODES = ("target string, tree int, node long, feature int, threshold double, lower long, upper long, value double, "
         "rows long, gain double")


class Ranges:
    """Upper bounds of each feature's value ranges (the last range has none).

    Histograms number the ranges: features of several bounds (``wide``) have ``bins``
    places each, then come features of one bound (``pair``) with two places each, and the last
    place holds the whole node."""

    def __init__(self, bounds: list[np.ndarray], bins: int):
        self.bounds, self.bins = bounds, bins
        self.wide = np.array([j for j, b in enumerate(bounds) if len(b) > 1], np.int64)
        self.pair = np.array([j for j, b in enumerate(bounds) if len(b) == 1], np.int64)
        self.split_at = len(self.wide) * bins
        self.places = self.split_at + 2 * len(self.pair) + 1

    @classmethod
    def of(cls, sample: np.ndarray, bins: int) -> Ranges:
        bounds = []
        for column in sample.T:
            values = np.unique(column)
            bounds.append(np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower")) if len(values) > bins
                          else (values[:-1] + values[1:]) / 2)
        return cls(bounds, bins)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Range of every value; a value belongs to the first range whose bound it does not exceed."""
        out = np.empty(x.shape, np.uint8)
        for j, bounds in enumerate(self.bounds):
            out[:, j] = np.searchsorted(bounds, x[:, j], side="left")
        return out

    def place(self, flat: int) -> tuple[int, int, float]:
        """Feature, range and bound of a place after which a node can be split."""
        j, code = ((self.wide[flat // self.bins], flat % self.bins) if flat < self.split_at
                   else (self.pair[(flat - self.split_at) // 2], 0))
        return int(j), int(code), float(self.bounds[j][code])

    def prepared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the wide features and ranges (0 or 1) of the others, by row."""
        return codes[:, self.wide] + np.arange(len(self.wide)) * self.bins, codes[:, self.pair]

    def counted(self, prepared: tuple[np.ndarray, np.ndarray], at: np.ndarray, weight: np.ndarray, wy: np.ndarray) -> np.ndarray:
        """(3, places): rows, weight and weighted sum of the target of the rows ``at``."""
        wide, pair = prepared
        total, top = np.zeros((3, self.places)), self.split_at
        for i in range(0, len(at), _CHUNK):
            rows = at[i:i + _CHUNK]
            w, s = weight[rows], wy[rows]
            flat = wide[rows].ravel()
            both, sums = (np.bincount(flat, np.repeat(v, wide.shape[1]), top) for v in (w + _ROWS, s))
            n = np.floor(both / _ROWS)
            total[0, :top] += n
            total[1, :top] += both - n * _ROWS
            total[2, :top] += sums
            values = np.stack([np.ones(len(rows)), w, s])
            total[:, top + 1:-1:2] += values @ pair[rows].astype(np.float64)
            total[:, -1] += values.sum(axis=1)
        total[:, top:-1:2] = total[:, -1:] - total[:, top + 1:-1:2]
        return total

    def best(self, hist: np.ndarray, min_leaf: int) -> tuple[int, float] | None:
        """Place after which to split and the gain in the sum of squares; None without one."""
        top = self.split_at
        runs = hist[:, :top].reshape(3, len(self.wide), self.bins).cumsum(axis=2).reshape(3, top)
        rows, weight, below = np.concatenate([runs, hist[:, top:-1:2]], axis=1)
        all_rows, all_weight, whole = hist[:, -1]
        ok = (rows >= min_leaf) & (rows <= all_rows - min_leaf)
        if not ok.any():
            return None
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(ok, below ** 2 / weight + (whole - below) ** 2 / (all_weight - weight), -np.inf)
        most = score.max()
        at = int(np.argmax(score >= most - 1e-9 * abs(most)))      # of equal splits the first, whatever the order of sums
        gain = float(score[at] - whole ** 2 / all_weight)
        if gain <= 1e-9 * max(1.0, abs(score[at])):
            return None
        return (at if at < top else top + 2 * (at - top)), gain

    def below(self, hist: np.ndarray, flat: int) -> np.ndarray:
        """Rows, weight and sum of the rows up to a place of a feature."""
        return hist[:, flat // self.bins * self.bins if flat < self.split_at else flat:flat + 1].sum(axis=1)


def grow(ranges: Ranges, codes: np.ndarray, weight: np.ndarray, y: np.ndarray, base: int, min_leaf: int,
         depth: int | None = None, prepared: tuple | None = None) -> list[tuple]:
    """The nodes (id, feature, threshold, lower, upper, value, rows, gain) of a whole
    subtree (or ``depth`` levels of it); ids count from ``base``, its top."""
    wy, out, used, prepared = weight * y, [], 1, prepared or ranges.prepared(codes)
    stack = [(0, np.arange(len(y)), None, 0)]
    while stack:
        node, rows, hist, level = stack.pop()
        value = float(wy[rows].sum() / weight[rows].sum())
        split = None
        if level != depth and len(rows) >= 2 * min_leaf and np.ptp(y[rows]) > 0:
            hist = ranges.counted(prepared, rows, weight, wy) if hist is None else hist
            split = ranges.best(hist, min_leaf)
        if split is None:
            out.append((base + node, -1, 0.0, -1, -1, value, len(rows), 0.0))
            continue
        feature, code, bound = ranges.place(split[0])
        low = codes[rows, feature] <= code
        parts = [rows[low], rows[~low]]
        small = 0 if len(parts[0]) <= len(parts[1]) else 1
        hists: list = [None, None]
        if level + 1 != depth and len(parts[1 - small]) >= 2 * min_leaf:
            hists[small] = ranges.counted(prepared, parts[small], weight, wy)
            hists[1 - small] = hist - hists[small]
        out.append((base + node, feature, bound, base + used, base + used + 1, value, len(rows), split[1]))
        stack += [(used + k, parts[k], hists[k], level + 1) for k in (0, 1)]
        used += 2
    return out


# -- bags and the upper parts of the trees -----------------------------------------------

def _weights(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) weights of the rows (hashes) in a tree's bag."""
    x = row.view(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95 & 2 ** 64 - 1)
    for mul, shift in ((0xBF58476D1CE4E5B9, 30), (0x94D049BB133111EB, 27)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    unit = (x ^ (x >> np.uint64(31))) >> np.uint64(11)
    return np.searchsorted(_POISSON, unit.astype(np.float64) / 2.0 ** 53, side="right").astype(np.float64)


@dataclass
class Top:
    """The upper part of a tree: parallel lists by node number; feature -1 is an end, from
    where one task goes on unless it is ``closed`` (many rows that no split parts)."""
    feature: list = field(default_factory=lambda: [-1])
    code: list = field(default_factory=lambda: [0])
    lower: list = field(default_factory=lambda: [-1])
    facts: list = field(default_factory=lambda: [(0.0, 0.0, 0, 0.0)])     # threshold, value, rows, gain
    closed: list = field(default_factory=list)

    def ends(self, codes: np.ndarray) -> np.ndarray:
        """Number of the end that each row falls to."""
        at = np.zeros(len(codes), np.int64)
        if len(self.feature) == 1:
            return at
        feature, code, lower = (np.array(v) for v in (self.feature, self.code, self.lower))
        while True:
            go = np.flatnonzero(feature[at] >= 0)
            if not len(go):
                return at
            now = at[go]
            at[go] = lower[now] + (codes[go, feature[now]] > code[now])

    def split(self, node: int, feature: int, code: int, facts: tuple) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.code[node], self.lower[node], self.facts[node] = feature, code, first, facts
        for _ in range(2):
            self.feature.append(-1)
            self.code.append(0)
            self.lower.append(-1)
            self.facts.append((0.0, 0.0, 0, 0.0))
        return first, first + 1


@dataclass(frozen=True)
class Task:
    """What every task of a fit gets."""
    ranges: Ranges
    targets: list[str]
    trees: int
    min_leaf: int
    seed: int

    def batches(self, batches: Iterator[pa.RecordBatch]):
        """(row hashes, codes, targets) of batches (row, codes, y)."""
        for batch in batches:
            if batch.num_rows:
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                y = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield batch, batch.column(0).to_numpy(), codes, y


def coded_rows(train: DataFrame, features_col: str, labels: list[str], bins: int) -> tuple[DataFrame, Ranges]:
    """Stored (row, codes, y), and the ranges of the codes."""
    spark = train.sparkSession
    rows = train.select(vector_to_array(features_col).alias("x"),
                        F.array(*[F.col(f"`{c}`").cast("double") for c in labels]).alias("y"))
    rows = rows.filter(~F.exists("y", lambda v: v.isNull())).withColumn("row", F.xxhash64("x", "y"))
    sample = rows.orderBy("row").select("x").limit(SAMPLE).collect()
    if not sample:
        raise ValueError("no training rows")
    ranges = Ranges.of(np.array([r["x"] for r in sample]), bins)
    shared = spark.sparkContext.broadcast(ranges)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(shared.value.bounds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in shared.value.codes(x)], pa.binary()), batch.column(2)],
                names=["row", "codes", "y"])

    path = scratch_path(spark, "forest-rows")
    rows.select("row", "x", "y").mapInArrow(code, "row long, codes binary, y array<double>").write.parquet(path)
    return spark.read.parquet(path), ranges


def best_splits(rows: DataFrame, task: Task, nodes_of) -> list:
    """The best split of each node in one pass: rows (k, tree, node, flat, gain, below, rows,
    value, low, high), ``flat`` -1 where nothing parts the node, ``low`` and ``high`` the means below
    and above the split.  ``nodes_of(row hashes, codes, y)`` yields ((k, tree, node), positions,
    weights, targets).  The histograms are added up by node; a row a node comes to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(task)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, hists = shared.value.ranges, {}
        for _, row, codes, y in shared.value.batches(batches):
            for key, at, weight, own in nodes_of(row, codes, y):
                hists[key] = hists.get(key, 0) + ranges.counted(ranges.prepared(codes[at]), np.arange(len(at)), weight, weight * own)
        schema = pa.schema([("k", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("hist", pa.binary())])
        for key, hist in hists.items():
            yield pa.RecordBatch.from_pylist([{**dict(zip(("k", "tree", "node"), key)), "hist": hist.tobytes()}], schema)

    def split(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, total = shared.value.ranges, 0
        for batch in batches:
            for part in batch.column("hist").to_pylist():
                total = total + np.frombuffer(part, np.float64).reshape(3, -1)
        n, weight, whole = total[:, -1]
        flat, gain = ranges.best(total, shared.value.min_leaf) or (-1, 0.0)
        below = ranges.below(total, flat) if flat >= 0 else np.zeros(3)
        low, high = (below[2] / below[1], (whole - below[2]) / (weight - below[1])) if flat >= 0 else (0.0, 0.0)
        yield pa.RecordBatch.from_pylist([{
            **dict(zip(("k", "tree", "node"), (x.as_py() for x in key))), "flat": flat, "gain": gain, "below": int(below[0]),
            "rows": int(n), "value": float(whole / weight), "low": float(low), "high": float(high)}])

    found = rows.mapInArrow(count, "k int, tree int, node long, hist binary").groupBy("k", "tree", "node").applyInArrow(
        split, "k long, tree long, node long, flat long, gain double, below long, rows long, value double, low double, "
               "high double").collect()
    shared.destroy()
    return sorted(found)


def _tops(rows: DataFrame, task: Task, local_rows: int) -> dict[tuple[int, int], Top]:
    """The upper parts of all trees: nodes of more than ``local_rows`` rows, split."""
    tops = {(k, tree): Top() for k in range(len(task.targets)) for tree in range(task.trees)}
    waiting = [(*key, 0) for key in tops] if rows.count() > local_rows else []
    while waiting:
        now, waiting = waiting[:OPEN_NODES], waiting[OPEN_NODES:]
        shared = rows.sparkSession.sparkContext.broadcast(({n[:2]: tops[n[:2]] for n in now}, set(now)))

        def bagged(row: np.ndarray, codes: np.ndarray, y: np.ndarray):
            parts, wanted = shared.value
            for (k, tree), top in parts.items():
                weight = _weights(row, tree, task.seed)
                end = np.where(weight > 0, top.ends(codes), -1)
                for node in np.unique(end).tolist():
                    if (k, tree, node) in wanted:
                        at = np.flatnonzero(end == node)
                        yield (k, tree, node), at, weight[at], y[at, k]

        for r in best_splits(rows, task, bagged):                  # at most OPEN_NODES rows
            if r.flat < 0:
                tops[r.k, r.tree].closed.append(r.node)
                tops[r.k, r.tree].facts[r.node] = (0.0, r.value, r.rows, 0.0)
                continue
            j, code, bound = task.ranges.place(r.flat)
            children = tops[r.k, r.tree].split(r.node, j, code, (bound, r.value, r.rows, r.gain))
            waiting += [(r.k, r.tree, c) for c, n in zip(children, (r.below, r.rows - r.below)) if n > local_rows]
        shared.destroy()
    return tops


class ForestModel:
    """A fitted forest: ``nodes`` is a stored table, ``pred_<target>`` the mean of the
    target's trees."""

    def __init__(self, nodes: DataFrame, targets: list[str], trees: int):
        self.nodes, self.targets, self.trees = nodes, list(targets), trees

    @classmethod
    def fit(cls, train: DataFrame, targets=TARGETS, features_col: str = "features", label_prefix: str = "y_",
            trees: int = 100, min_leaf: int = 3, seed: int = 123, bins: int = BINS,
            local_rows: int = LOCAL_ROWS) -> ForestModel:
        spark = train.sparkSession
        rows, ranges = coded_rows(train, features_col, [f"{label_prefix}{t}" for t in targets], bins)
        task = Task(ranges, list(targets), trees, min_leaf, seed)
        tops = _tops(rows, task, local_rows)
        shared = spark.sparkContext.broadcast((task, tops))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, parts = shared.value
            for batch, row, codes, y in own.batches(batches):
                for tree in range(own.trees):
                    weight = _weights(row, tree, own.seed)
                    at = np.flatnonzero(weight)
                    for k in range(len(own.targets)):
                        end = parts[k, tree].ends(codes[at])
                        on = ~np.isin(end, parts[k, tree].closed)
                        go = at[on]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(go), k, np.int32)), pa.array(np.full(len(go), tree, np.int32)),
                             pa.array(end[on]), batch.column(1).take(pa.array(go)), pa.array(y[go, k]), pa.array(weight[go])],
                            names=["k", "tree", "node", "codes", "y", "weight"])

        def finish(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value[0]
            group = pa.Table.from_batches(list(batches))
            codes = np.frombuffer(b"".join(group["codes"].to_pylist()), np.uint8).reshape(group.num_rows, -1)
            y, weight = group["y"].to_numpy(), group["weight"].to_numpy()
            order = np.lexsort((*codes.T[:3], weight, y))          # one order of rows, whatever the shuffle's
            found = grow(own.ranges, codes[order], weight[order], y[order], key[2].as_py() << 32, own.min_leaf)
            columns = [pa.array(c) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.targets[key[0].as_py()]] * len(found)), pa.array([key[1].as_py()] * len(found), pa.int32()),
                 columns[0], columns[1].cast(pa.int32()), *columns[2:]],
                names=[c.split()[0] for c in NODES.split(", ")])

        local = rows.mapInArrow(deal, "k int, tree int, node long, codes binary, y double, weight double").groupBy(
            "k", "tree", "node").applyInArrow(finish, NODES)
        upper = []
        for (k, tree), top in tops.items():
            for n, feature in enumerate(top.feature):
                bound, value, n_rows, gain = top.facts[n]
                if feature >= 0:
                    upper.append((targets[k], tree, n << 32, feature, bound, top.lower[n] << 32, top.lower[n] + 1 << 32, value,
                                  n_rows, gain))
                elif n in top.closed:
                    upper.append((targets[k], tree, n << 32, -1, 0.0, -1, -1, value, n_rows, 0.0))
        path = scratch_path(spark, "forest-nodes")
        local.write.parquet(path)
        if upper:
            spark.createDataFrame(upper, NODES).write.mode("append").parquet(path)
        return cls(spark.read.schema(NODES).parquet(path), list(targets), trees)

    def importances(self) -> DataFrame:
        """(target, feature, importance): a feature's share of its tree's gains, averaged over trees."""
        by_tree = self.nodes.filter("feature >= 0").groupBy("target", "tree", "feature").agg(F.sum("gain").alias("gain"))
        whole = by_tree.groupBy("target", "tree").agg(F.sum("gain").alias("whole"))
        return by_tree.join(whole, ["target", "tree"]).groupBy("target", "feature").agg(
            (F.sum(F.col("gain") / F.col("whole")) / self.trees).alias("importance"))

    def _slices(self, slice_nodes: int) -> Iterator[dict]:
        """{(target, tree): parallel arrays of nodes}: whole lower parts of at most
        ``slice_nodes`` nodes together, with all that lies above."""
        nodes = self.nodes.withColumn("end", F.shiftright("node", 32))
        sizes = nodes.groupBy("target", "tree", "end").agg(F.count(F.lit(1)).alias("n")).collect()
        groups, room = [[]], 0
        for r in sorted(sizes):
            if groups[-1] and room + r["n"] > slice_nodes:
                groups.append([])
                room = 0
            groups[-1].append(tuple(r)[:3])
            room += r["n"]
        above = (F.col("feature") >= 0) & (F.col("lower") % (1 << 32) == 0)
        for group in groups:
            key = F.struct("target", "tree", "end")

            def at(x: tuple):
                return F.struct(F.lit(x[0]).alias("target"), F.lit(x[1]).cast("int").alias("tree"),
                                F.lit(x[2]).cast("long").alias("end"))

            inside = nodes if len(groups) == 1 else nodes.filter(key.between(at(group[0]), at(group[-1])) | above)
            table = inside.select("target", "tree", "node", "feature", "threshold", "lower", "upper", "value").toArrow()
            out: dict = {}
            trees = table["tree"].to_numpy()
            names = np.array(table["target"].to_pylist())
            columns = {c: table[c].to_numpy() for c in table.column_names[2:]}
            for t in self.targets:
                for tree in np.unique(trees[names == t]).tolist():
                    mine = np.flatnonzero((names == t) & (trees == tree))
                    mine = mine[np.argsort(columns["node"][mine])]
                    ids = columns["node"][mine]
                    part = {c: columns[c][mine] for c in ("feature", "threshold", "value")}
                    for c in ("lower", "upper"):
                        place = np.searchsorted(ids, columns[c][mine]).clip(max=len(ids) - 1)
                        part[c] = np.where(ids[place] == columns[c][mine], place, -1)
                    if ids[0] == 0:
                        out[t, tree] = part
            yield out

    def transform(self, df: DataFrame, features_col: str = "features", slice_nodes: int = SLICE_NODES) -> DataFrame:
        """``df`` without its vector, with pred_<target>."""
        names = [f"pred_{t}" for t in self.targets]
        kept = [c for c in df.columns if c != features_col and c not in names]
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), vector_to_array(features_col).alias("x"),
                         F.array(*[F.lit(0.0)] * len(names)).alias("sums"))
        schema = T.StructType(rows.schema.fields)
        for part in self._slices(slice_nodes):
            rows = rows.mapInArrow(_adder(df.sparkSession, part, self.targets), schema)
        return rows.select(*[F.col(f"row.`{c}`") for c in kept],
                           *[(F.col("sums")[k] / self.trees).alias(n) for k, n in enumerate(names)])

    def save(self, path: str) -> None:
        base = path.rstrip("/")
        self.nodes.write.mode("overwrite").parquet(f"{base}/nodes")
        self.nodes.sparkSession.createDataFrame([(self.targets, self.trees)], "targets array<string>, trees int") \
            .coalesce(1).write.mode("overwrite").parquet(f"{base}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        facts = spark.read.parquet(f"{path.rstrip('/')}/facts").first()
        return cls(spark.read.schema(NODES).parquet(f"{path.rstrip('/')}/nodes"), list(facts["targets"]), facts["trees"])


def _adder(spark: SparkSession, part: dict, targets: list[str]):
    """A mapInArrow function that adds a slice's values to ``sums``."""
    shared = spark.sparkContext.broadcast(part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(n, -1)
            sums = batch.column(2).flatten().to_numpy().reshape(n, -1).copy()
            for (t, _), tree in shared.value.items():
                at, alive = np.zeros(n, np.int64), np.arange(n)
                feature, bound, lower, upper = (tree[c] for c in ("feature", "threshold", "lower", "upper"))
                while len(alive):
                    now = at[alive]
                    j = feature[now]
                    inner = j >= 0
                    alive, now, j = alive[inner], now[inner], j[inner]
                    at[alive] = np.where(x[alive, j] <= bound[now], lower[now], upper[now])
                    alive = alive[at[alive] >= 0]                 # paths that leave the slice end here
                done = at >= 0
                sums[done, targets.index(t)] += tree["value"][at[done]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(sums), pa.list_(pa.float64()))], names=batch.schema.names)

    return add
