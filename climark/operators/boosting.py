"""Gradient boosting for several targets: start at the mean, fit each tree to the
residuals, shrink every tree.

A round takes one pass over the coded training rows for each level of its trees, all
targets together: a task works out the residuals of its rows from the trees so far,
counts them by node, feature and range, and the histograms are added up by node
(``forest.best_splits``).  Nothing but a row a node reaches the driver, and no residual is
stored between rounds.  As in the forest, nodes of at most ``local_rows`` rows are grown by
one task each: where that holds for the tops of the trees, a task goes through all
rounds of a target.  The model is small (rounds x 2**depth nodes) and is broadcast.
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

from climark.operators.forest import BINS, LOCAL_ROWS, Ranges, Task, best_splits, coded_rows, grow
from climark.schemas import TARGETS

NODES = "target string, round int, node int, feature int, threshold double, lower int, value double, gain double"


@dataclass
class SmallTree:
    """Parallel lists by node number; feature -1 is a leaf, the upper child is lower + 1."""
    feature: list = field(default_factory=lambda: [-1])
    threshold: list = field(default_factory=lambda: [0.0])
    lower: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, threshold: float, gain: float, low: float, high: float) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.threshold[node], self.lower[node], self.gain[node] = feature, threshold, first, gain
        for value in (low, high):
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.lower.append(-1)
            self.value.append(value)
            self.gain.append(0.0)
        return first, first + 1

    def leaves(self, column) -> np.ndarray:
        """Leaf of every row; ``column(j)`` gives the values of feature j."""
        at = np.zeros(len(column(0)), np.int64)
        for node in range(len(self.feature)):          # children come after their parent
            if self.feature[node] >= 0:
                here = np.flatnonzero(at == node)
                at[here] = self.lower[node] + (column(self.feature[node])[here] > self.threshold[node])
        return at


@dataclass
class BoostedModel:
    """``start`` and trees by target; ``pred_<target>`` = start + shrink * the sum of its trees."""
    start: dict[str, float]
    trees: dict[str, list[SmallTree]]
    shrink: float

    @property
    def targets(self) -> list[str]:
        return list(self.start)

    @classmethod
    def fit(cls, train: DataFrame, targets=TARGETS, features_col: str = "features", label_prefix: str = "y_",
            rounds: int = 50, depth: int = 3, shrink: float = 0.1, min_leaf: int = 1, bins: int = BINS,
            local_rows: int = LOCAL_ROWS) -> BoostedModel:
        labels = [f"{label_prefix}{t}" for t in targets]
        rows, ranges = coded_rows(train, features_col, labels, bins)
        start = train.filter(" and ".join(f"`{c}` is not null" for c in labels)).agg(
            *[F.avg(c).alias(t) for c, t in zip(labels, targets)]).first().asDict()
        model = cls({t: float(start[t]) for t in targets}, {t: [] for t in targets}, shrink)
        task = Task(ranges, list(targets), 1, min_leaf, 0)
        if rows.count() <= local_rows:
            model._add_rounds_by_target(rows, task, rounds, depth)
            return model
        for _ in range(rounds):
            model._add_round(rows, task, depth)
        return model

    def _add_rounds_by_target(self, rows: DataFrame, task: Task, rounds: int, depth: int) -> None:
        shared = rows.sparkSession.sparkContext.broadcast((self, task))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, _, y in shared.value[1].batches(batches):
                for k in range(y.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), k, np.int32)), batch.column(0), batch.column(1), pa.array(y[:, k])],
                        names=["k", "row", "codes", "y"])

        def boost(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, own = shared.value
            group = pa.Table.from_batches(list(batches)).sort_by([("row", "ascending"), ("y", "ascending")])
            codes = np.frombuffer(b"".join(group["codes"].to_pylist()), np.uint8).reshape(group.num_rows, -1)
            prepared, target = own.ranges.prepared(codes), model.targets[key[0].as_py()]
            left = group["y"].to_numpy() - model.start[target]
            for i in range(rounds):
                nodes = sorted(grow(own.ranges, codes, np.ones(len(left)), left, 0, own.min_leaf, depth, prepared))
                tree = SmallTree(*(list(c) for c in zip(*((n[1], n[2], n[3], n[5], n[7]) for n in nodes))))
                left = left - model.shrink * np.array(tree.value)[tree.leaves(_by_code(own.ranges, codes))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target] * len(nodes)), pa.array(np.full(len(nodes), i, np.int32)),
                     pa.array(np.arange(len(nodes), dtype=np.int32)), pa.array(tree.feature, pa.int32()),
                     pa.array(tree.threshold), pa.array(tree.lower, pa.int32()), pa.array(tree.value), pa.array(tree.gain)],
                    names=[c.split()[0] for c in NODES.split(", ")])

        nodes = rows.mapInArrow(deal, "k int, row long, codes binary, y double").groupBy("k").applyInArrow(boost, NODES)
        for t, trees in _trees(nodes.collect()).items():
            self.trees[t] = trees

    def _add_round(self, rows: DataFrame, task: Task, depth: int) -> None:
        grown = {k: SmallTree() for k in range(len(self.targets))}
        wanted = {(k, 0) for k in grown}
        for level in range(depth):
            shared = rows.sparkSession.sparkContext.broadcast((self, grown, wanted))

            def residuals(row: np.ndarray, codes: np.ndarray, y: np.ndarray):
                model, trees, nodes = shared.value
                for k, t in enumerate(model.targets):
                    own = y[:, k] - model.predicted(t, _by_code(task.ranges, codes))
                    at = trees[k].leaves(_by_code(task.ranges, codes))
                    for node in range(len(trees[k].feature)):
                        here = np.flatnonzero(at == node)
                        if (k, node) in nodes and len(here):
                            yield (k, 0, node), here, np.ones(len(here)), own[here]

            found = best_splits(rows, task, residuals)
            shared.destroy()
            wanted = set()
            for r in found:
                if level == 0:
                    grown[r.k].value[0] = r.value
                if r.flat >= 0:
                    j, _, bound = task.ranges.place(r.flat)
                    wanted |= {(r.k, c) for c in grown[r.k].split(r.node, j, bound, r.gain, r.low, r.high)}
            if not wanted:
                break
        for k, t in enumerate(self.targets):
            self.trees[t].append(grown[k])

    def steps(self, target: str, column) -> Iterator[np.ndarray]:
        """What each tree adds to the rows' predictions."""
        for tree in self.trees[target]:
            yield self.shrink * np.array(tree.value)[tree.leaves(column)]

    def predicted(self, target: str, column) -> np.ndarray:
        return self.start[target] + sum(self.steps(target, column), np.zeros(len(column(0))))

    def transform(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """``df`` without its vector, with pred_<target>."""
        names = [f"pred_{t}" for t in self.targets]
        kept = [c for c in df.columns if c != features_col and c not in names]
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), vector_to_array(features_col).alias("x"))
        shared = df.sparkSession.sparkContext.broadcast(self)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    column = _columns(batch.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), *[pa.array(shared.value.predicted(t, column)) for t in shared.value.targets]],
                        names=["row", *names])

        out = rows.mapInArrow(add, T.StructType([rows.schema["row"], *[T.StructField(n, T.DoubleType()) for n in names]]))
        return out.select(*[F.col(f"row.`{c}`") for c in kept], *names)

    def history(self, rows: DataFrame, split_col: str = "split", train: str = "train", val: str = "val",
                features_col: str = "features", label_prefix: str = "y_") -> DataFrame:
        """Per round (after it): loss (MSE) / MAE / RMSE / R^2 on both splits, averaged over the
        targets, in one pass over the rows."""
        parts = rows.filter(F.col(split_col).isin(train, val)).select(
            (F.col(split_col) == val).cast("int").alias("part"), vector_to_array(features_col).alias("x"),
            F.array(*[F.col(f"{label_prefix}{t}").cast("double") for t in self.targets]).alias("y"))
        shared = rows.sparkSession.sparkContext.broadcast(self)

        def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, total = shared.value, {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                part, column = batch.column(0).to_numpy(), _columns(batch.column(1))
                y = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                for k, t in enumerate(model.targets):
                    so_far = np.full(batch.num_rows, model.start[t])
                    for i, step in enumerate(model.steps(t, column)):
                        so_far = so_far + step
                        for p in np.unique(part).tolist():
                            off = (y[:, k] - so_far)[part == p]
                            got = np.array([len(off), (off ** 2).sum(), np.abs(off).sum()])
                            total[p, k, i] = total.get((p, k, i), 0) + got
            if total:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int32()) for c in zip(*total)], *[pa.array(c) for c in zip(*total.values())]],
                    names=["part", "k", "iteration", "n", "sq", "ab"])

        sums = parts.mapInArrow(errors, "part int, k int, iteration int, n double, sq double, ab double").groupBy(
            "part", "k", "iteration").agg(F.sum("n").alias("n"), F.sum("sq").alias("sq"), F.sum("ab").alias("ab"))
        spread = parts.select("part", F.posexplode("y").alias("k", "v")).groupBy("part", "k").agg(F.var_pop("v").alias("var"))
        per = sums.join(F.broadcast(spread), ["part", "k"])            # two rows a target
        loss, mae = F.sum("sq") / F.sum("n"), F.sum("ab") / F.sum("n")
        r2 = F.when(F.min("var") > 0, F.avg(1 - F.try_divide(F.col("sq") / F.col("n"), F.col("var"))))
        by_part = per.groupBy("iteration", "part").agg(loss.alias("loss"), mae.alias("mae"), F.sqrt(loss).alias("rmse"),
                                                       r2.alias("r2"))
        both = [F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{pre}{c}")
                for c in ("loss", "mae", "rmse", "r2") for p, pre in ((0, ""), (1, "val_"))]
        return by_part.groupBy("iteration").agg(*both)

    def importances(self) -> list[tuple[str, int, float]]:
        """(target, feature, share): a feature's share of its tree's gains, averaged over the trees that split."""
        out = []
        for t, trees in self.trees.items():
            shares: dict[int, float] = {}
            split = [tree for tree in trees if sum(tree.gain) > 0]
            for tree in split:
                for j, g in zip(tree.feature, tree.gain):
                    if j >= 0:
                        shares[j] = shares.get(j, 0.0) + g / sum(tree.gain) / len(split)
            out += [(t, j, v) for j, v in shares.items()]
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(t, i, n, tree.feature[n], tree.threshold[n], tree.lower[n], tree.value[n], tree.gain[n])
                for t, trees in self.trees.items() for i, tree in enumerate(trees) for n in range(len(tree.feature))]
        base = path.rstrip("/")
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{base}/nodes")
        spark.createDataFrame([(t, v, self.shrink) for t, v in self.start.items()], "target string, start double, shrink double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{base}/start")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        start = spark.read.parquet(f"{path.rstrip('/')}/start").collect()
        trees = _trees(spark.read.schema(NODES).parquet(f"{path.rstrip('/')}/nodes").collect())
        return cls({r.target: r.start for r in start}, {r.target: trees.get(r.target, []) for r in start}, start[0].shrink)


def _trees(nodes: list) -> dict[str, list[SmallTree]]:
    """Trees by target from rows of ``NODES`` (few: rounds x 2**(depth + 1) a target)."""
    found: dict = {}
    for r in sorted(nodes):
        tree = found.setdefault(r["target"], {}).setdefault(r["round"], SmallTree([], [], [], [], []))
        for name in ("feature", "threshold", "lower", "value", "gain"):
            getattr(tree, name).append(r[name])
    return {t: [trees[i] for i in sorted(trees)] for t, trees in found.items()}


def _columns(column: pa.Array):
    x = column.flatten().to_numpy().reshape(len(column), -1)
    return lambda j: x[:, j]


def _by_code(ranges: Ranges, codes: np.ndarray):
    """Values that compare with the bounds as the coded ones do: a range's own bound, or
    infinity in the last range."""
    def column(j: int) -> np.ndarray:
        return np.append(ranges.bounds[j], np.inf)[codes[:, j]]
    return column
