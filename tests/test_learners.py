"""Least squares, forest, boosting, stored model."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from climark.operators import forest
from climark.operators.boosting import BoostedModel
from climark.operators.forecast import CANDIDATES, LeastSquares, MultiTarget, ServingModel, elastic_net
from climark.operators.forest import ForestModel, Ranges
from climark.schemas import TARGETS
from climark.session import scratch_path


def frame(spark, x, ys, parts=4):
    rows = [(k, r.tolist(), *map(float, y)) for k, (r, y) in enumerate(zip(x, ys))]
    names = ", ".join(f"y_{t} double" for t in TARGETS)
    df = spark.createDataFrame(rows, f"id int, x array<double>, {names}").repartition(parts)
    return df.withColumn("features", array_to_vector("x")).drop("x")


def sample(n=400, seed=2):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n, 4)), rng.integers(0, 2, (n, 3)), np.zeros((n, 1))], axis=1)
    y = np.stack([3 * (x[:, 0] > .2) + x[:, 4], np.abs(x[:, 1]) * 4, x[:, 2] * (1 - 2 * x[:, 5])], axis=1)
    return x, y + rng.normal(scale=.05, size=y.shape)


def test_least_squares_is_the_least_norm_solution(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 5))
    hot = np.eye(4)[rng.integers(0, 4, 300)]                   # indicators that add up to 1
    x = np.concatenate([base, hot, hot, base[:, :1] * 2, np.ones((300, 1))], axis=1)
    y = base @ np.array([1., -2, 0, 3, .5]) + hot @ np.array([1., 2, 3, 4]) + rng.normal(size=300)
    df = frame(spark, x, np.stack([y] * 3, axis=1))
    model = LeastSquares().setLabelCol("y_tmax").fit(df)
    centred = x - x.mean(axis=0)
    w = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-8)
    assert np.isclose(model.intercept, y.mean() - x.mean(axis=0) @ w)
    got = model.transform(df).orderBy("id").select("prediction").collect()
    assert np.allclose([r[0] for r in got], x @ w + model.intercept)


def plain_tree(codes, w, y, min_leaf):
    """The same greedy tree by exhaustive search over (feature, range)."""
    best = None
    total = (w * y).sum() ** 2 / w.sum()
    for j in range(codes.shape[1]):
        for c in range(codes[:, j].max()):
            low = codes[:, j] <= c
            if low.sum() < min_leaf or (~low).sum() < min_leaf:
                continue
            gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (low, ~low)) - total
            if best is None or gain > best[0] + 1e-9:
                best = (gain, j, c, low)
    if best is None or best[0] <= 1e-9 or np.ptp(y) == 0:
        return np.full(len(y), (w * y).sum() / w.sum())
    out = np.empty(len(y))
    for s in (best[3], ~best[3]):
        out[s] = plain_tree(codes[s], w[s], y[s], min_leaf)
    return out


def test_grown_trees_equal_exhaustive_search():
    x, ys = sample(150)
    ranges = Ranges.of(x, 8)
    codes = ranges.codes(x)
    rng = np.random.default_rng(0)
    for y in ys.T:
        w = rng.integers(1, 4, len(y)).astype(float)
        nodes = {n[0]: n for n in forest.grow(ranges, codes, w, y, 0, 3)}
        got = []
        for r in x:
            n = nodes[0]
            while n[1] >= 0:
                n = nodes[n[3] if r[n[1]] <= n[2] else n[4]]
            got.append(n[5])
        assert np.allclose(got, plain_tree(codes, w, y, 3))
        assert all(n[6] >= 3 for n in nodes.values())


def test_forest_learns_and_predicts_the_mean_of_its_trees(spark, monkeypatch):
    x, y = sample()
    df = frame(spark, x, y)
    model = ForestModel.fit(df, trees=7)
    whole = model.transform(df).orderBy("id").collect()
    pred = np.array([[r[f"pred_{t}"] for t in TARGETS] for r in whole])
    assert (((pred - y) ** 2).mean(axis=0) < .2 * y.var(axis=0)).all()
    sliced = model.transform(df, slice_nodes=model.nodes.count() // 3).orderBy("id").collect()
    assert np.allclose(pred, [[r[f"pred_{t}"] for t in TARGETS] for r in sliced])
    path = scratch_path(spark, "forest-test")
    model.save(path)
    again = ForestModel.load(spark, path).transform(df).orderBy("id").collect()
    assert whole == again
    tops = {r.target: r.feature for r in model.importances().orderBy("importance").collect()}
    assert tops == {"tmax": 0, "tmin": 1, "tavg": 2} or tops["tmax"] == 0


def test_forest_in_passes_equals_forest_in_one_task(spark):
    """Upper nodes split by histograms of all tasks: the same trees as grown at once."""
    x, y = sample(300)
    df = frame(spark, x, y)
    whole = ForestModel.fit(df, trees=3)
    parts = ForestModel.fit(df, trees=3, local_rows=40)
    assert parts.nodes.where("node >= 4294967296").count() > 0
    a, b = (np.array([[r[f"pred_{t}"] for t in TARGETS] for r in m.transform(df).orderBy("id").collect()])
            for m in (whole, parts))
    assert np.allclose(a, b)
    assert np.allclose(a, [[r[f"pred_{t}"] for t in TARGETS]
                           for r in parts.transform(df, slice_nodes=parts.nodes.count() // 3).orderBy("id").collect()])


def test_forest_closes_large_nodes_that_nothing_parts(spark):
    x, y = np.zeros((120, 3)), np.tile([1., 2., 3.], (120, 1))
    df = frame(spark, x, y)
    out = ForestModel.fit(df, trees=2, local_rows=10).transform(df).first()
    assert [out[f"pred_{t}"] for t in TARGETS] == [1., 2., 3.]
    with pytest.raises(ValueError):
        ForestModel.fit(df.limit(0), trees=1)


def test_boosting_starts_at_the_mean_and_shrinks_every_tree(spark):
    """Two rounds of stumps on four rows, by hand: mean 4; residuals -4 -2 0 6."""
    x = np.array([[0.], [1.], [2.], [3.]])
    df = frame(spark, x, np.array([[0., 0, 0], [2, 2, 2], [4, 4, 4], [10, 10, 10]]), parts=2)
    for local in (0, 50_000):
        model = BoostedModel.fit(df, rounds=2, depth=1, shrink=0.1, local_rows=local)
        assert model.start["tmax"] == 4.0
        # round 1: {0, 1, 2} against {3} gains most: -2 and 6; round 2: residuals -3.8 -1.8 .2 5.4
        first, second = model.trees["tmax"]
        assert np.allclose(first.value[1:], [-2, 6]) and first.threshold[0] == 2.5
        assert np.allclose(second.value[1:], [-1.8, 5.4])
        got = [r.pred_tmax for r in model.transform(df).orderBy("id").collect()]
        assert np.allclose(got, [4 - .2 - .18] * 3 + [4 + .6 + .54])
        hist = {r.iteration: r for r in model.history(df.withColumn("split", F.lit("train")).unionByName(
            df.withColumn("split", F.lit("val")))).collect()}
        one = np.array([-3.8, -1.8, .2, 5.4])
        assert np.isclose(hist[0].loss, (one ** 2).mean()) and np.isclose(hist[0].val_mae, np.abs(one).mean())
        assert np.isclose(hist[1].r2, 1 - ((one - [-.18, -.18, -.18, .54]) ** 2).mean() / 14) and len(hist) == 2


def test_boosting_in_passes_equals_boosting_in_one_task(spark):
    x, y = sample(200)
    df = frame(spark, x, y)
    a, b = (BoostedModel.fit(df, rounds=4, local_rows=n) for n in (0, 1000))
    pa, pb = (np.array([[r[f"pred_{t}"] for t in TARGETS] for r in m.transform(df).orderBy("id").collect()]) for m in (a, b))
    assert np.allclose(pa, pb) and (((pa - y) ** 2).mean(axis=0) < y.var(axis=0)).all()
    path = scratch_path(spark, "boost-test")
    a.save(spark, path)
    back = BoostedModel.load(spark, path)
    assert back.trees == a.trees and back.start == a.start


def test_every_candidate_fits_and_predicts(spark):
    x, y = sample(120)
    df = frame(spark, x, y)
    assert list(CANDIDATES) == ["Linear Regression", "Elastic Net", "Decision Tree", "Random Forest", "Gradient Boosting"]
    for name, fit in CANDIDATES.items():
        out = fit(df).transform(df)
        assert out.where(" or ".join(f"pred_{t} is null" for t in TARGETS)).count() == 0, name


def test_stored_model_is_checked_on_load(spark):
    x, y = sample(60)
    df = frame(spark, x[:, :2], y)
    path = scratch_path(spark, "serving-test")
    with pytest.raises(FileNotFoundError):
        ServingModel.load(spark, path)
    models = MultiTarget.fit(df, lambda std: elastic_net(.1, .5, std))
    ServingModel("Elastic Net", models, [("a", 0.0, 1.0), ("b", 1.0, 2.0)], 1).save(spark, path)
    back = ServingModel.load(spark, path, "Elastic Net", ["a", "b"], 1)
    assert back.scaler == [("a", 0.0, 1.0), ("b", 1.0, 2.0)]
    assert back.model.transform(df).select("pred_tavg").collect() == models.transform(df).select("pred_tavg").collect()
    for wrong in (dict(kind="Random Forest"), dict(features=["b", "a"]), dict(T=2)):
        with pytest.raises(ValueError):
            ServingModel.load(spark, path, **wrong)
