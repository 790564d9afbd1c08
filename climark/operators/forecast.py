"""Next-day regressors on flattened windows (Spark ML), multi-target.

The candidates share one feature vector.  Linear models and single trees are one
Spark ML model a target (``MultiTarget``); their predictions are chained ``transform``
calls that each add a ``pred_<target>`` column, so no join is needed to assemble
outputs.  Forest and boosting grow the trees of all targets together (``forest``,
``boosting``).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression,
                                   LinearRegressionModel)
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.operators.boosting import BoostedModel
from climark.operators.forest import ForestModel
from climark.schemas import TARGETS


class LeastSquares:
    """Ordinary least squares with an intercept; where the features are linearly
    dependent, the solution of least norm.

    The covariance of features and label (d + 1 squared numbers) is summed on the
    executors; only it reaches the driver, where eigenvalues below ``RCOND`` of the largest
    count as zero."""

    RCOND = 1e-12

    def __init__(self):
        self.cols = {"features": "features", "label": "label", "prediction": "prediction"}

    def setFeaturesCol(self, name: str) -> LeastSquares:
        self.cols["features"] = name
        return self

    def setLabelCol(self, name: str) -> LeastSquares:
        self.cols["label"] = name
        return self

    def setPredictionCol(self, name: str) -> LeastSquares:
        self.cols["prediction"] = name
        return self

    def fit(self, train: DataFrame) -> LinearRegressionModel:
        both = VectorAssembler(inputCols=[self.cols["features"], self.cols["label"]], outputCol="_both") \
            .transform(train.select(self.cols["features"], self.cols["label"])).select("_both")
        matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(both, "_both"))
        mean = np.asarray(matrix.computeColumnSummaryStatistics().mean())
        cov = matrix.computeCovariance().toArray()
        w = np.linalg.pinv(cov[:-1, :-1], rcond=self.RCOND, hermitian=True) @ cov[:-1, -1]
        return linear_model(train.sparkSession, w, float(mean[-1] - mean[:-1] @ w)) \
            .setFeaturesCol(self.cols["features"]).setPredictionCol(self.cols["prediction"])


def linear_model(spark: SparkSession, coefficients: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A Spark ML linear model with given coefficients."""
    java = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        f"least_squares_{abs(hash((intercept, len(coefficients)))):x}",
        _py2java(spark.sparkContext, Vectors.dense(coefficients)), intercept)
    return LinearRegressionModel(java)


def elastic_net(alpha: float, l1_ratio: float, label_std: float) -> LinearRegression:
    """Minimises 1/(2n) |y - Xw|^2 + alpha l1_ratio |w|_1 + alpha (1 - l1_ratio)/2 |w|^2.

    Without standardization Spark divides the L2 part (only) by the label's
    sample deviation, so that part is multiplied by it beforehand."""
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * label_std
    return LinearRegression(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2), standardization=False,
                            maxIter=500, tol=1e-9)


class MultiTarget:
    """One fitted regressor per target over a shared ``features`` vector."""

    def __init__(self, models: dict[str, object]):
        self.models = models

    @classmethod
    def fit(cls, train: DataFrame, estimator_factory, targets=TARGETS, features_col: str = "features",
            label_prefix: str = "y_") -> MultiTarget:
        stds = train.agg(*[F.coalesce(F.stddev_samp(f"{label_prefix}{t}"), F.lit(0.0)).alias(t) for t in targets]).first()

        def fit_one(t):
            est = estimator_factory(stds[t] or 1.0).setFeaturesCol(features_col).setLabelCol(f"{label_prefix}{t}") \
                .setPredictionCol(f"pred_{t}")
            return t, est.fit(train)

        # the targets' fits are independent Spark jobs: submit them together
        # so their stages share the cluster instead of running back to back
        with ThreadPoolExecutor(max_workers=len(targets)) as pool:
            models = dict(pool.map(fit_one, targets))
        return cls({t: models[t] for t in targets})

    def transform(self, df: DataFrame) -> DataFrame:
        for t, m in self.models.items():
            df = m.setPredictionCol(f"pred_{t}").transform(df)
        return df

    def save(self, path: str) -> None:
        for t, m in self.models.items():
            m.write().overwrite().save(f"{path.rstrip('/')}/{t}")

    @classmethod
    def load(cls, path: str, model_cls, targets=TARGETS) -> MultiTarget:
        return cls({t: model_cls.load(f"{path.rstrip('/')}/{t}") for t in targets})


def coefficients_long(mt: MultiTarget, names: list[str]) -> list[tuple[str, str, float]]:
    """(target, term, value) rows of linear models (bounded: targets x terms)."""
    rows = []
    for t, m in mt.models.items():
        rows.append((t, "intercept", float(m.intercept)))
        rows += [(t, n, float(v)) for n, v in zip(names, m.coefficients.toArray())]
    return rows


def importances_long(mt: MultiTarget, names: list[str]) -> list[tuple[str, str, float]]:
    rows = []
    for t, m in mt.models.items():
        rows += [(t, n, float(v)) for n, v in zip(names, m.featureImportances.toArray())]
    return rows


# --- fixed values: candidate hyper-parameters (as in the reference) -------
# each entry fits all targets on a frame with features and y_<target>; the
# estimators of MultiTarget are built from the label's sample standard deviation
CANDIDATES: dict[str, Callable[[DataFrame], object]] = {
    "Linear Regression": lambda train: MultiTarget.fit(train, lambda std: LeastSquares()),
    "Elastic Net": lambda train: MultiTarget.fit(train, lambda std: elastic_net(0.1, 0.5, std)),
    "Decision Tree": lambda train: MultiTarget.fit(
        train, lambda std: DecisionTreeRegressor(maxDepth=5, minInstancesPerNode=3, seed=123)),
    "Random Forest": lambda train: ForestModel.fit(train, trees=100, min_leaf=3, seed=123),
    "Gradient Boosting": lambda train: BoostedModel.fit(train, rounds=50, depth=3, shrink=0.1),
}
# ---------------------------------------------------------------------------

#: Spark ML classes of the candidates that ``MultiTarget`` holds.
MODEL_CLASSES = {"Linear Regression": LinearRegressionModel, "Elastic Net": LinearRegressionModel,
                 "Decision Tree": DecisionTreeRegressionModel}


@dataclass
class ServingModel:
    """What a forecast needs, stored and loaded together: the fitted models, the scaler,
    the features and the window length."""
    kind: str
    model: MultiTarget
    scaler: list[tuple[str, float, float]]
    T: int

    @property
    def features(self) -> list[str]:
        return [f for f, _, _ in self.scaler]

    def save(self, spark: SparkSession, path: str) -> None:
        """The models first, the description last: a folder without it is no model."""
        base = path.rstrip("/")
        self.model.save(f"{base}/models")
        row = (self.kind, json.dumps(list(self.model.models)), json.dumps(self.scaler), self.T)
        spark.createDataFrame([row], "kind string, targets string, scaler string, T int").coalesce(1) \
            .write.mode("overwrite").parquet(f"{base}/description")

    @classmethod
    def load(cls, spark: SparkSession, path: str, kind: str | None = None, features: list[str] | None = None,
             T: int | None = None) -> ServingModel:
        """The stored model; an error if there is none, or if it is not of the ``kind``, the
        ``features`` or the window length that the caller expects."""
        base = path.rstrip("/")
        try:
            row = spark.read.parquet(f"{base}/description").first()
        except Exception as error:
            raise FileNotFoundError(f"no stored model in {base}") from error
        scaler = [(f, m, s) for f, m, s in json.loads(row["scaler"])]
        for what, want, own in (("type", kind, row["kind"]), ("features", features, [f for f, _, _ in scaler]),
                                ("window length", T, row["T"])):
            if want is not None and want != own:
                raise ValueError(f"the model in {base} has {what} {own}, not {want}")
        if row["kind"] not in MODEL_CLASSES:
            raise ValueError(f"the model in {base} has the unknown type {row['kind']}")
        models = MultiTarget.load(f"{base}/models", MODEL_CLASSES[row["kind"]], json.loads(row["targets"]))
        return cls(row["kind"], models, scaler, row["T"])
