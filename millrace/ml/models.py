"""Model families as Spark ML pipelines over plain numeric columns, and scoring with explicit output columns.

A builder takes feature columns, the label column and settings, and returns an unfitted pipeline. Fitted pipelines add
`prediction` (and `probability` for classifiers) under the names given by `output`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from millrace.ml.base import present
from millrace.ml.encode import ordered_target_statistics
from millrace.operators.profile import with_class_weights
from millrace.session import materialise, spread

FEATURES = "_features"
FOREST_BYTES = 200_000_000  # of training rows, as a forest stores them, in one task
COSINE_BLOCK = 512  # rows whose cosine features are held together: about a core's cache


def without_summary(model):
    """Forget the training summary of a fitted Spark model.

    The summary refers to the session; once the session has used an `Observation`, a model that carries one can no longer
    be sent to the tasks (Spark 4.1).
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


class ModelPipeline(Pipeline):
    """A pipeline whose fitted models carry no training summary."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted = super()._fit(dataset)
        for stage in fitted.stages:
            without_summary(stage)
        return fitted


def _pipeline(features: Sequence[str], estimator: Estimator) -> Pipeline:
    return ModelPipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=FEATURES), estimator])


class ForestPipeline(ModelPipeline):
    """A pipeline whose training rows are dealt to tasks by what Spark's forests store of them: a count for each tree and row."""

    trees = 1

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        rows = FOREST_BYTES // (4 * self.trees + 200)
        return super()._fit(spread(dataset, rows) if dataset.count() > rows * dataset.rdd.getNumPartitions() else dataset)


def _classifier_columns(output: str) -> dict:
    return {"featuresCol": FEATURES, "predictionCol": f"{output}prediction", "probabilityCol": f"{output}probability",
            "rawPredictionCol": f"{output}raw"}


def linear_regression(features: Sequence[str], label: str, output: str = "", intercept: bool = True) -> Pipeline:
    """Ordinary least squares."""
    return _pipeline(features, LinearRegression(featuresCol=FEATURES, labelCol=label, fitIntercept=intercept, regParam=0.0,
                                                predictionCol=f"{output}prediction"))


def logistic_regression(
    features: Sequence[str], label: str, rows: int, output: str = "", C: float = 1.0, weight: str | None = None,
    max_iter: int = 1000,
) -> Pipeline:
    """L2-penalised logistic regression, binary or multinomial; `rows` is the number of training rows.

    C weighs the summed loss against half the squared norm; Spark averages the loss, hence regParam = 1 / (C * rows).
    """
    options = _classifier_columns(output) | ({"weightCol": weight} if weight else {})
    return _pipeline(features, LogisticRegression(labelCol=label, family="auto", regParam=1.0 / (C * rows), elasticNetParam=0.0,
                                                  standardization=False, maxIter=max_iter, **options))


def random_forest(features: Sequence[str], label: str, output: str = "", trees: int = 100, weight: str | None = None,
                  max_depth: int = 5, seed: int = 42) -> Pipeline:
    options = _classifier_columns(output) | ({"weightCol": weight} if weight else {})
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=max_depth, seed=seed, **options)
    pipeline = ForestPipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=FEATURES), forest])
    pipeline.trees = trees
    return pipeline


def _boosted(features, label, output, classes, regression, weight, **settings) -> Pipeline:
    if weight:
        settings["weightCol"] = weight
    if regression:
        return _pipeline(features, GBTRegressor(featuresCol=FEATURES, labelCol=label, predictionCol=f"{output}prediction", **settings))
    if classes == 2:
        names = _classifier_columns(output)
        trees = GBTClassifier(featuresCol=FEATURES, labelCol=label, predictionCol=names["predictionCol"], **settings)
        return _pipeline(features, trees.setProbabilityCol(names["probabilityCol"]).setRawPredictionCol(names["rawPredictionCol"]))
    # Spark's boosted classifier is binary: one model per class against the rest.
    settings.pop("weightCol", None)
    single = GBTClassifier(featuresCol=FEATURES, labelCol=label, **settings)
    return _pipeline(features, OneVsRest(classifier=single, featuresCol=FEATURES, labelCol=label,
                                         predictionCol=f"{output}prediction", **({"weightCol": weight} if weight else {})))


def boosted_levelwise(
    features: Sequence[str], label: str, output: str = "", classes: int = 2, regression: bool = False, trees: int = 100,
    learning_rate: float = 0.1, max_depth: int = 6, min_child: int = 1, subsample: float = 0.8, columns: float = 0.8,
    min_gain: float = 0.0, weight: str | None = None, seed: int = 42,
) -> Pipeline:
    """Boosted trees with row and column sampling (leaf penalties are not available)."""
    return _boosted(features, label, output, classes, regression, weight, maxIter=trees, stepSize=learning_rate,
                    maxDepth=max_depth, minInstancesPerNode=min_child, subsamplingRate=subsample,
                    featureSubsetStrategy=str(columns), minInfoGain=min_gain, seed=seed)


def boosted_leafwise(
    features: Sequence[str], label: str, output: str = "", classes: int = 2, regression: bool = False, trees: int = 100,
    learning_rate: float = 0.1, leaves: int = 31, min_child: int = 20, subsample: float = 0.8, columns: float = 0.8,
    weight: str | None = None, seed: int = 42,
) -> Pipeline:
    """Boosted trees limited by leaf count: the depth whose full tree has about that many leaves."""
    return _boosted(features, label, output, classes, regression, weight, maxIter=trees, stepSize=learning_rate,
                    maxDepth=max(1, round(np.log2(leaves))), minInstancesPerNode=min_child, subsamplingRate=subsample,
                    featureSubsetStrategy=str(columns), seed=seed)


class CategoryStatistics(Estimator):
    """Ordered target statistics for training rows; category means drawn to the overall mean for other rows."""

    def __init__(self, columns: Sequence[str], target: str, key: str, prior_weight: float = 1.0):
        super().__init__()
        self.columns, self.target, self.key, self.prior_weight = list(columns), target, key, prior_weight

    def encode_training(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            df = ordered_target_statistics(df, self.key, c, self.target, f"{c}_stat", self.prior_weight)
        return df

    def _fit(self, dataset: DataFrame) -> "CategoryStatisticsModel":
        y = F.col(self.target).cast("double")
        prior = dataset.agg(F.avg(y)).first()[0]
        tables = {c: dataset.groupBy(F.col(c).alias("_cat")).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
                  for c in self.columns}
        return CategoryStatisticsModel(tables, prior, self.prior_weight)


class CategoryStatisticsModel(Model):
    def __init__(self, tables: dict[str, DataFrame], prior: float, prior_weight: float):
        super().__init__()
        self.tables, self.prior, self.prior_weight = tables, prior, prior_weight

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for c, table in self.tables.items():
            value = (F.col("_s") + F.lit(self.prior_weight * self.prior)) / (F.col("_n") + F.lit(self.prior_weight))
            dataset = dataset.join(table, dataset[c].eqNullSafe(table["_cat"]), "left").withColumn(
                f"{c}_stat", F.coalesce(value, F.lit(self.prior))).drop("_cat", "_s", "_n")
        return dataset


def boosted_categorical(
    train: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], label: str, output: str = "",
    classes: int = 2, regression: bool = False, trees: int = 100, learning_rate: float = 0.1, depth: int = 6,
    borders: int = 254, balanced: bool = True, seed: int = 42,
):
    """Fit boosted trees on numeric columns and ordered target statistics of categorical ones.

    Returns a function that scores a table: training rows see only earlier rows of their category, scored rows the
    whole training category.
    """
    statistics = CategoryStatistics(categorical, label, key)
    table = statistics.fit(train)
    ready = statistics.encode_training(train)
    if balanced and not regression:
        ready = with_class_weights(ready, label, "_weight")
    ready = materialise(ready, "encoded")
    features = [*numeric, *[f"{c}_stat" for c in categorical]]
    model = _boosted(features, label, output, classes, regression, "_weight" if balanced and not regression else None,
                     maxIter=trees, stepSize=learning_rate, maxDepth=depth, maxBins=borders, seed=seed).fit(ready)
    return lambda df: model.transform(table.transform(df)).drop(FEATURES, *[f"{c}_stat" for c in categorical])


# -- kernel machines by random features ------------------------------------------------------------------------------


def scale_gamma(df: DataFrame, features: Sequence[str]) -> float:
    """1 / (number of features * variance of all feature values together)."""
    entries = F.explode(F.array(*[present(c) for c in features])).alias("v")
    variance = df.select(entries).agg(F.var_pop("v")).first()[0]
    return 1.0 / (len(features) * variance) if variance else 1.0


def _directions(width: int, gamma: float, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts of the cosine features."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), size=(count, width)), rng.uniform(0.0, 2.0 * np.pi, size=count)


def random_features(df: DataFrame, features: Sequence[str], gamma: float, count: int = 100, seed: int = 42) -> DataFrame:
    """Cosine features whose inner product approximates exp(-gamma * distance^2); the directions are a small constant."""
    directions, shifts = _directions(len(features), gamma, count, seed)
    norm = float(np.sqrt(2.0 / count))
    added = {}
    for j in range(count):
        terms = " + ".join(f"{float(w)!r}D * `{c}`" for w, c in zip(directions[j], features))
        added[f"_rf_{j}"] = F.expr(f"{norm!r}D * cos({float(shifts[j])!r}D + {terms})")
    wide = df.withColumns(added)
    return VectorAssembler(inputCols=list(added), outputCol=FEATURES).transform(wide).drop(*added)


def cosine_blocks(width: int, gamma: float, count: int = 100, seed: int = 42):
    """The numbers of `random_features` inside tasks: a function from an array of rows to blocks (first row, cosine features).

    For passes that use the features and forget them, which takes neither memory nor disk for them. The function carries its
    own code; a missing or infinite number fails, as it does in a vector.
    """
    directions, shifts = _directions(width, gamma, count, seed)
    turns, start, norm = directions.T / (2.0 * np.pi), shifts / (2.0 * np.pi), float(np.sqrt(2.0 / count))
    # cos(2 pi t) for t in [-0.5, 0.5]: the series of a quarter of the angle, doubled twice. As exact as numpy's and faster.
    series = [(-1) ** k * (np.pi / 2.0) ** (2 * k) / math.factorial(2 * k) for k in range(9)]
    size = COSINE_BLOCK

    def blocks(rows: np.ndarray):
        if not np.isfinite(rows).all():
            raise ValueError("a feature is missing or infinite")
        for first in range(0, len(rows), size):
            t = rows[first:first + size] @ turns
            t += start
            t -= np.rint(t)
            t *= t
            out = t * series[-1]
            for c in series[-2:0:-1]:
                out += c
                out *= t
            out += 1.0
            for _ in range(2):
                out *= out
                out *= 2.0
                out -= 1.0
            out *= norm
            yield first, out

    return blocks


def fit_huber(rows: DataFrame, blocks, count: int, C: float, epsilon: float = 1.35, max_iter: int = 100, tol: float = 1e-6):
    """Weights, intercept and scale of a robust linear fit on `count` cosine features of a row, whose last column is the label.

    The minimum of Spark's Huber regression, which is convex in all of them together: the mean of (s + r^2 / s) / 2 over rows whose
    residual r is at most epsilon * s, and of epsilon * |r| + s * (1 - epsilon^2) / 2 over the others, plus the squared weights of the
    standardised features / (2 * C * rows). Newton steps need some ten passes instead of hundreds, as a pass adds up the
    curvature too, and features are made anew in each, so nothing but the rows themselves is kept. Ends where the minimum is at most
    about a share `tol` away.
    """
    few = np.array([tuple(r) for r in rows.limit(1000).collect()], dtype=float)
    if not len(few):
        raise ValueError("no training rows")
    centre, level = np.concatenate([b for _, b in blocks(few[:, :-1])]).mean(0), few[:, -1].mean()  # they only steer rounding
    size = count + 2

    def totals(weights, intercept, cut):
        """Over the rows within `cut`, products of (centred features, 1, residual); over the others, their sums by the residual's sign."""

        def add(batches):
            import pyarrow as pa

            products, sums = np.zeros((size, size)), np.zeros(size)
            for batch in batches:
                table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                if np.isnan(table[:, -1]).any():
                    raise ValueError("a label is missing")
                for first, features in blocks(table[:, :-1]):
                    features -= centre
                    residual = features @ weights + intercept - (table[first:first + len(features), -1] - level)
                    row = np.column_stack([features, np.ones(len(features)), residual])
                    near = np.abs(residual) <= cut
                    inside = row if near.all() else row[near]
                    products += inside.T @ inside
                    if len(inside) < len(row):
                        sums += np.where(near, 0.0, np.sign(residual)) @ row
            both = np.vstack([products, sums]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(both.size), pa.int32()), pa.array(both)], names=["i", "v"])

        both = np.zeros((size + 1) * size)
        for r in rows.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            both[r["i"]] = r["v"]
        return both[:-size].reshape(size, size), both[-size:]

    products, _ = totals(np.zeros(count), 0.0, np.inf)
    n, label = products[count, count], -products[count, -1] / products[count, count]
    around = products[:count, :count] / n - np.outer(products[count, :count], products[count, :count]) / n**2
    spread_of = np.sqrt(np.maximum(np.diag(around), 0.0) * n / max(n - 1, 1))
    used = spread_of > 1e-10  # a constant feature has no weight
    spread_label = np.sqrt(max(products[-1, -1] / n - label**2, 0.0))
    if spread_label <= 1e-12 * max(abs(level + label), 1e-300):
        return np.zeros(count), level + label, 1.0
    penalty = 1.0 / (C * n)
    unit = np.where(used, 1.0 / np.where(used, spread_of, 1.0), 0.0)
    ridge = np.append(np.full(count, penalty), [0.0, 0.0])

    def weights_of(point):
        return point[:count] * unit

    def looked_at(point):
        """Value, gradient and curvature there."""
        s = point[-1]
        products, sums = totals(weights_of(point), point[count], epsilon * s)
        inside = products[count, count]
        value = ((inside + (n - inside) * (1.0 - epsilon**2)) * s + products[-1, -1] / s + 2.0 * epsilon * sums[-1]) / (2.0 * n)
        by = np.append(unit, 1.0)
        slope = np.append((products[:-1, -1] / s + epsilon * sums[:-1]) / n * by,
                          (inside - products[-1, -1] / s**2 + (n - inside) * (1.0 - epsilon**2)) / (2.0 * n))
        by = np.append(by, -1.0 / s)
        return value + ridge @ point**2 / 2.0, slope + ridge * point, products * np.outer(by, by) / (n * s) + np.diag(ridge)

    # From least squares, penalised as at the label's own scale.
    by = np.append(unit, 1.0)
    gram, cross = products[:-1, :-1] * np.outer(by, by) / n, -products[:-1, -1] * by / n
    start = np.linalg.lstsq(gram + np.diag(ridge[:-1]) * spread_label, cross, rcond=None)[0]
    left = products[-1, -1] / n - 2.0 * start @ cross + start @ gram @ start
    point = np.append(start, max(np.sqrt(max(left, 0.0)), 1e-6 * spread_label))
    value, slope, curvature = looked_at(point)
    for _ in range(max_iter):
        step = np.linalg.lstsq(curvature, -slope, rcond=None)[0]
        gain = -slope @ step
        if gain / 2.0 <= tol * abs(value) or point[-1] <= 1e-9 * spread_label:
            break
        length = min(1.0, 0.9 * point[-1] / -step[-1]) if step[-1] < 0.0 else 1.0  # the scale stays above 0
        for _ in range(20):
            ahead = point + length * step
            found = looked_at(ahead)
            if found[0] <= value - 1e-4 * length * gain:
                break
            length /= 2.0
        else:
            break
        point, (value, slope, curvature) = ahead, found
    weights = weights_of(point)
    return weights, level + point[count] - weights @ centre, float(point[-1])


class KernelRegressionModel:
    """A linear model on random features that are made where they are used; `transform` adds the prediction."""

    def __init__(self, weights, intercept, scale, features, gamma, count, seed, output):
        self.weights, self.intercept, self.scale = weights, intercept, scale
        self.features, self.gamma, self.count, self.seed, self.output = list(features), gamma, count, seed, output

    def transform(self, df: DataFrame) -> DataFrame:
        blocks = cosine_blocks(len(self.features), self.gamma, self.count, self.seed)
        weights, intercept = self.weights, float(self.intercept)

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            found = np.empty(len(rows))
            for first, features in blocks(rows.to_numpy(dtype=float)):
                found[first:first + len(features)] = features @ weights + intercept
            return pd.Series(found)

        return df.withColumn(f"{self.output}prediction", predict(F.struct(*[
            F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])))


class KernelModel:
    """A linear model on random features; `transform` adds prediction (and probability) columns."""

    def __init__(self, stages, features, gamma, count, seed, output):
        self.stages, self.features, self.gamma, self.count, self.seed, self.output = stages, features, gamma, count, seed, output

    def transform(self, df: DataFrame) -> DataFrame:
        out = random_features(df, self.features, self.gamma, self.count, self.seed)
        for stage in self.stages:
            out = stage.transform(out)
        return out.drop(FEATURES, "_margin", f"{self.output}raw", "_margin_raw")


def kernel_regression(
    train: DataFrame, features: Sequence[str], label: str, output: str = "", C: float = 1.0, gamma: float | None = None,
    count: int = 100, max_iter: int = 100, seed: int = 42,
) -> KernelRegressionModel:
    """Robust regression in the feature space of an RBF kernel (Huber loss takes the place of the tube)."""
    rows = train.select(*dict.fromkeys([*features, label])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gamma = scale_gamma(rows, features) if gamma is None else gamma
        plain = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*features, label])])
        blocks = cosine_blocks(len(features), gamma, count, seed)
        fitted = fit_huber(plain, blocks, count, C, max_iter=max_iter)
    finally:
        rows.unpersist()
    return KernelRegressionModel(*fitted, features, gamma, count, seed, output)


def kernel_classifier(
    train: DataFrame, features: Sequence[str], label: str, output: str = "", C: float = 1.0, gamma: float | None = None,
    balanced: bool = True, count: int = 100, max_iter: int = 100, seed: int = 42,
) -> KernelModel:
    """Maximum-margin classifier in the feature space of an RBF kernel; a logistic fit turns margins into probabilities."""
    gamma = scale_gamma(train, features) if gamma is None else gamma
    ready = random_features(train, features, gamma, count, seed)
    weight = {}
    if balanced:
        ready, weight = with_class_weights(ready, label, "_weight"), {"weightCol": "_weight"}
    rows = train.count()
    svm = without_summary(LinearSVC(featuresCol=FEATURES, labelCol=label, regParam=1.0 / (C * rows), maxIter=max_iter,
                    predictionCol=f"{output}prediction", rawPredictionCol="_margin_raw", **weight).fit(ready))
    margins = VectorAssembler(inputCols=["_m"], outputCol="_margin")

    class Margin(Model):
        def _transform(self, dataset):
            return margins.transform(dataset.withColumn("_m", vector_to_array("_margin_raw")[1])).drop("_m")

    margin = Margin()
    platt = LogisticRegression(featuresCol="_margin", labelCol=label, probabilityCol=f"{output}probability",
                               rawPredictionCol=f"{output}raw", predictionCol="_platt").fit(margin.transform(svm.transform(ready)))
    return KernelModel([svm, margin, without_summary(platt)], features, gamma, count, seed, output)


def score_columns(df: DataFrame, output: str = "", classes: Sequence[int] = (1,)) -> DataFrame:
    """Class probabilities as plain columns `<output>p<class>`."""
    p = vector_to_array(f"{output}probability")
    return df.withColumns({f"{output}p{c}": p[c] for c in classes}).drop(f"{output}probability", f"{output}raw", FEATURES)
