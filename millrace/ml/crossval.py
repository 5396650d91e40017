"""Cross-validated model comparison: families x settings x folds, scored with the exact ROC-AUC."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.ml.metrics import average_precision, roc_auc
from millrace.ml.models import logistic_regression, score_columns
from millrace.ml.resample import random_over_sample, random_under_sample, smote
from millrace.ml.split import fold_pair
from millrace.operators.profile import with_class_weights
from millrace.operators.relational import best_rows
from millrace.session import materialise

# A family takes settings and the number of training rows and returns an unfitted pipeline.
Family = Callable[..., Pipeline]


def grid(**options: Sequence) -> list[dict]:
    """Every combination of the given option values."""
    return [dict(zip(options, values)) for values in product(*options.values())]


def _fit(train: DataFrame, preprocess: Pipeline | None, family: Family, settings: dict):
    """Preprocessing and model fitted on the same rows; returns a scoring function."""
    ready, before = train, None
    if preprocess is not None:
        before = preprocess.fit(train)
        ready = before.transform(train)
    model = family(rows=train.count(), **settings).fit(ready)

    def score(df: DataFrame) -> DataFrame:
        return score_columns(model.transform(df if before is None else before.transform(df)))

    return score


def fold_scores(
    data: DataFrame, folds: Sequence[int], families: dict[str, Family], grids: dict[str, list[dict]], label: str,
    preprocess: Pipeline | None = None, fold_column: str = "fold", expanding: bool = False, parallelism: int = 4,
) -> DataFrame:
    """(model_family, hyperparams, fold, score). Preprocessing is fitted inside each fold, on its training rows only.

    `data` carries the fold number; with `expanding`, a fold trains on all earlier blocks. Fits are submitted from a
    few driver threads so that small jobs overlap.
    """
    spark = data.sparkSession
    data = materialise(data, "folds")

    def one(task):
        name, settings, fold = task
        train, held = fold_pair(data, fold, fold_column, expanding)
        scored = _fit(train, preprocess, families[name], settings)(held)
        value = roc_auc(scored, label, "p1").first()["roc_auc"]
        return name, str(sorted(settings.items())), fold, value

    tasks = [(name, settings, fold) for name in families for settings in grids[name] for fold in folds]
    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(one), tasks))
    return spark.createDataFrame(rows, "model_family string, hyperparams string, fold int, score double")


def summarise(scores: DataFrame) -> DataFrame:
    """(model_family, hyperparams, mean_score, std_score) with the population standard deviation."""
    return scores.groupBy("model_family", "hyperparams").agg(
        F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))


def best_model(summary: DataFrame) -> DataFrame:
    named = summary.withColumn("_name", F.concat_ws("|", "model_family", "hyperparams"))
    return best_rows("mean_score", "_name")(named).drop("_name")


def refit_and_test(
    train: DataFrame, test: DataFrame, summary: DataFrame, families: dict[str, Family], grids: dict[str, list[dict]],
    label: str, preprocess: Pipeline | None = None,
) -> DataFrame:
    """Fit the best family and settings on all training rows and score the test rows once."""
    best = best_model(summary).first()
    settings = next(s for s in grids[best["model_family"]] if str(sorted(s.items())) == best["hyperparams"])
    scored = _fit(train, preprocess, families[best["model_family"]], settings)(test)
    return roc_auc(scored, label, "p1").select(
        F.lit(best["model_family"]).alias("model_family"), F.lit(best["hyperparams"]).alias("hyperparams"),
        F.lit(best["mean_score"]).alias("mean_score"), F.col("roc_auc").alias("test_score"))


def compare_imbalance_methods(
    train: DataFrame, test: DataFrame, key: str, label: str, features: Sequence[str], seed: int = 42
) -> DataFrame:
    """(method, roc_auc, average_precision) of a logistic model after each way of treating unequal classes."""
    columns = [key, label, *features]
    methods: dict[str, tuple[DataFrame, str | None]] = {
        "as_is": (train, None),
        "smote": (smote(train, key, label, features, seed=seed), None),
        "over_sampled": (random_over_sample(train, key, label, seed), None),
        "under_sampled": (random_under_sample(train, key, label, seed), None),
        "class_weights": (with_class_weights(train, label, "_weight"), "_weight"),
    }
    rows = []
    for name, (data, weight) in methods.items():
        ready = materialise(data.select(*columns, *([weight] if weight else [])), "resampled")
        model = logistic_regression(features, label, rows=ready.count(), weight=weight).fit(ready)
        scored = score_columns(model.transform(test))
        rows.append((name, roc_auc(scored, label, "p1").first()[0], average_precision(scored, label, "p1").first()[0]))
    spark: SparkSession = train.sparkSession
    return spark.createDataFrame(rows, "method string, roc_auc double, average_precision double")
