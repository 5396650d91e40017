"""Voting and stacking over score columns. Base models score the same rows one after another, so no join is needed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.ml.models import logistic_regression, score_columns
from millrace.ml.split import fold_pair, kfold
from millrace.operators.relational import union_all
from millrace.session import materialise

# A builder gets the output prefix and returns an unfitted pipeline.
Builder = Callable[[str], object]


def soft_vote(probabilities: Sequence[str]) -> Column:
    """Mean probability."""
    total = F.col(probabilities[0])
    for p in probabilities[1:]:
        total = total + F.col(p)
    return total / F.lit(float(len(probabilities)))


def hard_vote(labels: Sequence[str]) -> Column:
    """Most frequent label, the lowest on ties."""
    votes = F.array(*[F.col(c) for c in labels])
    ranked = F.transform(F.array_distinct(votes), lambda v: F.struct(
        (-F.size(F.filter(votes, lambda x: x == v))).alias("n"), v.alias("v")))
    return F.array_min(ranked)["v"]


class VotingModel:
    def __init__(self, models: dict[str, object]):
        self.models = models

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds <name>_p1 and <name>_prediction per model, and the votes p1 (soft) and prediction (hard)."""
        for name, model in self.models.items():
            df = score_columns(model.transform(df), f"{name}_")
        return df.withColumn("p1", soft_vote([f"{n}_p1" for n in self.models])).withColumn(
            "prediction", hard_vote([f"{n}_prediction" for n in self.models]))


def fit_voting(train: DataFrame, builders: dict[str, Builder]) -> VotingModel:
    return VotingModel({name: build(f"{name}_").fit(train) for name, build in builders.items()})


class StackingModel:
    def __init__(self, bases: VotingModel, meta):
        self.bases, self.meta = bases, meta

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.bases.transform(df).drop("p1", "prediction")
        return score_columns(self.meta.transform(scored))


def fit_stacking(train: DataFrame, builders: dict[str, Builder], key: str, label: str, folds: int = 5, seed: int = 42) -> StackingModel:
    """Base models score the folds they were not trained on; a logistic model learns from these scores.

    The base models used for scoring are then fitted on all training rows.
    """
    data = materialise(kfold(train, key, folds, stratify=label, seed=seed, out="_fold"), "folds")
    parts = []
    for fold in range(folds):
        fit_rows, held = fold_pair(data, fold, "_fold")
        parts.append(fit_voting(fit_rows, builders).transform(held).drop("p1", "prediction"))
    scores = [f"{n}_p1" for n in builders]
    out_of_fold = materialise(union_all(parts).select(key, label, *scores), "out-of-fold")
    meta = logistic_regression(scores, label, rows=out_of_fold.count()).fit(out_of_fold)
    return StackingModel(fit_voting(train, builders), meta)
