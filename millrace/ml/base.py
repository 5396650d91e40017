"""Estimators whose fitted state is a few numbers per column.

Such estimators say which aggregates and quantiles they need; `fit_together` collects the needs of several of them and
fits all from one aggregation and one shared quantile search.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.quantiles import exact_quantiles


class Configured(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Options travel as one JSON parameter, so `write().save()` and `load()` keep them."""

    options = Param(Params._dummy(), "options", "settings as JSON", TypeConverters.toString)

    def _configure(self, columns: Sequence[str], **settings):
        self._set(inputCols=list(columns), options=json.dumps(settings))
        return self

    @property
    def settings(self) -> dict:
        return json.loads(self.getOrDefault("options"))

    @property
    def columns(self) -> list[str]:
        return self.getInputCols()


class ColumnModel(Model, Configured):
    """A model that rewrites or adds columns by expressions; `state` is the fitted numbers."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    @classmethod
    def fitted(cls, estimator: "ColumnEstimator", state: dict):
        model = cls()
        model._set(inputCols=estimator.columns, options=json.dumps(estimator.settings), state=json.dumps(state))
        return model

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def expressions(self) -> dict[str, Column]:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(self.expressions())


class ColumnEstimator(Estimator, Configured):
    model_class: type[ColumnModel]

    def aggregates(self) -> dict[str, Column]:
        """Named scalar aggregates over the training table."""
        return {}

    def quantiles(self) -> Sequence[float]:
        """Probabilities wanted for each input column."""
        return ()

    def learn(self, df: DataFrame, scalars: dict, quantiles: dict[str, dict[float, float]]) -> dict:
        """The fitted state from the collected numbers."""
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> ColumnModel:
        return fit_together(dataset, [self])[0]


def fit_together(df: DataFrame, estimators: Sequence[ColumnEstimator]) -> list[ColumnModel]:
    """Fit independent estimators on the same table with shared scans."""
    wanted = {f"{i}:{name}": column for i, e in enumerate(estimators) for name, column in e.aggregates().items()}
    row = df.agg(*[c.alias(n) for n, c in wanted.items()]).first() if wanted else {}
    columns = sorted({c for e in estimators if e.quantiles() for c in e.columns})
    probs = sorted({p for e in estimators for p in e.quantiles()})
    found = exact_quantiles(df, columns, probs) if columns else {}
    by_prob = {c: dict(zip(probs, v)) for c, v in found.items()}
    models = []
    for i, e in enumerate(estimators):
        scalars = {name: row[f"{i}:{name}"] for name in e.aggregates()}
        models.append(e.model_class.fitted(e, e.learn(df, scalars, by_prob)))
    return models


class Step(Transformer):
    """A plain table step, a function from DataFrame to DataFrame, as a stage that needs no fitting."""

    def __init__(self, step: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.step = step

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.step(dataset)


def _shares_scans(stage) -> bool:
    """Column estimators that are fitted from aggregates and quantiles alone."""
    return isinstance(stage, ColumnEstimator) and type(stage)._fit is ColumnEstimator._fit


class ColumnRouter(Estimator):
    """Different estimators for different columns, fitted on the same input; other columns pass through.

    Column estimators share their scans; any other estimator is fitted on its own. Steps without a fit, functions or
    transformers, may stand among them.
    """

    def __init__(self, stages: Sequence[Estimator]):
        super().__init__()
        self.stages = list(stages)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        simple = [s for s in self.stages if _shares_scans(s)]
        fitted = iter(fit_together(dataset, simple) if simple else [])

        def ready(stage):
            if _shares_scans(stage):
                return next(fitted)
            if isinstance(stage, Estimator):
                return stage.fit(dataset)
            return stage if isinstance(stage, Transformer) else Step(stage)

        return PipelineModel([ready(s) for s in self.stages])


def preprocessing(*stages) -> Pipeline:
    """Stages one after another, each fitted on the output of the ones before it."""
    return Pipeline(stages=list(stages))


def present(c: str) -> Column:
    """A number with NaN read as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
