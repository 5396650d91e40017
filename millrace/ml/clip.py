"""Outlier clipping: values outside fitted bounds move to the bound, missing values stay missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.clean import clip
from millrace.ml.base import ColumnEstimator, ColumnModel, present


class ClipModel(ColumnModel):
    def expressions(self):
        return {c: clip(present(c), *bounds) if bounds[0] is not None else F.col(c) for c, bounds in self.values.items()}


class IQRClipper(ColumnEstimator):
    """Bounds Q1 - factor * IQR and Q3 + factor * IQR from exact quartiles."""

    model_class = ClipModel

    def __init__(self, columns=(), factor: float = 1.5):
        super().__init__()
        self._configure(columns, factor=factor)

    def quantiles(self):
        return (0.25, 0.75)

    def learn(self, df, scalars, quantiles):
        factor, state = self.settings["factor"], {}
        for c in self.columns:
            q1, q3 = quantiles[c][0.25], quantiles[c][0.75]
            state[c] = [None, None] if q1 is None else [q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)]
        return state


class ZScoreClipper(ColumnEstimator):
    """Bounds mean -/+ threshold * population standard deviation."""

    model_class = ClipModel

    def __init__(self, columns=(), threshold: float = 3.0):
        super().__init__()
        self._configure(columns, threshold=threshold)

    def aggregates(self):
        return {f"{n}_{c}": f(present(c)) for c in self.columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))}

    def learn(self, df, scalars, quantiles):
        t, state = self.settings["threshold"], {}
        for c in self.columns:
            mean, std = scalars[f"mean_{c}"], scalars[f"std_{c}"]
            state[c] = [None, None] if mean is None else [mean - t * std, mean + t * std]
        return state
