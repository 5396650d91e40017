"""Scaling by fitted centre and spread: (x - centre) / spread, spread 1 for constant columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml.base import ColumnEstimator, ColumnModel, present


class ScaleModel(ColumnModel):
    def expressions(self):
        return {c: (present(c) - F.lit(centre)) / F.lit(spread) if centre is not None else F.col(c)
                for c, (centre, spread) in self.values.items()}


class _Scaler(ColumnEstimator):
    model_class = ScaleModel

    def __init__(self, columns=()):
        super().__init__()
        self._configure(columns)


class StandardScaler(_Scaler):
    """Centre mean, spread population standard deviation."""

    def aggregates(self):
        return {f"{n}_{c}": f(present(c)) for c in self.columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))}

    def learn(self, df, scalars, quantiles):
        return {c: [scalars[f"mean_{c}"], scalars[f"std_{c}"] or 1.0] for c in self.columns}


class MinMaxScaler(_Scaler):
    """Centre minimum, spread maximum - minimum."""

    def aggregates(self):
        return {f"{n}_{c}": f(present(c)) for c in self.columns for n, f in (("min", F.min), ("max", F.max))}

    def learn(self, df, scalars, quantiles):
        state = {}
        for c in self.columns:
            low, high = scalars[f"min_{c}"], scalars[f"max_{c}"]
            state[c] = [low, 1.0 if low is None else (high - low) or 1.0]
        return state


class RobustScaler(_Scaler):
    """Centre median, spread interquartile range, both exact."""

    def quantiles(self):
        return (0.25, 0.5, 0.75)

    def learn(self, df, scalars, quantiles):
        state = {}
        for c in self.columns:
            q = quantiles[c]
            state[c] = [q[0.5], 1.0 if q[0.5] is None else (q[0.75] - q[0.25]) or 1.0]
        return state
