"""Imputation fitted on training rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.ml.base import ColumnEstimator, ColumnModel, Configured, present
from millrace.operators.neighbours import knn_with_gaps
from millrace.session import materialise
from millrace.operators.ordered import forward_fill
from millrace.operators.profile import modes


class FillModel(ColumnModel):
    def expressions(self):
        state = self.values
        out = {f"missing_{c}": F.col(c).isNull().cast("int") if state["text"] else present(c).isNull().cast("int")
               for c in state["flag"]}
        for c, value in state["fill"].items():
            out[c] = F.coalesce(F.col(c) if state["text"] else present(c), F.lit(value))
        return out


class MedianImputer(ColumnEstimator):
    """Exact median of the training rows; `indicators` adds missing_<column> for columns with gaps in training."""

    model_class = FillModel

    def __init__(self, columns=(), indicators: bool = False):
        super().__init__()
        self._configure(columns, indicators=indicators)

    def aggregates(self):
        return {f"gaps_{c}": F.count_if(present(c).isNull()) for c in self.columns}

    def quantiles(self):
        return (0.5,)

    def learn(self, df, scalars, quantiles):
        flags = [c for c in self.columns if self.settings["indicators"] and scalars[f"gaps_{c}"]]
        return {"text": False, "flag": flags, "fill": {c: quantiles[c][0.5] for c in self.columns}}


class ModeImputer(ColumnEstimator):
    """Most frequent value of the training rows, the lowest on ties."""

    model_class = FillModel

    def __init__(self, columns=()):
        super().__init__()
        self._configure(columns)

    def learn(self, df, scalars, quantiles):
        found = {r["column"]: r["value"] for r in modes(df, self.columns).collect()}
        return {"text": True, "flag": [], "fill": {c: found.get(c) for c in self.columns}}


def forward_fill_step(columns: Sequence[str], order: str, tie: str | None = None, by: Sequence[str] = (),
                      fill_start: bool = False):
    """Time-series fill; the order must be named because tables have none."""
    return lambda df: forward_fill(df, columns, order, tie, by, fill_start)


# -- nearest neighbours ----------------------------------------------------------------------------------------------


class KNNImputer(Estimator, Configured):
    """Mean of the k nearest training rows that have the value, weighted by inverse distance.

    Distance is Euclidean over the columns both rows have, scaled up to all columns. Rows sharing no column with any
    donor get the training mean. Any number of columns and of missing patterns: values and masks go through one block kernel.
    """

    def __init__(self, columns=(), key: str = "id", k: int = 5, weights: str = "distance"):
        super().__init__()
        self._configure(columns, key=key, k=k, weights=weights)

    def _fit(self, dataset: DataFrame) -> "KNNImputerModel":
        row = dataset.agg(*[F.avg(present(c)).alias(c) for c in self.columns]).first()
        donors = dataset.select(F.col(self.settings["key"]).cast("bigint").alias("id"),
                                *[present(c).alias(c) for c in self.columns])
        return KNNImputerModel(self.columns, self.settings, donors, row.asDict())


class KNNImputerModel(Model):
    def __init__(self, columns: Sequence[str], settings: dict, donors: DataFrame, means: dict):
        super().__init__()
        self.columns, self.settings, self.donors, self.means = list(columns), settings, donors, means

    def neighbours(self, df: DataFrame, **join_options) -> DataFrame:
        """(query_id, target, donor_id, distance, value): the k nearest donors per row and missing column."""
        def points(table: DataFrame, key: str) -> DataFrame:
            vec = F.array(*[present(c).cast("double") for c in self.columns])
            return materialise(table.select(F.col(key).cast("bigint").alias("id"), vec.alias("vec")), "knn-points")

        return knn_with_gaps(points(df, self.settings["key"]), points(self.donors, "id"), self.settings["k"], **join_options)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, key = self.columns, self.settings["key"]
        near = self.neighbours(dataset).withColumnRenamed("value", "v")
        if self.settings["weights"] == "distance":
            touching = F.count_if(F.col("distance") == 0) > 0
            at_zero = F.avg(F.when(F.col("distance") == 0, F.col("v")))
            positive = F.when(F.col("distance") > 0, F.col("distance"))
            weighted = F.sum(F.col("v") / positive) / F.sum(F.lit(1.0) / positive)
            estimate = F.when(touching, at_zero).otherwise(weighted)
        else:
            estimate = F.avg("v")
        per_target = near.groupBy("query_id", "target").agg(estimate.alias("v"))
        wide = per_target.groupBy("query_id").agg(
            *[F.max(F.when(F.col("target") == i, F.col("v"))).alias(f"_knn_{i}") for i in range(len(columns))])
        joined = dataset.join(wide, F.col(key).cast("bigint") == F.col("query_id"), "left")
        fills = {c: F.coalesce(present(c), F.col(f"_knn_{i}"), F.lit(self.means[c])) for i, c in enumerate(columns)}
        return joined.withColumns(fills).select(*dataset.columns)


# -- chained regressions ---------------------------------------------------------------------------------------------


def _apply_steps(data: np.ndarray, missing: np.ndarray, steps: Sequence[tuple[int, Sequence[float]]]) -> np.ndarray:
    """Run fitted regressions in order: each overwrites the missing entries of one column."""
    for column, coefficients in steps:
        rows = missing[:, column]
        if rows.any():
            others = np.delete(data[rows], column, axis=1)
            data[rows, column] = coefficients[0] + others @ np.asarray(coefficients[1:])
    return data


def _standardised(batch: pd.DataFrame, mean: np.ndarray, std: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = (batch.to_numpy(dtype=np.float64) - mean) / std
    missing = np.isnan(data)
    data[missing] = 0.0  # the mean, after centring
    return data, missing


class MICEImputer(ColumnEstimator):
    """Start from column means; then, up to `max_iter` rounds, regress every gappy column on all others.

    Each regression is one scan that adds up cross products per batch; the driver solves one small system. Earlier
    regressions are replayed inside the scan, so no intermediate table is stored and no lineage grows. Rounds stop
    early once no coefficient (on standardised columns) moves by more than `tol`.
    """

    def __init__(self, columns=(), max_iter: int = 10, tol: float = 1e-3):
        super().__init__()
        self._configure(columns, max_iter=max_iter, tol=tol)

    def _fit(self, dataset: DataFrame) -> "MICEModel":
        columns = self.columns
        table = dataset.select(*[present(c).alias(c) for c in columns]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            row = table.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
                            *[F.count_if(F.col(c).isNull()).alias(f"g_{c}") for c in columns]).first()
            mean = np.array([row[f"m_{c}"] for c in columns])
            std = np.array([row[f"s_{c}"] or 1.0 for c in columns])
            gappy = [i for i, c in enumerate(columns) if row[f"g_{c}"]]
            steps: list[tuple[int, list[float]]] = []
            for _ in range(self.settings["max_iter"] if gappy else 0):
                for i in gappy:
                    steps.append((i, self._regress(table, mean, std, steps, i)))
                if len(steps) > len(gappy):
                    moved = max(np.abs(np.subtract(a[1], b[1])).max()
                                for a, b in zip(steps[-len(gappy):], steps[-2 * len(gappy):]))
                    if moved < self.settings["tol"]:
                        break
        finally:
            table.unpersist()
        return MICEModel.fitted(self, {"mean": mean.tolist(), "std": std.tolist(), "steps": steps})

    @staticmethod
    def _regress(table: DataFrame, mean, std, steps, target: int) -> list[float]:
        size = len(mean)

        def products(batches):
            total = np.zeros((size, size + 1))
            for batch in batches:
                data, missing = _standardised(batch, mean, std)
                data = _apply_steps(data, missing, steps)
                known = data[~missing[:, target]]
                a = np.column_stack([np.ones(len(known)), np.delete(known, target, axis=1)])
                total += a.T @ np.column_stack([a, known[:, target]])
            yield pd.DataFrame([(i, j, total[i, j]) for i in range(size) for j in range(size + 1)], columns=["i", "j", "v"])

        sums = table.mapInPandas(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        system = np.zeros((size, size + 1))
        for r in sums:
            system[r["i"], r["j"]] = r["v"]
        return np.linalg.lstsq(system[:, :-1], system[:, -1], rcond=None)[0].tolist()


class MICEModel(ColumnModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        state, columns = self.values, self.columns
        mean, std = np.array(state["mean"]), np.array(state["std"])
        schema = ", ".join(f"`{c}` double" for c in columns)

        @F.pandas_udf(schema)
        def impute(rows: pd.DataFrame) -> pd.DataFrame:
            data, missing = _standardised(rows, mean, std)
            filled = _apply_steps(data, missing, state["steps"]) * std + mean
            values = rows.to_numpy(dtype=np.float64)
            return pd.DataFrame(np.where(np.isnan(values), filled, values), columns=columns)

        done = dataset.withColumn("_mice", impute(F.struct(*[present(c).alias(c) for c in columns])))
        return done.withColumns({c: F.col("_mice")[c] for c in columns}).drop("_mice")
