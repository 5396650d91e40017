"""Feature selection: score tables computed in one scan, and selectors that keep a subset of the input columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.ml.base import ColumnEstimator, ColumnModel, present
from millrace.ml.metrics import accuracy_value
from millrace.ml.models import without_summary
from millrace.ml.split import fold_pair, kfold
from millrace.operators.profile import correlations, unpivot_row
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.relational import best_rows
from millrace.session import materialise, spread

# -- scores: (feature, score) ----------------------------------------------------------------------------------------


def variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population variance."""
    row = df.agg(*[F.var_pop(present(c)).alias(f"v_{i}") for i, c in enumerate(features)])
    return unpivot_row(row, {c: {"score": f"v_{i}"} for i, c in enumerate(features)}, "feature")


def _by_class(df: DataFrame, features: Sequence[str], label: str, measures: dict[str, Callable]) -> DataFrame:
    """(feature, label, n, measures...): class statistics of every feature from one aggregation."""
    per = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(present(c)).alias(f"{m}_{i}") for i, c in enumerate(features) for m, f in measures.items()])
    entries = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
               for i, c in enumerate(features)]
    return per.select("label", "n", F.explode(F.array(*entries)).alias("e")).select("label", "n", "e.*")


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F statistic of each feature between classes."""
    stats = _by_class(df, features, label, {"mean": F.avg, "var": F.var_pop})
    n = F.col("n").cast("double")
    whole = stats.groupBy("feature").agg((F.sum(n * F.col("mean")) / F.sum(n)).alias("_grand"))
    joined = stats.join(whole, "feature")
    between = F.sum(n * (F.col("mean") - F.col("_grand")) * (F.col("mean") - F.col("_grand")))
    within = F.sum(n * F.col("var"))
    classes, rows = F.count(F.lit(1)).cast("double"), F.sum(n)
    return joined.groupBy("feature").agg(
        F.try_divide(between / (classes - F.lit(1.0)), within / (rows - classes)).alias("score"))


def regression_f(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """F statistic of the single-feature linear regression."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(present(c), present(target)).alias(f"r_{i}")
                                                 for i, c in enumerate(features)])
    freedom = F.col("n").cast("double") - F.lit(2.0)
    scored = row.select(*[F.try_divide(F.col(f"r_{i}") * F.col(f"r_{i}") * freedom,
                                       F.lit(1.0) - F.col(f"r_{i}") * F.col(f"r_{i}")).alias(f"f_{i}")
                          for i in range(len(features))])
    return unpivot_row(scored, {c: {"score": f"f_{i}"} for i, c in enumerate(features)}, "feature")


def chi2(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Class sums of a non-negative feature against the sums expected from the class shares."""
    stats = _by_class(df, features, label, {"observed": F.sum})
    totals = stats.groupBy("feature").agg(F.sum("observed").alias("_total"), F.sum("n").alias("_rows"))
    expected = F.col("_total") * F.col("n").cast("double") / F.col("_rows").cast("double")
    gap = F.col("observed") - expected
    return stats.join(totals, "feature").groupBy("feature").agg(F.sum(F.try_divide(gap * gap, expected)).alias("score"))


def bin_number(c: str, cuts: Sequence[float]) -> Column:
    """How many cut points lie below the value."""
    return reduce(lambda a, b: a + b, [(present(c) > F.lit(float(x))).cast("int") for x in cuts], F.lit(0))


def _information(joint: DataFrame) -> DataFrame:
    """Mutual information in nats from (feature, x, y, n) counts; the table holds bins x classes rows per feature."""
    n = F.col("n").cast("double")
    every = Window.partitionBy("feature")
    counted = joint.select("feature", n.alias("n"), F.sum(n).over(every).alias("t"),
                           F.sum(n).over(Window.partitionBy("feature", "x")).alias("nx"),
                           F.sum(n).over(Window.partitionBy("feature", "y")).alias("ny"))
    share = F.col("n") / F.col("t")
    return counted.groupBy("feature").agg(
        F.sum(share * F.ln(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))).alias("score"))


BINNED_AT_ONCE = 4  # features whose bins are counted together: at most bins ** 4 counts of each class in a task


def mutual_information(
    df: DataFrame, features: Sequence[str], target: str, continuous_target: bool = False, bins: int = 10
) -> DataFrame:
    """Plug-in mutual information over equal-frequency bins of each feature (and of a continuous target)."""
    probs = [i / bins for i in range(1, bins)]
    columns = [*features, *([target] if continuous_target else [])]
    cuts = {c: sorted(set(v)) for c, v in exact_quantiles(df, columns, probs).items()}
    y = bin_number(target, cuts[target]) if continuous_target else F.col(target)

    def counts(some: Sequence[str]) -> DataFrame:
        # Rows are counted by all bins of a few features at once; only these counts are listed feature by feature.
        binned = df.groupBy(*[bin_number(c, cuts[c]).alias(f"x_{i}") for i, c in enumerate(some)], y.alias("y")).agg(
            F.count(F.lit(1)).alias("n"))
        entries = [F.struct(F.lit(c).alias("feature"), F.col(f"x_{i}").alias("x")) for i, c in enumerate(some)]
        return binned.select(F.explode(F.array(*entries)).alias("e"), "y", "n").select("e.*", "y", "n")

    parts = [counts(features[i:i + BINNED_AT_ONCE]) for i in range(0, len(features), BINNED_AT_ONCE)]
    joint = reduce(DataFrame.unionByName, parts).groupBy("feature", "x", "y").agg(F.sum("n").alias("n"))
    return _information(joint)


SCORERS: dict[str, Callable[..., DataFrame]] = {
    "f_classif": anova_f,
    "f_regression": regression_f,
    "chi2": chi2,
    "mutual_info_classif": mutual_information,
    "mutual_info_regression": lambda df, features, target: mutual_information(df, features, target, True),
}

# -- selectors -------------------------------------------------------------------------------------------------------


class SubsetModel(ColumnModel):
    """Drops the input columns that were not kept."""

    @property
    def kept(self) -> list[str]:
        return self.values["kept"]

    @property
    def scores(self) -> dict[str, float]:
        return self.values.get("scores", {})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = set(self.kept)
        return dataset.drop(*[c for c in self.columns if c not in kept])


class _Selector(ColumnEstimator):
    model_class = SubsetModel

    def _kept(self, scores: dict[str, float], kept) -> dict:
        return {"kept": [c for c in self.columns if c in set(kept)], "scores": scores}


class VarianceThreshold(_Selector):
    """Keep columns whose population variance is above the threshold."""

    def __init__(self, columns=(), threshold: float = 0.01):
        super().__init__()
        self._configure(columns, threshold=threshold)

    def aggregates(self):
        return {c: F.var_pop(present(c)) for c in self.columns}

    def learn(self, df, scalars, quantiles):
        limit = self.settings["threshold"]
        return self._kept(scalars, [c for c in self.columns if scalars[c] is not None and scalars[c] > limit])


class SelectKBest(_Selector):
    """Keep the k columns with the best score, ties by name."""

    def __init__(self, columns=(), label: str = "label", scorer: str = "f_classif", k: int = 10):
        super().__init__()
        self._configure(columns, label=label, scorer=scorer, k=k)

    def learn(self, df, scalars, quantiles):
        table = SCORERS[self.settings["scorer"]](df, self.columns, self.settings["label"])
        scores = {r["feature"]: r["score"] for r in best_rows("score", "feature", len(self.columns))(table).collect()}
        return self._kept(scores, list(scores)[: self.settings["k"]])


def correlated_columns(pairs: dict[tuple[str, str], float | None], columns: Sequence[str], threshold: float) -> list[str]:
    """Columns whose absolute correlation with any earlier column, kept or not, is above the threshold."""
    return [b for j, b in enumerate(columns)
            if any(pairs.get((a, b)) is not None and abs(pairs[a, b]) > threshold for a in columns[:j])]


class CorrelationDropper(_Selector):
    def __init__(self, columns=(), threshold: float = 0.95):
        super().__init__()
        self._configure(columns, threshold=threshold)

    def learn(self, df, scalars, quantiles):
        pairs = {(r["left"], r["right"]): r["corr"] for r in correlations(df, self.columns).collect()}
        doomed = correlated_columns(pairs, self.columns, self.settings["threshold"])
        return self._kept({}, [c for c in self.columns if c not in doomed])


def _assembled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    ready = df.select(*[present(c).alias(c) for c in features], F.col(label).cast("double").alias("_label"))
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(ready).select("_features", "_label")


def lasso_weights(df: DataFrame, features: Sequence[str], label: str, alpha: float) -> dict[str, float]:
    """Absolute coefficients of a least-squares fit with an L1 penalty on the columns as they are."""
    model = LinearRegression(featuresCol="_features", labelCol="_label", regParam=alpha, elasticNetParam=1.0,
                             standardization=False, maxIter=1000).fit(_assembled(df, features, label))
    return {c: abs(float(w)) for c, w in zip(features, model.coefficients)}


def _forest(df: DataFrame, features: Sequence[str], label: str, trees: int, seed: int):
    return RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=trees, seed=seed).fit(
        _assembled(df, features, label))


def _importances(model, features: Sequence[str]) -> dict[str, float]:
    return {c: float(w) for c, w in zip(features, model.featureImportances.toArray())}


def forest_importances(df: DataFrame, features: Sequence[str], label: str, trees: int, seed: int) -> dict[str, float]:
    return _importances(_forest(df, features, label, trees, seed), features)


class LassoSelector(_Selector):
    """Keep columns whose absolute Lasso coefficient is at least the median one."""

    def __init__(self, columns=(), label: str = "label", alpha: float = 0.01):
        super().__init__()
        self._configure(columns, label=label, alpha=alpha)

    def learn(self, df, scalars, quantiles):
        weights = lasso_weights(df, self.columns, self.settings["label"], self.settings["alpha"])
        limit = float(np.median(list(weights.values())))
        return self._kept(weights, [c for c, w in weights.items() if w >= limit])


class ForestSelector(_Selector):
    """Keep columns whose forest importance is at least the mean one."""

    def __init__(self, columns=(), label: str = "label", trees: int = 100, seed: int = 42):
        super().__init__()
        self._configure(columns, label=label, trees=trees, seed=seed)

    def learn(self, df, scalars, quantiles):
        s = self.settings
        weights = forest_importances(df, self.columns, s["label"], s["trees"], s["seed"])
        limit = float(np.mean(list(weights.values())))
        return self._kept(weights, [c for c, w in weights.items() if w >= limit])


def _weakest_first(weights: dict[str, float]) -> list[str]:
    return sorted(weights, key=lambda c: (weights[c], c))


def eliminate(df: DataFrame, features: Sequence[str], label: str, keep: int, step: int, trees: int, seed: int,
              seen: Callable | None = None) -> list[list[str]]:
    """Feature sets from all features down to `keep`, dropping the `step` weakest after each forest fit.

    `seen(features, forest)`, if given, gets every set with its forest, the last set too; a set is fitted once.
    """
    sets = [list(features)]
    while True:
        now = sets[-1]
        more = len(now) > keep
        if not more and seen is None:
            return sets
        forest = _forest(df, now, label, trees, seed)
        if seen is not None:
            seen(now, forest)
        if not more:
            return sets
        weak = _weakest_first(_importances(forest, now))[: min(step, len(now) - keep)]
        sets.append([c for c in now if c not in weak])


class RFE(_Selector):
    """Recursive elimination down to `n_features` columns."""

    def __init__(self, columns=(), label: str = "label", n_features: int = 10, step: int = 1, trees: int = 100, seed: int = 42):
        super().__init__()
        self._configure(columns, label=label, n_features=n_features, step=step, trees=trees, seed=seed)

    def learn(self, df, scalars, quantiles):
        s = self.settings
        stored = materialise(spread(df.select(*self.columns, s["label"])), "features")
        sets = eliminate(stored, self.columns, s["label"], s["n_features"], s["step"], s["trees"], s["seed"])
        return self._kept({}, sets[-1])


class RFECV(_Selector):
    """Recursive elimination whose size is chosen by the mean accuracy over k folds; the fewest features win ties."""

    def __init__(self, columns=(), label: str = "label", key: str = "id", step: int = 1, min_features: int = 5,
                 folds: int = 5, trees: int = 100, seed: int = 42):
        super().__init__()
        self._configure(columns, label=label, key=key, step=step, min_features=min_features, folds=folds, trees=trees, seed=seed)

    def learn(self, df, scalars, quantiles):
        s = self.settings
        data = kfold(df.select(s["key"], *self.columns, s["label"]), s["key"], s["folds"], stratify=s["label"])
        data = materialise(spread(data), "folds")  # in even files, for the many passes of the fits
        # Sizes are compared on eliminations made inside each fold's training rows.
        table: dict[int, list[float]] = {}
        for fold in range(s["folds"]):
            train, held = fold_pair(data, fold)

            def score(chosen, forest, held=held):
                scored = without_summary(forest).transform(_assembled(held, chosen, s["label"]))
                table.setdefault(len(chosen), []).append(accuracy_value(scored, "_label", "prediction"))

            eliminate(train, self.columns, s["label"], s["min_features"], s["step"], s["trees"], s["seed"], score)
        best = max(table, key=lambda n: (np.mean(table[n]), -n))
        sets = eliminate(data, self.columns, s["label"], best, s["step"], s["trees"], s["seed"])
        state = self._kept({}, sets[-1])
        state["fold_scores"] = {str(n): scores for n, scores in table.items()}
        return state


class ConsensusSelector(_Selector):
    """Keep columns that at least `min_votes` selectors keep. Selectors must read the same columns."""

    def __init__(self, selectors: Sequence[tuple[str, _Selector]] = (), min_votes: int = 2):
        super().__init__()
        self.selectors = list(selectors)
        self._configure(self.selectors[0][1].columns if self.selectors else [], min_votes=min_votes)

    def learn(self, df, scalars, quantiles):
        votes = {c: 0 for c in self.columns}
        for _, selector in self.selectors:
            for c in selector.fit(df).kept:
                votes[c] += 1
        return self._kept({c: float(v) for c, v in votes.items()},
                          [c for c, v in votes.items() if v >= self.settings["min_votes"]])
