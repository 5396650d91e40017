"""Categorical encoders fitted on training rows.

Low-cardinality encoders keep their categories as parameters. Encoders with a value per category keep a table, however
many categories there are, and join it; the join planner broadcasts it only when its size allows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder as SparkOneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from millrace.functions.keys import key_hash
from millrace.ml.base import ColumnEstimator, ColumnModel, Configured
from millrace.ml.split import hash_prefix, hash_rank
from millrace.session import materialise

MAX_ONE_HOT = 1_000


class OneHotModel(ColumnModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
                 for c, categories in self.values.items() for v in categories}
        return dataset.withColumns(added).drop(*self.columns)


class OneHotEncoder(ColumnEstimator):
    """One 0/1 column per training category, sorted by value; unknown values give all zeros.

    Meant for few categories: more than `max_categories` in a column is an error, never cut off.
    """

    model_class = OneHotModel

    def __init__(self, columns=(), max_categories: int = MAX_ONE_HOT):
        super().__init__()
        self._configure(columns, max_categories=max_categories)

    def learn(self, df, scalars, quantiles):
        limit, state = self.settings["max_categories"], {}
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in self.columns])
        found = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null").distinct()
        rows = found.limit(limit * len(self.columns) + 1).collect()
        for c in self.columns:
            state[c] = sorted(r["v"] for r in rows if r["c"] == c)
            if len(state[c]) > limit:
                raise ValueError(f"{c}: more than {limit} categories, use SparseOneHotEncoder")
        if len(rows) > limit * len(self.columns):
            raise ValueError(f"more than {limit} categories per column, use SparseOneHotEncoder")
        return state


class OrdinalModel(ColumnModel):
    def expressions(self):
        unknown = self.settings["unknown"]
        return {c: F.coalesce(F.when(F.col(c).isNotNull(), F.nullif(
            F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c)).cast("int"), F.lit(0)) - 1), F.lit(unknown))
            for c, order in self.values.items()}


class OrdinalEncoder(ColumnEstimator):
    """Position in a given order of categories; unknown values get `unknown`."""

    model_class = OrdinalModel

    def __init__(self, orders: Mapping[str, Sequence[str]] | None = None, unknown: int = -1):
        super().__init__()
        orders = dict(orders or {})
        self._configure(list(orders), orders=orders, unknown=unknown)

    def learn(self, df, scalars, quantiles):
        return self.settings["orders"]


class HashingModel(ColumnModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        n = self.settings["components"]
        added = {f"{c}_{i}": F.coalesce((F.pmod(key_hash(c, seed="hash"), F.lit(n)) == i).cast("int"), F.lit(0))
                 for c in self.columns for i in range(n)}
        return dataset.withColumns(added).drop(*self.columns)


class HashingEncoder(ColumnEstimator):
    """`components` 0/1 columns, one of them 1 by the hash of the value; nothing is learnt."""

    model_class = HashingModel

    def __init__(self, columns=(), components: int = 8):
        super().__init__()
        self._configure(columns, components=components)

    def learn(self, df, scalars, quantiles):
        return {}


# -- encoders with a value per category ------------------------------------------------------------------------------


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for c in self.instance.columns:
            self.instance.tables[c].write.parquet(f"{path}/tables/{c}")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.tables = {c: self.sparkSession.read.parquet(f"{path}/tables/{c}") for c in model.columns}
        return model


class TableModel(Model, Configured, MLReadable, MLWritable):
    """A category table per column plus a few numbers; saving writes the tables as parquet."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self.tables: dict[str, DataFrame] = {}

    @classmethod
    def fitted(cls, estimator, state: dict, tables: dict[str, DataFrame]):
        model = cls()
        model._set(inputCols=estimator.columns, options=json.dumps(estimator.settings), state=json.dumps(state))
        model.tables = tables
        return model

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)


class _TargetStatistics(Estimator, Configured):
    """Sum and count of the target per category, and the target mean."""

    model: type[TableModel]

    def _fit(self, dataset: DataFrame) -> TableModel:
        y = F.col(self.settings["target"]).cast("double")
        prior = dataset.agg(F.avg(y)).first()[0]
        # Stored, so that transforms do not scan the training rows again.
        tables = {c: materialise(dataset.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_cat"))
                                 .agg(F.sum(y).alias("_sum"), F.count(y).alias("_n")), "targets") for c in self.columns}
        return self.model.fitted(self, {"prior": prior}, tables)


class TargetModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        s, prior, out = self.settings, F.lit(self.values["prior"]), dataset
        for c in self.columns:
            out = out.join(self.tables[c], out[c] == F.col("_cat"), "left")
            n = F.col("_n").cast("double")
            weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(s["min_samples_leaf"]))) / F.lit(float(s["smoothing"]))))
            value = prior * (F.lit(1.0) - weight) + F.col("_sum") / n * weight
            out = out.withColumn(c, F.coalesce(value, prior)).drop("_cat", "_sum", "_n")
        return out


class TargetEncoder(_TargetStatistics):
    """Category mean of the target drawn toward the overall mean when the category is small; unknown -> overall mean."""

    model = TargetModel

    def __init__(self, columns=(), target: str = "target", min_samples_leaf: int = 20, smoothing: float = 10.0):
        super().__init__()
        self._configure(columns, target=target, min_samples_leaf=min_samples_leaf, smoothing=smoothing)


class LeaveOneOutModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Plain category mean, for rows whose target is not used."""
        return self._encode(dataset, None)

    def encode_training(self, dataset: DataFrame) -> DataFrame:
        """For training rows: the mean of the category's other rows; a category of one row gets the overall mean."""
        return self._encode(dataset, F.col(self.settings["target"]).cast("double"))

    def _encode(self, dataset, y):
        prior, out = F.lit(self.values["prior"]), dataset
        for c in self.columns:
            out = out.join(self.tables[c], out[c] == F.col("_cat"), "left")
            if y is None:
                value = F.col("_sum") / F.col("_n")
            else:
                value = F.try_divide(F.col("_sum") - y, (F.col("_n") - 1).cast("double"))
            out = out.withColumn(c, F.coalesce(value, prior)).drop("_cat", "_sum", "_n")
        return out


class LeaveOneOutEncoder(_TargetStatistics):
    """Category mean of the target without the row's own target."""

    model = LeaveOneOutModel

    def __init__(self, columns=(), target: str = "target"):
        super().__init__()
        self._configure(columns, target=target)


class BinaryModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c in self.columns:
            bits = self.values["bits"][c]
            out = out.join(self.tables[c], out[c] == F.col("_cat"), "left")
            code = F.coalesce(F.col("_code"), F.lit(0).cast("bigint"))
            added = {f"{c}_{i}": F.shiftright(code, bits - 1 - i).bitwiseAND(F.lit(1).cast("bigint")).cast("int")
                     for i in range(bits)}
            out = out.withColumns(added).drop("_cat", "_code", c)
        return out


class BinaryEncoder(Estimator, Configured):
    """Category codes 1..n written as bit columns, highest bit first; unknown -> all zeros.

    Codes are ranks in category-hash order, which needs no sort of all categories in one task.
    """

    def __init__(self, columns=()):
        super().__init__()
        self._configure(columns)

    def _fit(self, dataset: DataFrame) -> BinaryModel:
        tables, bits = {}, {}
        for c in self.columns:
            categories = dataset.where(F.col(c).isNotNull()).select(F.col(c).alias("_cat")).distinct()
            tables[c] = materialise(hash_rank(categories, "_cat", seed="code", out="_code"), "codes")
            bits[c] = max(1, int(tables[c].count()).bit_length())
        return BinaryModel.fitted(self, {"bits": bits}, tables)


class SparseOneHotModel(TableModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, out, vectors = self.values["sizes"], dataset, []
        for c in self.columns:
            out = out.join(self.tables[c], out[c] == F.col("_cat"), "left")
            # What the table does not hold takes the place after the last, which the encoder drops.
            out = out.withColumn(f"_at_{c}", F.coalesce(F.col("_code") - 1, F.lit(sizes[c])).cast("double")).drop("_cat", "_code")
            vectors.append(f"_hot_{c}")
        places = [f"_at_{c}" for c in self.columns]
        # The encoder only wants to know how many places there are.
        largest = dataset.sparkSession.range(1).select(*[F.lit(float(max(sizes[c] - 1, 0))).alias(p) for c, p in zip(self.columns, places)])
        encoder = SparkOneHotEncoder(inputCols=places, outputCols=vectors, dropLast=True, handleInvalid="keep").fit(largest)
        joined = VectorAssembler(inputCols=vectors, outputCol=self.settings["out"]).transform(encoder.transform(out))
        return joined.drop(*places, *vectors, *self.columns)


class SparseOneHotEncoder(Estimator, Configured):
    """One sparse vector with a place for every training category of every column, however many there are; unknown: all zeros.

    Categories are numbered in key-hash order and kept as a table that is joined by value, so neither the driver nor the
    expression of a column grows with them.
    """

    def __init__(self, columns=(), out: str = "one_hot"):
        super().__init__()
        self._configure(columns, out=out)

    def _fit(self, dataset: DataFrame) -> SparseOneHotModel:
        tables, sizes = {}, {}
        for c in self.columns:
            categories = dataset.where(F.col(c).isNotNull()).select(F.col(c).alias("_cat")).distinct()
            tables[c] = materialise(hash_rank(categories, "_cat", seed="code", out="_code"), "codes")
            sizes[c] = tables[c].count()
        return SparseOneHotModel.fitted(self, {"sizes": sizes}, tables)


def ordered_target_statistics(
    df: DataFrame, key: str, column: str, target: str, out: str, prior_weight: float = 1.0, seed: int = 42
) -> DataFrame:
    """Running category mean of the target over the rows earlier in key-hash order, started at the overall mean.

    A row's own target never enters its value.
    """
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y).alias("p")).scalar()
    running = hash_prefix(df, key, {"_s": y, "_n": F.lit(1).cast("bigint")}, [column], seed)
    value = (F.col("_s") - y + F.lit(prior_weight) * prior) / ((F.col("_n") - 1).cast("double") + F.lit(prior_weight))
    return running.withColumn(out, value).select(*df.columns, out)
