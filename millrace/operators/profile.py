"""Whole-table profiles, each one scan with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.joins import join_small


LISTED_PER_CHUNK = 10_000


def missing(df: DataFrame, column: str) -> Column:
    """Whether the value is missing: NULL, or NaN in a column of floating-point numbers."""
    value = df[column]
    return value.isNull() | F.isnan(value) if df.schema[column].dataType in (T.DoubleType(), T.FloatType()) else value.isNull()


def numbered(df: DataFrame, times: str, out: str) -> DataFrame:
    """Each row `times` times, numbered from 1; rows with very many repeats are cut into chunks that are spread over tasks."""
    last = F.expr(f"({times} - 1) div {LISTED_PER_CHUNK}")
    chunks = df.where(F.col(times) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("_chunk") * LISTED_PER_CHUNK
    spread = chunks.repartition(*[c for c in chunks.columns])
    return spread.withColumn(out, F.explode(F.sequence(start + 1, F.least(start + LISTED_PER_CHUNK, F.col(times))))).drop("_chunk")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unpivot_row(row: DataFrame, parts: dict[str, dict[str, str]], key: str = "column") -> DataFrame:
    """A one-row aggregate as one row per key: parts maps key -> {output name: aggregate column}."""
    structs = [F.struct(F.lit(k).alias(key), *[F.col(c).alias(o) for o, c in outputs.items()])
               for k, outputs in parts.items()]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum and mean of every numeric column: (column, min, max, mean)."""
    columns = list(columns or numeric_columns(df))
    aggregates = [f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(columns)
                  for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    return unpivot_row(df.agg(*aggregates),
                       {c: {n: f"{n}_{i}" for n in ("min", "max", "mean")} for i, c in enumerate(columns)})


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage per column (NaN is missing); the percentage of an empty table is NULL."""
    columns = list(columns or df.columns)
    aggregates = [F.count_if(missing(df, c)).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    aggregates += [(F.try_divide(F.count_if(missing(df, c)), F.count(F.lit(1))) * 100).alias(f"pct_{i}")
                   for i, c in enumerate(columns)]
    return unpivot_row(df.agg(*aggregates),
                       {c: {"null_count": f"nulls_{i}", "null_pct": f"pct_{i}"} for i, c in enumerate(columns)})


def duplicate_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: total rows, distinct values (a missing value counts as one), duplicates beyond the first."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_values"),
                         F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Every occurrence of a value after its first, counted before it is listed: (value, repeat)."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return numbered(per_value.withColumn("_n", F.col("_n") - 1), "_n", "repeat").select(column, "repeat")


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column: (column, distinct_values).

    The exact form shuffles (column, value) pairs once for all columns.
    """
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)])
        return unpivot_row(row, {c: {"distinct_values": f"d_{i}"} for i, c in enumerate(columns)})
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
        .groupBy("column").agg(F.count("value").alias("distinct_values"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the lowest on ties: (column, value); columns must share one type."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))


WIDE = 40  # columns from which on cross products come from matrix blocks
PARTS = ("n", "si", "sj", "qi", "qj", "p")  # of a pair, over the rows that have both: rows, sums, sums of squares, products


def cross_products(df: DataFrame, columns: Sequence[str], values: Column | None = None) -> DataFrame:
    """`i, j` and PARTS of every column pair i < j, over the rows where both are present, in one scan.

    Each task adds up X'X and the like for batches of rows, with zeros and a presence mask for what is missing, and hands on
    one row per pair; those are summed before and after the shuffle. Values are taken from near their mean (that of a few rows;
    it only steers rounding). `values` may give the row as one array instead of columns.
    """
    width = len(columns)
    row = F.array(*[F.col(c).cast("double") for c in columns]) if values is None else values
    rows = df.select(row.alias("v"))
    few = [r["v"] for r in rows.limit(100).collect()]

    def products(batches):
        import numpy as np
        import pyarrow as pa

        def centre_of(sample):
            known = ~np.isnan(sample)
            return np.where(known, sample, 0.0).sum(0) / np.maximum(known.sum(0), 1)

        centre = centre_of(np.array(few, dtype=float).reshape(-1, width))
        total = np.zeros((4, width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width) - centre
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.triu_indices(width, 1)
        n, s, q, p = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(v) for v in (n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]))],
            names=["i", "j", *PARTS])

    schema = "i int, j int, " + ", ".join(f"{c} double" for c in PARTS)
    return rows.mapInArrow(products, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in PARTS])


def wide_correlations(df: DataFrame, columns: Sequence[str], values: Column | None = None) -> DataFrame:
    """`correlations` for any number of columns; a pair without two rows or without variance has none."""
    found = cross_products(df, columns, values)
    di, dj = (F.col(f"q{k}") - F.col(f"s{k}") * F.col(f"s{k}") / F.col("n") for k in "ij")
    flat = (di <= 1e-12 * F.col("qi")) | (dj <= 1e-12 * F.col("qj")) | (F.col("n") < 2)
    corr = F.when(~flat, (F.col("p") - F.col("si") * F.col("sj") / F.col("n")) / F.sqrt(di * dj))
    names = F.array(*[F.lit(c) for c in columns])
    return found.where("n > 0").select(names[F.col("i")].alias("left"), names[F.col("j")].alias("right"), corr.alias("corr")).unionByName(
        found.where("n = 0").select(names[F.col("i")].alias("left"), names[F.col("j")].alias("right"), F.lit(None).cast("double").alias("corr")))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are present, all pairs in one scan."""
    if len(columns) > WIDE:
        return wide_correlations(df, columns)
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r_{i}").alias("corr"))
               for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the balanced weight n / (classes * n_class): (label, n, weight)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("share"))
    return counts.withColumn("weight", totals.scalar() / F.col("n"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return join_small(df, weights, [label])


def size_check(df: DataFrame) -> DataFrame:
    """Row count and emptiness as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) == 0).alias("is_empty"))
