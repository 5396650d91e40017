"""Joins, grouping, distinct, ordering and set operations with the frame semantics of missing values."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import join_small

Step = Callable[[DataFrame], DataFrame]


def left_join(other: DataFrame, on: str, null_safe: bool = False) -> Step:
    """Left outer equi-join; rows fan out over repeated keys. Adaptive execution picks broadcast or splits hot keys.

    With `null_safe`, missing keys match each other.
    """
    if not null_safe:
        return lambda df: df.join(other, on, "left")

    def step(df: DataFrame) -> DataFrame:
        right = other.withColumnRenamed(on, "_right_key")
        return df.join(right, df[on].eqNullSafe(right["_right_key"]), "left").drop("_right_key")

    return step


def absent_from(reference: DataFrame, column: str, ref_column: str, null_safe: bool = True) -> Step:
    """Rows whose value does not occur in the reference column; by default a missing value can occur there too."""
    keys = reference.select(F.col(ref_column).alias("_ref")).distinct()

    def step(df: DataFrame) -> DataFrame:
        match = df[column].eqNullSafe(keys["_ref"]) if null_safe else df[column] == keys["_ref"]
        return df.join(keys, match, "left_anti")

    return step


def present_in(reference: DataFrame, column: str, ref_column: str) -> Step:
    """Rows whose value occurs in the reference column."""
    keys = reference.select(F.col(ref_column).alias("_ref"))
    return lambda df: df.join(keys, df[column] == keys["_ref"], "left_semi")


def keep_first(keys: Sequence[str], order: Sequence[str]) -> Step:
    """First row per key in the given order. The rank limit is applied before the shuffle, so hot keys stay small."""

    def step(df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

    return step


def _summary(value: str, counted: str, category: str) -> list[Column]:
    return [
        F.coalesce(F.sum(value), F.lit(0)).alias("sum_per_group"),
        F.avg(value).alias("avg_per_group"),
        F.count(counted).alias("count_per_group"),
        F.countDistinct(category).alias("unique_per_group"),
    ]


def group_summary(group: str, value: str, counted: str, category: str) -> Step:
    """Sum, mean, non-missing count and distinct count per group; rows without a group are left out."""
    return lambda df: df.where(F.col(group).isNotNull()).groupBy(group).agg(*_summary(value, counted, category))


def with_group_summary(group: str, value: str, counted: str, category: str) -> Step:
    """The same statistics on every row.

    Aggregated once and joined back: a window would hold a whole hot group in one task.
    """

    def step(df: DataFrame) -> DataFrame:
        return join_small(df, group_summary(group, value, counted, category)(df), [group])

    return step


def group_means(keys: Sequence[str], columns: Sequence[str]) -> Step:
    return lambda df: df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def sort_rows(*by: tuple[str, bool]) -> Step:
    """Sort by (column, ascending) pairs, missing values last either way."""
    keys = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in by]
    return lambda df: df.orderBy(*keys)


def best_rows(score: str, name: str, k: int = 1) -> Step:
    """Rows with the k highest scores, ties by name."""
    return lambda df: df.orderBy(F.col(score).desc_nulls_last(), F.col(name).asc()).limit(k)


def sample_rows(n: int, *keys: str, seed: int = 42) -> Step:
    """Exactly n rows in a pseudo-random order taken from the key."""
    from millrace.functions.keys import key_hash

    return lambda df: df.orderBy(key_hash(*keys, seed=seed), *keys).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, absent ones filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def values_missing_from(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Distinct expected rows that were not observed."""
    return expected.subtract(observed)


def column_changes(before: Sequence[str], after: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns in exactly one of two schemas, and columns in both."""
    a, b = set(before), set(after)
    return sorted(a ^ b), sorted(a & b)
