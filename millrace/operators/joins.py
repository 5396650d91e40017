"""Joins that lose no row to a missing key, and joins with tables whose size is counted first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from millrace.session import materialise

SHIPPED_ROWS = 200_000


def join_null_safe(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", shipped: bool = False) -> DataFrame:
    """Join on equally named keys where a missing key equals a missing key; key columns come from `df`."""
    rest = [c for c in table.columns if c not in keys]
    side = table.select(*[F.col(k).alias(f"_on_{i}") for i, k in enumerate(keys)], *rest)
    side = F.broadcast(side) if shipped else side
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_on_{i}")) for i, k in enumerate(keys)])
    joined = df.join(side, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{i}" for i in range(len(keys))])


def join_small(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", shipped_rows: int = SHIPPED_ROWS) -> DataFrame:
    """Null-safe join with a reduced table, for example of classes.

    The table is stored and counted. Up to `shipped_rows` rows are broadcast, so the big side is not shuffled on a key of few
    values; beyond that it is an ordinary join, whose skewed partitions are split at run time.
    """
    stored = materialise(table, "small")
    return join_null_safe(df, stored, keys, how, shipped=stored.count() <= shipped_rows)
