"""Deterministic pseudo-random numbers taken from row keys.

Partition layout, retries and lost executors cannot change them, and any SQL engine with md5 can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 52


def key_hash(*keys: str | Column, seed: int | str = 42) -> Column:
    """A 52-bit non-negative integer from the row key and a seed."""
    text = F.concat_ws("_", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    digest = F.md5(F.concat(text, F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def key_uniform(*keys: str | Column, seed: int | str = 42) -> Column:
    """A number in [0, 1) from the row key and a seed."""
    return key_hash(*keys, seed=seed).cast("double") / F.lit(float(2**HASH_BITS))
