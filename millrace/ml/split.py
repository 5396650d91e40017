"""Deterministic shuffles, train/test splits and fold numbers.

A "random" order is the order of a hash of the row key (then the key), so a split never depends on partitioning.
Ranks in that order need no sort of the whole table or of a whole class: the hash range is cut into equal parts,
rows are ranked inside a part, and the number of rows in earlier parts is added from a small count table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.keys import HASH_BITS, key_hash
from millrace.operators.joins import join_null_safe, join_small
from millrace.operators.ordered import ROWS_PER_SLICE, row_index
from millrace.session import materialise

# The hash range is cut into parts of equal width; hashes are uniform, so parts are equally full. There are 2**PART_BITS of
# them, or as many more as keep them at ROWS_PER_PART rows; their number does not change any rank.
PART_BITS = 12
ROWS_PER_PART = 1_000_000
CHUNK = 10_000


def hash_prefix(
    df: DataFrame, key: str, sums: dict[str, Column], within: Sequence[str] = (), seed: int | str = 42
) -> DataFrame:
    """Running sums (own row included) in key-hash order, separately for each `within` value. Keys must be unique."""
    h = key_hash(key, seed=seed)
    rows = df.count()
    bits = max(PART_BITS, math.ceil(math.log2(max(1, rows) / ROWS_PER_PART)))
    base = df.withColumns({"_h": h, "_part": F.shiftright(h, HASH_BITS - bits).cast("bigint")})
    totals = base.groupBy(*within, "_part").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*within, "_part", *[
        F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_c_{o}") for o in sums])
    inner = Window.partitionBy(*within, "_part").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, 0)
    running = base.select("*", *[F.sum(c).over(inner).alias(f"_r_{o}") for o, c in sums.items()])
    joined = join_small(running, carry, [*within, "_part"])
    return joined.select(
        *df.columns, *[(F.col(f"_r_{o}") + F.col(f"_c_{o}")).alias(o) for o in sums])


def hash_rank(df: DataFrame, key: str, within: Sequence[str] = (), seed: int | str = 42, out: str = "hash_rank") -> DataFrame:
    """One-based rank of each row in key-hash order."""
    return hash_prefix(df, key, {out: F.lit(1).cast("bigint")}, within, seed)


def train_test_split(
    df: DataFrame, key: str, test_size: float = 0.2, stratify: str | None = None, seed: int | str = 42,
    out: str = "is_test",
) -> DataFrame:
    """Mark ceil(test_size * n) rows as test rows, of the whole table or of every class; a missing class is a class."""
    share = F.lit(float(test_size))
    if stratify is None:
        total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        ranked = hash_rank(df, key, seed=seed, out="_rank")
        return ranked.withColumn(out, F.col("_rank") <= F.ceil(share * total)).drop("_rank")
    sizes = df.groupBy(stratify).agg(F.count(F.lit(1)).alias("_n"))
    ranked = join_small(hash_rank(df, key, [stratify], seed, "_rank"), sizes, [stratify])
    return ranked.withColumn(out, F.col("_rank") <= F.ceil(share * F.col("_n"))).select(*df.columns, out)


def kfold(df: DataFrame, key: str, k: int = 5, stratify: str | None = None, seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1; folds (of every class, when stratified) differ by at most one row."""
    ranked = hash_rank(df, key, [stratify] if stratify else (), seed, "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def group_kfold_by_hash(df: DataFrame, group: str, k: int = 5, seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Fold from a hash of the group: no shuffle, groups stay together, sizes are balanced on average."""
    return df.withColumn(out, F.pmod(key_hash(group, seed=seed), F.lit(k)).cast("int"))


def _dealt(sizes: list[tuple[int, int]], k: int) -> list[tuple[int, int, list[int], list[int]]]:
    """Greedy placement of groups, given (size, how many groups) from the largest size on.

    Each group goes to the lightest fold so far, the lowest on ties. For every size: (size, groups, fold loads before, groups
    each fold gets). Groups of one size go to the folds in the order of load + j * size, so only their number per fold counts.
    """
    loads, out = [0] * k, []
    for size, many in sizes:
        low, high = min(loads), max(loads) + size * (many + 1)
        while low < high:  # the largest load up to which at most `many` groups start
            level = (low + high + 1) // 2
            if sum(max(0, -((load - level) // size)) for load in loads) <= many:
                low = level
            else:
                high = level - 1
        got = [max(0, -((load - low) // size)) for load in loads]
        for f in range(k):  # the rest starts at exactly that load, in order of the folds
            if sum(got) < many and loads[f] + got[f] * size == low:
                got[f] += 1
        out.append((size, many, list(loads), got))
        loads = [load + n * size for load, n in zip(loads, got)]
    return out


def group_kfold(df: DataFrame, group: str, k: int = 5, seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Groups from the largest to the smallest, equal ones in key-hash order, go to the lightest fold so far.

    Only the table of distinct group sizes comes to the driver (n rows have fewer than sqrt(2n)); which fold the i-th group of
    a size gets is computed for all groups at once. A missing group is a group.
    """
    spark = df.sparkSession
    sizes = materialise(df.groupBy(group).agg(F.count(F.lit(1)).alias("_size")), "groups")
    counted = sorted(((r["_size"], r["count"]) for r in sizes.groupBy("_size").count().collect()), reverse=True)
    plan = [(size, f, n, loads) for size, _, loads, got in _dealt(counted, k) for f, n in enumerate(got) if n]
    table = spark.createDataFrame(plan, "_size bigint, _placed int, _n bigint, _loads array<bigint>")
    chunks = table.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_n - 1) div {CHUNK})")))
    start = F.col("_chunk") * CHUNK
    turns = chunks.repartition("_size", "_placed", "_chunk").withColumn(
        "_j", F.explode(F.sequence(start, F.least(start + CHUNK, F.col("_n")) - 1)))
    # How many groups of the size go before the j-th one of this fold: for each fold those at a lower load, on ties those of
    # lower folds.
    ahead = "(_at - if(g < _placed, 0L, 1L) - element_at(_loads, g + 1))"
    before = f"aggregate(sequence(0, size(_loads) - 1), 0L, (t, g) -> t + if({ahead} < 0, 0L, {ahead} div _size + 1))"
    turns = turns.withColumn("_at", F.expr("element_at(_loads, _placed + 1) + _j * _size")).select(
        "_size", "_placed", (F.expr(before) + 1).alias("_rank"))
    ranked = hash_rank(sizes, group, ["_size"], seed, "_rank")
    placed = ranked.join(turns, ["_size", "_rank"]).select(group, F.col("_placed").alias(out))
    return join_null_safe(df, placed, [group]).select(*df.columns, out)


def expanding_folds(
    df: DataFrame, time: str, key: str, k: int = 5, test_size: int | None = None, out: str = "block",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Block number by time: fold f = 1..k trains on blocks below f and validates on block f.

    Without `test_size` the blocks hold n // (k + 1) rows, the oldest rest is block 0.
    """
    n = df.agg(F.count(F.lit(1)).alias("n"))
    size = n.select(F.lit(test_size).cast("bigint") if test_size else F.floor(F.col("n") / (k + 1))).scalar()
    placed = row_index(df, time, key, "_pos", rows_per_slice)
    from_end = F.floor((n.scalar() - 1 - F.col("_pos")) / size)
    return placed.withColumn(out, F.greatest(F.lit(0), F.lit(k) - from_end).cast("int")).drop("_pos")


def fold_pair(df: DataFrame, fold: int, column: str = "fold", expanding: bool = False) -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) of one fold."""
    train = F.col(column) < fold if expanding else F.col(column) != fold
    return df.where(train), df.where(F.col(column) == fold)
